"""Words of whole texts as arrays: bounds, documents and 64-bit fingerprints, without a Python loop over words.

A word is a longest run of characters other than the six ASCII blanks (tab, line feed, vertical tab, form feed,
carriage return, space). All functions take a list of texts, of which None counts as empty.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Upper-case ASCII letters to lower-case ones, all other bytes to themselves.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_LONG = 512
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit values that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= _B
    x ^= x >> np.uint64(27)
    x *= _C
    x ^= x >> np.uint64(31)
    return x


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Fingerprint of two adjoining sequences from the fingerprints of both."""
    return mix(left * _A + (right ^ (right >> np.uint64(29))) * _C + _B)


@dataclass
class Words:
    """Words of some texts. `start`, `end`: bytes in `data`; `first[d]`, `first[d + 1]`: the words of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    text_at: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def fingerprints(self) -> np.ndarray:
        """64-bit fingerprint of each word's bytes."""
        length = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        loads = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
        out = length.astype(np.uint64) * _A
        out = mix(out ^ (loads[self.start] & _MASKS[np.minimum(length, 8)]))
        at = np.flatnonzero((length > 8) & (length <= _LONG))
        done = 8
        while len(at):
            rest = length[at] - done
            out[at] = mix(out[at] * _A ^ (loads[self.start[at] + done] & _MASKS[np.minimum(rest, 8)]))
            done += 8
            at = at[rest > 8]
        for k in np.flatnonzero(length > _LONG):
            word = self.data[self.start[k]:self.end[k]].tobytes()
            out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def split(texts: list[str | None], lower: bool = False, between: np.ndarray = BLANK) -> Words:
    """All words of `texts`, in order. `between`: which of the 256 bytes part words (a line feed must be one)."""
    parts = [b"" if text is None else text.encode("utf-8", "surrogatepass") for text in texts]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    if lower:
        data = LOWER[data]
    text_at = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum(sizes + 1, out=text_at[1:])
    blank = np.ones(len(data) + 1, dtype=bool)
    blank[1:] = between[data]
    turns = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = turns[0::2], turns[1::2]
    first = np.searchsorted(start, text_at)
    doc = np.repeat(np.arange(len(parts), dtype=np.int64), np.diff(first))
    return Words(data, start, end, doc, first, text_at)


def sequences(words: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of every run of `length` fingerprints; entry i starts at word i. Shorter input: empty."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, taken, block, width = None, 0, words, 1
    while True:
        if length & width:
            piece = block[taken:taken + count]
            out = piece if out is None else chain(out, piece)
            taken += width
        if taken == length:
            return mix(out + np.uint64(length))
        block = chain(block[:-width], block[width:])
        width *= 2


def split_batches(texts: list[str | None], most_bytes: int):
    """Index ranges of `texts` that hold about `most_bytes` characters each (one text at least)."""
    begin, held = 0, 0
    for k, text in enumerate(texts):
        size = 0 if text is None else len(text)
        if k > begin and held + size > most_bytes:
            yield begin, k
            begin, held = k, 0
        held += size
    if begin < len(texts):
        yield begin, len(texts)
