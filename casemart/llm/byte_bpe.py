"""Byte-level BPE: encoding whole texts by a file of ranks, and decoding ids, without a merge loop over the text.

A text is cut by the vocabulary's pattern; each match is encoded by itself, without special tokens.

Method. Bytes stand as Latin-1 characters, so that an Aho-Corasick automaton over all tokens gives the longest token at any place. The encoder goes on with the
longest token there and falls back to its next shorter prefix that is a token. A token may follow another only if merging the bytes of both by rank gives just
these two; the answers are kept. A place from which nothing fits is marked, and the token before it is taken back. A sequence of tokens
is what merging by rank gives if and only if each token follows its neighbour so: a merge across a border would show
in the two tokens beside it, and merges inside of them don't depend on the rest. So each prefix has one encoding, a place is given up once at most, and
the work is linear in the text. Decoding joins the bytes of ids.

The pattern's classes (letters, numbers, blanks) are those of the tokenizer library's own Unicode tables, asked from the library once for each worker
process, since tables of different libraries are of different years.

Scale. One pass over whole texts without a shuffle. Kept answers and kept pieces are bounded (cleared when full), and batches leave a task after
`_BATCH` characters. A worker process builds the automaton once.

Edge cases. Null and empty texts have no ids and decode to no bytes. Repeated rows and ids, also null ones, each get a row. Special tokens' strings are plain
text. Runs of millions of blanks or letters are one piece like any other. Without rows, no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.words import split_batches

_BATCH = 2 << 20
_KEPT = 1 << 19
_SHORT = 64
#: Texts by their highest character: classes are cut there, since small classes match faster.
_HIGHEST = (0x7F, 0xFFFF, 0x10FFFF)
_BEYOND_BMP = re.compile("[\U00010000-\U0010ffff]")


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    """Bytes of each token and its rank, which is its id."""
    with open(vocabulary, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _members(name: str) -> list[tuple[int, int]]:
    """Ranges of the characters of a class such as `\\p{L}` in the tokenizer library's tables."""
    import tiktoken

    keep = tiktoken.Encoding("members", pat_str=f"{name}+", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    known = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    found = np.frombuffer(keep.decode(keep.encode_ordinary(known)).encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.flatnonzero(np.diff(found) != 1)
    return list(zip(found[np.r_[0, ends + 1]].tolist(), found[np.r_[ends, len(found) - 1]].tolist(), strict=True))


def _in_class(ranges: list[tuple[int, int]], highest: int) -> str:
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(min(b, highest)))}" for a, b in ranges if a <= highest)


@lru_cache(maxsize=4)
def piece_patterns(pattern: str) -> tuple[re.Pattern, ...]:
    """The pattern with its classes written out, for texts up to each of the highest characters."""
    ranges = {name: _members(name) for name in (r"\p{L}", r"\p{N}", r"\s")}
    made = []
    for highest in _HIGHEST:
        inner = {name: _in_class(of, highest) for name, of in ranges.items()}
        spelled = re.sub(r"\[\^((?:\\s|\\p\{[LN]\})+)\]", lambda m: "[^" + "".join(inner[n] for n in re.findall(r"\\s|\\p\{[LN]\}", m[1])) + "]", pattern)
        for name, of in inner.items():
            spelled = spelled.replace(name, f"[{of}]")
        made.append(re.compile(spelled.replace(r"\S", f"[^{inner[chr(92) + 's']}]")))
    return tuple(made)


class _Kept(dict):
    """Answers of a function, forgotten when there are too many."""

    def __init__(self, function, small=lambda key: True):
        super().__init__()
        self.function, self.small = function, small

    def __missing__(self, key):
        value = self.function(key)
        if self.small(key):
            if len(self) >= _KEPT:
                self.clear()
            self[key] = value
        return value


class ByteBpe:
    """One vocabulary: `encode` and `decode`."""

    def __init__(self, vocabulary: str, pattern: str):
        import ahocorasick

        ranks = read_ranks(vocabulary)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.ids = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens = ahocorasick.Automaton()
        for token, rank in self.ids.items():
            self.bytes_of[rank] = token.encode("latin-1")
            self.tokens.add_word(token, token)
        self.tokens.make_automaton()
        self.longest = max(map(len, self.ids))
        self.patterns = piece_patterns(pattern)
        self.follows = _Kept(self._follows)
        self.made = _Kept(lambda token: self.merged(token) == [token])
        self.halves, self.rising = _Kept(lambda token: self.merged(token, 2)), _Kept(self._rising)
        self.shorter = _Kept(self._shorter)
        self.pieces = _Kept(self.encode_piece, lambda piece: len(piece) <= _SHORT)

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merging by rank, as it is defined, until `least` parts are left: the adjoining pair of lowest rank first, the leftmost of equal ones.

        For the bytes of one token or two.
        """
        parts = list(text)
        while True:
            if len(parts) <= least:
                return parts
            known = [(self.ids[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ids]
            if not known:
                return parts
            k = min(known)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def _rising(self, token: str) -> bool:
        """Whether each part of a token has a lower rank than the whole, so that ranks are the order in time of all its merges."""
        return len(token) == 1 or all(self.rising[half] and (len(half) == 1 or self.ids[half] < self.ids[token]) for half in self.halves[token])

    def _follows(self, pair: tuple[str, str]) -> bool:
        """Whether merging the bytes of two tokens gives just these two.

        What stands on both sides of the border is followed back in time, by undoing the later merge first: nothing may join across the border
        before one of the two is merged away from it.
        """
        left, right = pair
        if not (self.rising[left] and self.rising[right]):
            return self.merged(left + right) == [left, right]
        left_ends = right_ends = len(self.bytes_of)
        while True:
            across = self.ids.get(left + right)
            if across is not None and across < left_ends and across <= right_ends:
                return False
            left_made = self.ids[left] if len(left) > 1 else -1
            right_made = self.ids[right] if len(right) > 1 else -1
            if left_made > right_made:
                left_ends, left = left_made, self.halves[left][1]
            elif right_made >= 0:
                right_ends, right = right_made, self.halves[right][0]
            else:
                return True

    def _shorter(self, token: str) -> str | None:
        """The longest token that is a proper prefix and that merging can give."""
        ends = (token[:n] for n in range(len(token) - 1, 0, -1))
        return next((end for end in ends if end in self.ids and self.made[end]), None)

    def _at(self, text: str, place: int) -> str | None:
        """The longest token at a place that merging can give."""
        token = next(self.tokens.iter_long(text[place:place + self.longest]))[1]
        return token if self.made[token] else self.shorter[token]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one match of the pattern."""
        text = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        if text in self.ids:
            return (self.ids[text],)
        given_up, out, place, size = bytearray(len(text) + 1), [], 0, len(text)
        token = self._at(text, 0)
        while True:
            while token is not None and (given_up[place + len(token)] or out and not self.follows[out[-1], token]):
                token = self.shorter[token]
            if token is None:  # nothing leads on from here: take the token before back
                given_up[place] = 1
                token = out.pop()
                place -= len(token)
                continue
            out.append(token)
            place += len(token)
            if place == size:
                return tuple(self.ids[t] for t in out)
            token = self._at(text, place)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        kind = 0 if text.isascii() else 2 if _BEYOND_BMP.search(text) else 1
        return np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, self.patterns[kind].findall(text))), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def byte_bpe(vocabulary: str, pattern: str) -> ByteBpe:
    """A worker process's encoder."""
    return ByteBpe(vocabulary, pattern)


class _Encoder:
    def __init__(self, vocabulary: str, pattern: str):
        self.vocabulary, self.pattern = vocabulary, pattern

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) to ids and the bytes that they decode to."""
        bpe = byte_bpe(self.vocabulary, self.pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in split_batches(texts, _BATCH):
                ids = [bpe.encode(text or "") for text in texts[begin:end]]
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                values = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin), pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    pa.array([bpe.decode(x) for x in ids], pa.binary())], names=["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids and decoded (the bytes that the ids stand for) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_Encoder(vocabulary, pattern), f"doc_id {kind}, ids array<int>, decoded binary")


def encoding_report(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, the number of ids, and digests of the ids and of what they decode to."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encode_documents(docs, vocabulary, pattern).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
