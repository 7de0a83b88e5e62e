"""Removal of word sequences that occur more than once in a corpus, found through difference-cover anchors.

A *window* is `window` consecutive words of one text. A word is removed if any window over it also starts at another
place, in the same or another document. Windows are judged on the input.

Method. Positions of a text are taken modulo 21; the residues 3, 6, 7, 12, 14 form a perfect difference cover: for any
two places i and j there is a shift below 21 that puts both on covered residues. So two equal windows share an equal
*anchor* (a run of `window - 20` words) that starts on covered positions of both. Only anchors at covered positions,
5 of 21, are compared across the corpus. A repeated anchor is then extended: the windows over it are
the only ones that can be repeated, and those are compared by 128 bits over the 64-bit fingerprints of all their words.

Scale. Equal texts are merged first and counted, within each task before the shuffle, so a text that makes up a third of
the rows is one row afterwards. Fingerprints travel packed per task and group. A fingerprint that is repeated within a batch
is known to be repeated; one copy of it is sent on, so a passage that stands in every document
costs one entry for each batch instead of one for each occurrence. Nothing is collected to the driver.

Edge cases. Null and empty texts: no words, nothing removed, the hash of the empty string. Texts below `window` words:
unchanged. Repeated rows and repeated or null ids: one result row for each input row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.storage import Scratch
from casemart.llm.texts import distinct_texts, text_key
from casemart.llm.words import sequences, split, split_batches

#: A perfect difference cover of the integers modulo 21.
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
_COVERED = np.isin(np.arange(PERIOD), COVER)
_CHUNK = 4 << 20
_BUCKET = 16 << 20  # bytes of text whose places one task gathers

_SENT = "group int, first binary, second binary, doc binary, position binary, keys binary, own boolean"
_FOUND = "bucket int, keys binary, sizes binary, positions binary"
_PLACES = "key binary, positions binary"
_SENT_ARROW = pa.schema([
    ("group", pa.int32()), ("first", pa.binary()), ("second", pa.binary()), ("doc", pa.binary()), ("position", pa.binary()),
    ("keys", pa.binary()), ("own", pa.bool_()),
])
_FOUND_ARROW = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("positions", pa.binary())])
_RESULT_ARROW = pa.schema([
    ("key", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()),
])


def _pack(groups: int, first, second, doc, position, keys: list[bytes]) -> pa.RecordBatch | None:
    """Fingerprints of a batch as one packed row for each group: one entry for each value; and what repeats right here."""
    if not len(first):
        return None
    order = np.lexsort((second, first))
    first, second, doc, position = first[order], second[order], doc[order], position[order]
    same = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
    repeated = np.zeros(len(first), dtype=bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    once = np.concatenate([[True], ~same])
    packed_keys = b"".join(keys)
    rows = []

    def add(chosen: np.ndarray, group: int, own: bool) -> None:
        used, local = np.unique(doc[chosen], return_inverse=True)
        names = b"".join(packed_keys[16 * d:16 * d + 16] for d in used)
        empty = own
        rows.append((
            group, b"" if empty else first[chosen].tobytes(), b"" if empty else second[chosen].tobytes(),
            local.astype(np.uint32).tobytes(), position[chosen].astype(np.uint32).tobytes(), names, own,
        ))

    place = (first[once] >> np.uint64(17)) % np.uint64(groups)
    at = np.flatnonzero(once)
    by_place = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[by_place], np.arange(groups + 1))
    for group in range(groups):
        chosen = at[by_place[bounds[group]:bounds[group + 1]]]
        if len(chosen):
            add(chosen, group, False)
    if repeated.any():
        chosen = np.flatnonzero(repeated)
        add(chosen, int(place[0]), True)
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), _SENT_ARROW, strict=True)],
                                      schema=_SENT_ARROW)


def _found_rows(doc: np.ndarray, position: np.ndarray, keys: bytes, buckets: int) -> Iterator[tuple]:
    """Places in texts, packed for each bucket of texts: the keys, how many places each has, and the places."""
    order = np.lexsort((position, doc))
    doc, position = doc[order], position[order].astype(np.uint32)
    bounds = np.append(np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])), len(doc))
    used = doc[bounds[:-1]]
    names = np.frombuffer(keys, dtype="V16")[used]
    bucket = np.frombuffer(keys, dtype=np.uint32)[4 * used] % buckets
    for b in np.unique(bucket):
        mine = np.flatnonzero(bucket == b)
        sizes = (bounds[mine + 1] - bounds[mine]).astype(np.uint32)
        yield int(b), names[mine].tobytes(), sizes.tobytes(), np.concatenate([position[bounds[k]:bounds[k + 1]] for k in mine]).tobytes()


def _resolver(buckets: int):
    def resolve(table: pa.Table) -> pa.Table:
        """Of one group: the places of all fingerprints that came from more than one batch, and those known before."""
        first, second, doc, position, keys, found = [], [], [], [], [], []
        offset = 0
        for row in table.to_pylist():
            local, at = np.frombuffer(row["doc"], np.uint32).astype(np.int64), np.frombuffer(row["position"], np.uint32)
            if row["own"]:
                found += _found_rows(local, at, row["keys"], buckets)
                continue
            first.append(np.frombuffer(row["first"], np.uint64))
            second.append(np.frombuffer(row["second"], np.uint64))
            doc.append(local + offset)
            position.append(at)
            keys.append(row["keys"])
            offset += len(row["keys"]) // 16
        if first:
            h1, h2 = np.concatenate(first), np.concatenate(second)
            order = np.lexsort((h2, h1))
            h1, h2 = h1[order], h2[order]
            same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
            chosen = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
            if len(chosen):
                # a text stands in many batches' rows under numbers of their own: one number each
                names, number = np.unique(np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2), axis=0, return_inverse=True)
                found += _found_rows(number.ravel()[np.concatenate(doc)[chosen]], np.concatenate(position)[chosen], names.tobytes(), buckets)
        columns = list(zip(*found)) or [[]] * len(_FOUND_ARROW)
        return pa.table([pa.array(list(column), field.type) for column, field in zip(columns, _FOUND_ARROW)], schema=_FOUND_ARROW)
    return resolve


def _gather(table: pa.Table) -> pa.Table:
    """Of one bucket of texts: one row for each text with all its places."""
    keys, sizes, positions = (b"".join(table.column(name).to_pylist()) for name in ("keys", "sizes", "positions"))
    names, number = np.unique(np.frombuffer(keys, "<u8").reshape(-1, 2), axis=0, return_inverse=True)
    doc = np.repeat(number.ravel(), np.frombuffer(sizes, np.uint32))
    position = np.frombuffer(positions, np.uint32)
    order = np.lexsort((position, doc))
    position, ends = position[order], np.cumsum(np.bincount(doc, minlength=len(names)))
    packed = [position[low:high].tobytes() for low, high in zip(np.concatenate([[0], ends[:-1]]), ends)]
    return pa.table({"key": pa.array([name.tobytes() for name in names], pa.binary()), "positions": pa.array(packed, pa.binary())})


def _positions(packed: bytes | None) -> np.ndarray:
    return np.frombuffer(packed or b"", np.uint32).astype(np.int64)


class _Finder:
    """Functions over batches of (key, text[, packed positions]); picklable by reference."""

    def __init__(self, window: int, groups: int):
        self.window, self.groups, self.anchor = window, groups, window - (PERIOD - 1)

    def _sent(self, batches, fingerprints):
        for batch in batches:
            rows = batch.to_pydict()
            h1, h2, docs, positions, keys, offset = [], [], [], [], [], 0
            for begin, end in split_batches(rows["text"], _CHUNK):
                words = split(rows["text"][begin:end])
                f = words.fingerprints()
                at, a, b = fingerprints(words, f, rows, begin)
                h1.append(a)
                h2.append(b)
                docs.append(words.doc[at] + begin)
                positions.append(at - words.first[words.doc[at]])
            if h1:
                out = _pack(self.groups, *map(np.concatenate, (h1, h2, docs, positions)), rows["key"])
                if out is not None:
                    yield out

    def anchors(self, batches):
        """Anchors at covered positions."""
        def of(words, f, rows, begin):
            h = sequences(f, self.anchor)
            at = np.arange(len(h))
            doc = words.doc[:len(h)]
            inside = (doc == words.doc[self.anchor - 1:]) & _COVERED[(at - words.first[doc]) % PERIOD]
            at = at[inside & (np.diff(words.first)[doc] >= self.window)]
            return at, h[at], np.zeros(len(at), dtype=np.uint64)  # 64 bits are enough to propose windows
        return self._sent(batches, of)

    def windows(self, batches):
        """Windows over repeated anchors."""
        def of(words, f, rows, begin):
            h = sequences(f, self.window)
            if not len(h):
                return np.zeros(0, np.int64), h, h
            wanted = np.zeros(len(words) + 1, dtype=np.int64)
            for d, packed in enumerate(rows["positions"][begin:begin + len(words.first) - 1]):
                p = words.first[d] + _positions(packed)
                low = np.maximum(p - (self.window - self.anchor), words.first[d])
                np.add.at(wanted, low, 1)
                np.add.at(wanted, p + 1, -1)
            over = np.cumsum(wanted)[:len(h)] > 0
            at = np.flatnonzero(over & (words.doc[:len(h)] == words.doc[self.window - 1:]))
            other = sequences(f * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1), self.window)
            return at, h[at], other[at]
        return self._sent(batches, of)

    def removed(self, batches):
        """Result for each text: what is left after the removal of all words under repeated windows."""
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for begin, end in split_batches(rows["text"], _CHUNK):
                words = split(rows["text"][begin:end])
                for d in range(end - begin):
                    low, high = words.first[d], words.first[d + 1]
                    count = high - low
                    marks = np.zeros(count + 1, dtype=np.int64)
                    if rows["copies"][begin + d] > 1 and count >= self.window:
                        marks[0] = 1
                    else:
                        p = _positions(rows["positions"][begin + d])
                        np.add.at(marks, p, 1)
                        np.add.at(marks, p + self.window, -1)
                    keep = np.flatnonzero(np.cumsum(marks[:-1]) == 0) + low
                    # runs of kept words; inside a run the text is taken word by word so that blanks become one space
                    kept = b" ".join([words.data[s:e].tobytes() for s, e in zip(words.start[keep].tolist(), words.end[keep].tolist())])
                    out.append((rows["key"][begin + d], int(count), int(count - len(keep)), hashlib.sha256(kept).hexdigest(),
                                kept.decode("utf-8", "surrogatepass")))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*out), _RESULT_ARROW)],
                                                 schema=_RESULT_ARROW)

    def digests(self, batches):
        """As `removed`, without the texts."""
        for batch in self.removed(batches):
            yield batch.select(["key", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, window: int = 35, id_column: str = "doc_id", text_column: str = "text",
                   with_text: bool = False) -> DataFrame:
    """One row for each row of `docs`: its id, `n_words`, `n_removed`, `kept_sha256` (and `kept_text`).

    `window` is at least 21 words. Runs jobs; the result is read from a stored table.
    """
    if window < PERIOD:
        raise ValueError(f"window must be at least {PERIOD}")
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    keyed = docs.select(F.col(id_column).alias("id"), text_key(F.col(text_column)).alias("key"))
    texts = scratch.store(distinct_texts(docs, text_column), "texts")
    counted = texts.groupBy("key").agg(F.sum("copies").alias("copies"))
    texts = texts.where("text IS NOT NULL").select("key", "text")

    # groups of windows and buckets of texts hold as much at any size of input
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-length // _BUCKET))
    find, resolve = _Finder(window, 2 * buckets), _resolver(buckets)

    def places(sent: DataFrame, table: str) -> DataFrame:
        found = sent.groupBy("group").applyInArrow(resolve, _FOUND)
        return scratch.store(found.groupBy("bucket").applyInArrow(_gather, _PLACES), table)

    candidates = places(texts.mapInArrow(find.anchors, _SENT), "candidates")
    over = texts.join(candidates, "key").select("key", "text", "positions")
    repeated = places(over.mapInArrow(find.windows, _SENT), "repeated")
    scratch.drop("candidates")
    known = counted.join(repeated, "key", "left")
    joined = texts.join(known, "key").select("key", "copies", "text", "positions")
    schema = "key binary, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text
    results = scratch.store(joined.mapInArrow(find.removed if with_text else find.digests, schema), "results")
    scratch.drop("texts", "repeated")
    columns = [F.col("id").alias(id_column), "n_words", "n_removed", "kept_sha256"] + [F.col("kept").alias("kept_text")] * with_text
    return keyed.join(results, "key").select(*columns)
