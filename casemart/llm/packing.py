"""Packing of tokenised documents into sequences: best fit, then local search by moves and swaps.

A document's tokens are its ids and one end id. Longer ones than `capacity` are cut into full pieces, behind a first piece that may be
shorter. Full pieces are sequences of their own; the others are packed.

Method. Within a group, pieces go by falling length into the fullest sequence that holds them. Local search then works on sequences
that aren't full: the emptiest one gives pieces away by moves, one-for-one and two-for-one exchanges, as long as
the sum of squared fills grows, until it is empty or nothing helps; then comes the next emptiest one, until no sequence
can give anything away or no fewer sequences could hold all pieces. Sequences that stay clearly underfull are opened, and their
pieces are packed once more in groups of such leftovers.

Scale. Tokenising is one pass over whole texts without a shuffle; only pieces (ids, lengths, checksums) move. Groups
are drawn by hash and hold about `group_size` pieces at any size of input, so no task grows and hot sources don't matter. Groups of
20,000 pieces waste less than one sequence each before leftovers are packed together.

Edge cases. Null and empty texts are one end id. Repeated rows are documents of their own. A null doc_id stays null. Special tokens'
strings in a text count as the tokenizer's own special tokens. Without rows, no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.storage import Scratch

_PIECES = "doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


def load_encoding(vocabulary: str):
    """The byte-level BPE of a file of ranks (base64 token, rank). It gives the same ids as the vocabulary's JSON form, four times faster."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


class _Tokenizer:
    """Ids of a text by the file of ranks. Texts on which its regular expressions give up (about a million blanks in a row) go through the JSON form."""

    def __init__(self, vocabulary: str):
        self.encoding, self.plain = load_encoding(vocabulary), None
        self.json = vocabulary.removesuffix(".tiktoken") + ".json"

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            if self.plain is None:
                from tokenizers import Tokenizer

                self.plain = Tokenizer.from_file(self.json)
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


class _Cutter:
    def __init__(self, vocabulary: str, capacity: int, end_id: int):
        self.vocabulary, self.capacity, self.end_id = vocabulary, capacity, end_id

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) to pieces."""
        encode = _Tokenizer(self.vocabulary)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), self.end_id).astype("<u4")
                at, end = 0, len(ids) % self.capacity or self.capacity
                number = 0
                while at < len(ids):
                    row.append(k)
                    piece.append(number)
                    start.append(at)
                    length.append(end - at)
                    crc.append(zlib.crc32(ids[at:end].tobytes()))
                    at, end, number = end, end + self.capacity, number + 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def pack(lengths: list[int], capacity: int, passes: int | None = None) -> list[list[int]]:
    """Bins of item numbers: best fit by falling length, then local search."""
    free_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins, free = 0, [], []
    for item in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        size = lengths[item]
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = free_bins[room].pop()
            if not free_bins[room]:
                mask &= ~(1 << room)
        else:
            b, room = len(bins), capacity
            bins.append([])
            free.append(capacity)
        bins[b].append(item)
        free[b] = room - size
        if free[b]:
            free_bins[free[b]].append(b)
            mask |= 1 << free[b]
    return [b for b in _local_search(bins, free, lengths, capacity, passes) if b]


class _Underfull:
    """The bins that local search works on: room, and the lengths of single items and of pairs, one row for each bin (padded with 0: nothing)."""

    def __init__(self, bins: list[list[int]], free: list[int], lengths: list[int], capacity: int):
        self.bins, self.free, self.lengths, self.capacity = bins, free, lengths, capacity
        self.numbers = [b for b in range(len(bins)) if bins[b] and free[b]]
        self.room = np.zeros(len(self.numbers), dtype=np.int64)
        self.live = np.ones(len(self.numbers), dtype=bool)
        self.one, self.two = np.zeros((len(self.numbers), 1), np.int32), np.zeros((len(self.numbers), 1), np.int32)
        # by length and bin: whether a single item, or a pair, of that length fills the bin by a step
        self.by_one, self.by_two = (np.zeros((capacity + 1, len(self.numbers)), dtype=bool) for _ in range(2))
        for row in range(len(self.numbers)):
            self.refresh(row)

    def refresh(self, row: int) -> None:
        """Read a bin again after a change."""
        b = self.numbers[row]
        self.room[row], self.live[row] = self.free[b], bool(self.bins[b]) and self.free[b] > 0
        sizes = sorted(self.lengths[i] for i in self.bins[b])
        kept = [x for k, x in enumerate(sizes) if k < 2 or sizes[k - 2] != x]
        singles, pairs = sorted(set(kept)), sorted({x + y for k, x in enumerate(kept) for y in kept[k + 1:]})
        self.one, self.two = self._put(self.one, row, singles), self._put(self.two, row, pairs)
        room, fits = self.free[b], np.zeros(self.capacity + 1, dtype=bool)
        for take in (0, *singles):
            fits[take + 1:take + room + 1] = True
        self.by_two[:, row] = fits
        for take in pairs:
            fits[take + 1:take + room + 1] = True
        self.by_one[:, row] = fits

    @staticmethod
    def _put(table: np.ndarray, row: int, values: list[int]) -> np.ndarray:
        if len(values) >= table.shape[1]:  # the last column stays 0
            table = np.pad(table, ((0, 0), (0, 2 * len(values) + 1 - table.shape[1])))
        table[row] = 0
        table[row, :len(values)] = values
        return table

    def target(self, source: int) -> int | None:
        """The fullest bin, no emptier than `source`, that a step from `source` can fill."""
        hit = self.by_one[self.one[source]].any(axis=0) | self.by_two[self.two[source]].any(axis=0)
        hit[source] = False
        rows = np.flatnonzero(hit & self.live & (self.room <= self.room[source]))
        return int(rows[self.room[rows].argmin()]) if len(rows) else None

    def sources(self, target: int) -> np.ndarray:
        """The bins, no fuller than `target`, from which a step can fill it."""
        one, two = np.ascontiguousarray(self.by_one[:, target]), np.ascontiguousarray(self.by_two[:, target])
        hit = (one[self.one].any(axis=1) | two[self.two].any(axis=1)) & self.live & (self.room >= self.room[target])
        hit[target] = False
        return np.flatnonzero(hit)


def _local_search(bins: list[list[int]], free: list[int], lengths: list[int], capacity: int, passes: int | None = None) -> list[list[int]]:
    """Empty the emptiest bins into the other underfull ones; every step increases the sum of squared fills.

    A bin that can give nothing away is set aside until a bin that it could give to changes. The search ends when all are set aside, or when the bins are
    as few as their total length allows. `passes` bounds the sources tried (None: no bound).
    """
    under = _Underfull(bins, free, lengths, capacity)
    spare, aside, tried = int(under.room.sum()), np.zeros(len(under.numbers), dtype=bool), 0
    while spare >= capacity and (passes is None or tried < passes):
        open_rows = np.flatnonzero(under.live & ~aside)
        if not len(open_rows):
            break
        source, changed = int(open_rows[under.room[open_rows].argmax()]), set()
        tried += 1
        while under.live[source] and (target := under.target(source)) is not None:
            s, t = under.numbers[source], under.numbers[target]
            give, take = _best_step(bins, free, lengths, s, t)
            for item in give:
                bins[s].remove(item)
                bins[t].append(item)
            for item in take:
                bins[t].remove(item)
                bins[s].append(item)
            moved = sum(lengths[i] for i in give) - sum(lengths[i] for i in take)
            free[s] += moved
            free[t] -= moved
            under.refresh(source)
            under.refresh(target)
            changed.add(target)
        aside[source] = True
        if not bins[under.numbers[source]]:
            spare -= capacity
        for row in changed:
            aside[row] = False
        for row in (changed | {source} if changed else ()):
            if under.live[row]:
                aside[under.sources(row)] = False
    return bins


def _two_of_each(items: list[int], lengths: list[int]) -> list[int]:
    """Items without the third and further ones of equal length: a step takes two at most."""
    seen: dict[int, int] = {}
    kept = []
    for item in items:
        seen[lengths[item]] = seen.get(lengths[item], 0) + 1
        if seen[lengths[item]] <= 2:
            kept.append(item)
    return kept


def _best_step(bins, free, lengths, source: int, target: int) -> tuple[list[int], list[int]] | None:
    """The move or exchange that fills `target` most from `source`, which is no fuller: squared fills grow with any such gain."""
    room, best, gain = free[target], None, 0
    give, there = _two_of_each(bins[source], lengths), _two_of_each(bins[target], lengths)
    for a in give:  # a move
        if gain < lengths[a] <= room:
            best, gain = ([a], []), lengths[a]
    if gain == room:
        return best
    for a in give:  # one for one, and one for two
        rest = [(lengths[a] - lengths[b], b) for b in there if lengths[b] < lengths[a]]
        for d, b in rest:
            if gain < d <= room:
                best, gain = ([a], [b]), d
        for i, (d, b) in enumerate(rest):
            for _, other in rest[i + 1:]:
                if gain < d - lengths[other] <= room:
                    best, gain = ([a], [b, other]), d - lengths[other]
    for i, a in enumerate(give):  # two, for none or one
        for other in give[i + 1:]:
            both = lengths[a] + lengths[other]
            if gain < both <= room:
                best, gain = ([a, other], []), both
            for b in there:
                if gain < both - lengths[b] <= room:
                    best, gain = ([a, other], [b]), both - lengths[b]
    return best


def _packer(capacity: int, number: int, keep_from: float):
    """A function that packs one group of pieces; a sequence's number holds the round, the group and the bin."""

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        lengths = table.column("length").to_pylist()
        group = table.column("group")[0].as_py()
        sequence, offset, placed = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), bool)
        for bin_number, items in enumerate(pack(lengths, capacity)):
            at = 0
            for item in items:
                sequence[item], offset[item] = bin_number, at
                at += lengths[item]
            placed[items] = at >= keep_from * capacity
        sequence += (number << 61) + (group << 24)
        table = table.drop_columns(["group"])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("placed", placed)):
            table = table.append_column(name, pa.array(values))
        return table

    return place


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, group_size: int = 20_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "packing")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", "text").mapInArrow(_Cutter(vocabulary, capacity, end_id), _PIECES.format(kind=kind))
    pieces = scratch.store(cut.withColumn("item", F.monotonically_increasing_id()), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = pieces.where(F.col("length") == capacity).select(*columns, F.col("item").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))

    def packed(parts: DataFrame, number: int, keep_from: float) -> DataFrame:
        groups = -(-max(parts.count(), 1) // group_size)
        grouped = parts.select("item", *columns, F.pmod(F.xxhash64("item", F.lit(number)), F.lit(groups)).alias("group"))
        schema = "item bigint, " + _PIECES.format(kind=kind) + ", sequence_id bigint, offset bigint, placed boolean"
        return scratch.store(grouped.groupBy("group").applyInArrow(_packer(capacity, number, keep_from), schema), f"packed-{number}")

    first = packed(pieces.where(F.col("length") < capacity), 1, 0.98)
    second = packed(first.where("NOT placed"), 2, 0.0)
    ends = [part.select(*columns, "sequence_id", "offset") for part in (first.where("placed"), second)]
    return whole.unionAll(ends[0]).unionAll(ends[1])
