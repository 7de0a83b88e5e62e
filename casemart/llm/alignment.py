"""Alignment of the tokens that two tokenizers give for the same text, and how often ids meet over the whole corpus.

A is a byte-level BPE (a blank and the text), B a piece model (which puts the blank itself). Every token covers a range of bytes. Offsets at which a token of
both sides ends cut a text into groups; an A and a B token of one group are linked.

Method. For a batch of texts, `pandas.merge_asof`, keyed by document, finds for each token's start the token of the other side that covers it. Both
directions together give all overlaps, and overlaps that end alike end the groups. Within a group, links are counted by
id: the number of links is a product, and pairs of ids are made of distinct ids, never of token occurrences.

Scale. A chunk is a number of documents (about `chunk` characters) with their distinct pairs of ids and the number of its documents that hold each. Only
these pairs are counted over the corpus and looked up again, so a pair moves once for each chunk that holds it instead of once for each document; pairs
that all documents hold cost a row a chunk, and sums are combined before the shuffle. Texts are tokenised once and never shuffled. No table of pairs is
sent to all tasks.

Memory. Texts are aligned in parts of about `part` bytes, which is all that a task holds as strings, tokens and frames. A part is a row of its own with what is
needed of each of its documents and its share of the chunk's pairs, so rows stay small where they are written, sorted and sent to Python, whatever
the size of a chunk. Parts and looked-up pairs meet by chunk as sorted rows (cogroup), not as collected arrays. A text longer than a part is a part.

Edge cases. Null and empty texts, and texts whose joined A or B bytes differ from the blank and the text (characters that a piece model rewrites), have no
tokens: zeros and an empty digest. Special tokens' strings are plain text. Null and repeated ids each get a row; repeated rows count as documents of
their own. Without rows, no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from contextlib import suppress
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from casemart.llm.packing import load_encoding
from casemart.llm.storage import Scratch

_FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_SIDE = 32  # bits of an id within the code of a pair
_CHUNK = 2 << 20
_PART = 128 << 10
_DOC = 64  # what a text counts besides its length: its digest
#: Row groups of the stored parts, which writers and columnar readers hold as a whole; their size is looked at from the first row on.
_ROW_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1"}


def _byte_of_letter() -> dict[str, int]:
    """The rule by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteSide:
    """Ids and bytes of a byte-level BPE from its JSON file.

    Where its file of ranks lies beside it, ids come from there: they are the same (compared for every character and by tests) in a sixth of the time. Texts on
    which that library gives up (about a million blanks in a row) go through the JSON form, which is read when the first of them comes.
    """

    def __init__(self, path: str):
        self.path = path
        ranks = path.removesuffix(".json") + ".tiktoken"
        self.fast = load_encoding(ranks) if os.path.exists(ranks) else None
        byte = _byte_of_letter()
        with open(path, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        self.bytes_of = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes_of[number] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()

    @cached_property
    def model(self):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its own core
        model = Tokenizer.from_file(self.path)
        model.encode_special_tokens = True
        return model

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._ids(" " + text) for text in texts]

    def _ids(self, text: str) -> list[int]:
        if self.fast:
            with suppress(ValueError):
                return self.fast.encode_to_numpy(text, disallowed_special=()).tolist()
        return self.model.encode(text, add_special_tokens=False).ids


class PieceSide:
    """Ids and bytes of a piece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [self._bytes(k) for k in range(self.model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self.model.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _sides(byte_model: str, piece_model: str):
    """Both tokenizers of a worker process, with the lengths and the decimal forms of their ids."""
    sides = (ByteSide(byte_model), PieceSide(piece_model))
    lengths = tuple(np.array([len(b) for b in side.bytes_of], np.int64) for side in sides)
    decimal = np.array([f"{n}{mark}" for mark in (",", "|", ";", "") for n in range(max(map(len, lengths)))], object)
    return sides, lengths, decimal


def token_frame(ids: list[np.ndarray], lengths: np.ndarray, side: str) -> pd.DataFrame:
    """doc, id, start and end of all tokens, by document and start; offsets go on from document to document."""
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    end = np.cumsum(lengths[flat])
    return pd.DataFrame({"doc": doc, f"{side}_id": flat, "at": end - lengths[flat], f"{side}_end": end, side: np.arange(len(flat))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of an A and a B token whose ranges of bytes meet: columns a, a_end, b, b_end, by place."""
    starts_a, starts_b = a[["doc", "at", "a"]], b[["doc", "at", "b"]]
    both = [pd.merge_asof(starts_a, starts_b, on="at", by="doc"), pd.merge_asof(starts_b, starts_a, on="at", by="doc")]
    # by place, and once where both directions give the same pair: as one number, A before B
    width = max(len(b), 1)
    met = np.sort(np.concatenate([frame["a"].to_numpy(np.int64) * width + frame["b"].to_numpy(np.int64) for frame in both]), kind="stable")
    met = met[np.diff(met, prepend=-1) > 0]
    left, right = met // width, met % width
    return pd.DataFrame({"a": left, "a_end": a["a_end"].to_numpy()[left], "b": right, "b_end": b["b_end"].to_numpy()[right]})


def groups_of(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of each A token's and of each B token's group, and how many groups there are."""
    met = overlaps(a, b)
    same = (met["a_end"] == met["b_end"]).to_numpy()
    # a token's group is the number of groups that end before it
    groups = [np.cumsum(np.bincount(met[side].to_numpy()[same] + 1, minlength=len(tokens) + 1))[:-1] for side, tokens in (("a", a), ("b", b))]
    return *groups, int(same.sum())


def _linked_ids(group_a: np.ndarray, id_a: np.ndarray, group_b: np.ndarray, id_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """group, code of the id pair, and number of links, for distinct ids of each group."""
    def counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, times = np.unique((group << _SIDE) | ids, return_counts=True)
        return codes >> _SIDE, codes & ((1 << _SIDE) - 1), times

    groups = max(len(group_a) and group_a[-1] + 1, 0)
    size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    plain = (size_a == 1) & (size_b == 1)  # most groups
    one_a, one_b = plain[group_a], plain[group_b]
    (ga, a, times_a), (gb, b, times_b) = counted(group_a[~one_a], id_a[~one_a]), counted(group_b[~one_b], id_b[~one_b])
    first, last = np.searchsorted(gb, ga), np.searchsorted(gb, ga, side="right")
    width = last - first
    left = np.repeat(np.arange(len(ga)), width)
    right = np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first, width)
    return (np.r_[group_a[one_a], ga[left]], np.r_[(id_a[one_a] << _SIDE) | id_b[one_b], (a[left] << _SIDE) | b[right]],
            np.r_[np.ones(one_a.sum(), np.int64), times_a[left] * times_b[right]])


def _written(a: pd.DataFrame, b: pd.DataFrame, group_a: np.ndarray, group_b: np.ndarray, last_group: np.ndarray, decimal) -> np.ndarray:
    """Ids of all tokens in order, group by group, as text with the mark that follows each."""
    groups = len(last_group)
    upto_a, upto_b = (np.cumsum(np.bincount(group, minlength=groups)) for group in (group_a, group_b))
    place_a = np.arange(len(a)) + np.r_[0, upto_b][group_a]
    place_b = np.arange(len(b)) + upto_a[group_b]
    ids, mark = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    ids[place_a], ids[place_b] = a["a_id"].to_numpy(), b["b_id"].to_numpy()
    mark[place_a[upto_a - 1]], mark[place_b[upto_b - 1]] = 1, np.where(last_group, 3, 2)
    return decimal[mark * (len(decimal) // 4) + ids]


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of texts that have about `most` bytes together (one text at least)."""
    begin, upto = 0, np.r_[0, np.cumsum(sizes)]
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + most, side="right")) - 1)
        yield begin, end
        begin = end


class _Chunks:
    def __init__(self, byte_model: str, piece_model: str, chunk: int, part: int = _PART):
        self.byte_model, self.piece_model, self.chunk, self.part = byte_model, piece_model, chunk, min(part, chunk)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) to the rows of each chunk of documents, one for each part; chunks are numbered within the task."""
        number, held, parts = 0, 0, []
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + _DOC
            for begin, end in _parts(sizes, self.part):
                texts = [text or "" for text in batch.column(1).slice(begin, end - begin).to_pylist()]
                # a copy: what is kept mustn't hold the batch
                parts.append((pa.array([batch.column(0).slice(begin, end - begin).to_pylist()], pa.list_(batch.schema.field(0).type)), *self.align(texts)))
                held += sum(map(len, texts)) + _DOC * len(texts)
                if held >= self.chunk:
                    yield from _rows_of_chunk(number, parts)
                    number, held, parts = number + 1, 0, []
        if parts:
            yield from _rows_of_chunk(number, parts)

    def align(self, texts: list[str]):
        sides, lengths, decimal = _sides(self.byte_model, self.piece_model)
        none, ids = np.zeros(0, np.int64), ([], [])
        whole = [(" " + text).encode("utf-8", "surrogatepass") if text else b"" for text in texts]
        for text, *tokens in zip(whole, *(side.encode(texts) for side in sides)):
            fits = text and all(b"".join(map(side.bytes_of.__getitem__, t)) == text for side, t in zip(sides, tokens))
            for kept, t in zip(ids, tokens):
                kept.append(np.array(t, np.int64) if fits else none)
        a, b = token_frame(ids[0], lengths[0], "a"), token_frame(ids[1], lengths[1], "b")
        group_a, group_b, groups = groups_of(a, b)
        sizes = np.stack([np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)])
        # the document of each group, and for each document where its groups and its written tokens end
        count = np.array([len(x) + len(y) for x, y in zip(*ids)], np.int64)
        doc_of_group = a["doc"].to_numpy()[np.searchsorted(group_a, np.arange(groups))]
        n_groups = np.bincount(doc_of_group, minlength=len(texts))
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, doc_of_group, sizes[0] * sizes[1])
        last = np.r_[doc_of_group[1:] != doc_of_group[:-1], np.ones(min(groups, 1), bool)]
        written = _written(a, b, group_a, group_b, last, decimal)
        cut = np.r_[0, np.cumsum(count)]
        digests = [hashlib.sha256("".join(written[x:y].tolist()).encode()).hexdigest() if y > x else "" for x, y in zip(cut[:-1], cut[1:])]
        # links by document and pair of ids
        group, code, links = _linked_ids(group_a, a["a_id"].to_numpy(), group_b, b["b_id"].to_numpy())
        pairs, place = np.unique(code, return_inverse=True)
        keys, inverse = np.unique(doc_of_group[group] * np.int64(max(len(pairs), 1)) + place, return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, inverse, links)
        doc, link = keys // max(len(pairs), 1), keys % max(len(pairs), 1)
        figures = ([len(x) for x in ids[0]], [len(x) for x in ids[1]], n_groups, n_links)
        ends = np.searchsorted(doc, np.arange(len(texts)), side="right")
        return figures, digests, pairs, np.bincount(link, minlength=len(pairs)), ends, link, times


def _rows_of_chunk(number: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Parts with pairs of their own to rows that share the chunk's: each holds a range of them, and links are places among all."""
    pairs = np.unique(np.concatenate([part[3] for part in parts]))
    places, holders = [np.searchsorted(pairs, part[3]) for part in parts], np.zeros(len(pairs), np.int64)
    for place, part in zip(places, parts, strict=True):
        holders[place] += part[4]
    cut = np.linspace(0, len(pairs), len(parts) + 1).astype(np.int64)
    for k, (doc_ids, figures, digests, _, _, ends, links, times) in enumerate(parts):
        own = slice(cut[k], cut[k + 1])
        yield pa.RecordBatch.from_pydict({
            "chunk": pa.array([number], pa.int64()), "doc_ids": doc_ids,
            **{name: pa.array([column], pa.list_(pa.int64())) for name, column in zip(_FIGURES, figures, strict=True)},
            "digests": pa.array([digests], pa.list_(pa.string())), "pairs": pa.array([pairs[own]], pa.list_(pa.int64())),
            "holders": pa.array([holders[own]], pa.list_(pa.int64())), "ends": pa.array([ends], pa.list_(pa.int32())),
            "links": pa.array([places[k][links]], pa.list_(pa.int32())), "times": pa.array([times], pa.list_(pa.int64()))})


def _chunk_schema(kind: str) -> str:
    figures = ", ".join(f"{name} array<bigint>" for name in _FIGURES)
    return (f"chunk bigint, doc_ids array<{kind}>, {figures}, digests array<string>, pairs array<bigint>, holders array<bigint>, "
            "ends array<int>, links array<int>, times array<bigint>")


def _rated(id_type: pa.DataType):
    """The function from the parts of a chunk and the corpus counts of its pairs to one row for each document."""
    def rate(parts: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known["pair"].to_numpy())
        rates = [known[name].to_numpy()[order].astype(np.int64) for name in ("best", "n")]
        done = []
        for batch in parts.to_batches():
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].values for name in batch.schema.names if name != "chunk"}
                ends, links, times = (row[name].to_numpy() for name in ("ends", "links", "times"))
                starts = np.r_[0, ends[:-1]].astype(np.int64)
                sums = [np.r_[0, np.cumsum(times * of[links])] for of in rates]
                done.append(pa.Table.from_arrays(
                    [row["doc_ids"].cast(id_type), *(row[name] for name in _FIGURES), *(pa.array(s[ends] - s[starts]) for s in sums), row["digests"].cast(pa.string())],
                    names=["doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(done)

    return rate


def align_documents(docs: DataFrame, byte_model: str, piece_model: str, chunk: int = _CHUNK, part: int = _PART) -> tuple[DataFrame, DataFrame]:
    """The aligned parts of `docs` by chunk, and the table of id pairs (a_id, b_id, n documents, best of its A id). Runs jobs."""
    scratch = Scratch(docs.sparkSession, "alignment")
    kind = docs.schema["doc_id"].dataType.simpleString()
    aligned = docs.select("doc_id", "text").mapInArrow(_Chunks(byte_model, piece_model, chunk, part), _chunk_schema(kind))
    task = F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    chunks = scratch.store(aligned.withColumn("chunk", task + F.col("chunk")), "chunks", **_ROW_GROUPS)
    held = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("held")).select(F.col("held.pairs").alias("pair"), F.col("held.holders").alias("n"))
    counts = scratch.store(held.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    a_id = F.shiftright("pair", _SIDE)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))  # one row for each entry of a vocabulary
    rated = counts.withColumn("a_id", a_id).join(most, "a_id").select(
        "pair", "a_id", F.col("pair").bitwiseAND((1 << _SIDE) - 1).alias("b_id"), "n", (F.col("n") == F.col("most")).alias("best"))
    return chunks, scratch.store(rated, "rated")


def alignment_report(docs: DataFrame, byte_model: str, piece_model: str, chunk: int = _CHUNK, part: int = _PART) -> DataFrame:
    """Figures of the alignment of every row, with the corpus counts of its links. Runs jobs."""
    chunks, rated = align_documents(docs, byte_model, piece_model, chunk, part)
    asked = chunks.select(F.col("chunk").alias("of"), F.explode("pairs").alias("pair"))
    known = asked.join(rated, "pair").select("of", "pair", "n", "best")
    parts = chunks.select("chunk", "doc_ids", *_FIGURES, "digests", "ends", "links", "times")
    doc_id = docs.schema["doc_id"].dataType
    figures = ", ".join(f"{name} bigint" for name in (*_FIGURES, "n_best", "count_sum"))
    return parts.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(
        _rated(to_arrow_type(doc_id)), f"doc_id {doc_id.simpleString()}, {figures}, groups_sha256 string")
