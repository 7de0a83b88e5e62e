"""Ranked lexical search: the best documents of all for each item of a query set, by integer scores of shared terms.

A term is a longest run of ASCII letters and digits and of all other characters beyond ASCII; A-Z are lower-cased. N documents hold a term, L is the number of all
their terms, n that of one document, df the documents with a term, tf its occurrences in one. A term weighs w = floor(1000 ln((2N+2)/(2df+1)));
with m = 50 + 50 n N div L, a document's score for an item is the sum of w * (10^9 tf div (1000 tf + 20 m)) over the item's distinct terms.

Method. The second factor, a document's impact, doesn't depend on the item, so scores are a matrix product: items by vocabulary times vocabulary by
documents. Items are cut into tiles, whose own terms are their compact vocabulary; documents into tiles too. One
BLAS multiplication of float64 gives the scores of a pair of tiles. All factors are integers; a vocabulary is cut again wherever the sum of the largest possible products could reach 2^53, so
each partial sum is exact in float64, and partial sums are added as 64-bit integers. Of each product, scores that reach the item's k-th best
so far stay (equal ones too, since the smaller id wins).

Scale. The query set goes against all rows in blocks: items whose terms together number about `pass_terms` (a parameter, by hash; a text with more is a
pass of its own) are one pass, which sends their vocabulary, and nothing that grows with the corpus, to all tasks. A pass reads each whole text once and keeps
counts of vocabulary terms alone; multiplication reads these. A task leaves k rows for an item, the ranking takes them in
two steps, and no task holds more than one tile of documents.

Edge cases. Null texts, and texts without terms, count nowhere and are never found; items without terms find nothing. Null doc_ids come last among equal scores.
Rows with repeated ids are documents, and items, of their own. Fewer than k documents above 0: all. Without documents or items, no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.storage import Scratch

#: What separates terms, and letters to lower-case ones.
SEPARATED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = bytes(b if b > 0x7F or chr(b) in "0123456789" + _LOWER else ord(chr(b).lower()) if chr(b) in _UPPER else 0x20 for b in range(256))

_EXACT = 1 << 53
_IMPACT = 10**6  # every impact is below
_TILE_SCHEMA = "docs bigint, words bigint, doc_ids array<bigint>, lengths array<bigint>, ends array<int>, terms array<int>, times array<int>, held array<int>, holders array<bigint>"


def terms_of(text: str | None) -> list[bytes]:
    """A text's terms in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def distinct_terms(text: Column) -> Column:
    """A text's distinct terms."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(SEPARATED), F.lit(0)))


class _Counter:
    """(doc_id, text) to tiles of documents: for those with a vocabulary term its numbers of terms and occurrences, and counts over all."""

    def __init__(self, vocabulary: dict[bytes, int], tile: int):
        self.vocabulary, self.tile = vocabulary, tile

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, self.tile):
                yield self.count(batch.slice(begin, self.tile))

    def count(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        number, docs, words, chosen, lengths, parts, times = self.vocabulary.get, 0, 0, [], [], [], []
        for k, text in enumerate(batch.column(1)):
            all_terms = terms_of(text.as_py())
            known = np.array([n for n in map(number, all_terms) if n is not None], np.int64)
            docs, words = docs + (len(all_terms) > 0), words + len(all_terms)
            if len(known):
                terms, count = np.unique(known, return_counts=True)
                chosen.append(k)
                lengths.append(len(all_terms))
                parts.append(terms)
                times.append(count)
        terms = np.concatenate([np.zeros(0, np.int64), *parts])
        held, holders = np.unique(terms, return_counts=True)
        return pa.RecordBatch.from_pydict({
            "docs": pa.array([docs], pa.int64()), "words": pa.array([words], pa.int64()),
            "doc_ids": pa.array([batch.column(0).take(pa.array(chosen, pa.int64())).to_pylist()], pa.list_(pa.int64())),
            "lengths": pa.array([lengths], pa.list_(pa.int64())), "ends": pa.array([np.cumsum([len(p) for p in parts])], pa.list_(pa.int32())),
            "terms": pa.array([terms], pa.list_(pa.int32())), "times": pa.array([np.concatenate([np.zeros(0, np.int64), *times])], pa.list_(pa.int32())),
            "held": pa.array([held], pa.list_(pa.int32())), "holders": pa.array([holders], pa.list_(pa.int64()))})


class ItemTile:
    """Some items with their own terms: `rows`, and blocks of (term numbers, weights by item and term) whose products stay exact."""

    def __init__(self, items: list[tuple[int, np.ndarray]], weights: np.ndarray, most_terms: int):
        self.rows = np.array([row for row, _ in items], np.int64)
        own = np.unique(np.concatenate([np.zeros(0, np.int64), *(terms for _, terms in items)]))
        self.blocks, begin = [], 0
        while begin < len(own):
            held = np.cumsum(weights[own[begin:begin + most_terms]])  # as if one item held all these terms
            end = begin + max(int(np.searchsorted(held, (_EXACT - 1) // _IMPACT, side="right")), 1)
            self.blocks.append((own[begin:end], self._matrix(items, own[begin:end], weights)))
            begin = end

    @staticmethod
    def _matrix(items: list[tuple[int, np.ndarray]], own: np.ndarray, weights: np.ndarray) -> np.ndarray:
        matrix = np.zeros((len(items), len(own)))
        for k, (_, terms) in enumerate(items):
            inside = terms[np.isin(terms, own)]
            matrix[k, np.searchsorted(own, inside)] = weights[inside]
        return matrix

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, vocabulary: int) -> np.ndarray:
        """Scores of all items (rows) and documents of a tile (columns)."""
        total = np.zeros((len(self.rows), docs), np.int64)
        place = np.full(vocabulary, -1, np.int64)
        for own, matrix in self.blocks:
            place[own] = np.arange(len(own))
            at = place[term]
            place[own] = -1
            used = at >= 0
            impacts = np.zeros((len(own), docs))
            impacts[at[used], doc[used]] = impact[used]
            total += (matrix @ impacts).astype(np.int64)
        return total


class Best:
    """The k best documents of each item so far: the highest scores, equal ones by smaller id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.bar = k, np.ones(items, np.int64)
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in range(items)]

    def add(self, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        reach = scores >= self.bar[:, None]
        for item in np.flatnonzero(reach.any(axis=1)):
            at = np.flatnonzero(reach[item])
            score, null, doc = (np.r_[old, new[at]] for old, new in zip(self.kept[item], (scores[item], unknown, ids)))
            order = np.lexsort((doc, null, -score))[:self.k]
            self.kept[item] = score[order], null[order], doc[order]
            if len(order) == self.k:
                self.bar[item] = score[order[-1]]


class _Search:
    def __init__(self, tiles: list[ItemTile], vocabulary: int, docs: int, words: int, k: int):
        self.tiles, self.vocabulary, self.docs, self.words, self.k = tiles, vocabulary, docs, words, k

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles of documents to the best ones of all of a task's tiles."""
        best = [Best(len(tile.rows), self.k) for tile in self.tiles]
        for batch in batches:
            for n in range(batch.num_rows):
                lengths, ends, term, times = (batch.column(name)[n].values.to_numpy().astype(np.int64) for name in ("lengths", "ends", "terms", "times"))
                ids = batch.column("doc_ids")[n].values
                unknown, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                doc = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
                m = 50 + 50 * lengths * self.docs // max(self.words, 1)
                impact = 10**9 * times // (1000 * times + 20 * m[doc])
                for tile, found in zip(self.tiles, best, strict=True):
                    found.add(tile.scores(doc, term, impact, len(ids), self.vocabulary), ids, unknown)
        for tile, found in zip(self.tiles, best, strict=True):
            size = [len(score) for score, *_ in found.kept]
            score, null, doc = (np.concatenate(column) for column in zip(*found.kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(tile.rows, size)), pa.array(doc, mask=null), pa.array(score)], names=["item", "doc_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    """`rank` and the k best rows of each item, first by part of it so that no task sees all of a large one's rows."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(32))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    whole = first.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return whole.where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def _searched(docs: DataFrame, asked: DataFrame, scratch: Scratch, k: int, item_tile: int, doc_tile: int, tile_terms: int, name: str) -> DataFrame:
    """One pass: the best documents of the items of `asked` (item, terms), whose terms fit into memory."""
    items = [(row["item"], [term.encode() for term in row["terms"]]) for row in asked.collect()]
    items.sort()
    vocabulary = {term: n for n, term in enumerate(sorted({term for _, terms in items for term in terms}))}
    counted = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_Counter(vocabulary, doc_tile), _TILE_SCHEMA)
    tiles = scratch.store(counted, f"tiles-{name}")
    sums = tiles.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    held = tiles.select(F.explode(F.arrays_zip("held", "holders")).alias("h")).groupBy(F.col("h.held").alias("term")).agg(F.sum("h.holders").alias("df"))
    weights, n = np.zeros(len(vocabulary), np.int64), sums["docs"] or 0
    for row in held.collect():  # at most one row for each term of the pass
        weights[row["term"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * row["df"] + 1)))
    numbered = [(row, np.array(sorted(vocabulary[t] for t in terms), np.int64)) for row, terms in items if terms]
    item_tiles = [ItemTile(numbered[at:at + item_tile], weights, tile_terms) for at in range(0, len(numbered), item_tile)]
    search = _Search(item_tiles, len(vocabulary), n, sums["words"] or 0, k)
    found = tiles.select("doc_ids", "lengths", "ends", "terms", "times").mapInArrow(search, "item bigint, doc_id bigint, score bigint")
    ranked = scratch.store(_best(found, k), f"ranked-{name}")
    scratch.drop(f"tiles-{name}")
    return ranked


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, pass_terms: int = 1 << 18, item_tile: int = 64, doc_tile: int = 1024,
                   tile_terms: int = 4096) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every item. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "lexical")
    asked = scratch.store(items.select(F.monotonically_increasing_id().alias("item"), "item_id", distinct_terms(F.col("text")).alias("terms")), "items")
    passes = max(-(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // pass_terms), 1)
    ranked = None
    for number in range(passes):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).select("item", "terms")
        found = _searched(docs, part, scratch, k, item_tile, doc_tile, tile_terms, str(number))
        ranked = found if ranked is None else ranked.unionAll(found)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: The same for DuckDB.
LEXICAL_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
stats AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
items AS (
  SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts
  FROM benchmark),
asked AS (SELECT item, item_id, unnest(ts) AS term FROM items),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), stats),
impacts AS (
  SELECT tf.r, d.doc_id, tf.term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.ts) * n_docs) // n_terms)) AS impact
  FROM tf JOIN d ON tf.r = d.r CROSS JOIN stats),
scored AS (
  SELECT item, item_id, r, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""
