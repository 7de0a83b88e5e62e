"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and cut into two halves. Each half has its own codebook, so that `codes` x `codes` cells form a product grid,
and each vector lives in the cell of its nearest two codes. A vector visits cells in the order of the sum of
both squared distances (multi-sequence traversal). How many it visits is measured, not guessed: a sample of vectors is compared with all
others by brute force, and the count is the smallest, `floor` at least, at which `recall` of the true links lie in visited cells, within each class of
probes with about as many links (1, 2-3, 4-7, ...). Every probe of a class weighs the same, so that large groups don't speak for pairs.
Pairs that meet are verified by cosine in double precision. A link counts for both ends, whichever of the two visited.

Scale. Equal vectors are one row with a count. Codebooks are fitted on a bounded sample (`fit_rows`) and hold 2 x `codes` half vectors, which go along
with the tasks; `codes` follows the square root of the rows up to 1,024, as the sample supports no more, so beyond some 50 million vectors cells grow with them. Cells with many members or visitors are cut into blocks of `block` rows, so no
task holds more than two blocks. A task returns sums and the links' spanning edges, not pairs.

Edge cases. Vectors that are null, zero, or hold null or non-finite components link with nothing: n_links 0, a component of their own. Shorter vectors
end in zeros. Rows with equal ids each get a row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.components import components
from casemart.llm.storage import Scratch
from casemart.llm.vectors import finite, matrix

_STEP = 1024


def _unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(largest > 0, largest, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _squared(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1), 0)


class MultiIndex:
    """Two codebooks over the halves of unit vectors, and the number of cells that a vector visits."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int = 1):
        self.books, self.visits = (first, second), visits
        self.half, self.codes = first.shape[1], len(first)
        # places in two sorted lists that can be among the `visits` smallest sums
        side = min(self.codes, visits)
        a, b = np.divmod(np.arange(side * side), side)
        near = (a + 1) * (b + 1) <= visits
        self.left, self.right = a[near], b[near]

    def _distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _squared(x[:, :self.half], self.books[0]), _squared(x[:, self.half:], self.books[1])

    def cell(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector."""
        first, second = self._distances(x)
        return first.argmin(1) * self.codes + second.argmin(1)

    def visited(self, x: np.ndarray) -> np.ndarray:
        """The `visits` nearest cells of each vector, nearest first."""
        first, second = self._distances(x)
        by_first, by_second = np.argsort(first, axis=1, kind="stable"), np.argsort(second, axis=1, kind="stable")
        rows = np.arange(len(x))[:, None]
        codes = by_first[rows, self.left[None, :]], by_second[rows, self.right[None, :]]
        total = first[rows, codes[0]] + second[rows, codes[1]]
        cells = codes[0] * self.codes + codes[1]
        order = np.lexsort((cells, total), axis=1)[:, :self.visits]
        return cells[rows, order]

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """At which visit the vector x of a pair reaches the cell of y (1: at the first)."""
        first, second = self._distances(x)
        cell = self.cell(y)
        mine = first[np.arange(len(x)), cell // self.codes] + second[np.arange(len(x)), cell % self.codes]
        first, second = np.sort(first, axis=1), np.sort(second, axis=1)
        below = np.zeros(len(x), dtype=np.int64)
        for k in range(self.codes):
            below += (first[:, k:k + 1] + second < mine[:, None] - 1e-12).sum(1)
        return below + 1


def _codebook(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced rows of the sample."""
    book = x[np.linspace(0, len(x) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        nearest = _squared(x, book).argmin(1)
        size = np.bincount(nearest, minlength=codes)
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, x)
        book = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], book)
    return book


def _true_ranks(index: MultiIndex, probes: np.ndarray, probe_ids: np.ndarray, least: float, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _unit(matrix(batch.column(1), width))
            for at in range(0, len(ids), _STEP):
                part = x[at:at + _STEP]
                i, j = np.nonzero((probes @ part.T >= least) & (probe_ids[:, None] != ids[None, at:at + _STEP]))
                if len(i):
                    pairs, counts = np.unique(np.column_stack([i, index.rank(probes[i], part[j])]), axis=0, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.astype(np.int64)) for x in (pairs[:, 0], pairs[:, 1], counts)], names=["probe", "rank", "n"])
    return run


def _needed_visits(found: list[tuple[int, int, float]], recall: float, floor: int) -> int:
    """The smallest number of visits at which each class of (class, rank, weight) meets `recall` of its weight."""
    visits, classes = floor, {}
    for kind, rank, weight in found:
        classes.setdefault(kind, []).append((rank, weight))
    for links in classes.values():
        missed = (1 - recall) * sum(weight for _, weight in links)
        for rank, weight in sorted(links, reverse=True):
            missed -= weight
            if missed < 0:  # this rank can't be left out
                visits = max(visits, rank)
                break
    return visits


def _visits(index: MultiIndex, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, vector, copies) to rows of members (once, in the own cell) and visitors (in each visited cell)."""
        for batch in batches:
            x = _unit(matrix(batch.column(1), width))
            for at in range(0, len(x), _STEP):
                part = x[at:at + _STEP]
                cells = np.column_stack([index.cell(part), index.visited(part)])
                times = cells.shape[1]
                rows = np.repeat(np.arange(at, at + len(part)), times)
                member = np.tile(np.arange(times) == 0, len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.ravel().astype(np.int64)), pa.array(member), *[batch.column(k).take(pa.array(rows)) for k in range(3)]],
                    names=["cell", "member", "row", "vector", "copies"])
    return run


def _verifier(index: MultiIndex, least: float, width: int):
    def verify(table: pa.Table) -> pa.Table:
        """Of one cell's block of members and block of visitors: links to count, and edges that span them."""
        is_member = table.column("member").to_numpy()
        rows, copies = table.column("row").to_numpy(), table.column("copies").to_numpy()
        x = _unit(matrix(table.column("vector"), width))
        m, v = np.flatnonzero(is_member), np.flatnonzero(~is_member)
        links, edges = np.zeros(len(rows), dtype=np.int64), []
        if len(m) and len(v):
            near = (x[v] @ x[m].T >= least) & (rows[v][:, None] != rows[m][None, :])
            i, j = np.nonzero(near)
            # the member counts the visitor here only if it doesn't visit the visitor's cell itself
            home = index.cell(x[v])
            back = np.zeros(len(i), dtype=bool)
            seen = index.visited(x[m]) if len(i) else np.zeros((0, 1))
            for at in range(0, len(i), 65_536):
                a, b = i[at:at + 65_536], j[at:at + 65_536]
                back[at:at + 65_536] = (seen[b] == home[a][:, None]).any(axis=1)
            links[v] += np.bincount(i, weights=copies[m][j], minlength=len(v)).astype(np.int64)
            links[m] += np.bincount(j, weights=np.where(back, 0, copies[v][i]), minlength=len(m)).astype(np.int64)
            label = rows.copy()
            while len(i):  # smallest row reachable inside of this task
                before = label.copy()
                np.minimum.at(label, v[i], label[m[j]])
                np.minimum.at(label, m[j], label[v[i]])
                if (before == label).all():
                    break
            edges = np.flatnonzero(label != rows)
        some = np.flatnonzero(links)
        kind = np.concatenate([np.zeros(len(some), bool), np.ones(len(edges), bool)])
        return pa.table({
            "edge": pa.array(kind), "row": pa.array(np.concatenate([rows[some], rows[edges]] if len(edges) else [rows[some]]).astype(np.int64)),
            "value": pa.array(np.concatenate([links[some], label[edges]] if len(edges) else [links[some]]).astype(np.int64))})
    return verify


def vector_duplicates(vectors: DataFrame, least: float = 0.95, recall: float = 0.995, fit_rows: int = 4096, probe_rows: int = 1024,
                      block: int = 2048, floor: int = 16) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `vectors`. Runs jobs."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "multiindex")
    column = F.col("embedding")
    usable = finite(column) & F.exists(column, lambda x: x != 0)
    grouped = vectors.where(usable).groupBy("embedding").agg(F.count(F.lit(1)).alias("copies"))
    rows = scratch.store(grouped.select(F.monotonically_increasing_id().alias("row"), F.col("embedding").alias("vector"), "copies"), "rows")
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    n, width = known["n"], known["width"] or 1
    if n:
        drawn = rows.orderBy(F.xxhash64("row"), "row").limit(fit_rows).select("row", "vector").toArrow()
        sample = _unit(matrix(drawn.column("vector"), width))
        codes = int(min(2 ** np.ceil(np.log2(max(np.sqrt(n / 48), 4))), 1024, len(sample)))
        half = (width + 1) // 2
        books = _codebook(sample[:, :half], codes), _codebook(sample[:, half:], codes) if width > half else np.zeros((codes, 0))
        probes, probe_ids = sample[:probe_rows], np.asarray(drawn.column("row"))[:probe_rows]
        ranks = rows.select("row", "vector").mapInArrow(
            _true_ranks(MultiIndex(*books), probes, probe_ids, least, width), "probe bigint, rank bigint, n bigint")
        ranks = scratch.store(ranks.groupBy("probe", "rank").agg(F.sum("n").alias("n")), "ranks")
        totals = ranks.groupBy("probe").agg(F.sum("n").alias("total"))
        by_class = ranks.join(totals, "probe").groupBy(F.floor(F.log2("total")).alias("class"), "rank").agg(F.sum(F.col("n") / F.col("total")).alias("weight"))
        visits = _needed_visits([tuple(r) for r in by_class.collect()], recall, floor)
        index = MultiIndex(*books, visits=min(int(visits), codes * codes))
        placed = scratch.store(rows.select("row", "vector", "copies").mapInArrow(
            _visits(index, width), "cell bigint, member boolean, row bigint, vector array<float>, copies bigint"
            if "array<float>" in dict(rows.dtypes)["vector"] else "cell bigint, member boolean, row bigint, vector array<double>, copies bigint"), "placed")
        sizes = placed.groupBy("cell").agg(
            F.ceil(F.count_if("member") / block).cast("int").alias("m"), F.ceil(F.count_if(~F.col("member")) / block).cast("int").alias("v")).where("m > 0")
        dealt = placed.join(sizes, "cell")
        own = F.pmod(F.xxhash64("row"), F.when(F.col("member"), F.col("m")).otherwise(F.col("v"))).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.when(F.col("member"), F.col("v")).otherwise(F.col("m")) - 1))
        spread = dealt.withColumn("own", own).withColumn("other", other).select(
            "cell", F.when(F.col("member"), F.col("own")).otherwise(F.col("other")).alias("mb"),
            F.when(F.col("member"), F.col("other")).otherwise(F.col("own")).alias("vb"), "member", "row", "vector", "copies")
        verified = scratch.store(spread.groupBy("cell", "mb", "vb").applyInArrow(_verifier(index, least, width), "edge boolean, row bigint, value bigint"), "verified")
        scratch.drop("placed")
    else:
        verified = scratch.store(spark.createDataFrame([], "edge boolean, row bigint, value bigint"), "verified")
    links = verified.where("NOT edge").groupBy("row").agg(F.sum("value").alias("links"))
    label = components(verified.where("edge").select(F.col("row").alias("u"), F.col("value").alias("v")), scratch)
    summed = rows.join(links, "row", "left").join(label.withColumnRenamed("node", "row"), "row", "left").select(
        F.col("vector").alias("embedding"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("linked"), F.coalesce("component", "row").alias("component"))
    named = scratch.store(vectors.select("vec_id", F.when(usable, column).alias("embedding")).join(summed, "embedding", "left").select(
        "vec_id", F.coalesce("linked", F.lit(0)).cast("bigint").alias("n_links"), "component"), "named")
    least_id = named.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("least_id"))
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least_id"))
    return named.join(least_id, "component", "left").select(
        "vec_id", "n_links", component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
