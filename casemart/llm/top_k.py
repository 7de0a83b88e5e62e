"""Exact top-k by inner product with no-random-access aggregation over sorted lists.

Every component x becomes floor(`scale` * x). Queries are the rows whose id is divisible by `every`; all other rows are candidates.

Method. Candidates are dealt into chunks of likeness (by the pivot, of a sample, with the largest inner product; a pivot with many rows has several chunks), and
each chunk keeps one list for each dimension, sorted by value. For a query a list is read from the end where the dimension adds most, all to the
same depth, and depths rise. A candidate's lower bound is what was read of it plus the least that its unread lists can add, its upper bound adds the lists'
values at the depth instead. A query stops once few candidates can still reach its k-th lower bound; for those the rest of the lists is read on
and gives final scores in 64-bit integers. Before anything is read, the ends of the lists bound the whole chunk. Every query starts with
the k-th score that it found in its own chunk. Ties go to the smaller id.
Bounds of a block of queries are two matrix products a depth. They are float64, and each is widened by what rounding can do to it, so
they hold for components of any size; final scores are exact wherever sums fit into 64 bits (beyond that they wrap).

Scale. The query set goes against all rows in blocks of `block` queries, which move to the chunks; a chunk moves once for 64 blocks. A query isn't sent to
chunks of pivots whose range of values can't reach its bound (ranges of at most `pivots` pivots, a bounded sample, are known to all tasks). Chunks hold at most about
`chunk` candidates at any size of input. With isotropic vectors nothing can be left out, and the work is queries times rows.

Edge cases. Vectors that are null, empty or hold null or non-finite components, and rows with a null id, take no part. Missing trailing components
count as 0. With fewer than k candidates, all are returned. A row with a repeated id is a candidate of its namesake. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.storage import Scratch
from casemart.llm.vectors import finite, matrix

_DEPTHS = (0.25, 0.5, 0.75)
_BLOCKS = 64  # of queries that meet a chunk at a time
_FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_NONE = np.iinfo(np.int64).min


class SortedLists:
    """A chunk's lists, one for each dimension, and the products that give all bounds at a depth.

    Lists are kept by row: a list's part down to a depth are the rows whose value's place lies before it.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, values: np.ndarray):
        order = np.lexsort((rows, ids))  # ties go to the smaller id
        self.ids, self.rows, self.full = ids[order], rows[order], values[order]
        self.values = self.full.astype(np.float64)
        by_value = np.argsort(self.full, axis=0, kind="stable")
        self.place = np.empty(by_value.shape, np.int64)
        np.put_along_axis(self.place, by_value, np.arange(len(ids))[:, None], axis=0)
        self.sorted = np.take_along_axis(self.values, by_value, axis=0)
        self.largest = np.abs(self.values).max(axis=0, initial=0)
        self.known: dict[float, tuple] = {}

    def _read(self, depth: float) -> tuple:
        """What a depth gives, for falling and for rising lists: values read beyond the front, values read beyond the least, and both ends."""
        if depth not in self.known:
            n = len(self.ids)
            at = max(int(depth * n), 1)
            falling, rising = self.place >= n - at, self.place < at
            fronts = np.concatenate([self.sorted[n - at], self.sorted[at - 1]])
            least = np.concatenate([self.sorted[0], self.sorted[-1]])
            parts = [np.concatenate([(self.values - end[:len(end) // 2]) * falling, (self.values - end[len(end) // 2:]) * rising], axis=1) for end in (fronts, least)]
            self.known[depth] = (*parts, fronts, least)
        return self.known[depth]

    def search(self, queries: np.ndarray, k: int, bar: np.ndarray, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, places and scores of up to k candidates that reach `bar`; `own` is the query's own place, -1 if it isn't here."""
        n, out = len(self.ids), [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
        q = queries.astype(np.float64)
        split = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)
        # rounding moves a sum of this many products by less
        slack = np.abs(q) @ self.largest * (self.values.shape[1] + 4) * 2.0**-50
        bar = bar.astype(np.float64)
        best = np.maximum(q * self.sorted[0], q * self.sorted[-1]).sum(axis=1)
        alive = np.flatnonzero(best + slack >= bar)
        for depth in (*_DEPTHS, 1.0):
            if not len(alive):
                break
            upper, lower = self._bounds(depth, split[alive], q[alive])
            mine = own[alive]
            upper[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf
            lower[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf
            room = slack[alive][:, None]
            gain = np.flatnonzero((lower - room >= bar[alive][:, None]).sum(axis=1) >= k)
            if len(gain):
                bar[alive[gain]] = np.partition(lower[gain], n - k, axis=1)[:, n - k] - room[gain, 0]
            can = upper + room >= bar[alive][:, None]
            left = can.sum(axis=1)
            done = (left <= max(4 * k, n // 16)) | (depth == 1.0)
            for x in np.flatnonzero(done & (left > 0)):
                out[alive[x]] = self._final(np.flatnonzero(can[x] & (upper[x] > -np.inf)), queries[alive[x]], k)
            alive = alive[~done]
        return out

    def _bounds(self, depth: float, split: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if depth == 1.0:
            total = queries @ self.values.T
            return total, total.copy()
        beyond_front, beyond_least, fronts, least = self._read(depth)
        return split @ beyond_front.T + (split @ fronts)[:, None], split @ beyond_least.T + (split @ least)[:, None]

    def _final(self, places: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        score = self.full[places] @ query
        chosen = np.lexsort((places, -score))[:k]
        return places[chosen], score[chosen]


def _lists(row: dict, width: int) -> SortedLists:
    return SortedLists(*(np.frombuffer(row[name], np.int64) for name in ("ids", "rows")), np.frombuffer(row["vectors"], np.int64).reshape(-1, width))


def _found(query_rows: np.ndarray, query_ids: np.ndarray, lists: SortedLists, found: list) -> pa.Table:
    sizes = [len(score) for _, score in found]
    places, scores = (np.concatenate([np.zeros(0, np.int64), *column]) for column in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    return pa.table([pa.array(np.repeat(query_rows, sizes)), pa.array(np.repeat(query_ids, sizes)), pa.array(lists.ids[places]), pa.array(scores)], schema=_FOUND)


class _Dealer:
    """(row, vec_id, ints) with the pivot that a row is like."""

    def __init__(self, pivots: np.ndarray, width: int):
        length = np.sqrt((pivots.astype(np.float64) ** 2).sum(axis=1))
        self.unit, self.width = pivots / np.maximum(length, 1e-300)[:, None], width

    def __call__(self, batches):
        for batch in batches:
            like = matrix(batch.column(2), self.width) @ self.unit.T
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(like.argmax(axis=1).astype(np.int32))], names=["row", "vec_id", "ints", "pivot"])


def _packed(width: int):
    def build(table: pa.Table) -> pa.Table:
        """One row for a chunk."""
        values = matrix(table.column("ints"), width, np.int64)
        whole = {"ids": table.column("vec_id"), "rows": table.column("row")}
        return pa.table({
            "pivot": table.column("pivot")[:1].cast(pa.int32()), "part": table.column("part")[:1].cast(pa.int32()),
            **{name: pa.array([np.asarray(column, np.int64).tobytes()], pa.binary()) for name, column in whole.items()},
            "vectors": pa.array([values.tobytes()], pa.binary()),
            "low": pa.array([values.min(axis=0)], pa.list_(pa.int64())), "high": pa.array([values.max(axis=0)], pa.list_(pa.int64()))})
    return build


def _queries_at_home(k: int, every: int, width: int, block: int):
    def run(batches):
        """Chunks to what their own queries find inside, packed with the query: row, id, k-th score, ints, and places found."""
        for batch in batches:
            for row in batch.to_pylist():
                lists = _lists(row, width)
                asked = np.flatnonzero(lists.ids % every == 0)
                for at in range(0, len(asked), block):
                    part = asked[at:at + block]
                    found = lists.search(lists.full[part], k, np.full(len(part), _NONE), part)
                    bars = [int(score[-1]) if len(score) == k else _NONE for _, score in found]
                    yield pa.RecordBatch.from_pydict({
                        "query_row": pa.array(lists.rows[part]), "query_id": pa.array(lists.ids[part]), "bar": pa.array(bars, pa.int64()),
                        "pivot": pa.array([row["pivot"]] * len(part), pa.int32()), "part": pa.array([row["part"]] * len(part), pa.int32()),
                        "ints": pa.array(list(lists.full[part]), pa.list_(pa.int64())),
                        "vec_ids": pa.array([lists.ids[places] for places, _ in found], pa.list_(pa.int64())),
                        "scores": pa.array([score for _, score in found], pa.list_(pa.int64()))})
    return run


class _Sender:
    """Queries to blocks for each pivot whose range of values can reach their bar; `_BLOCKS` blocks of a pivot are a slice."""

    def __init__(self, low: np.ndarray, high: np.ndarray, block: int, width: int):
        self.low, self.high, self.block, self.width = low, high, block, width

    def __call__(self, batches):
        first, sent_to = TaskContext.get().partitionId() << 32, np.zeros(len(self.low), np.int64)
        for batch in batches:
            values = matrix(batch.column("ints"), self.width, np.int64)
            q, bar = values.astype(np.float64), batch.column("bar").to_numpy().astype(np.float64)
            columns = [batch.column(name).to_numpy() for name in ("query_row", "query_id", "bar", "pivot", "part")]
            wide = np.maximum(np.abs(self.low), np.abs(self.high))
            reach = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
            sent = reach + np.abs(q) @ wide.T * (self.width + 4) * 2.0**-50 >= bar[:, None]
            for pivot in range(len(self.low)):
                asked = np.flatnonzero(sent[:, pivot])
                for at in range(0, len(asked), self.block):
                    part = asked[at:at + self.block]
                    sent_to[pivot] += 1
                    yield pa.RecordBatch.from_pydict({
                        "pivot": pa.array([pivot], pa.int32()), "slice": pa.array([first + (sent_to[pivot] - 1) // _BLOCKS], pa.int64()),
                        "home": pa.array([np.stack([c[part] for c in columns]).astype(np.int64).tobytes()], pa.binary()),
                        "queries": pa.array([values[part].tobytes()], pa.binary())})


def _meet(k: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        """A chunk and blocks of queries from elsewhere."""
        rows = table.to_pylist()
        lists = next((_lists(row, width) for row in rows if row["vectors"] is not None), None)
        out = [_FOUND.empty_table()]
        for row in rows:
            if lists is None or row["vectors"] is not None:
                continue
            query_rows, query_ids, bar, pivot, part = np.frombuffer(row["home"], np.int64).reshape(5, -1)
            queries = np.frombuffer(row["queries"], np.int64).reshape(-1, width)
            away = np.flatnonzero((pivot != row["pivot"]) | (part != row["part"]))
            found = lists.search(queries[away], k, bar[away], np.full(len(away), -1))
            out.append(_found(query_rows[away], query_ids[away], lists, found))
        return pa.concat_tables(out)
    return run


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, chunk: int = 8192, block: int = 128, pivots: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query. Runs jobs."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    column = F.col("embedding")
    ints = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    usable = vectors.where(finite(column) & F.col("vec_id").isNotNull() & (F.size(column) > 0))
    rows = scratch.store(usable.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint"), ints.alias("ints")), "ints")
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("ints")).alias("width")).first()
    width, wanted = known["width"] or 1, min(pivots, -(-max(known["n"], 1) // chunk))
    drawn = rows.orderBy(F.xxhash64("row"), "row").limit(wanted).select("ints").toArrow()
    like = rows.mapInArrow(_Dealer(matrix(drawn.column("ints"), width) if drawn.num_rows else np.zeros((1, width)), width), "row bigint, vec_id bigint, ints array<bigint>, pivot int")
    dealt = scratch.store(like, "dealt")
    parts = dealt.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))  # one row for each pivot
    cut = dealt.join(parts, "pivot").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")
    chunks = scratch.store(cut.groupBy("pivot", "part").applyInArrow(
        _typed(_packed(width)), "pivot int, part int, ids binary, rows binary, vectors binary, low array<bigint>, high array<bigint>"), "chunks")
    at_home = scratch.store(chunks.select("pivot", "part", "ids", "rows", "vectors").mapInArrow(
        _queries_at_home(k, every, width, block), "query_row bigint, query_id bigint, bar bigint, pivot int, part int, ints array<bigint>, vec_ids array<bigint>, scores array<bigint>"), "home")
    # ranges of values by pivot: at most `pivots` rows
    at = F.posexplode(F.arrays_zip("low", "high")).alias("j", "end")
    ranges = chunks.select("pivot", "part", at).groupBy("pivot", "j").agg(F.min("end.low").alias("low"), F.max("end.high").alias("high"), (F.max("part") + 1).alias("parts")).collect()
    low, high, count = np.full((wanted, width), np.inf), np.full((wanted, width), -np.inf), np.zeros(wanted, np.int64)
    for row in ranges:
        low[row["pivot"], row["j"]], high[row["pivot"], row["j"]], count[row["pivot"]] = row["low"], row["high"], row["parts"]
    empty = count == 0
    low[empty], high[empty] = 0, 0
    asked = at_home.select("query_row", "query_id", "bar", "pivot", "part", "ints").coalesce(max(-(-(known["n"] // every) // (block * _BLOCKS)), 1))
    sent = scratch.store(asked.mapInArrow(_Sender(low, high, block, width), "pivot int, slice bigint, home binary, queries binary"), "sent")
    parts_of = F.element_at(F.array(*[F.lit(int(max(c, 1))) for c in count]), F.col("pivot") + 1)
    every_part = F.explode(F.sequence(F.lit(0), parts_of - 1)).alias("part")
    slices = sent.select("pivot", "slice").distinct()
    none = F.lit(None).cast("binary")
    to_chunks = sent.select("pivot", every_part, "slice", none.alias("ids"), none.alias("rows"), none.alias("vectors"), "home", "queries")
    lists = chunks.join(slices, "pivot").select("pivot", "part", "slice", "ids", "rows", "vectors", none.alias("home"), none.alias("queries"))
    met = lists.unionByName(to_chunks).groupBy("pivot", "part", "slice").applyInArrow(
        _typed(_meet(k, width)), "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    inside = at_home.select("query_row", "query_id", F.explode(F.arrays_zip("vec_ids", "scores")).alias("f")).select(
        "query_row", "query_id", F.col("f.vec_ids").alias("vec_id"), F.col("f.scores").alias("score"))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = scratch.store(met.unionAll(inside).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked")
    scratch.drop("ints", "dealt", "chunks", "home", "sent")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _typed(function):
    def grouped(table: pa.Table) -> pa.Table:
        return function(table)
    return grouped


#: The same for DuckDB.
TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""
