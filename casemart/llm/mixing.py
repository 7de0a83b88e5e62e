"""Mixing sources to target weights with hash-threshold histograms, in DataFrame operations only.

Each source gets a target number of words and every document a 40-bit hash of its id and text. A source that needs r times its words takes every document
floor(r) times and those whose hash lies below a threshold once more. The threshold is found without sorting: words are summed
by source and the first 10 bits of the hash, the bucket in which the running sum crosses the remaining budget is
found, and only that bucket is split by the next 10 bits, four times in all. Rows of the hash value at the threshold are rows
of one id and one text: they are stored with row numbers, and a hash of the number is refined in the same way, so that as many of them are taken
as fit. The words taken stay below the target by less than one document.

Scale. Sums by (source, bucket) are combined before the shuffle, so a source with a third of all rows costs 1,024 rows a
task. Words are counted once and stored; later passes read sources, sizes and hashes only, and each level's result is a stored table of one row for each source.
A group of equal rows, however large, is never in one task. Small tables of one row for each source are joined by Spark's own choice, never by a hint.

Edge cases. A null text has size 0; a null source is a source of its own, last in order; null ids and repeated ids hash with their text. Which
of several rows with equal id and text are taken once more is arbitrary, how many is not. A source without words has target 0. Without rows, no
rows. Rows pass as a whole, so other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.storage import Scratch

_LEVEL_BITS, _LEVELS = 10, 4


def word_count(text: Column) -> Column:
    """Number of longest runs of characters other than ASCII blanks; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def hash40(column: Column) -> Column:
    """The first 40 bits of the MD5 of a value as text."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 10), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size and target: `share` of all words by repeating weights, at most `most` times a source's words.

    What a source can't use goes to the others by weight until none is above its limit: the sources with the smallest limit for their
    weight are filled first, and all others share what is left. One row for each source takes part.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    limited = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("limit"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    left = (F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    level = limited.withColumn("left", left).withColumn("weights_left", F.sum("weight").over(after))
    even = F.col("weight") * F.col("left") / F.col("weights_left")
    # filled sources come first in this order: from the first that isn't filled on, all share the same level
    open_ = even <= F.col("limit")
    first_open = F.first(F.when(open_, F.struct("left", "weights_left")), ignorenulls=True).over(
        by_limit.rowsBetween(Window.unboundedPreceding, 0))
    shared = level.withColumn("at", first_open)
    target = F.when(F.col("at").isNull(), F.col("limit")).otherwise(F.col("weight") * F.col("at.left") / F.col("at.weights_left"))
    return shared.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _threshold(rows: DataFrame, budgets: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """source, budget and limit: rows (source, size, hash) with a hash below `limit` fit, and `budget` is what is left of it then."""
    state = budgets.select("source", "budget", F.lit(0).cast("bigint").alias("prefix"))
    bits = _LEVEL_BITS * _LEVELS
    for level in range(1, _LEVELS + 1):
        shift = bits - level * _LEVEL_BITS
        inside = rows.withColumnRenamed("source", "own").join(
            state, F.col("own").eqNullSafe(F.col("source")) & (F.shiftright("hash", shift + _LEVEL_BITS) == F.col("prefix")))
        sums = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("budget").alias("budget"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        reached = sums.withColumn("running", running)
        before = F.col("running") - F.col("words")
        ends = reached.groupBy("source").agg(
            F.min_by(F.when(F.col("running") > F.col("budget"), F.struct("bucket", (F.col("budget") - before).alias("budget"))),
                     F.when(F.col("running") > F.col("budget"), F.col("bucket"))).alias("at"),
            F.max("running").alias("all_words"))
        # where nothing crosses the budget, the whole prefix is taken: the next level then looks past its end, at no rows
        known = state.withColumnRenamed("source", "own").join(ends, F.col("own").eqNullSafe(F.col("source")), "left")
        past = (F.col("prefix") + 1) * F.lit(1 << _LEVEL_BITS)
        state = scratch.store(known.select(
            F.col("own").alias("source"), F.coalesce("at.budget", F.col("budget") - F.coalesce("all_words", F.lit(0))).alias("budget"),
            F.coalesce("at.bucket", past).alias("prefix")), f"{name}-{level}")
        if level > 1:
            scratch.drop(f"{name}-{level - 1}")
    return state.withColumnRenamed("prefix", "limit")


def _plan(sized: DataFrame, scratch: Scratch, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """own (the source), source_size, target, base, limit and budget left: one row for each source."""
    targets = scratch.store(source_targets(sized, weights, share, most), "targets")
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    budgets = targets.withColumn("base", base).withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
    limits = _threshold(sized, budgets, scratch, "limits")
    joined = budgets.drop("budget").withColumnRenamed("source", "own").join(limits, F.col("own").eqNullSafe(F.col("source")))
    return scratch.store(joined.select("own", "source_size", "target", "base", "limit", "budget"), "plan")


def _times(once_more: Column, most: float) -> Column:
    return F.least(F.col("base") + once_more.cast("bigint"), F.lit(int(most))).alias("times")


def _decided(rows: DataFrame, plan: DataFrame, size: Column, scratch: Scratch, most: float) -> DataFrame:
    """`rows` (row, source, hash) as row, source_size, target and times: how often the mix takes each."""
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("own")))
    kept = ["row", "source_size", "target"]
    clear = joined.where(F.col("hash") != F.col("limit")).select(*kept, _times(F.col("hash") < F.col("limit"), most))
    # rows at the threshold: of one id and text for each source, but for equal 40-bit hashes
    edge = scratch.store(joined.where(F.col("hash") == F.col("limit")).select(*kept, "source", "base", "budget", size.alias("size"), F.monotonically_increasing_id().alias("number")), "edge")
    numbered = edge.withColumn("hash", F.shiftrightunsigned(F.xxhash64("number"), 64 - _LEVEL_BITS * _LEVELS))
    budgets = numbered.groupBy("source").agg(F.first("budget").alias("budget"))
    limits = _threshold(numbered.select("source", "size", "hash"), budgets, scratch, "edges").select(F.col("source").alias("own"), "limit")
    split = numbered.join(limits, F.col("source").eqNullSafe(F.col("own"))).select(*kept, _times(F.col("hash") < F.col("limit"), most))
    return clear.unionAll(split)


def _hashed(row: Column) -> list[Column]:
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))
    return [row.alias("row"), F.col("source"), hash40(text).alias("hash")]


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) for every row of `docs`. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "mixing")
    size = word_count(F.col("text")).alias("size")
    rows = scratch.store(docs.select(*_hashed(F.struct("doc_id", size)), size), "sized")
    plan = _plan(rows.select("source", "size", "hash"), scratch, weights, share, most)
    done = _decided(rows.select("row", "source", "hash"), plan, F.col("row.size"), scratch, most)
    return done.select("row.doc_id", "row.size", "source_size", "target", (F.col("times") * F.col("row.size")).alias("taken"))


def take_mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with the same columns. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "mixing")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    sized = scratch.store(docs.select(*_hashed(F.lit(None)), word_count(F.col("text")).alias("size")).drop("row"), "sized")
    plan = _plan(sized, scratch, weights, share, most)
    done = _decided(docs.select(*_hashed(whole)), plan, word_count(F.col("row.text")), scratch, most)
    scratch.drop("sized")
    taken = done.select("row", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    return taken.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


#: The same result for DuckDB: there the running sum over sorted hashes is affordable.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 10) AS UBIGINT) AS BIGINT) AS hash
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS lim,
         1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total
  FROM sizes),
levels AS (
  SELECT *, total - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
  FROM weighed),
first_open AS (
  SELECT left_over AS l, weights_left AS w FROM levels WHERE weight * left_over / weights_left <= lim
  ORDER BY lim / weight, source NULLS LAST LIMIT 1),
open_from AS (SELECT min(lim / weight) AS c FROM levels WHERE weight * left_over / weights_left <= lim),
targets AS (
  SELECT source, source_size, CASE WHEN c IS NULL OR lim / weight < c THEN lim ELSE weight * l / w END AS target
  FROM levels CROSS JOIN open_from LEFT JOIN first_open ON TRUE),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM targets),
ranked AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.base, b.target - b.base * b.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash ROWS UNBOUNDED PRECEDING) AS running
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(least(base + CASE WHEN running <= budget THEN 1 ELSE 0 END, 2) * size AS BIGINT) AS taken
FROM ranked
"""
