"""Dense ranks over a whole column without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from casemart.operators.columns import quoted
from casemart.operators.storage import materialize

# Fixed number of ranges; it bounds what reaches the driver and the plan, not what is numbered.
RANGES = 64


def range_bounds(distinct: DataFrame, column: str, ranges: int) -> list:
    """Up to `ranges` - 1 values that split distinct values evenly: those of the smallest hashes (runs a job).

    Hashes don't depend on partitions or order, so a retried task sees the same ranges.
    """
    drawn = distinct.orderBy(F.xxhash64(column), column).limit(ranges - 1)
    return sorted(row[0] for row in drawn.collect())


def dense_keys(values: DataFrame, column: str, key: str, ranges: int = RANGES) -> DataFrame:
    """Distinct non-null values of `column` numbered 1, 2, ... in ascending order (runs a job).

    Values fall into a fixed number of ranges; a value's key is its place within its range plus the number
    of values in the ranges before it.
    """
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    bounds = range_bounds(distinct, column, ranges)
    kind = distinct.schema[column].dataType
    starts_at = F.array(*[F.lit(bound).cast(kind) for bound in bounds]).cast(ArrayType(kind))
    ranged = distinct.withColumn("_range", F.size(F.filter(starts_at, lambda start: start <= F.col(column))))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy("_range").orderBy(column))
    return (
        ranged.withColumn("_place", place)
        .join(starts, "_range")
        .select(column, (F.col("_start") + F.col("_place")).cast("int").alias(key))
    )


def positioned(df: DataFrame, order: Sequence[str | Column], path: str, position: str = "position") -> DataFrame:
    """`df` with every row's place, from 1, in a total order of `order` (runs a job that writes `path`).

    Rows are sorted within ranges; a row's position is its place within its range plus the number of rows in the ranges before it, of which
    there is one for each task. The stored ranges are read back, so positions don't change when a task is retried.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    stored = materialize(ranged, path).withColumn("_range", F.shiftright("_place", 33))
    sizes = stored.groupBy("_range").agg(F.count("*").alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.col("_place") - F.shiftleft("_range", 33) + F.col("_start") + 1
    return stored.join(starts, "_range").select(*[quoted(name) for name in df.columns], place.alias(position))


def running_total(df: DataFrame, position: str, value: str, total: str, block: int = 4096) -> DataFrame:
    """Add the sum of `value` over all rows of a smaller position: inside blocks of positions, plus the blocks before."""
    blocked = df.withColumn("_block", F.floor(F.col(position) / block))
    sums = blocked.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("_block").orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    summed = blocked.join(starts, "_block").withColumn(total, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.drop("_block", "_start")


def dense_rank_desc(df: DataFrame, column: str, rank: str) -> DataFrame:
    """Add the dense rank of `column`, largest first; NULL ranks as zero would."""
    valued = df.withColumn("_negated", -F.coalesce(F.col(column), F.lit(0)))
    ranks = dense_keys(valued, "_negated", rank)
    return valued.join(ranks, "_negated").drop("_negated")
