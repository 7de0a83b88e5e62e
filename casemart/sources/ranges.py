"""Records that reach over several pieces of a file, put together from files that Spark splits at every separator.

A reader deals a file out in byte ranges (`block`), and a range in pieces: lines, or what lies between two commas. Whether a piece starts a
record depends on all before it in the file, but only through a small state. What a range does to the state is a sum, so prefix sums
over a file's ranges (one row for each 128 MB) give the state in which each range begins, and running sums inside a range do the rest. Lines of CSV files
get theirs in the task that reads the range, pieces of JSON files by window functions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from casemart.operators.storage import materialize, scratch_path
from casemart.sources.paths import file_path



def in_range() -> WindowSpec:
    """The pieces of a byte range in order."""
    return Window.partitionBy("path", "block").orderBy("place")


def before_piece() -> WindowSpec:
    return in_range().rowsBetween(Window.unboundedPreceding, -1)


def whole_file() -> WindowSpec:
    """All ranges of a file."""
    return Window.partitionBy("path")


def before_range() -> WindowSpec:
    return whole_file().orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def file_pieces(spark: SparkSession, paths: Sequence[str], separator: str | None = None) -> DataFrame:
    """`path, block, place, piece`: what lies between separators (line ends), as stored. `block` is where a byte range begins, `place` orders its pieces."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(list(paths)).select(
        file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("piece"))


def summed_before(column: Column | str, window: WindowSpec) -> Column:
    """Sum over the rows of a window, 0 where it has none."""
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def whole_records(pieces: DataFrame, separator: str) -> DataFrame:
    """`path, at, text` of every record, from `path, block, place, at, starts, piece`. Runs jobs.

    What a range holds before its first record is the tail of the last record of an earlier range, and is joined to it: one row for each range, while records
    are put together inside of ranges.
    """
    numbered = pieces.withColumn("number", F.count_if("starts").over(in_range().rowsBetween(Window.unboundedPreceding, 0)))
    parts = materialize(numbered.groupBy("path", "block", "number").agg(F.min("at").alias("at"), joined("at", "piece", separator).alias("text")), scratch_path(pieces.sparkSession, "pieces"))
    last = parts.groupBy("path", "block").agg(F.max("number").alias("number"))
    owner = F.last(F.when(F.col("number") > 0, F.struct(F.col("block").alias("of_block"), F.col("number").alias("of_number"))), ignorenulls=True).over(before_range())
    owners = last.select("path", "block", owner.alias("owner")).select("path", "block", "owner.*")
    heads = parts.where("number = 0").join(owners, ["path", "block"])
    tails = heads.groupBy("path", F.col("of_block").alias("block"), F.col("of_number").alias("number")).agg(joined("at", "text", separator).alias("tail"))
    found = parts.where("number > 0").join(tails, ["path", "block", "number"], "left")
    return found.select("path", "at", F.concat_ws(separator, "text", "tail").alias("text"))


def joined(order: str, text: str, separator: str) -> Column:
    """The texts of a group in order, as one."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda part: part[text]), separator)


def whole_line_records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """`path, at, text, is_utf8, closed` of every CSV record, from `path, block, quotes, piece` as a scan gives them and the state of each range. Runs jobs.

    Lines stay in the task that reads them: it has a range's lines in order, so running sums need no window, and only the first and last record of a range
    are joined over ranges. The states, one row for each range, are sent to all tasks, which keeps the order of the lines.
    """
    spark = lines.sparkSession
    placed = lines.select("path", "block", "quotes", F.col("piece").cast("binary").alias("piece")).join(F.broadcast(ranges), ["path", "block"])
    cut = placed.select("path", "block", "first", "inside", "closed", "is_utf8", "quotes", "piece").mapInArrow(
        _line_records, "path string, block long, number long, at long, text binary, is_last boolean, closed boolean, is_utf8 boolean")
    parts = materialize(cut, scratch_path(spark, "pieces")).withColumn("text", F.col("text").cast("string"))
    owner = F.last(F.when(F.col("number") > 0, F.struct(F.col("block").alias("of_block"), F.col("number").alias("of_number"))), ignorenulls=True).over(before_range())
    owners = parts.where("is_last").select("path", "block", owner.alias("owner")).select("path", "block", "owner.*")
    heads = parts.where("number = 0").join(owners, ["path", "block"])
    tails = heads.groupBy("path", F.col("of_block").alias("block"), F.col("of_number").alias("number")).agg(joined("at", "text", "\n").alias("tail"))
    # stored, so that its size is known and whole records aren't shuffled for it
    stored = materialize(tails, scratch_path(spark, "tails"))
    found = parts.where("number > 0").join(stored, ["path", "block", "number"], "left")
    return found.select("path", "at", F.concat_ws("\n", "text", "tail").alias("text"), "is_utf8", "closed")


def _line_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ranges, in order, to records numbered from 1 within their range; 0 is what lies before the first one."""
    key, head = None, None  # the range being read, and the columns that all of its records share
    number = line = parity = open_at = 0
    open_text: list[bytes] = []  # lines of the record that isn't known to have ended

    def rows(numbers, at, texts, last: bool) -> pa.RecordBatch:
        n = len(texts)
        path, block, closed, utf8 = (pa.repeat(value, n) for value in head)
        return pa.RecordBatch.from_arrays(
            [path, block, pa.array(numbers, pa.int64()), pa.array(at, pa.int64()), texts, pa.repeat(pa.scalar(last), n), closed, utf8],
            names=["path", "block", "number", "at", "text", "is_last", "closed", "is_utf8"])

    def open_record(last: bool) -> pa.RecordBatch:
        return rows([number], [open_at], pa.array([b"\n".join(open_text)], pa.binary()), last)

    for batch in batches:
        path, block = batch.column("path"), batch.column("block")
        other = np.ones(batch.num_rows, dtype=bool)
        if batch.num_rows > 1:
            other[1:] = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        bounds = [*np.flatnonzero(other).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            if (path[a].as_py(), block[a].as_py()) != key:
                if open_text:
                    yield open_record(True)
                key, head = (path[a].as_py(), block[a].as_py()), (path[a], block[a], batch.column("closed")[a], batch.column("is_utf8")[a])
                number, line, parity, open_text = 0, batch.column("first")[a].as_py(), batch.column("inside")[a].as_py(), []
            part = batch.column("piece").slice(a, b - a)
            quotes = batch.column("quotes").slice(a, b - a).to_numpy().astype(np.int64)
            before = parity + np.cumsum(quotes) - quotes
            starts = np.flatnonzero(before % 2 == 0) if head[2].as_py() else np.arange(b - a)
            parity += int(quotes.sum())
            first = int(starts[0]) if len(starts) else b - a
            if first:
                if not open_text:
                    open_at = line + 1
                open_text += part.slice(0, first).to_pylist()
            if len(starts):
                if open_text:
                    yield open_record(False)
                if len(starts) > 1:
                    texts = part.slice(first, int(starts[-1]) - first)
                    if len(texts) > len(starts) - 1:
                        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts - first, pa.int32()), texts), b"\n")
                    yield rows(number + 1 + np.arange(len(starts) - 1), line + 1 + starts[:-1], texts, False)
                number, open_at, open_text = number + len(starts), line + 1 + int(starts[-1]), part.slice(int(starts[-1])).to_pylist()
            line += b - a
    if open_text:
        yield open_record(True)
