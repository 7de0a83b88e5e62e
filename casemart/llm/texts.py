"""Distinct texts of a corpus, so that later steps meet each text once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_SCHEMA = "key binary, copies bigint, text string"
_TEXT_ARROW = pa.schema([("key", pa.binary()), ("copies", pa.int64()), ("text", pa.string())])


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def merge_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key in a partition; copies seen later are counted in rows without a text at the end."""
    seen: dict[bytes, int] = {}
    for batch in batches:
        keys, copies, new = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        for k, (key, count) in enumerate(zip(keys, copies, strict=True)):
            if key not in seen:
                seen[key] = 0
                new.append(k)
            else:
                seen[key] += count
        if new:
            chosen = batch.take(pa.array(new, pa.int64()))
            yield pa.RecordBatch.from_arrays(chosen.columns, schema=_TEXT_ARROW)
    more = [(key, count) for key, count in seen.items() if count]
    for at in range(0, len(more), 50_000):
        part = more[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([
            pa.array([key for key, _ in part], pa.binary()), pa.array([count for _, count in part], pa.int64()),
            pa.nulls(len(part), pa.string()),
        ], schema=_TEXT_ARROW)


def distinct_texts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(key, copies, text): one row with the text for each distinct text, and rows without a text that add to its `copies`.

    Equal texts are merged within each task before the shuffle, so a text of a third of all rows arrives as one row a task.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(text_key(F.col(text_column)).alias("key"), F.lit(1).cast("bigint").alias("copies"), text.alias("text"))
    return rows.mapInArrow(merge_equal, TEXT_SCHEMA).repartition("key").mapInArrow(merge_equal, TEXT_SCHEMA)
