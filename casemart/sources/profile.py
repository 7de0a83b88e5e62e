"""Profiles of raw tables, as long tables instead of printed text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.operators.columns import quoted
from casemart.operators.identity import identical_rows


def missing_cells(df: DataFrame) -> DataFrame:
    """`column_name, missing_cells`, all columns counted in one pass."""
    counts = [
        F.struct(F.lit(name).alias("column_name"), F.count_if(quoted(name).isNull()).alias("missing_cells"))
        for name in df.columns
    ]
    return df.agg(F.array(*counts).alias("_counts")).select(F.inline("_counts"))


def table_profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells, rows that repeat another row."""
    empty_cells = sum((F.when(quoted(name).isNull(), 1).otherwise(0) for name in df.columns), F.lit(0))
    totals = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(empty_cells), F.lit(0)).alias("missing_cells"))
    repeated = identical_rows(df, df.columns).scalar()
    return totals.select(
        "rows", F.lit(len(df.columns)).alias("columns"), "missing_cells", repeated.alias("duplicate_rows")
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column_name, value, rows`, with NULL as a value of its own; all columns in one pass."""
    cells = [F.struct(F.lit(name).alias("column_name"), quoted(name).cast("string").alias("value")) for name in columns]
    return df.select(F.inline(F.array(*cells))).groupBy("column_name", "value").agg(F.count("*").alias("rows"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column_name, distinct_values`, NULL not counted; one shuffle for all columns."""
    return value_counts(df, columns).groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def date_range(df: DataFrame, column: str, parse) -> DataFrame:
    """Earliest and latest date; text that is no date counts as missing."""
    date: Column = parse(quoted(column))
    return df.agg(
        F.min(date).alias("earliest"), F.max(date).alias("latest"), F.count_if(date.isNull()).alias("unreadable")
    )


def subset_sums(df: DataFrame, column: str, members: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Row count and column sums of the rows whose `column` is one of `members`."""
    return df.where(quoted(column).isin(list(members))).agg(
        F.count("*").alias("rows"), *[F.sum(quoted(value).try_cast("double")).alias(value) for value in values]
    )
