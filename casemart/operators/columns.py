"""Finding columns by their known spellings (driver side, no job)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions.names import alias_key


class MissingColumnError(ValueError):
    """A column that the contract requires is absent under every known spelling."""


def column_key(name: str) -> str:
    return re.sub(r"\s+", "", name.lower())


def find_column(columns: DataFrame | Sequence[str], spellings: Iterable[str]) -> str | None:
    """The first spelling, in the given order, that some column carries."""
    names = columns.columns if isinstance(columns, DataFrame) else columns
    present = {column_key(name): name for name in names}
    return next((present[key] for key in map(column_key, spellings) if key in present), None)


def required_column(columns: DataFrame | Sequence[str], spellings: Iterable[str], meaning: str) -> str:
    found = find_column(columns, spellings)
    if found is None:
        names = columns.columns if isinstance(columns, DataFrame) else list(columns)
        raise MissingColumnError(f"no column for {meaning} among {names}")
    return found


def quoted(name: str) -> Column:
    """A column reference that survives dots, blanks and brackets in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_or(df: DataFrame, spellings: Iterable[str], default: Column) -> Column:
    found = find_column(df, spellings)
    return default if found is None else quoted(found)


def clean_headers(df: DataFrame) -> DataFrame:
    """Column names without byte-order marks and outer blanks."""
    return df.toDF(*[name.replace("\ufeff", "").strip() for name in df.columns])


def standardize_by_table(df: DataFrame, column: str, aliases: DataFrame, out: str) -> DataFrame:
    """`standardize_alias` with an alias table of any size (`spelling, name`) instead of a dict.

    Spellings that differ only in case, blanks and separators are one; of several names the smallest holds.
    """
    names = aliases.groupBy(alias_key(F.col("spelling")).alias("_key")).agg(F.min("name").alias("_name"))
    keyed = df.withColumn("_key", alias_key(quoted(column)))
    standard = F.coalesce("_name", F.trim(quoted(column).cast("string")))
    return keyed.join(names, "_key", "left").withColumn(out, standard).drop("_key", "_name")
