"""Choosing among versions of raw files: one file per year."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.reference_values import CASE_FILE_PATTERN
from casemart.sources.paths import SourceNotFound, list_files


def versions(files: DataFrame, pattern: str = CASE_FILE_PATTERN) -> DataFrame:
    """`path, year, kind, version` of the files whose name follows the pattern; others are left out.

    A full file without a version is older than every versioned one.
    """
    plain = F.translate("path", "\\", "/")
    parts = {name: F.regexp_extract(plain, pattern, group) for name, group in
             (("year", 1), ("kind", 2), ("version", 3))}
    return files.select("path", *[part.alias(name) for name, part in parts.items()]).where("year != ''")


def latest_per_year(files: DataFrame) -> DataFrame:
    """The newest full file of each year, or its sample where there is no full file."""
    rank = F.struct((F.col("kind") == "full").alias("full"), "version", "path")
    return versions(files).groupBy("year").agg(F.max_by("path", rank).alias("path"))


def latest_full(files: DataFrame, year: str | None = None) -> DataFrame:
    """The newest full file per year, or of one year; samples are ignored."""
    full = versions(files).where("kind = 'full'")
    if year is not None:
        full = full.where(F.col("year") == year)
    return full.groupBy("year").agg(F.max_by("path", F.struct("version", "path")).alias("path"))


def versioned_name(year: str, version: str) -> str:
    """The name under which a new full download of a year is kept."""
    if not re.fullmatch(r"\d{8}", version):
        raise ValueError(f"a version is a date as YYYYMMDD, not {version!r}")
    return f"disease_cases_{year}_full_{version}.csv"


def chosen_files(spark: SparkSession, location: str) -> list[str]:
    """Paths to read, one per year in year order (runs a listing job; bounded by the number of years)."""
    chosen = latest_per_year(list_files(spark, location)).orderBy("year").collect()
    if not chosen:
        raise SourceNotFound(f"no case files at {location}")
    return [row.path for row in chosen]
