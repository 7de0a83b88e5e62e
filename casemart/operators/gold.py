"""The yearly rate table: cases per year, place and disease against a denominator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions import incidence

GOLD_KEY = ("year_be", "district_name", "disease_name")


def records(ids_unique: bool) -> Column:
    """Distinct case ids; a plain count where deduplication has already made ids unique."""
    return F.count("case_id") if ids_unique else F.count_distinct("case_id")


def yearly_cases(cases: DataFrame, ids_unique: bool = False) -> DataFrame:
    return cases.groupBy(*GOLD_KEY).agg(
        F.sum("case_count").alias("total_cases"), records(ids_unique).alias("source_records")
    )


def gold_table(cases: DataFrame, population: DataFrame, ids_unique: bool = False) -> DataFrame:
    """Aggregate first, then look up the denominator: both join sides are one row per key."""
    rated = yearly_cases(cases, ids_unique).join(
        population.select("year_be", "district_name", "population"), ["year_be", "district_name"], "left"
    )
    return rated.select(
        *GOLD_KEY,
        F.round("total_cases").cast("long").alias("total_cases"),
        F.round("population").cast("long").alias("population"),
        incidence(F.col("total_cases"), F.col("population")).alias("incidence_rate_per_100k"),
        F.col("source_records").cast("long").alias("source_records"),
    )
