"""Data behind the five report pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.plans.measures import Filters, Mart


def one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Several one-value results side by side."""
    first, *rest = parts
    return first.withColumns({part.columns[0]: part.scalar() for part in rest})


def overview_cards(mart: Mart, filters: Filters | None = None) -> DataFrame:
    return one_row([mart.measure(name, filters) for name in ("total_cases", "incidence_per_100k", "coverage_status")])


def overview_trend(mart: Mart, filters: Filters | None = None) -> DataFrame:
    by_month = mart.measure("total_cases", filters, ["month_start", "month_label", "disease_name"])
    return by_month.orderBy("month_start", "disease_name")


def overview_by_disease(mart: Mart, filters: Filters | None = None) -> DataFrame:
    return mart.measure("total_cases", filters, ["disease_name"]).orderBy(F.desc("total_cases"), "disease_name")


def trend_by_month(mart: Mart, filters: Filters | None = None) -> DataFrame:
    return mart.measure("total_cases", filters, ["month_start", "month_label"]).orderBy("month_start")


def trend_cards(mart: Mart, filters: Filters | None = None) -> DataFrame:
    return one_row([mart.measure(name, filters) for name in ("mom_change", "yoy_change")])


def district_table(mart: Mart, filters: Filters | None = None) -> DataFrame:
    """Every selected place with its cases, denominator, rate and rank."""
    table = mart.measure("district_rank", filters, ["district_name"])
    for name in ("total_cases", "population", "incidence_per_100k"):
        table = table.join(mart.measure(name, filters, ["district_name"]), "district_name", "left")
    return table.select(
        "district_name", "total_cases", "population", "incidence_per_100k", "district_rank"
    ).orderBy(F.desc_nulls_last("incidence_per_100k"), "district_name")


def age_sex_counts(mart: Mart, filters: Filters | None = None) -> DataFrame:
    groups = ["age_group_key", "age_group", "sex_label"]
    return mart.measure("total_cases", filters, groups).orderBy("age_group_key", "sex_label")


def age_sex_share_matrix(mart: Mart, filters: Filters | None = None, sexes: Sequence[str] = ("F", "M", "U")):
    """Share per age band (rows) and sex code (columns)."""
    shares = mart.measure("case_share", filters, ["age_group_key", "age_group", "sex"])
    matrix = shares.groupBy("age_group_key", "age_group").pivot("sex", list(sexes)).agg(F.first("case_share"))
    return matrix.select(
        "age_group_key", "age_group", *[F.col(sex).alias(f"share_{sex.lower()}") for sex in sexes]
    ).orderBy("age_group_key")


def quality_table(mart: Mart) -> DataFrame:
    return mart.quality.select("layer", "rule", "observed", "threshold", "status").orderBy("status", "layer", "rule")
