"""The seven analytical views. Each takes a star and returns one DataFrame.

Facts join their dimensions before grouping: dimensions read from stored tables carry file sizes, so
Spark hash-joins the small ones map-side and the grouping is the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casemart.functions import case_share, cumulative_rate
from casemart.operators.star import Star
from casemart.reference_values import BUDDHIST_OFFSET


def disease_overview(star: Star) -> DataFrame:
    """The fact with every key resolved to its labels."""
    return (
        star.fact_disease_cases
        .join(star.dim_date, "date_key")
        .join(star.dim_district, "district_key")
        .join(star.dim_disease, "disease_key")
        .join(star.dim_age_group, "age_group_key")
        .join(star.dim_sex, "sex")
        .select("month_start", "year_be", "year_ce", "quarter", "month", "month_label", "district_name",
                "disease_name", "age_group_key", "age_group", "sex", "sex_label", "total_cases", "source_records")
    )


def month_disease_grid(star: Star) -> DataFrame:
    """Every month for every disease: the calendar is one small array, exploded per disease."""
    month = F.struct("date_key", "month_start", "month_label", "year_be")
    months = star.dim_date.agg(F.collect_list(month)).scalar()
    return star.dim_disease.select("disease_key", "disease_name", F.explode(months).alias("m")).select(
        "disease_key", "disease_name", "m.*"
    )


def monthly_trend(star: Star) -> DataFrame:
    """Cases per month and disease, zero where a month has none."""
    counted = star.fact_disease_cases.groupBy("date_key", "disease_key").agg(F.sum("total_cases").alias("cases"))
    return month_disease_grid(star).join(counted, ["date_key", "disease_key"], "left").select(
        "month_start", "month_label", "year_be", "disease_name",
        F.coalesce("cases", F.lit(0)).cast("long").alias("total_cases"),
    )


def year_period(star: Star) -> DataFrame:
    """Months covered per year and the label of the span."""
    first, last = F.min_by("month_label", "month_start"), F.max_by("month_label", "month_start")
    return star.dim_date.groupBy("year_be").agg(
        F.count("*").alias("months_covered"), F.concat(first, F.lit(" – "), last).alias("period_label")
    )


def year_disease(star: Star) -> DataFrame:
    """City-wide cases and rate per year and disease; the rate needs a denominator for every place in scope."""
    cases = (
        star.fact_disease_cases.join(star.dim_date.select("date_key", "year_be"), "date_key")
        .groupBy("year_be", "disease_key")
        .agg(F.sum("total_cases").alias("total_cases"), F.sum("source_records").alias("source_records"))
    )
    scope = star.dim_district.agg(F.count_if("is_bangkok_district")).scalar()
    population = (
        star.fact_population.join(star.dim_district, "district_key")
        .groupBy("year_be")
        .agg(F.sum("population").alias("population"),
             F.count_if("is_bangkok_district").alias("districts_with_population"))
    )
    covered = F.col("districts_with_population") == scope
    rate = F.when(covered, cumulative_rate(F.col("total_cases"), F.col("population")))
    return (
        cases.join(star.dim_disease, "disease_key")
        .join(year_period(star), "year_be")
        .join(population, "year_be", "left")
        .select(
            "year_be", (F.col("year_be") - BUDDHIST_OFFSET).alias("year_ce"), "months_covered", "period_label",
            "disease_name", "total_cases", "source_records", "population",
            F.coalesce("districts_with_population", F.lit(0)).cast("long").alias("districts_with_population"),
            rate.alias("cumulative_incidence_per_100k"),
        )
    )


def district_disease_year(star: Star) -> DataFrame:
    """Cases and rate per year, place and disease against the place's own denominator."""
    cases = (
        star.fact_disease_cases.join(star.dim_date.select("date_key", "year_be"), "date_key")
        .groupBy("year_be", "district_key", "disease_key")
        .agg(F.sum("total_cases").alias("total_cases"))
    )
    return (
        cases.join(star.dim_district, "district_key")
        .join(star.dim_disease, "disease_key")
        .join(year_period(star), "year_be")
        .join(star.fact_population, ["year_be", "district_key"], "left")
        .select(
            "year_be", "months_covered", "period_label", "district_name", "disease_name", "total_cases", "population",
            cumulative_rate(F.col("total_cases"), F.col("population")).alias("cumulative_incidence_per_100k"),
        )
    )


def district_ranking(star: Star) -> DataFrame:
    """Places ranked by cases within each year; ties share a rank and leave a gap."""
    totals = (
        star.fact_disease_cases.join(star.dim_date.select("date_key", "year_be"), "date_key")
        .groupBy("year_be", "district_key")
        .agg(F.sum("total_cases").alias("total_cases"), F.sum("source_records").alias("source_records"))
        .join(star.dim_district, "district_key")
    )
    most_first = W.partitionBy("year_be").orderBy(F.desc("total_cases"))
    return totals.select(
        "year_be", "district_name", "total_cases", "source_records", F.rank().over(most_first).alias("cases_rank")
    )


def demographics(star: Star) -> DataFrame:
    """Age band and sex counts with their share of the year and disease."""
    counts = (
        star.fact_disease_cases.join(star.dim_date.select("date_key", "year_be"), "date_key")
        .groupBy("year_be", "disease_key", "age_group_key", "sex")
        .agg(F.sum("total_cases").alias("total_cases"))
        .join(star.dim_disease, "disease_key")
        .join(star.dim_age_group, "age_group_key")
        .join(star.dim_sex, "sex")
    )
    # A (year, disease) holds at most bands x sexes rows here.
    whole = F.sum("total_cases").over(W.partitionBy("year_be", "disease_name"))
    return counts.select(
        "year_be", "disease_name", "age_group_key", "age_group", "sex_label", "total_cases",
        case_share(F.col("total_cases"), whole).alias("share_pct"),
    )


VIEWS = {
    "vw_disease_overview": disease_overview,
    "vw_monthly_trend": monthly_trend,
    "vw_year_period": year_period,
    "vw_year_disease": year_disease,
    "vw_district_disease_year": district_disease_year,
    "vw_district_ranking": district_ranking,
    "vw_demographics": demographics,
}
