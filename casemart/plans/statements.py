"""The twelve ad-hoc statements over a star, its quality report and its load audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.functions import case_share, cumulative_rate
from casemart.operators.star import Star
from casemart.plans.views import demographics, monthly_trend, year_disease
from casemart.reference_values import NOT_RECONCILED, RECONCILED, SEX_LABELS

# What one row of each mart table stands for.
GRAINS: dict[str, str] = {
    "fact_disease_cases": "เดือน × เขต × โรค × กลุ่มอายุ × เพศ",
    "fact_population": "ปี × เขต (ตัวหารอัตราป่วย)",
    "dim_date": "เดือน",
    "dim_district": "เขต (ครบ 50 เขต)",
    "dim_disease": "โรค",
    "dim_age_group": "กลุ่มอายุ",
    "dim_sex": "เพศ",
    "data_quality": "กฎตรวจคุณภาพข้อมูลจาก Spark",
}
# Where the denominators of a year come from.
POPULATION_SOURCES: dict[int, str] = {
    2568: "กรมการปกครอง ณ 31 ธ.ค. 2567",
    2569: "สำนักงานปกครองและทะเบียน กทม. ณ มิ.ย. 2569",
}
INFORMATIONAL = "informational"


def table_counts(tables: Mapping[str, DataFrame], grains: Mapping[str, str] = GRAINS) -> DataFrame:
    """Row count and grain of every table."""
    counted = [
        table.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(grains.get(name, "")).alias("grain")
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def mart_counts(star: Star, quality: DataFrame) -> DataFrame:
    return table_counts({**star.tables(), "data_quality": quality})


def reconciliation(star: Star, quality: DataFrame) -> DataFrame:
    """Raw rows minus quarantined rows must equal the cases in the mart."""
    raw = quality.where("rule = 'raw_rows_not_empty'").select(F.col("observed").try_cast("long").alias("raw_rows"))
    rejected = quality.where("rule = 'quarantined_rows'").agg(F.max(F.col("observed").try_cast("long"))).scalar()
    mart = star.fact_disease_cases.agg(F.sum("total_cases")).scalar()
    return (
        raw.select("raw_rows", rejected.alias("quarantined"))
        .withColumn("expected", F.col("raw_rows") - F.col("quarantined"))
        .withColumn("mart_cases", mart)
        .withColumn("verdict", F.when(F.col("expected") == F.col("mart_cases"), RECONCILED).otherwise(NOT_RECONCILED))
    )


def load_history(audit: DataFrame, timezone: str = "Asia/Bangkok", newest: int = 5) -> DataFrame:
    """The newest loads in local time, with two of their row counts."""
    return audit.orderBy(F.desc("load_id")).limit(newest).select(
        "load_id",
        F.convert_timezone(None, F.lit(timezone), F.col("loaded_at")).alias("loaded_local"),
        F.col("row_counts")["fact_disease_cases"].alias("fact_rows"),
        F.col("row_counts")["fact_population"].alias("population_rows"),
    )


def cases_by_year_disease(star: Star) -> DataFrame:
    return (
        star.fact_disease_cases
        .join(star.dim_date.select("date_key", "year_be"), "date_key")
        .join(star.dim_disease, "disease_key")
        .groupBy("year_be", "disease_name").agg(F.sum("total_cases").alias("total_cases"))
        .orderBy("year_be", F.desc("total_cases"))
    )


def rate_list(star: Star) -> DataFrame:
    """City-wide rates, missing ones first within a year."""
    return year_disease(star).select(
        "year_be", "period_label", "disease_name", "total_cases", "population", "cumulative_incidence_per_100k"
    ).orderBy("year_be", F.desc_nulls_first("cumulative_incidence_per_100k"))


def month_disease_crosstab(star: Star, columns: Mapping[str, str]) -> DataFrame:
    """One row per month; `columns` maps output columns to disease names; all diseases in `total`."""
    trend = monthly_trend(star)
    cells = [F.sum(F.when(F.col("disease_name") == name, F.col("total_cases"))).alias(out)
             for out, name in columns.items()]
    return trend.groupBy("month_start", "month_label").agg(*cells, F.sum("total_cases").alias("total")).orderBy(
        "month_start"
    )


def peak_months(star: Star) -> DataFrame:
    """The month with most cases per disease; the earlier month wins a tie."""
    height = F.struct("total_cases", -F.unix_date("month_start"))
    peak = F.max_by(F.struct("month_label", "total_cases"), height).alias("peak")
    return (
        monthly_trend(star).groupBy("disease_name").agg(peak)
        .select("disease_name", "peak.month_label", "peak.total_cases")
        .orderBy(F.desc("total_cases"), "disease_name")
    )


def top_district_rates(star: Star, year_be: int, k: int = 10) -> DataFrame:
    """The k places with the highest all-disease rate in one year."""
    return (
        star.fact_disease_cases
        .join(star.dim_date.where(F.col("year_be") == year_be).select("date_key"), "date_key")
        .groupBy("district_key").agg(F.sum("total_cases").alias("total_cases"))
        .join(star.fact_population.where(F.col("year_be") == year_be), "district_key")
        .join(star.dim_district, "district_key")
        .select("district_name", "total_cases", "population",
                cumulative_rate(F.col("total_cases"), F.col("population"), 1).alias("rate_per_100k"))
        .orderBy(F.desc("rate_per_100k"), "district_name")
        .limit(k)
    )


def age_sex_shares(star: Star, year_be: int, labels: Mapping[str, str] = SEX_LABELS) -> DataFrame:
    """Cases by age band and sex in one year, with each band's share of the year."""
    year = demographics(star).where(F.col("year_be") == year_be)
    by_band = year.groupBy("age_group_key", "age_group").agg(
        F.sum(F.when(F.col("sex_label") == labels["M"], F.col("total_cases"))).alias("male"),
        F.sum(F.when(F.col("sex_label") == labels["F"], F.col("total_cases"))).alias("female"),
        F.sum("total_cases").alias("total"),
    )
    whole = (
        star.fact_disease_cases
        .join(star.dim_date.where(F.col("year_be") == year_be), "date_key", "left_semi")
        .agg(F.sum("total_cases")).scalar()
    )
    return by_band.orderBy("age_group_key").select(
        "age_group", "male", "female", "total", case_share(F.col("total"), whole, 1).alias("share_pct")
    )


def denominator_list(star: Star, sources: Mapping[int, str] = POPULATION_SOURCES) -> DataFrame:
    label = F.coalesce(*[F.when(F.col("year_be") == year, F.lit(text)) for year, text in sources.items()])
    return (
        star.fact_population.groupBy("year_be")
        .agg(F.count("*").alias("districts"), F.sum("population").alias("population"))
        .withColumn("source", label)
        .orderBy("year_be")
    )


def status_counts(quality: DataFrame) -> DataFrame:
    return quality.groupBy("status").agg(F.count("*").alias("rules"))


def enforced_rules(quality: DataFrame, columns: Sequence[str] = ("layer", "rule", "observed", "threshold", "status")):
    return quality.where(F.col("threshold") != INFORMATIONAL).select(*columns).orderBy("layer", "rule")
