"""The data-quality report: one aggregate per layer, assembled into one row, unfolded into rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.config import Settings
from casemart.domain import CaseDomain
from casemart.functions import safe_ratio
from casemart.operators.columns import quoted
from casemart.operators.gold import GOLD_KEY
from casemart.operators.identity import compact_fingerprint, duplicate_summary
from casemart.operators.rules import REASON
from casemart.operators.star import FACT_KEY, Star
from casemart.reference_values import BUDDHIST_OFFSET

PASS, FAIL, SKIP = "PASS", "FAIL", "SKIP"
INFORMATIONAL = "informational"
LINEAGE_COLUMNS = ("_source_file", "_record_id", "_id")
REQUIRED_COLUMNS = ("year_be", "disease_name_raw", "district_name_raw", "case_count", "report_date", "age")
RATE_TOLERANCE = 0.01


@dataclass(frozen=True)
class Layers:
    """What the report looks at. `tagged` holds canonical cases with their quarantine reason."""

    raw: DataFrame
    tagged: DataFrame
    identified: DataFrame
    standardized: DataFrame
    gold: DataFrame
    star: Star | None = None
    population: DataFrame | None = None


def raw_metrics(raw: DataFrame) -> DataFrame:
    """Rows, and rows that repeat another one in every source column."""
    source = [quoted(c) for c in raw.columns if c not in LINEAGE_COLUMNS]
    per_record = raw.groupBy(compact_fingerprint(source).alias("_print")).agg(F.count("*").alias("_copies"))
    return per_record.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("identical_rows"),
    )


def case_metrics(tagged: DataFrame, settings: Settings) -> DataFrame:
    """Counts of the tagged layer, and a map of rows by reason, whatever reasons its rules have. One scan, grouped by reason first."""
    date_year = F.year("report_date") + F.lit(BUDDHIST_OFFSET)
    by_reason = tagged.groupBy(F.col(REASON).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.isnull("report_date")).alias("missing_dates"),
        F.count_if(~F.col("age").between(0, settings.maximum_age)).alias("odd_ages"),
        F.count_if(F.col("year_be") != date_year).alias("odd_years"),
    )
    clean = F.isnull("reason")

    def total(counted: Column | str) -> Column:
        return F.coalesce(F.sum(counted), F.lit(0))

    return by_reason.agg(
        total(F.when(clean, F.col("rows"))).alias("clean_rows"),
        total(F.when(~clean, F.col("rows"))).alias("quarantined_rows"),
        total("missing_dates").alias("missing_dates"),
        total(F.when(clean, F.col("odd_ages"))).alias("invalid_ages"),
        total(F.when(clean, F.col("odd_years"))).alias("year_mismatches"),
        F.array_sort(F.collect_list(F.when(~clean, F.struct("reason", "rows")))).alias("reasons"),
    )


def standardized_metrics(standardized: DataFrame, domain: CaseDomain) -> DataFrame:
    return standardized.agg(
        F.count("*").alias("standardized_rows"),
        F.count_if(~domain.in_scope(F.col("district_name"))).alias("outside_master"),
        F.coalesce(F.round(F.sum("case_count")), F.lit(0)).cast("long").alias("standardized_cases"),
    )


def gold_metrics(gold: DataFrame) -> DataFrame:
    """Row counts by condition; covered rows are counted by themselves, so that the sum can be checked."""
    population, rate = F.col("population"), F.col("incidence_rate_per_100k")
    exact = safe_ratio(F.col("total_cases"), population) * F.lit(100_000)
    covered = F.coalesce(population > 0, F.lit(False))
    off = covered & (rate.isNull() | (F.abs(rate - exact) > RATE_TOLERANCE))
    flags = {
        "gold_covered": covered,
        "gold_uncovered": population.isNull() | (population <= 0),
        "gold_non_positive": F.col("total_cases") <= 0,
        "gold_without_rate": rate.isNull(),
        "gold_off_formula": off,
    }
    per_key = gold.groupBy(*GOLD_KEY).agg(
        F.count("*").alias("_copies"), *[F.count_if(flag).alias(name) for name, flag in flags.items()]
    )
    return per_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("gold_rows"),
        F.count_if(F.col("_copies") > 1).alias("gold_duplicate_keys"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags],
    )


def fact_metrics(star: Star) -> list[DataFrame]:
    fact = star.fact_disease_cases
    per_key = fact.groupBy(*FACT_KEY).agg(F.count("*").alias("_copies"), F.sum("total_cases").alias("_cases"))
    totals = per_key.agg(
        F.coalesce(F.sum("_cases"), F.lit(0)).alias("fact_cases"),
        F.count_if(F.col("_copies") > 1).alias("fact_duplicate_keys"),
    )
    per_month = fact.groupBy("date_key").agg(F.count("*").alias("_rows"))
    unmatched = per_month.join(star.dim_date, "date_key", "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("unmatched_dates")
    )
    return [totals, unmatched]


def filled_metrics(population: DataFrame) -> DataFrame:
    years = F.array_sort(F.collect_set(F.when(F.col("filled"), F.col("year_be"))))
    return population.agg(F.array_join(F.transform(years, lambda y: y.cast("string")), ", ").alias("filled_years"))


def one_wide_row(parts: list[DataFrame]) -> DataFrame:
    """One-row results merged into one row."""
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(column).alias(column) for column in stacked.columns])


def report_row(layer: str, rule: str | Column, observed: Column, threshold: str, status: Column | str) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"), (rule if isinstance(rule, Column) else F.lit(rule)).alias("rule"), observed.cast("string").alias("observed"),
        F.lit(threshold).alias("threshold"), F.lit(status).alias("status"),
    )


def passes(condition: Column) -> Column:
    return F.when(condition, PASS).otherwise(FAIL)


def quality_report(
    layers: Layers, settings: Settings, domain: CaseDomain, population_available: bool = True
) -> DataFrame:
    """`layer, rule, observed, threshold, status`: one row per rule."""
    parts = [
        raw_metrics(layers.raw),
        case_metrics(layers.tagged, settings),
        duplicate_summary(layers.identified).select(F.col("removed").alias("duplicates_removed")),
        standardized_metrics(layers.standardized, domain),
        gold_metrics(layers.gold),
    ]
    if layers.star is not None:
        parts += fact_metrics(layers.star)
    if population_available and layers.population is not None:
        parts.append(filled_metrics(layers.population))
    wide = one_wide_row(parts)
    present = set(wide.columns)

    def count(layer, rule, value):
        return report_row(layer, rule, value, INFORMATIONAL, PASS)

    def none(layer, rule, value):
        return report_row(layer, rule, value, "= 0", passes(value == 0))

    def some(layer, rule, value):
        return report_row(layer, rule, value, "> 0", passes(value > 0))

    def decimals(value):
        return F.format_string("%.4f", F.coalesce(value, F.lit(0.0)))

    c = F.col
    retention = safe_ratio(c("clean_rows"), c("raw_rows"))
    uncovered = F.coalesce(safe_ratio(c("gold_uncovered"), c("gold_rows")), F.lit(0.0))
    missing_columns = ", ".join(sorted(set(REQUIRED_COLUMNS) - set(layers.tagged.columns)))
    limit = settings.max_missing_population_rate
    rules = [
        some("raw", "raw_rows_not_empty", c("raw_rows")),
        some("clean", "clean_rows_not_empty", c("clean_rows")),
        report_row("clean", "clean_retention_rate", decimals(retention), f">= {settings.min_retention_rate:g}",
                   passes(retention >= settings.min_retention_rate)),
        count("clean", "duplicate_rows_removed", c("duplicates_removed")),
        some("standardized", "standardized_rows_not_empty", c("standardized_rows")),
        none("standardized", "district_in_bangkok_master", c("outside_master")),
        some("gold", "curated_rows_not_empty", c("gold_rows")),
        report_row("gold", "missing_population_rate", decimals(uncovered), f"<= {limit:.4f}", passes(uncovered <= limit))
        if population_available else
        report_row("gold", "missing_population_rate", decimals(uncovered), "cases-only mode (no population)", SKIP),
        count("gold", "population_coverage_rate", decimals(safe_ratio(c("gold_covered"), c("gold_rows")))),
        count("gold", "population_uncovered_rows", c("gold_uncovered")),
        count("gold", "population_uncovered_rate", decimals(uncovered)),
        none("gold", "population_coverage_accounting", c("gold_covered") + c("gold_uncovered") - c("gold_rows")),
        none("gold", "non_positive_total_case_rows", c("gold_non_positive")),
        none("gold", "primary_key_unique", c("gold_duplicate_keys")),
        count("gold", "incidence_rate_unavailable_rows", c("gold_without_rate")),
        none("gold", "incidence_unavailable_matches_uncovered", c("gold_without_rate") - c("gold_uncovered")),
        none("gold", "incidence_formula_mismatch_rows", c("gold_off_formula")),
        report_row("dq", "required_schema_columns", F.lit(missing_columns or "complete"), "complete",
                   FAIL if missing_columns else PASS),
        count("dq", "missing_report_date_rows", c("missing_dates")),
        none("dq", "invalid_age_rows_after_clean", c("invalid_ages")),
        count("clean", "quarantined_rows", c("quarantined_rows")),
        count("clean", "year_be_vs_report_date_mismatch_rows", c("year_mismatches")),
        count("raw", "identical_source_rows_kept", c("identical_rows")),
    ]
    if "filled_years" in present:
        years = F.coalesce(F.nullif(c("filled_years"), F.lit("")), F.lit("none"))
        rules.append(count("gold", "population_years_filled_from_latest", years))
    if "fact_cases" in present:
        rules += [
            none("warehouse", "fact_cases_reconcile_with_standardized", c("fact_cases") - c("standardized_cases")),
            none("warehouse", "fact_primary_key_unique", c("fact_duplicate_keys")),
            none("warehouse", "fact_date_key_in_dim_date", c("unmatched_dates")),
        ]
    # One row for each reason that occurred; other rules without a value have no row.
    by_reason = F.transform(c("reasons"), lambda found: report_row(
        "clean", F.concat(F.lit("quarantined_"), found["reason"]), found["rows"], INFORMATIONAL, PASS))
    return wide.select(F.inline(F.concat(F.array(*rules), by_reason))).where("observed is not null")


def failing_rules(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") == FAIL)


def has_failure(report: DataFrame) -> DataFrame:
    """One row: whether any rule failed."""
    return report.agg(F.coalesce(F.bool_or(F.col("status") == FAIL), F.lit(False)).alias("has_failure"))
