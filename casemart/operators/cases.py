"""From raw columns to canonical and standardized cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.domain import CaseDomain
from casemart.functions import lineage_year, parse_report_date, to_buddhist, to_numeric, year_from_path
from casemart.operators.columns import column_or, quoted, required_column

SOURCE_FILE = "_source_file"


def canonical_cases(raw: DataFrame, domain: CaseDomain) -> DataFrame:
    """Typed cases under fixed names. Absent columns get defaults: one case, everything else NULL.

    Parsed values become columns before they are used again: an expression that repeats a parse is
    evaluated repeatedly, and a generated method beyond 8,000 bytes is never compiled by the JVM.
    """
    spelled = domain.case_columns
    nothing = F.lit(None).cast("string")
    disease = quoted(required_column(raw, spelled["disease_name"], "disease_name"))
    district = quoted(required_column(raw, spelled["district_name"], "district_name"))
    source = F.col(SOURCE_FILE) if SOURCE_FILE in raw.columns else F.input_file_name()
    typed = raw.select(
        column_or(raw, spelled["case_id"], nothing).cast("string").alias("case_id"),
        parse_report_date(column_or(raw, spelled["report_date"], nothing)).alias("report_date"),
        to_numeric(column_or(raw, spelled["year"], nothing)).try_cast("int").alias("_stated_year"),
        F.trim(disease.cast("string")).alias("disease_name_raw"),
        F.trim(district.cast("string")).alias("district_name_raw"),
        to_numeric(column_or(raw, spelled["case_count"], F.lit("1"))).alias("case_count"),
        F.trim(column_or(raw, spelled["sex"], nothing).cast("string")).alias("sex"),
        to_numeric(column_or(raw, spelled["age"], nothing)).alias("age"),
        source.alias("source_file"),
    )
    year = lineage_year(to_buddhist(F.col("_stated_year")), year_from_path(F.col("source_file")), F.col("report_date"))
    return typed.select(
        "case_id", "report_date", year.alias("year_be"), "disease_name_raw", "district_name_raw", "case_count",
        "sex", "age", "source_file",
    )


def standardized_cases(clean: DataFrame, domain: CaseDomain) -> DataFrame:
    """Standard names, sex code and age band; rows whose standard name is blank are dropped."""
    return clean.withColumns({
        "district_name": domain.district(F.col("district_name_raw")),
        "disease_name": domain.disease(F.col("disease_name_raw")),
        "sex": domain.sex(F.col("sex")),
        "age_group_key": domain.age_band(F.col("age")),
    }).where((F.trim("district_name") != "") & (F.trim("disease_name") != ""))
