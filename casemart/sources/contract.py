"""The raw contract as queries: one row per file with what is wrong, or one row per violation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.operators.columns import quoted
from casemart.reference_values import CASE_CSV_FIELDS, CASE_JSON_FIELDS, DISTRICTS, POPULATION_FIELDS
from casemart.sources.json_arrays import array_faults
from casemart.sources.records import csv_faults, header_names


def json_contract(spark: SparkSession, paths: Sequence[str], fields: Sequence[str] = CASE_JSON_FIELDS) -> DataFrame:
    """`path, records, wrong_records, status` per JSON file: a non-empty array of records, each with exactly the fields, and nothing else. Runs jobs.

    Elements are put together from pieces between commas, so that an array of any size is read by many tasks and no row holds a file.
    """
    faults = array_faults(spark, paths, fields)
    status = (
        F.when(~F.col("is_array"), "not_json").when(F.col("records") == 0, "empty")
        .when(F.col("wrong_records") > 0, "wrong_fields").otherwise("ok")
    )
    empty = unread_files(spark, paths, faults).select("path", *[F.lit(0).cast("long").alias(name) for name in ("records", "wrong_records")], F.lit("not_json").alias("status"))
    return faults.select("path", *[F.when(F.col("is_array"), F.col(name)).otherwise(0).alias(name) for name in ("records", "wrong_records")], status.alias("status")).unionByName(empty)


def json_document_contract(documents: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The contract over `path, value`: a non-empty array of records, each with exactly the fields, and nothing else.

    The parser stops after the first value, so a document is also read as one element before a closing one.
    """
    elements = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit(',"end"]')), "array<string>")
    whole = (F.array_size(elements) == 2) & (F.try_element_at(elements, F.lit(2)) == "end")
    parsed = F.when(F.coalesce(whole, F.lit(False)), F.from_json("value", "array<map<string,string>>"))
    expected = F.array_sort(F.array(*[F.lit(field) for field in fields]))
    wrong = F.filter("_parsed", lambda record: ~F.coalesce(F.array_sort(F.map_keys(record)) == expected, F.lit(False)))
    counted = documents.select("path", parsed.alias("_parsed")).select(
        "path",
        F.coalesce(F.array_size("_parsed"), F.lit(0)).cast("long").alias("records"),
        F.coalesce(F.array_size(wrong), F.lit(0)).cast("long").alias("wrong_records"),
        F.isnull("_parsed").alias("_unreadable"),
    )
    status = (
        F.when(F.col("_unreadable"), "not_json").when(F.col("records") == 0, "empty")
        .when(F.col("wrong_records") > 0, "wrong_fields").otherwise("ok")
    )
    return counted.withColumn("status", status).drop("_unreadable")


def csv_contract(spark: SparkSession, paths: Sequence[str], fields: Sequence[str] = CASE_CSV_FIELDS) -> DataFrame:
    """`path, records, ragged_records, blank_records, blank_lines, first_fault, status` per CSV file. Runs jobs.

    The header must be the field set, every row must have as many cells, and there must be a row. A blank line has no cells and is a fault
    like a ragged row; a row of empty cells is only counted. A file without a first line is empty; one that isn't UTF-8 is reported as
    such, with the counts of its single-byte reading. `first_fault` is the line where the first faulty record begins.
    """
    faults = csv_faults(spark, paths)
    headers = [row["header"] for row in faults.select("header").distinct().collect()]
    good = [header for header in headers if sorted(header_names(header)) == sorted(fields)]
    status = (
        F.when(~F.col("is_utf8"), "not_utf8").when(~F.col("header").isin(good), "wrong_header").when(~F.col("closed"), "open_quote")
        .when((F.col("records") == 0) & (F.col("blank_lines") == 0), "empty").when(F.col("first_fault").isNotNull(), "ragged").otherwise("ok")
    )
    counts = ["records", "ragged_records", "blank_records", "blank_lines"]
    found = faults.select("path", *counts, "first_fault", status.alias("status"))
    empty = unread_files(spark, paths, faults).select(
        "path", *[F.lit(0).cast("long").alias(name) for name in counts], F.lit(None).cast("long").alias("first_fault"), F.lit("empty").alias("status"))
    return found.unionByName(empty)


def unread_files(spark: SparkSession, paths: Sequence[str], found: DataFrame) -> DataFrame:
    """`path` of the files that hold nothing, so that no reader sees them. Local paths with or without their scheme are one."""
    def plain(path: str) -> Column:
        return F.regexp_replace(path, "^file:/*", "/")

    given = spark.createDataFrame([(path,) for path in paths], "path string")
    return given.join(found.select(plain("path").alias("_found")), plain("path") == F.col("_found"), "left_anti")


def population_contract(
    rows: DataFrame, year: int, master: DataFrame | None = None, fields: Sequence[str] = POPULATION_FIELDS
) -> DataFrame:
    """Violations of a yearly population table as `rule, value, rows`; empty when the table is good.

    The table must have exactly the columns year, district and population; every row the given year, a
    district and a positive whole number; and the districts must be the master list, each once.
    """
    spark = rows.sparkSession
    if list(rows.columns) != list(fields):
        return spark.createDataFrame([("columns", ", ".join(rows.columns), 1)], "rule string, value string, rows long")
    year_col, district_col, population_col = (F.trim(quoted(name).cast("string")) for name in fields)
    checked = rows.select(
        year_col.alias("year"), district_col.alias("district"), population_col.alias("population")
    )
    whole = F.when(F.col("population").rlike(r"^[+-]?\d+$"), F.col("population").try_cast("long"))

    def broken(rule: str, condition: Column, value: str) -> Column:
        return F.when(condition, F.struct(F.lit(rule).alias("rule"), F.col(value).alias("value")))

    row_rules = F.array_compact(F.array(
        broken("year", ~F.col("year").eqNullSafe(F.lit(str(year))), "year"),
        broken("district_blank", F.coalesce("district", F.lit("")) == "", "district"),
        broken("population_not_integer", whole.isNull(), "population"),
        broken("population_not_positive", whole <= 0, "population"),
    ))
    by_row = checked.select(F.inline(row_rules)).groupBy("rule", "value").agg(F.count("*").alias("rows"))
    if master is None:
        master = spark.createDataFrame([(name,) for name in DISTRICTS], "district string")
    counted = checked.where("district != ''").groupBy("district").agg(F.count("*").alias("rows"))
    duplicate = counted.where("rows > 1").select(
        F.lit("duplicate_district").alias("rule"), F.col("district").alias("value"), "rows"
    )
    missing = master.join(counted, "district", "left_anti").select(
        F.lit("missing_district").alias("rule"), F.col("district").alias("value"), F.lit(0).cast("long").alias("rows")
    )
    unexpected = counted.join(master, "district", "left_anti").select(
        F.lit("unexpected_district").alias("rule"), F.col("district").alias("value"), "rows"
    )
    return by_row.unionByName(duplicate).unionByName(missing).unionByName(unexpected)


def set_difference(expected: DataFrame, actual: DataFrame, column: str) -> DataFrame:
    """Names on one side only, as `side, name`."""
    left = expected.select(column).distinct()
    right = actual.select(column).distinct()
    missing = left.join(right, column, "left_anti").select(F.lit("missing").alias("side"), F.col(column).alias("name"))
    extra = right.join(left, column, "left_anti").select(F.lit("unexpected").alias("side"), F.col(column).alias("name"))
    return missing.unionByName(extra)
