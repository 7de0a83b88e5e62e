"""Reading population files: any header, UTF-8 or a Thai single-byte code page."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.operators.cases import SOURCE_FILE
from casemart.operators.columns import clean_headers, find_column
from casemart.functions import year_from_path
from casemart.reference_values import POPULATION_COLUMNS
from casemart.sources.paths import SourceNotFound, list_files
from casemart.sources.records import read_csv_records


def is_population(names: Sequence[str]) -> bool:
    return all(find_column(names, POPULATION_COLUMNS[column]) for column in ("district_name", "population"))


def read_population(spark: SparkSession, location: str) -> DataFrame:
    """Every population file at a folder or glob, with the year its name carries and its file name.

    Files without a district and a population column are skipped; having none at all is `SourceNotFound`.
    """
    listed = list_files(spark, location).where(F.lower("path").endswith(".csv")).select("path").collect()
    tables = read_csv_records(spark, [row.path for row in listed], SOURCE_FILE) if listed else []
    frames = [clean_headers(table) for names, table in tables if is_population(names)]
    if not frames:
        raise SourceNotFound(f"no population file with district and population columns at {location}")
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    name = F.element_at(F.split(SOURCE_FILE, "/"), -1)
    return merged.withColumns({"_source_year": year_from_path(name, r"(\d{4})"), SOURCE_FILE: name})
