"""Listing files through Spark's own file sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class SourceNotFound(FileNotFoundError):
    """Nothing matches a path; callers with optional inputs may go on without it."""


def file_path() -> Column:
    """The path of the file a row was read from, as readers accept it (the metadata column is URL-encoded)."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, location: str, name_glob: str | None = None, recursive: bool = False) -> DataFrame:
    """`path, length, modificationTime` of the files at a folder or glob; their content is not read."""
    reader = spark.read.format("binaryFile")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        return reader.load(location).select("path", "length", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFound(f"no files at {location}") from error
        raise


def found(spark: SparkSession, location: str) -> bool:
    """Whether a path or glob exists."""
    try:
        list_files(spark, location)
    except SourceNotFound:
        return False
    return True
