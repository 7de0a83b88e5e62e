"""Reading raw CSV and JSON as all-string tables with lineage."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.operators.cases import SOURCE_FILE
from casemart.operators.columns import clean_headers, quoted
from casemart.operators.identity import record_identity
from casemart.reference_values import ENVELOPE_KEYS
from casemart.sources.catalog import chosen_files
from casemart.sources.json_arrays import read_json_arrays
from casemart.sources.paths import SourceNotFound, file_path
from casemart.sources.records import CORRUPT, header_names, read_csv_records, thai_code_page

UTF8, SINGLE_BYTE_THAI = "UTF-8", "ISO-8859-1"


def string_schema(names: Sequence[str], corrupt: bool = False) -> T.StructType:
    extra = [CORRUPT] if corrupt else []
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, *extra]])


def file_heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`path, head, valid_utf8` per file, in one job that keeps only two small values per file."""
    lines = spark.read.text(list(paths)).select(
        file_path().alias("path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )
    first = F.when(F.col("_start") == 0, F.col("_line"))
    return lines.groupBy("path").agg(
        F.min_by("value", first).alias("head"), F.bool_and(F.is_valid_utf8("value")).alias("valid_utf8")
    )


def csv_groups(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """Files that can be read together: same encoding, same header (runs a job; one row per file).

    Files without a first line have no header and belong to no group.
    """
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)
    latin, thai = thai_code_page()
    for row in heads_as_bytes(spark, paths):
        if row.head is None:
            continue
        encoding = UTF8 if row.valid_utf8 else SINGLE_BYTE_THAI
        text = bytes(row.head).decode("utf-8" if row.valid_utf8 else "latin-1")
        if not row.valid_utf8:
            text = text.translate(str.maketrans(latin, thai))
        groups[(encoding, header_names(text))].append(row.path)
    return groups


def heads_as_bytes(spark: SparkSession, paths: Sequence[str]):
    """Headers as bytes, because a header in a single-byte code page is not valid text yet."""
    heads = file_heads(spark, paths)
    return heads.select("path", "valid_utf8", F.col("head").cast("binary").alias("head")).orderBy("path").collect()


def read_csv(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str],
    encoding: str = UTF8,
    multi_line: bool = True,
    corrupt: bool = False,
) -> DataFrame:
    """CSV files of one header as strings. Files without quoted line breaks may set `multi_line=False`,
    which lets Spark split them."""
    frame = (
        spark.read.schema(string_schema(names, corrupt))
        .option("header", "true").option("encoding", encoding).option("multiLine", str(multi_line).lower())
        .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(list(paths))
    )
    frame = frame.select("*", file_path().alias(SOURCE_FILE))
    if encoding == SINGLE_BYTE_THAI:
        latin, thai = thai_code_page()
        others = [CORRUPT] * corrupt + [SOURCE_FILE]
        frame = frame.select(*[F.translate(quoted(n), latin, thai).alias(n) for n in names], *others)
    return frame


def read_json(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """JSON arrays or enveloped records as strings, one row per record."""
    frame = (
        spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").option("primitivesAsString", "true")
        .json(list(paths))
    )
    return flatten_envelope(frame.select("*", file_path().alias(SOURCE_FILE)))


def flatten_envelope(df: DataFrame, keys: Sequence[str] = ENVELOPE_KEYS) -> DataFrame:
    """Records inside the first array column among `keys`, with their lineage; other tables pass unchanged."""
    envelope = next((key for key in keys if key in df.columns and isinstance(df.schema[key].dataType, T.ArrayType)), None)
    if envelope is None:
        return df
    lineage = [SOURCE_FILE] if SOURCE_FILE in df.columns else []
    return df.select(F.explode_outer(envelope).alias("_record"), *lineage).select("_record.*", *lineage)


def read_case_files(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> DataFrame:
    """All chosen files as one table: absent columns are NULL, rows of CSV files get a record id.

    Records with quoted line breaks and JSON arrays are put together from pieces, so files of any size are read by many tasks. Where no cell holds a
    line break, `multi_line=False` spares that.
    """
    if not paths:
        raise SourceNotFound("no case files to read")
    csv_paths, json_paths = ([path for path in paths if path.endswith(".csv") is is_csv] for is_csv in (True, False))
    frames = []
    for names, frame in csv_tables(spark, csv_paths, multi_line) if csv_paths else []:
        # Folder and name: files of one name in several folders stay apart, and ids survive a move of the whole lake.
        file = F.substring_index(SOURCE_FILE, "/", -2)
        frames.append(record_identity(frame, names, file).drop("_print", "_occurrence"))
    if json_paths:
        arrays, others = read_json_arrays(spark, json_paths, SOURCE_FILE)
        frames += [arrays] if arrays is not None else []
        # Each document may be wrapped differently, and there is one file per year.
        frames += [read_json(spark, [path]) for path in others]
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), map(clean_headers, frames))
    return merged.drop(CORRUPT)


def csv_tables(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> list[tuple[tuple[str, ...], DataFrame]]:
    """(header, cells and their file) for each header among the files. Runs jobs."""
    if multi_line:
        return read_csv_records(spark, paths, SOURCE_FILE)
    return [(names, read_csv(spark, group, names, encoding, multi_line)) for (encoding, names), group in csv_groups(spark, paths).items()]


def read_cases(spark: SparkSession, location: str, multi_line: bool = True) -> DataFrame:
    """The newest file of every year under a folder or glob, local or remote."""
    return read_case_files(spark, chosen_files(spark, location), multi_line)
