"""Records of CSV files, exact also where quoted cells hold line breaks, from files that Spark splits like any text.

Whether a line starts a record depends on the quotes before it in its file: it does if they are even in number (an escaped quote is two). So a
quoted file of any size is read by as many tasks as it has byte ranges (see `ranges`).

Quotes stand around whole cells, as in RFC 4180. A file whose quotes are odd in number has a cell that never ends; each of its lines is then a record. Line
breaks inside of cells are given as line feeds. Files that aren't UTF-8 are read by the Thai single-byte code page, file by file in the
same scan.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.operators.storage import materialize, scratch_path
from casemart.sources.ranges import before_range, file_pieces, summed_before, whole_file, whole_line_records

CORRUPT = "_corrupt_record"
# Cells as they are, blanks kept.
CSV_CELLS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1"}


def thai_code_page() -> tuple[str, str]:
    """Characters read as Latin-1 and what they are in the Thai single-byte code pages.

    Thai letters are one consecutive run, so the table is a rule; the other entries are the code page's
    punctuation (fixed values).
    """
    letters = {code: chr(0x0E01 + code - 0xA1) for code in range(0xA1, 0xFC) if not 0xDB <= code <= 0xDE}
    punctuation = {0x80: "€", 0x85: "…", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—"}
    table = {**letters, **punctuation}
    return "".join(map(chr, table)), "".join(table.values())


def single_byte_text(line: Column) -> Column:
    """Bytes of the Thai single-byte code page as text."""
    latin, thai = thai_code_page()
    return F.translate(F.decode(line.cast("binary"), "ISO-8859-1"), latin, thai)


def quotes_of(line: str) -> Column:
    """Number of quotes, counted in bytes as the line may not be UTF-8."""
    return F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit('"'), F.lit("")))


def file_ranges(lines: DataFrame) -> DataFrame:
    """`path, block, inside, first, is_utf8, closed`: for each byte range, whether it begins inside a cell, and how many lines lie before it."""
    per_block = lines.groupBy("path", "block").agg(
        F.sum("quotes").alias("quotes"), F.count(F.lit(1)).alias("lines"), F.bool_and(F.is_valid_utf8("piece")).alias("valid"))
    closed = F.sum("quotes").over(whole_file()) % 2 == 0
    return per_block.select(
        "path", "block", closed.alias("closed"), (summed_before("quotes", before_range()) % 2).alias("inside"),
        summed_before("lines", before_range()).alias("first"), F.bool_and("valid").over(whole_file()).alias("is_utf8"))


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`path, line, text, is_utf8, closed`: every record with the number of its first line, from 1. Blank lines are records without a character.

    Runs jobs; the records are read from a stored table, so what follows may read them several times.
    """
    lines = file_pieces(spark, paths).withColumn("quotes", quotes_of("piece"))
    records = whole_line_records(lines, materialize(file_ranges(lines), scratch_path(spark, "csv-ranges")))
    text = F.when(F.col("is_utf8"), F.col("text")).otherwise(single_byte_text(F.col("text")))
    plain = F.when(F.col("at") == 1, F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    return records.select("path", F.col("at").alias("line"), plain.alias("text"), "is_utf8", "closed")


def header_names(text: str) -> tuple[str, ...]:
    """Names of a header record, which may hold quoted line breaks."""
    return tuple(name.replace("\ufeff", "").strip() for name in next(csv.reader(text.splitlines(keepends=True)), []))


def cells(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """`path, line` and the cells of records by name; the corrupt-record column holds records with more or fewer cells."""
    fields = [f"c{n}" for n in range(len(names))]
    schema = ", ".join(f"{field} string" for field in [*fields, CORRUPT])
    parsed = records.select("path", "line", F.from_csv("text", schema, CSV_CELLS).alias("row"))
    found = [F.col(f"row.{field}").alias(name) for field, name in zip(fields, names, strict=True)]
    return parsed.select("path", "line", *found, F.col(f"row.{CORRUPT}").alias(CORRUPT))


def tables_by_header(records: DataFrame) -> dict[tuple[str, ...], DataFrame]:
    """Records below each header, for each distinct header (which alone come to the driver, not one row for each file). Runs a job."""
    # stored, so that its size is known and records aren't shuffled for it
    heads = materialize(records.where("line = 1").select("path", F.col("text").alias("head")), scratch_path(records.sparkSession, "csv-heads"))
    known = [row["head"] for row in heads.select("head").distinct().orderBy("head").collect()]
    by_names: dict[tuple[str, ...], list[str]] = {}
    for head in known:
        by_names.setdefault(header_names(head), []).append(head)
    body = records.where("line > 1").join(heads, "path")
    return {names: cells(body.where(F.col("head").isin(texts) & (F.col("text") != "")), names) for names, texts in by_names.items() if names}


def read_csv_records(spark: SparkSession, paths: Sequence[str], source: str) -> list[tuple[tuple[str, ...], DataFrame]]:
    """(header, cells with the path in the column `source`) for each distinct header. Blank lines are left out; short and long records stay. Runs jobs."""
    records = csv_records(spark, paths)
    return [(names, table.select(*[F.col(f"`{name}`") for name in names], F.col("path").alias(source))) for names, table in tables_by_header(records).items()]


def csv_faults(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`path, header, records, ragged_records, blank_records, blank_lines, first_fault, is_utf8, closed` of every file that has a line. Runs jobs.

    `first_fault` is the line of the first record that has another number of cells than the header or none.
    """
    records = csv_records(spark, paths)
    reports = []
    for names, table in tables_by_header(records).items():
        marked = table.toDF("path", "line", *[f"c{n}" for n in range(len(names))], CORRUPT)
        blank = F.coalesce(*[f"c{n}" for n in range(len(names))]).isNull()
        ragged = F.col(CORRUPT).isNotNull()
        reports.append(marked.groupBy("path").agg(
            F.count(F.lit(1)).alias("records"), F.count_if(ragged).alias("ragged_records"), F.count_if(~ragged & blank).alias("blank_records"),
            F.min(F.when(ragged, F.col("line"))).alias("first_ragged")))
    per_file = records.groupBy("path").agg(
        F.max(F.when(F.col("line") == 1, F.col("text"))).alias("header"), F.count_if((F.col("line") > 1) & (F.col("text") == "")).alias("blank_lines"),
        F.min(F.when((F.col("line") > 1) & (F.col("text") == ""), F.col("line"))).alias("first_blank"), F.bool_and("is_utf8").alias("is_utf8"), F.bool_and("closed").alias("closed"))
    if not reports:
        reports = [spark.createDataFrame([], "path string, records long, ragged_records long, blank_records long, first_ragged long")]
    counted = per_file.join(reduce(DataFrame.unionByName, reports), "path", "left")
    none = F.lit(0).cast("long")
    return counted.select(
        "path", "header", *[F.coalesce(name, none).alias(name) for name in ("records", "ragged_records", "blank_records", "blank_lines")],
        F.least("first_ragged", "first_blank").alias("first_fault"), "is_utf8", "closed")
