"""The whole mart as JSON text, in chunks of bounded size instead of one document row, and as one document made of such pieces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.operators.ranking import positioned, running_total
from casemart.operators.star import Star
from casemart.plans.views import year_period

CHUNK = 1000


def section(name: str, rows: DataFrame, order: list[str], payload: Column, chunk: Column) -> DataFrame:
    """One JSON array per chunk, its records in order. `chunk` bounds the records of an array; `_first` orders chunks by their first record."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, payload.alias("_json"))))
    texts = F.transform(ordered, lambda record: record["_json"])
    first = F.concat_ws("|", *[F.lpad(F.element_at("_ordered", 1)[column].cast("string"), 20, "0") for column in order])
    return rows.groupBy(chunk.cast("string").alias("chunk")).agg(F.count("*").alias("records"), ordered.alias("_ordered"), texts.alias("_texts")).select(
        F.lit(name).alias("section"), "chunk", "records",
        F.concat(F.lit("["), F.array_join("_texts", ","), F.lit("]")).alias("payload"), first.alias("_first"),
    )


def record(**fields: str) -> Column:
    return F.to_json(F.struct(*[F.col(column).alias(key) for key, column in fields.items()]),
                     {"ignoreNullFields": "false"})


#: The sections of the document in order.
SECTIONS = ("fact", "dim_date", "dim_district", "dim_disease", "dim_age", "dim_sex", "population", "period", "dq")


def snapshot(star: Star, quality: DataFrame) -> DataFrame:
    """`section, chunk, records, payload`: every section of the mart as arrays of JSON records.

    Chunks are a month and place (facts), a thousand keys (names), a calendar year or one whole section
    where the rows are bounded by the calendar or by a fixed list, so no array grows with the data.
    """
    return ordered_chunks(star, quality).drop("_first")


def ordered_chunks(star: Star, quality: DataFrame) -> DataFrame:
    """The chunks of the snapshot with `_first`."""
    fact = F.concat(
        F.lit("["), F.concat_ws(",", "date_key", "district_key", "disease_key", "age_group_key"), F.lit(',"'),
        F.col("sex"), F.lit('",'), F.col("total_cases").cast("string"), F.lit("]"),
    )
    months = star.dim_date.withColumn("_month", F.date_format("month_start", "yyyy-MM"))
    whole = F.lit("all")
    def block(key: str) -> Column:
        return F.floor(F.col(key) / CHUNK)

    in_scope = star.dim_district.where("is_bangkok_district")
    sections = [
        section("fact", star.fact_disease_cases,
                ["date_key", "district_key", "disease_key", "age_group_key", "sex"], fact,
                F.concat_ws("-", "date_key", "district_key", block("disease_key").cast("string"))),
        section("dim_date", months, ["date_key"], record(k="date_key", m="_month", label="month_label", y="year_be"),
                F.col("year_be")),
        section("dim_district", in_scope, ["district_key"], record(k="district_key", name="district_name"),
                block("district_key")),
        section("dim_disease", star.dim_disease, ["disease_key"], record(k="disease_key", name="disease_name"),
                block("disease_key")),
        section("dim_age", star.dim_age_group, ["age_group_key"], record(k="age_group_key", label="age_group"), whole),
        section("dim_sex", star.dim_sex, ["sex"], record(k="sex", label="sex_label"), whole),
        section("population", star.fact_population, ["year_be", "district_key"],
                record(y="year_be", k="district_key", p="population"),
                F.concat_ws("-", F.col("year_be"), block("district_key").cast("string"))),
        section("period", year_period(star), ["year_be"],
                record(y="year_be", months="months_covered", label="period_label"), whole),
        section("dq", quality, ["layer", "rule"],
                record(layer="layer", rule="rule", observed="observed", threshold="threshold", status="status"), whole),
    ]
    return reduce(DataFrame.unionByName, sections)


def loaded_at(audit: DataFrame, timezone: str = "Asia/Bangkok") -> DataFrame:
    """One row: local time of the newest load, to the minute."""
    local = F.convert_timezone(None, F.lit(timezone), F.max("loaded_at"))
    return audit.agg(F.date_format(local, "yyyy-MM-dd HH:mm").alias("loaded_at"))


class EmptyMart(LookupError):
    """There is nothing to show before the first run."""


def document(star: Star, quality: DataFrame, audit: DataFrame, path: str) -> DataFrame:
    """`position, offset, text`: the whole mart as one JSON document in pieces (runs jobs; writes `path`).

    The texts in order of position, each followed by a line feed, are the document: an object of the sections and of `loaded_at`. A piece is a chunk with what
    opens and closes its section; `offset` is where it begins in bytes, so pieces can be written side by side. Sections without rows are null, as is the time
    without a load. A mart without facts is an `EmptyMart`.
    """
    if star.fact_disease_cases.isEmpty():
        raise EmptyMart("the mart is empty: run the pipeline first")
    names = F.array(*[F.lit(name) for name in SECTIONS])
    chunks = ordered_chunks(star, quality).select(
        F.array_position(names, F.col("section")).cast("int").alias("number"), "section", "_first", F.expr("substr(payload, 2, length(payload) - 2)").alias("inner"))
    every = quality.sparkSession.createDataFrame(list(enumerate(SECTIONS, 1)), "number int, section string")
    missing = every.join(chunks.select("section").distinct(), "section", "left_anti").select("number", "section", F.lit("").alias("_first"), F.lit(None).cast("string").alias("inner"))
    placed = positioned(chunks.unionByName(missing), ["number", "_first"], path)
    ends = placed.groupBy("number").agg(F.min("position").alias("_begin"), F.max("position").alias("_end"))
    time = F.coalesce(F.concat(F.lit('"'), loaded_at(audit).scalar(), F.lit('"')), F.lit("null"))
    opened = F.when(F.col("position") == F.col("_begin"), F.concat(
        F.when(F.col("number") == 1, "{").otherwise(","), F.lit('"'), F.col("section"), F.when(F.isnull("inner"), '":').otherwise('":['))).otherwise(",")
    closed = F.when(F.isnull("inner"), "").when(F.col("position") == F.col("_end"), "]").otherwise("")
    last = F.when((F.col("position") == F.col("_end")) & (F.col("number") == len(SECTIONS)), F.concat(F.lit(',"loaded_at":'), time, F.lit("}"))).otherwise("")
    pieces = placed.join(ends, "number").select("position", F.concat(opened, F.coalesce("inner", F.lit("null")), closed, last).alias("text"))
    return running_total(pieces.withColumn("_size", F.octet_length("text") + 1), "position", "_size", "offset").select("position", "offset", "text")


def write_document(pieces: DataFrame, path: str) -> None:
    """The document as files whose contents, in order of their names, are the document."""
    pieces.orderBy("position").select("text").write.mode("overwrite").text(path)


def write_snapshot(star: Star, quality: DataFrame, path: str) -> None:
    """One folder per section with JSON lines."""
    snapshot(star, quality).write.mode("overwrite").partitionBy("section").json(path)
