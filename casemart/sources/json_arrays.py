"""Elements of JSON arrays of any size, from files that Spark splits at every comma.

A comma parts two elements if it lies outside of strings and inside of one bracket. Both depend on all before it: on the parity of quotes
(escaped characters taken out), and on the sum of brackets opened and closed outside of strings. What a byte range adds to that sum is known for
both cases, that it begins inside or outside of a string, so ranges are scanned independently and composed by prefix sums (see `ranges`). Elements are parsed
one by one. Documents of other shapes, such as records inside of an envelope, are left to Spark's own reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.operators.storage import materialize, scratch_path
from casemart.sources.ranges import before_piece, before_range, file_pieces, in_range, summed_before, whole_file, whole_records

_BLANKS = r"[ \t\n\r]*"


def _net(parts: Column, odd: int) -> Column:
    """Brackets opened less brackets closed in every other part between quotes."""
    outside = F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), " ")
    return F.regexp_count(outside, F.lit(r"[\[{]")) - F.regexp_count(outside, F.lit(r"[\]}]"))


def scanned(pieces: DataFrame) -> DataFrame:
    """`pieces` with `quotes`, and the brackets that a piece adds if its range begins outside (`net_0`) or inside (`net_1`) of a string."""
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"')
    counted = pieces.withColumn("parts", parts).select(
        "path", "block", "place", "piece", (F.size("parts") - 1).alias("quotes"), _net(F.col("parts"), 0).alias("even"), _net(F.col("parts"), 1).alias("odd"))
    flipped = summed_before("quotes", before_piece()) % 2 == 1
    return counted.withColumns({
        "net_0": F.when(flipped, F.col("odd")).otherwise(F.col("even")), "net_1": F.when(flipped, F.col("even")).otherwise(F.col("odd"))}).drop("even", "odd")


def file_ranges(pieces: DataFrame) -> DataFrame:
    """`path, block, inside, depth, first, balanced, is_utf8`: the state in which each byte range begins, and what holds for its file."""
    per_block = pieces.groupBy("path", "block").agg(
        F.sum("quotes").alias("quotes"), F.sum("net_0").alias("net_0"), F.sum("net_1").alias("net_1"), F.count(F.lit(1)).alias("pieces"),
        F.bool_and(F.is_valid_utf8("piece")).alias("valid"))
    begun = per_block.withColumn("inside", summed_before("quotes", before_range()) % 2)
    summed = begun.withColumn("net", F.when(F.col("inside") == 1, F.col("net_1")).otherwise(F.col("net_0")))
    balanced = (F.sum("quotes").over(whole_file()) % 2 == 0) & (F.sum("net").over(whole_file()) == 0)
    return summed.select(
        "path", "block", "inside", summed_before("net", before_range()).alias("depth"), summed_before("pieces", before_range()).alias("first"),
        balanced.alias("balanced"), F.bool_and("valid").over(whole_file()).alias("is_utf8"))


def array_elements(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`path, at, text, opens, is_array`: the elements in order, without the array's own brackets. Runs jobs.

    `opens`: the file begins with a bracket; `is_array`: it is one array that is closed at its end, as far as brackets and quotes show. An array without
    elements is one blank element.
    """
    pieces = scanned(file_pieces(spark, paths, ","))
    ranges = materialize(file_ranges(pieces), scratch_path(spark, "json-ranges"))
    placed = pieces.join(ranges, ["path", "block"]).withColumn("net", F.when(F.col("inside") == 1, F.col("net_1")).otherwise(F.col("net_0")))
    at = F.col("first") + F.row_number().over(in_range())
    outside = (F.col("inside") + summed_before("quotes", before_piece())) % 2 == 0
    depth = F.col("depth") + summed_before("net", before_piece())
    marked = placed.select("path", "block", "place", "piece", at.alias("at"), ((at == 1) | (outside & (depth == 1))).alias("starts"))
    elements = materialize(whole_records(marked, ","), scratch_path(spark, "json-elements"))
    files = ranges.groupBy("path").agg(F.bool_and("balanced").alias("balanced"), F.bool_and("is_utf8").alias("is_utf8"))
    ends = elements.groupBy("path").agg(
        F.max("at").alias("last"), F.bool_or((F.col("at") == 1) & F.col("text").rlike(rf"^{_BLANKS}\[")).alias("opens"),
        F.max_by(F.col("text").rlike(rf"\]{_BLANKS}$"), "at").alias("closes"))
    known = ends.join(files, "path").select("path", "last", "opens", (F.col("opens") & F.col("closes") & F.col("balanced") & F.col("is_utf8")).alias("is_array"))
    bare = F.when(F.col("at") == 1, F.regexp_replace("text", rf"^{_BLANKS}\[", "")).otherwise(F.col("text"))
    text = F.when(F.col("at") == F.col("last"), F.regexp_replace(bare, rf"\]{_BLANKS}$", "")).otherwise(bare)
    return elements.join(known, "path").select("path", "at", text.alias("text"), (F.col("at") == F.col("last")).alias("is_last"), "opens", "is_array")


def _alone() -> Column:
    """An array that holds nothing: its one element is blank."""
    return (F.col("at") == 1) & F.col("is_last") & F.col("text").rlike(rf"^{_BLANKS}$")


def array_faults(spark: SparkSession, paths: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """`path, records, wrong_records, is_array` of every file that holds anything. Runs jobs.

    The parser stops after the first value, so an element is also read before a last one.
    """
    elements = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit(',"end"]')), "array<string>")
    whole = F.coalesce((F.array_size(elements) == 2) & (F.try_element_at(elements, F.lit(2)) == "end"), F.lit(False))
    expected = F.array_sort(F.array(*[F.lit(field) for field in fields]))
    exact = F.coalesce(F.array_sort(F.map_keys(F.from_json("text", "map<string,string>"))) == expected, F.lit(False))
    judged = array_elements(spark, paths).select("path", "is_array", _alone().alias("nothing"), whole.alias("whole"), exact.alias("exact"))
    return judged.groupBy("path").agg(
        F.count_if(~F.col("nothing")).alias("records"), F.count_if(~F.col("nothing") & ~F.col("exact")).alias("wrong_records"),
        F.bool_and(F.col("is_array") & (F.col("nothing") | F.col("whole"))).alias("is_array"))


def read_json_arrays(spark: SparkSession, paths: Sequence[str], source: str) -> tuple[DataFrame | None, list[str]]:
    """The records of all files that are arrays, as strings with their file in the column `source`, and the files that aren't. Runs jobs.

    The names of all fields, not one row for each file or record, come to the driver.
    """
    elements = materialize(array_elements(spark, paths), scratch_path(spark, "json-arrays"))
    others = [row["path"] for row in elements.where("NOT opens").select("path").distinct().orderBy("path").collect()]
    records = elements.where("opens").where(~_alone()).select("path", F.from_json("text", "map<string,string>").alias("record"))
    names = [row["name"] for row in records.select(F.explode(F.map_keys("record")).alias("name")).distinct().orderBy("name").collect()]
    if not names:
        return None, others
    return records.select(*[F.try_element_at("record", F.lit(name)).alias(name) for name in names], F.col("path").alias(source)), others
