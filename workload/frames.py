"""How the given tables stand in for cases, denominators and raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casemart import CaseDomain, Settings
from casemart.functions import NameRules
from casemart.functions.names import DISTRICT_RULES
from casemart.operators.cases import canonical_cases, standardized_cases
from casemart.operators.denominators import carry_forward, clean_population
from casemart.operators.gold import gold_table
from casemart.operators.identity import assign_case_id, keep_latest
from casemart.operators.quality import Layers, quality_report
from casemart.operators.rules import REASON, case_rules, clean_rows, tag
from casemart.operators.star import Star, build_star
from casemart.operators.storage import materialize, scratch_path

SETTINGS = Settings(maximum_age=120)

# The places in scope and the spellings of the part types.
PLACES = tuple(f"NATION_{i}" for i in range(23))
PLACE_ALIASES = {f"N{i}": f"NATION_{i}" for i in range(25)}
TYPE_ALIASES = {"economy": "Economy", "standard": "Standard", "medium": "Medium", "large": "Large", "small": "Small"}

DOMAIN = CaseDomain(
    districts=PLACES, district_rules=NameRules(DISTRICT_RULES.steps, PLACE_ALIASES), disease_aliases=TYPE_ALIASES
)


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is inferred once, as inference runs a job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def year_span(dates: DataFrame, column: str) -> DataFrame:
    """One row with the first and last year of a date column."""
    return dates.agg(F.min(F.year(column)).alias("first"), F.max(F.year(column)).alias("last"))


def each_year(span: DataFrame):
    """All years of a one-row span, as an array to explode."""
    return F.explode(span.select(F.sequence("first", "last")).scalar())


# -- orders as clean cases -------------------------------------------------------------------------


def order_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case per order: the customer's nation is the place, the priority the disease."""
    joined = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    date = F.col("o_orderdate").cast("date")
    sex = F.when(F.col("o_orderstatus") == "F", "F").when(F.col("o_orderstatus") == "O", "M").otherwise("U")
    age = F.col("c_acctbal") / 100
    return joined.select(
        F.col("o_orderkey").cast("string").alias("case_id"), date.alias("report_date"),
        (F.year(date) + 543).alias("year_be"), F.col("n_name").alias("district_name"),
        F.col("o_orderpriority").alias("disease_name"),
        (F.col("o_orderkey") % 3 + 1).cast("double").alias("case_count"),
        sex.alias("sex"), age.alias("age"), DOMAIN.age_band(age).alias("age_group_key"),
    )


def order_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A denominator per nation and order year, with single gaps in some years and none in others."""
    years = each_year(year_span(table(spark, sf_dir, "orders"), "o_orderdate")).alias("year_ce")
    per_year = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", years)
    gap = ((F.col("year_ce") % 3 == 0) & (F.col("n_nationkey") % 11 == 5)) | (F.col("year_ce") % 4 == 0)
    people = 1000 * (F.col("n_nationkey") + 1) + 37 * (F.col("year_ce") - 1990)
    return per_year.where(~gap).select(
        (F.col("year_ce") + 543).cast("int").alias("year_be"), F.col("n_name").alias("district_name"),
        people.cast("double").alias("population"),
    )


def order_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_table(order_cases(spark, sf_dir), order_population(spark, sf_dir), ids_unique=True)


def order_star(spark: SparkSession, sf_dir: str) -> Star:
    cases = order_cases(spark, sf_dir)
    years = cases.select("year_be")
    return build_star(cases, carry_forward(order_population(spark, sf_dir), years), DOMAIN, scratch_path(spark, "star"), ids_unique=True)


def order_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers of orders, which are clean from the start."""
    cases = order_cases(spark, sf_dir)
    named = cases.withColumns({"disease_name_raw": F.col("disease_name"), "district_name_raw": F.col("district_name")})
    population = materialize(carry_forward(order_population(spark, sf_dir), cases.select("year_be")), scratch_path(spark, "population"))
    gold = materialize(gold_table(cases, population, ids_unique=True), scratch_path(spark, "gold"))
    star = build_star(cases, population, DOMAIN, scratch_path(spark, "star"), ids_unique=True)
    return Layers(cases, named.withColumn(REASON, F.lit(None).cast("string")), cases, cases, gold, star, population)


# -- line items as untidy raw records --------------------------------------------------------------


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as text under Thai headers: three date shapes, two calendars, prefixes, gaps, copies."""
    # Rows are heavy to derive and may come from one row group, so they are always spread by key.
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate",
    ).repartition("l_orderkey", "l_linenumber")
    date = F.col("l_shipdate").cast("date")
    joined = (
        items
        .join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumns({"d": F.dayofmonth(date), "m": F.month(date), "y": F.year(date), "iso": date.cast("string")})
    )
    order, line, part, supp = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    buddhist = (F.col("y") + 543).cast("string")
    onset = (
        F.when((line == 6) & (supp % 10 == 3), "31/02/2024")
        .when((line == 6) & (supp % 10 == 4), F.lit(None))
        .when(order % 6 == 0, F.concat_ws("/", "d", "m", buddhist))
        .when(order % 6 == 1, F.concat_ws("-", F.substring("iso", 9, 2), F.substring("iso", 6, 2), "y"))
        .when(order % 6 == 2, F.col("iso"))
        .when(order % 6 == 3, F.translate("iso", "-", "/"))
        .when(order % 6 == 4, F.concat(F.col("iso"), F.lit(" 08:30:00")))
        .otherwise(F.concat(F.lit(" "), F.concat_ws("/", "d", "m", "y"), F.lit(" ")))
    )
    stated_year = (
        F.when(supp % 40 == 39, "1800")
        .when(part % 4 == 1, F.col("y").cast("string"))
        .when(part % 4 == 2, buddhist)
        .when(part % 4 == 3, F.concat_ws(",", F.substring(buddhist, 1, 1), F.substring(buddhist, 2, 3)))
    )
    kind = F.col("p_type")
    disease = (
        F.when((line == 5) & (supp % 20 == 11), F.lit(None))
        .when(order % 4 == 0, kind).when(order % 4 == 1, F.lower(kind))
        .when(order % 4 == 2, F.concat(F.substring(kind, 1, 2), F.lit("-"), F.substring(kind, 3, 99)))
        .otherwise(F.concat(F.lit(" "), kind, F.lit(" ")))
    )
    name = F.col("n_name")
    district = (
        F.when((line == 4) & (supp % 20 == 12), F.lit(None))
        .when(supp % 50 == 7, F.concat(F.lit("เมือง"), name))
        .when(part % 6 == 0, name).when(part % 6 == 1, F.concat(F.lit("เขต"), name))
        .when(part % 6 == 2, F.concat(F.lit("ข. "), name)).when(part % 6 == 3, F.concat(name, F.lit(" กทม.")))
        .when(part % 6 == 4, F.concat(F.lit("  "), F.replace(name, F.lit("_"), F.lit(" _ ")), F.lit(" ")))
        .otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
    )
    sex = (
        F.when(line == 1, "?").when(F.col("l_returnflag") == "A", "M").when(F.col("l_returnflag") == "N", "Female")
        .when(F.col("l_linestatus") == "O", "ชาย").otherwise("2")
    )
    years = F.col("l_quantity").cast("int").cast("string")
    age = (
        F.when((line == 3) & (supp % 10 == 6), F.concat(F.lit(" 1,0"), F.lpad(years, 2, "0")))
        .when(supp % 25 == 8, "-5").when((line == 2) & (supp % 4 == 1), F.lit(None)).when(line == 7, "abc")
        .when(line == 5, F.concat(years, F.lit(".5"))).otherwise(F.concat(years, F.lit(" ")))
    )
    cases = (
        F.when(supp % 30 == 13, "x").when(supp % 30 == 14, "0").when(supp % 100 == 99, "1,000")
        .when(order % 5 == 0, "2").otherwise("1")
    )
    record = F.when((line == 7) & (supp % 5 == 0), "  ").otherwise(
        F.concat(order.cast("string"), F.lit("-"), line.cast("string")))
    file_year = (F.col("y") + 543 + F.when(order % 17 == 0, 1).otherwise(0)).cast("string")
    return joined.select(
        record.alias("_id"), onset.alias("วันที่เริ่มป่วย"), stated_year.alias("ปี"), disease.alias("ชื่อกลุ่มโรค"),
        district.alias("อำเภอ/เขต"), sex.alias("เพศ"), age.alias("อายุ (เต็ม) ปี"), cases.alias("จำนวน"),
        F.concat(F.lit("lake/raw/disease/disease_cases_"), file_year, F.lit("_full.csv")).alias("_source_file"),
    )


def feed_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw denominators per nation and ship year: two calendars, total rows, zeros, copies and split rows."""
    years = each_year(year_span(table(spark, sf_dir, "lineitem"), "l_shipdate")).alias("y")
    key, y = F.col("n_nationkey"), F.col("y")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", years).select(
        "*", F.explode(F.sequence(F.lit(1), F.when((key % 5 == 0) | (key % 7 == 3), 2).otherwise(1))).alias("copy")
    )
    # Copies of a nation divisible by five are identical; the others hold different parts of one total.
    people = 1000 * (key + 1) + 37 * (y - 1990) + F.when(key % 5 == 0, 0).otherwise(500 * (F.col("copy") - 1))
    text = people.cast("string")
    with_comma = F.concat(F.substring(text, 1, 1), F.lit(","), F.substring(text, 2, 99))
    name = F.when(key == 19, "รวม").when(key % 2 == 0, F.concat(F.lit("เขต"), F.col("n_name"))).otherwise(F.col("n_name"))
    return rows.where(y % 4 != 0).select(
        (y + F.when(y % 2 == 0, 543).otherwise(0)).cast("string").alias("ปี"), name.alias("เขต"),
        F.when((key + y) % 13 == 0, "0").when(key % 3 == 0, with_comma).otherwise(text).alias("ประชากรรวม"),
    )


def stored_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw records as files, which is how raw records arrive."""
    return materialize(feed(spark, sf_dir), scratch_path(spark, "raw"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag(canonical_cases(stored_feed(spark, sf_dir), DOMAIN), case_rules(SETTINGS, DOMAIN))


def stored_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged cases as a stored layer: what follows plans from a scan, not from every parsing expression."""
    return materialize(tagged(spark, sf_dir), scratch_path(spark, "tagged"))


def identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_case_id(clean_rows(stored_tagged(spark, sf_dir)))


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardized_cases(keep_latest(identified(spark, sf_dir)), DOMAIN)


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Every layer of the untidy feed, each stored once."""
    raw = stored_feed(spark, sf_dir)
    marked = materialize(tag(canonical_cases(raw, DOMAIN), case_rules(SETTINGS, DOMAIN)), scratch_path(spark, "tagged"))
    ids = assign_case_id(clean_rows(marked))
    cases = materialize(standardized_cases(keep_latest(ids), DOMAIN), scratch_path(spark, "standardized"))
    known = clean_population(feed_population(spark, sf_dir), SETTINGS, DOMAIN)
    population = materialize(carry_forward(known, cases), scratch_path(spark, "population"))
    gold = materialize(gold_table(cases, population, ids_unique=True), scratch_path(spark, "gold"))
    return Layers(raw, marked, ids, cases, gold, build_star(cases, population, DOMAIN, scratch_path(spark, "star"), ids_unique=True), population)


def report(spark: SparkSession, sf_dir: str) -> tuple[Layers, DataFrame]:
    found = layers(spark, sf_dir)
    return found, quality_report(found, SETTINGS, DOMAIN)
