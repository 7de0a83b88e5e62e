"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemart import CaseDomain, functions as fn
from casemart import reference_values as ref
from casemart.operators.identity import BUSINESS_COLUMNS, fingerprint
from workload import oracle as o
from workload.frames import DOMAIN, clean_rows, stored_feed, stored_tagged, table

CITY = CaseDomain()
SPELLINGS = sorted(ref.DISEASE_ALIASES)


def order_texts(spark, sf_dir):
    """District names with typing errors and disease spellings with noise, one pair per order."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    name = F.element_at(F.array(*[F.lit(d) for d in ref.DISTRICTS]), (customer % 50 + 1).cast("int"))
    untidy = (
        F.when(key % 6 == 0, F.concat(F.lit("เขต"), name)).when(key % 6 == 1, F.concat(F.lit(" ข. "), name, F.lit(" กทม.")))
        .when(key % 6 == 2, F.replace(name, F.lit("แ"), F.lit("เเ"))).when(key % 6 == 3, F.replace(name, F.lit("ั"), F.lit("ััั")))
        .when(key % 6 == 4, F.concat(F.substring(name, 1, 3), F.lit("  "), F.substring(name, 4, 99), F.lit(" กรุงเทพมหานคร")))
        .otherwise(F.concat(name, F.lit("ฯ")))
    )
    spelling = F.element_at(F.array(*[F.lit(d) for d in SPELLINGS]), (customer % len(SPELLINGS) + 1).cast("int"))
    noisy = (
        F.when(key % 4 == 0, F.upper(spelling)).when(key % 4 == 1, F.concat(F.lit("  "), spelling, F.lit(". ")))
        .when(key % 4 == 2, F.replace(spelling, F.lit(" "), F.lit("_"))).otherwise(F.concat(spelling, F.lit(" x")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", untidy.alias("place"), noisy.alias("disease"))


def sql_list(values) -> str:
    return "[" + ", ".join(map(o.text, values)) + "]"


ORDER_TEXTS = f"""texts AS (
  SELECT o_orderkey,
    CASE o_orderkey % 6 WHEN 0 THEN 'เขต' || name WHEN 1 THEN ' ข. ' || name || ' กทม.' WHEN 2 THEN replace(name, 'แ', 'เเ')
      WHEN 3 THEN replace(name, 'ั', 'ััั') WHEN 4 THEN substr(name, 1, 3) || '  ' || substr(name, 4) || ' กรุงเทพมหานคร'
      ELSE name || 'ฯ' END AS place,
    CASE o_orderkey % 4 WHEN 0 THEN upper(spelling) WHEN 1 THEN '  ' || spelling || '. ' WHEN 2 THEN replace(spelling, ' ', '_')
      ELSE spelling || ' x' END AS disease
  FROM (SELECT o_orderkey, list_extract({sql_list(ref.DISTRICTS)}, CAST(o_custkey % 50 + 1 AS INTEGER)) AS name,
               list_extract({sql_list(SPELLINGS)}, CAST(o_custkey % {len(SPELLINGS)} + 1 AS INTEGER)) AS spelling FROM orders))"""


def alias_sql() -> str:
    import re

    values = {re.sub(r"[\s_./\-]+", "", k.lower()): v for k, v in ref.DISEASE_ALIASES.items()}
    return o.mapped(o.key("disease"), values, "trim(disease)")


def from_feed(**columns):
    def run(spark, sf_dir):
        raw = stored_feed(spark, sf_dir)
        return raw.select(F.col("_id").alias("id"), *[make(raw).alias(name) for name, make in columns.items()])

    return run


def feed_sql(select: str) -> str:
    return o.query(o.FEED, select=f"SELECT id, {select} FROM feed")


def age_bands(spark, sf_dir):
    age = F.col("c_acctbal") / 100
    return table(spark, sf_dir, "customer").select("c_custkey", DOMAIN.age_band(age).alias("age_group_key"))


def months(spark, sf_dir):
    date = F.col("o_orderdate").cast("date")
    start = F.trunc(date, "month")
    year = F.year(date) + 543
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.month_key(date).alias("date_key"), start.alias("month_start"), F.quarter(date).alias("quarter"),
        fn.month_label(F.month(date), year).alias("month_label"), fn.shift_months(start, -1).alias("previous_month"),
        fn.shift_months(start, -12).alias("month_last_year"),
    )


MONTHS_SQL = f"""SELECT o_orderkey, CAST(year(m) * 100 + month(m) AS INTEGER) AS date_key, m AS month_start,
  CAST(quarter(m) AS INTEGER) AS quarter, {o.MONTH_LABEL} AS month_label,
  CAST(m - INTERVAL 1 MONTH AS DATE) AS previous_month, CAST(m - INTERVAL 12 MONTH AS DATE) AS month_last_year
FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)"""


def safe_division(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.safe_ratio(F.col("l_tax"), F.col("l_discount")).alias("ratio")
    )


def json_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.get_json_object("props", "$.none").alias("none"),
    )


def local_days(spark, sf_dir):
    """Events per day and type in another time zone, with the text forms the statements use."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Bangkok"), "ts")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.date_format(local, "yyyy-MM-dd").alias("local_day"), "event_type").agg(F.count("*").alias("events"))
    )


def lineage_years(spark, sf_dir):
    raw = stored_feed(spark, sf_dir)
    date = fn.parse_report_date(F.col("`วันที่เริ่มป่วย`"))
    year = fn.lineage_year(fn.buddhist_year(F.col("ปี")), fn.year_from_path(F.col("_source_file")), date)
    return raw.select(F.col("_id").alias("id"), year.alias("year_be"))


def surrogate_keys(spark, sf_dir):
    return clean_rows(stored_tagged(spark, sf_dir)).select(
        F.col("case_id").alias("given_id"), fingerprint(BUSINESS_COLUMNS).alias("surrogate_key")
    )


QUERIES = {
    "fn_numeric": (
        from_feed(age=lambda r: fn.to_numeric(F.col("`อายุ (เต็ม) ปี`")), cases=lambda r: fn.to_numeric(F.col("จำนวน"))),
        feed_sql(f"{o.numeric('age')} AS age, {o.numeric('cases')} AS cases")),
    "fn_year_be": (
        from_feed(year_be=lambda r: fn.buddhist_year(F.col("ปี"))),
        feed_sql(f"CAST({o.year_be('stated_year')} AS INTEGER) AS year_be")),
    "fn_parse_date": (
        from_feed(report_date=lambda r: fn.parse_report_date(F.col("`วันที่เริ่มป่วย`"))),
        feed_sql(f"{o.date('onset')} AS report_date")),
    "fn_lineage_year": (
        lineage_years, o.query(o.FEED, o.CANONICAL, select="SELECT case_id AS id, year_be FROM canonical")),
    "fn_standardize_name": (
        lambda s, d: order_texts(s, d).select("o_orderkey", CITY.district(F.col("place")).alias("district_name")),
        o.query(ORDER_TEXTS, "repaired AS (SELECT o_orderkey, " + o.place_text("place", marks=True) + " AS name FROM texts)",
                select=f"SELECT o_orderkey, {o.mapped('name', ref.DISTRICT_ALIASES, 'name')} AS district_name FROM repaired")),
    "fn_standardize_alias": (
        lambda s, d: order_texts(s, d).select("o_orderkey", CITY.disease(F.col("disease")).alias("disease_name")),
        o.query(ORDER_TEXTS, select=f"SELECT o_orderkey, {alias_sql()} AS disease_name FROM texts")),
    "fn_sex": (from_feed(sex=lambda r: DOMAIN.sex(F.col("เพศ"))), feed_sql(f"{o.sex('sex')} AS sex")),
    "fn_alias_key": (
        from_feed(key=lambda r: fn.alias_key(F.col("ชื่อกลุ่มโรค"))), feed_sql(f"{o.key('disease')} AS key")),
    "fn_age_band": (
        age_bands, f"SELECT c_custkey, {o.band('(c_acctbal / 100)')} AS age_group_key FROM customer"),
    "fn_month": (months, MONTHS_SQL),
    "fn_safe_div": (
        safe_division,
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio FROM lineitem"),
    "fn_json_field": (
        json_fields,
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
        "json_extract_string(props, '$.none') AS none FROM events"),
    "fn_local_time": (
        local_days,
        "SELECT strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS local_day, event_type, count(*) AS events FROM events GROUP BY ALL"),
    "surrogate_key": (
        surrogate_keys,
        o.query(o.FEED, o.CANONICAL, o.TAGGED,
                select=f"SELECT case_id AS given_id, {o.SURROGATE} AS surrogate_key FROM tagged WHERE _quarantine_reason IS NULL")),
}
