"""Rules, identity, denominators and quality over the untidy feed and the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemart.operators import constraints, identity
from casemart.operators.denominators import carry_forward, clean_population, yearly_reference
from casemart.operators.quality import failing_rules, has_failure
from casemart.operators.rules import quarantined_rows, reason_counts
from casemart.operators.cases import canonical_cases
from casemart.operators.gold import gold_table
from casemart.operators.storage import materialize, scratch_path
from casemart.sources import contract
from workload import oracle as o
from workload.frames import (
    DOMAIN, SETTINGS, clean_rows, feed_population, identified, order_gold, order_star, report, standardized, stored_feed,
    stored_tagged, table, tagged,
)

CANONICAL_COLUMNS = ("case_id, report_date, year_be, disease_name_raw, district_name_raw, case_count, sex, age, "
                     "source_file")


def copies(spark, sf_dir):
    """Line items seen through three columns repeat often; every copy gets its number."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_tax", "l_linestatus")
    return identity.record_identity(items, ["l_returnflag", "l_quantity", "l_tax"], "l_linestatus").select(
        "l_linestatus", "l_returnflag", "l_quantity", "l_tax", F.col("_occurrence").alias("occurrence"),
        F.col("_record_id").alias("record_id"))


COPIES_SQL = """SELECT l_linestatus, l_returnflag, l_quantity, l_tax, n AS occurrence,
  l_linestatus || ':' || sha256('["' || l_returnflag || '","' || l_quantity || '","' || l_tax || '"]') || ':' || n AS record_id
FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus, l_returnflag, l_quantity, l_tax) AS n FROM lineitem)"""


def latest_items(spark, sf_dir):
    """One line item per (order, line number): the last shipped, then every other column."""
    return identity.keep_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


LATEST_ITEMS_SQL = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
           l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"""


def filled(spark, sf_dir):
    return carry_forward(
        clean_population(feed_population(spark, sf_dir), SETTINGS, DOMAIN), standardized(spark, sf_dir).select("year_be"))


def feed_gold(spark, sf_dir):
    cases = materialize(standardized(spark, sf_dir), scratch_path(spark, "standardized"))
    population = clean_population(feed_population(spark, sf_dir), SETTINGS, DOMAIN)
    return gold_table(cases, carry_forward(population, cases))


def office_rows(spark, sf_dir):
    """An official-looking file: an office per customer with its province, totals and blanks among them."""
    key = F.col("c_custkey")
    office = (
        F.when(key % 97 == 0, "-").when(key % 89 == 0, "ยอรวม").when(key % 83 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("ท้องถิ่นเขต"), F.col("n_name")))
    )
    province = F.when(F.col("n_regionkey") == 1, "สมุทรปราการ").otherwise("กรุงเทพมหานคร")
    people = F.when(key % 7 == 0, "0").when(key % 11 == 0, "x").otherwise(
        F.concat(F.lit("1,"), F.lpad((key % 1000).cast("string"), 3, "0")))
    return table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(province.alias("ชื่อจังหวัด"), office.alias("ชื่อสำนักทะเบียน"), people.alias("จำนวนประชากรทั้งหมด"))


OFFICES_SQL = """SELECT 2568 AS year_be, n_name AS district_name,
  CAST(sum(CASE WHEN c_custkey % 7 = 0 THEN 0 WHEN c_custkey % 11 = 0 THEN NULL ELSE 1000 + c_custkey % 1000 END) AS BIGINT) AS population
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey <> 1 AND c_custkey % 97 <> 0 AND c_custkey % 89 <> 0 AND c_custkey % 83 <> 0
  AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 GROUP BY n_name"""


def population_rows(spark, sf_dir):
    """A yearly table with faults: one row per customer's nation and segment, some wrong."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.when(key % 10 == 9, "2567").otherwise(" 2568 ").alias("ปี"),
        F.when(key % 10 == 8, " ").otherwise(F.concat(F.lit(" "), F.col("n_name"))).alias("เขต"),
        F.when(key % 10 == 7, "1.5").when(key % 10 == 6, "-3").otherwise(key.cast("string")).alias("ประชากรรวม"),
    )


def broken_population(spark, sf_dir):
    master = table(spark, sf_dir, "nation").where("n_regionkey < 4").select(F.col("n_name").alias("district"))
    return contract.population_contract(population_rows(spark, sf_dir), 2568, master)


BROKEN_POPULATION_SQL = """WITH t AS (
  SELECT CASE WHEN s_suppkey % 10 = 9 THEN '2567' ELSE '2568' END AS y,
         CASE WHEN s_suppkey % 10 = 8 THEN '' ELSE n_name END AS d,
         CASE WHEN s_suppkey % 10 = 7 THEN '1.5' WHEN s_suppkey % 10 = 6 THEN '-3' ELSE CAST(s_suppkey AS VARCHAR) END AS p
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
master AS (SELECT n_name AS d FROM nation WHERE n_regionkey < 4),
per AS (SELECT d, count(*) AS n FROM t WHERE d <> '' GROUP BY d)
SELECT 'year' AS rule, y AS value, count(*) AS rows FROM t WHERE y <> '2568' GROUP BY ALL
UNION ALL SELECT 'district_blank', d, count(*) FROM t WHERE d = '' GROUP BY ALL
UNION ALL SELECT 'population_not_integer', p, count(*) FROM t WHERE NOT regexp_matches(p, '^[+-]?[0-9]+$') GROUP BY ALL
UNION ALL SELECT 'population_not_positive', p, count(*) FROM t WHERE regexp_matches(p, '^[+-]?[0-9]+$') AND try_cast(p AS BIGINT) <= 0 GROUP BY ALL
UNION ALL SELECT 'duplicate_district', d, n FROM per WHERE n > 1
UNION ALL SELECT 'missing_district', d, 0 FROM master WHERE d NOT IN (SELECT d FROM per)
UNION ALL SELECT 'unexpected_district', d, n FROM per WHERE d NOT IN (SELECT d FROM master)"""

TABLE_CONTRACTS = {
    "lineitem": constraints.TableContract(
        unique=(("l_orderkey", "l_linenumber"),), required=("l_orderkey", "l_shipdate"),
        checks={"quantity_over_ten": "l_quantity > 10", "discount_range": "l_discount between 0 and 1"},
        foreign={"l_orderkey": ("orders", "o_orderkey"), "l_partkey": ("part", "p_partkey")},
    ),
    "orders": constraints.TableContract(
        unique=(("o_orderkey",), ("o_custkey",)), required=("o_orderdate",),
        checks={"open_status": "o_orderstatus in ('O', 'P')"}, foreign={"o_custkey": ("customer", "c_custkey")},
    ),
    "labels": constraints.TableContract(
        unique=(("doc_id",),), required=("quality",), checks={"not_toxic": "toxic = 0"},
        foreign={"doc_id": ("documents", "doc_id")},
    ),
}


def table_constraints(kind):
    def run(spark, sf_dir):
        tables = {name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "labels", "customer", "part", "documents")}
        return constraints.check_constraints(tables, TABLE_CONTRACTS, (kind,))

    return run


def constraint_sql(kind: str, contracts=TABLE_CONTRACTS) -> str:
    parts = []
    for name, rules in contracts.items():
        if kind == "UNIQUE":
            # a key that isn't complete is a violation for each of its rows
            parts += [(name, ", ".join(k), f"SELECT CAST(count(*) FILTER (c AND n > 1) + coalesce(sum(n) FILTER (NOT c), 0) AS BIGINT) FROM (SELECT {' AND '.join(f'{x} IS NOT NULL' for x in k)} AS c, "
                                           f"count(*) AS n FROM {name} GROUP BY {', '.join(k)})") for k in rules.unique]
        if kind == "NOT NULL":
            parts += [(name, c, f"SELECT count(*) FROM {name} WHERE {c} IS NULL") for c in rules.required]
        if kind == "CHECK":
            parts += [(name, label, f"SELECT count(*) FROM {name} WHERE NOT ({rule})") for label, rule in rules.checks.items()]
        if kind == "FOREIGN KEY":
            parts += [(name, c, f"SELECT count(*) FROM {name} WHERE {c} NOT IN (SELECT {pc} FROM {parent})")
                      for c, (parent, pc) in rules.foreign.items()]
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{kind}' AS kind, '{label}' AS constraint_name, n AS violations, "
        f"CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({count}) t(n)" for name, label, count in parts)


STAR_TABLES = {name: rules for name, rules in constraints.STAR_CONTRACTS.items() if name != "data_quality"}
STAR_SQL = "SELECT kind, status, count(*) AS constraints, CAST(sum(violations) AS BIGINT) AS violations FROM (" + "\nUNION ALL ".join(
    f"SELECT * FROM ({constraint_sql(kind, STAR_TABLES)})" for kind in constraints.KINDS) + ") GROUP BY kind, status"


def star_constraints(spark, sf_dir):
    return summed_constraints(order_star(spark, sf_dir).tables())


def summed_constraints(tables):
    return constraints.check_constraints(tables).groupBy("kind", "status").agg(
        F.count("*").alias("constraints"), F.sum("violations").alias("violations"))


def broken_star(spark, sf_dir):
    """The star with copies of facts, counts below zero, unknown sexes and places, and diseases without a name."""
    tables = order_star(spark, sf_dir).tables()
    fact, odd = tables["fact_disease_cases"], F.col("disease_key") % 2 == 1
    tables["fact_disease_cases"] = fact.withColumns({
        "total_cases": F.when(F.col("date_key") % 5 == 0, -F.col("total_cases")).otherwise(F.col("total_cases")),
        "sex": F.when(F.col("date_key") % 7 == 0, "?").otherwise(F.col("sex"))}).unionByName(fact.where("date_key % 11 = 0"))
    tables["dim_disease"] = tables["dim_disease"].withColumn("disease_name", F.when(~odd, F.col("disease_name")))
    tables["dim_district"] = tables["dim_district"].where("district_key % 4 <> 0")
    return summed_constraints(tables)


BROKEN_STAR_SQL = o.over_orders(
    STAR_SQL.replace("fact_disease_cases", "broken_facts").replace("dim_disease", "broken_diseases").replace("dim_district", "broken_districts"),
    """broken_facts AS (
  SELECT * REPLACE (CASE WHEN date_key % 5 = 0 THEN -total_cases ELSE total_cases END AS total_cases, CASE WHEN date_key % 7 = 0 THEN '?' ELSE sex END AS sex)
  FROM fact_disease_cases UNION ALL SELECT * FROM fact_disease_cases WHERE date_key % 11 = 0)""",
    "broken_diseases AS (SELECT * REPLACE (CASE WHEN disease_key % 2 = 0 THEN disease_name END AS disease_name) FROM dim_disease)",
    "broken_districts AS (SELECT * FROM dim_district WHERE district_key % 4 <> 0)")


def names_apart(spark, sf_dir):
    observed = clean_rows(stored_tagged(spark, sf_dir)).select(DOMAIN.disease(F.col("disease_name_raw")).alias("name"))
    expected = table(spark, sf_dir, "part").select(F.initcap("p_type").alias("name"))
    return contract.set_difference(expected, observed, "name")


def through_tagged(select):
    return o.query(o.FEED, o.CANONICAL, o.TAGGED, select=select)


def through_identified(select):
    return o.query(o.FEED, o.CANONICAL, o.TAGGED, o.IDENTIFIED, o.DEDUPLICATED, select=select)


QUERIES = {
    "gold_incidence": (
        order_gold,
        o.query(o.ORDER_CASES, o.ORDER_POPULATION, "population AS (SELECT * FROM known_population)", o.GOLD,
                select="SELECT * FROM gold")),
    "gold_feed": (
        feed_gold, o.over_feed("SELECT * FROM gold")),
    "canonical_cases": (
        lambda s, d: canonical_cases(stored_feed(s, d), DOMAIN),
        o.query(o.FEED, o.CANONICAL, select=f"SELECT {CANONICAL_COLUMNS} FROM canonical")),
    "quarantine_reasons": (
        lambda s, d: reason_counts(tagged(s, d)),
        through_tagged("SELECT _quarantine_reason AS reason, count(*) AS rows FROM tagged WHERE _quarantine_reason IS NOT NULL GROUP BY ALL")),
    "clean_rows": (
        lambda s, d: clean_rows(stored_tagged(s, d)),
        through_tagged(f"SELECT {CANONICAL_COLUMNS} FROM tagged WHERE _quarantine_reason IS NULL")),
    "quarantine_rows": (
        lambda s, d: quarantined_rows(stored_tagged(s, d)),
        through_tagged(f"SELECT {CANONICAL_COLUMNS}, _quarantine_reason FROM tagged WHERE _quarantine_reason IS NOT NULL")),
    "case_ids": (
        lambda s, d: identified(s, d).select("case_id", "year_be", "source_file"),
        through_identified("SELECT case_id, year_be, source_file FROM identified")),
    "dedup_latest": (
        lambda s, d: identity.keep_latest(identified(s, d)),
        through_identified(f"SELECT {CANONICAL_COLUMNS} FROM deduplicated")),
    "dedup_items": (latest_items, LATEST_ITEMS_SQL),
    "dedup_removed": (
        lambda s, d: identity.duplicate_summary(identified(s, d)),
        through_identified("SELECT CAST(count(*) AS BIGINT) AS rows, count(DISTINCT case_id) AS kept, "
                           "count(*) - count(DISTINCT case_id) AS removed FROM identified")),
    "dup_key_count": (
        lambda s, d: identity.duplicate_keys(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "SELECT count(*) AS duplicate_keys FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
    "record_identity": (copies, COPIES_SQL),
    "identical_rows": (
        lambda s, d: identity.identical_rows(table(s, d, "conversations"), ["role", "text"]),
        "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT role, text FROM conversations)) AS identical_rows FROM conversations"),
    "standardized_cases": (
        standardized,
        o.over_feed("SELECT * FROM cases")),
    "population_clean": (
        lambda s, d: clean_population(feed_population(s, d), SETTINGS, DOMAIN),
        o.query(o.FEED_POPULATION, select="SELECT CAST(year_be AS INTEGER) AS year_be, district_name, population FROM known_population")),
    "population_fill_years": (
        filled, o.over_feed("SELECT CAST(year_be AS INTEGER) AS year_be, district_name, population, filled FROM population")),
    "population_reference": (lambda s, d: yearly_reference(office_rows(s, d), 2568), OFFICES_SQL),
    "population_contract": (broken_population, BROKEN_POPULATION_SQL),
    "name_set_difference": (
        names_apart,
        o.query(o.FEED, o.CANONICAL, o.TAGGED,
                "observed AS (SELECT DISTINCT " + o.disease("disease_name_raw") + " AS name FROM tagged WHERE _quarantine_reason IS NULL)",
                "expected AS (SELECT DISTINCT upper(p_type[1]) || lower(p_type[2:]) AS name FROM part)",
                select="SELECT 'missing' AS side, name FROM expected WHERE name NOT IN (SELECT name FROM observed) "
                       "UNION ALL SELECT 'unexpected', name FROM observed WHERE name NOT IN (SELECT name FROM expected)")),
    "dq_report": (lambda s, d: report(s, d)[1], o.over_feed("SELECT * FROM report", o.quality())),
    "dq_failing": (
        lambda s, d: failing_rules(report(s, d)[1]), o.over_feed("SELECT * FROM report WHERE status = 'FAIL'", o.quality())),
    "dq_has_failure": (
        lambda s, d: has_failure(report(s, d)[1]),
        o.over_feed("SELECT count(*) > 0 AS has_failure FROM report WHERE status = 'FAIL'", o.quality())),
    "ck_primary_key": (table_constraints("UNIQUE"), constraint_sql("UNIQUE")),
    "ck_foreign_key": (table_constraints("FOREIGN KEY"), constraint_sql("FOREIGN KEY")),
    "ck_check": (table_constraints("CHECK"), constraint_sql("CHECK")),
    "ck_not_null": (table_constraints("NOT NULL"), constraint_sql("NOT NULL")),
    "ck_star": (star_constraints, o.over_orders(STAR_SQL)),
    "ck_star_broken": (broken_star, BROKEN_STAR_SQL),
}
