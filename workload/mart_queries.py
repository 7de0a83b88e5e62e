"""Star tables, views, statements, measures and page datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemart.plans import reports, statements, views
from casemart.plans.measures import Mart
from casemart.reference_values import COVERAGE_COMPLETE, COVERAGE_PARTIAL, NOT_RECONCILED, RECONCILED
from workload import oracle as o
from workload.frames import order_star, report, table

PRIORITIES = {
    "urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "not_specified": "4-NOT SPECIFIED", "low": "5-LOW",
}
SOURCES = {2541: "survey", 2544: "register"}


def star_table(name):
    return lambda spark, sf_dir: order_star(spark, sf_dir).tables()[name]


def view(name):
    return lambda spark, sf_dir: views.VIEWS[name](order_star(spark, sf_dir))


def over_star(function, *arguments):
    return lambda spark, sf_dir: function(order_star(spark, sf_dir), *arguments)


def over_report(function):
    """A statement over the feed's star and quality report."""
    def run(spark, sf_dir):
        layers, quality = report(spark, sf_dir)
        return function(layers.star, quality)

    return run


def measured(name, filters=None, by=()):
    return lambda spark, sf_dir: Mart(order_star(spark, sf_dir)).measure(name, filters, by)


def paged(page, filters=None):
    return lambda spark, sf_dir: page(Mart(order_star(spark, sf_dir)), filters)


def audit_rows(spark, sf_dir):
    """A load per month of orders, with the number of its orders and of its customers."""
    month = F.date_format("o_orderdate", "yyyyMM").cast("long")
    instant = F.timestamp_seconds(F.unix_date(F.max(F.col("o_orderdate").cast("date"))) * 86400)
    return table(spark, sf_dir, "orders").groupBy(month.alias("load_id")).agg(
        instant.alias("loaded_at"),
        F.create_map(F.lit("fact_disease_cases"), F.count("*"), F.lit("fact_population"), F.count_distinct("o_custkey"))
        .alias("row_counts"),
    )


def load_history(spark, sf_dir):
    history = statements.load_history(audit_rows(spark, sf_dir))
    return history.withColumn("loaded_local", F.date_format("loaded_local", "yyyy-MM-dd HH:mm"))


AUDIT_SQL = """SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS load_id,
  strftime(max(o_orderdate) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M') AS loaded_local,
  count(*) AS fact_rows, count(DISTINCT o_custkey) AS population_rows
FROM orders GROUP BY 1 ORDER BY load_id DESC LIMIT 5"""

COUNTED = ("fact_disease_cases", "fact_population", "dim_date", "dim_district", "dim_disease", "dim_age_group", "dim_sex")
COUNTS_SQL = "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, {o.text(statements.GRAINS[name])} AS grain FROM {source}"
    for name, source in [*((n, n) for n in COUNTED), ("data_quality", "report")])

RECONCILE_SQL = f"""SELECT r AS raw_rows, q AS quarantined, r - q AS expected, m AS mart_cases,
  CASE WHEN r - q = m THEN {o.text(RECONCILED)} ELSE {o.text(NOT_RECONCILED)} END AS verdict
FROM (SELECT (SELECT CAST(observed AS BIGINT) FROM report WHERE rule = 'raw_rows_not_empty') AS r,
             (SELECT CAST(observed AS BIGINT) FROM report WHERE rule = 'quarantined_rows') AS q,
             (SELECT CAST(sum(total_cases) AS BIGINT) FROM fact_disease_cases) AS m)"""

DETAIL = ("detail AS (SELECT * FROM fact_disease_cases JOIN dim_date USING (date_key) JOIN dim_district USING (district_key) "
          "JOIN dim_disease USING (disease_key) JOIN dim_age_group USING (age_group_key) JOIN dim_sex USING (sex))")
PEOPLE = "people AS (SELECT * FROM fact_population JOIN dim_district USING (district_key))"
MONTHLY = "monthly AS (SELECT month_start, sum(total_cases) AS n FROM detail GROUP BY ALL)"
SCOPE = "(SELECT count(*) FROM dim_district WHERE is_bangkok_district)"
CASES = "CAST(sum(total_cases) AS BIGINT) AS total_cases"


def detail(select: str, *extra: str) -> str:
    return o.over_orders(select, DETAIL, PEOPLE, MONTHLY, *extra)


def feed_report(select: str) -> str:
    return o.over_feed(select, o.quality())


def change_sql(months: int, name: str) -> str:
    """Change by month: the month itself against an earlier one, months on either side kept."""
    return detail(
        f"SELECT coalesce(a.month_start, b.m) AS month_start, (coalesce(a.n, 0) - b.n) / CAST(b.n AS DOUBLE) AS {name} "
        "FROM monthly a FULL JOIN (SELECT d.month_start AS m, t.n FROM dim_date d JOIN monthly t "
        f"ON t.month_start = d.month_start - INTERVAL {months} MONTH) b ON b.m = a.month_start")


COVERAGE_BY_YEAR = ("SELECT year_be, count(DISTINCT district_key) / CAST(" + SCOPE + " AS DOUBLE) AS population_coverage "
                    "FROM people WHERE is_bangkok_district AND year_be IN (SELECT year_be FROM dim_date) GROUP BY year_be")

QUERIES = {
    **{name: (star_table(name), o.over_orders(f"SELECT * FROM {name}")) for name in (
        "dim_date", "dim_district", "dim_disease", "fact_population")},
    "fact_cases": (star_table("fact_disease_cases"), o.over_orders("SELECT * FROM fact_disease_cases")),
    "fact_feed": (
        lambda s, d: report(s, d)[0].star.fact_disease_cases, o.over_feed("SELECT * FROM fact_disease_cases")),
    **{name: (view(name), o.over_orders(f"SELECT * FROM {name}")) for name in views.VIEWS},
    # statements
    "demo_mart_counts": (over_report(statements.mart_counts), feed_report(COUNTS_SQL)),
    "demo_reconcile": (over_report(statements.reconciliation), feed_report(RECONCILE_SQL)),
    "demo_audit": (load_history, AUDIT_SQL),
    "demo_star": (
        over_star(statements.cases_by_year_disease), detail(f"SELECT year_be, disease_name, {CASES} FROM detail GROUP BY ALL")),
    "demo_rates": (
        over_star(statements.rate_list),
        o.over_orders("SELECT year_be, period_label, disease_name, total_cases, population, cumulative_incidence_per_100k FROM vw_year_disease")),
    "demo_crosstab": (
        over_star(statements.month_disease_crosstab, PRIORITIES),
        o.over_orders("SELECT month_start, month_label, " + ", ".join(
            f"CAST(sum(total_cases) FILTER (WHERE disease_name = {o.text(v)}) AS BIGINT) AS {k}" for k, v in PRIORITIES.items())
            + ", CAST(sum(total_cases) AS BIGINT) AS total FROM vw_monthly_trend GROUP BY month_start, month_label")),
    "demo_peak_month": (
        over_star(statements.peak_months),
        o.over_orders("SELECT disease_name, month_label, total_cases FROM (SELECT *, row_number() OVER (PARTITION BY disease_name "
                      "ORDER BY total_cases DESC, month_start) AS rn FROM vw_monthly_trend) WHERE rn = 1")),
    "demo_top10": (
        over_star(statements.top_district_rates, 2541),
        detail("SELECT district_name, c AS total_cases, population, " + o.rate("c", "population", 1) + " AS rate_per_100k "
               "FROM (SELECT district_key, district_name, CAST(sum(total_cases) AS BIGINT) AS c FROM detail WHERE year_be = 2541 GROUP BY ALL) "
               "JOIN (SELECT district_key, population FROM fact_population WHERE year_be = 2541) USING (district_key) "
               "ORDER BY rate_per_100k DESC, district_name LIMIT 10")),
    "demo_age_sex": (
        over_star(statements.age_sex_shares, 2541),
        detail("SELECT age_group, CAST(sum(total_cases) FILTER (WHERE sex = 'M') AS BIGINT) AS male, "
               "CAST(sum(total_cases) FILTER (WHERE sex = 'F') AS BIGINT) AS female, CAST(sum(total_cases) AS BIGINT) AS total, "
               "round(100.0::DOUBLE * sum(total_cases) / sum(sum(total_cases)) OVER (), 1) AS share_pct "
               "FROM detail WHERE year_be = 2541 GROUP BY age_group")),
    "demo_denominators": (
        over_star(statements.denominator_list, SOURCES),
        o.over_orders("SELECT year_be, count(*) AS districts, CAST(sum(population) AS BIGINT) AS population, "
                      "CASE year_be WHEN 2541 THEN 'survey' WHEN 2544 THEN 'register' END AS source FROM fact_population GROUP BY year_be")),
    "demo_dq_status": (
        over_report(lambda star, quality: statements.status_counts(quality)),
        feed_report("SELECT status, count(*) AS rules FROM report GROUP BY status")),
    "demo_dq_rules": (
        over_report(lambda star, quality: statements.enforced_rules(quality)),
        feed_report("SELECT * FROM report WHERE threshold <> 'informational'")),
    # measures
    "me_total_cases": (
        measured("total_cases", {"year_be": [2540, 2541]}, ["district_name", "disease_name"]),
        detail(f"SELECT district_name, disease_name, {CASES} FROM detail WHERE year_be IN (2540, 2541) GROUP BY ALL")),
    "me_source_records": (
        measured("source_records", {"sex": ["F"]}, ["year_be"]),
        detail("SELECT year_be, CAST(sum(source_records) AS BIGINT) AS source_records FROM detail WHERE sex = 'F' GROUP BY ALL")),
    "me_population": (
        measured("population", {"year_be": [2540, 2541], "disease_name": ["1-URGENT"]}, ["district_name"]),
        detail("SELECT district_name, CAST(sum(population) AS BIGINT) AS population FROM people WHERE year_be IN (2540, 2541) GROUP BY ALL")),
    "me_population_by_month": (
        measured("population", {"district_name": ["NATION_3", "NATION_5"]}, ["month_start"]),
        detail("SELECT month_start, CAST(sum(population) AS BIGINT) AS population FROM people JOIN dim_date USING (year_be) "
               "WHERE district_name IN ('NATION_3', 'NATION_5') GROUP BY ALL")),
    "me_incidence": (
        measured("incidence_per_100k", {"disease_name": ["1-URGENT"]}, ["year_be", "district_name"]),
        detail("SELECT year_be, district_name, n * 100000 / CAST(population AS DOUBLE) AS incidence_per_100k FROM "
               "(SELECT year_be, district_name, sum(total_cases) AS n FROM detail WHERE disease_name = '1-URGENT' GROUP BY ALL) "
               "LEFT JOIN (SELECT year_be, district_name, population FROM people) USING (year_be, district_name)")),
    "me_incidence_by_sex": (
        measured("incidence_per_100k", None, ["year_be", "sex"]),
        detail("SELECT DISTINCT year_be, sex, CAST(NULL AS DOUBLE) AS incidence_per_100k FROM detail")),
    "me_coverage": (measured("population_coverage", None, ["year_be"]), detail(COVERAGE_BY_YEAR)),
    "me_coverage_status": (
        measured("coverage_status", None, ["year_be"]),
        detail(f"SELECT year_be, CASE WHEN population_coverage >= 1 THEN {o.text(COVERAGE_COMPLETE)} "
               f"ELSE {o.text(COVERAGE_PARTIAL)} END AS coverage_status "
               f"FROM (SELECT DISTINCT year_be FROM dim_date) LEFT JOIN ({COVERAGE_BY_YEAR}) USING (year_be)")),
    "me_case_share": (
        measured("case_share", {"year_be": [2540]}, ["disease_name", "age_group", "sex"]),
        detail("SELECT disease_name, age_group, sex, sum(total_cases) / CAST(sum(sum(total_cases)) OVER (PARTITION BY disease_name) AS DOUBLE) "
               "AS case_share FROM detail WHERE year_be = 2540 GROUP BY disease_name, age_group, sex")),
    "me_case_share_filtered": (
        measured("case_share", {"sex": ["M"], "age_group_key": [4, 5]}, ["year_be"]),
        detail("SELECT year_be, sum(total_cases) FILTER (WHERE sex = 'M' AND age_group_key IN (4, 5)) / CAST(sum(total_cases) AS DOUBLE) "
               "AS case_share FROM detail GROUP BY ALL")),
    "me_district_rank": (
        measured("district_rank", {"year_be": [2540]}, ["district_name"]),
        detail("SELECT district_name, CAST(dense_rank() OVER (ORDER BY coalesce(n, 0) DESC) AS INTEGER) AS district_rank FROM dim_district "
               "LEFT JOIN (SELECT district_name, sum(total_cases) AS n FROM detail WHERE year_be = 2540 GROUP BY ALL) USING (district_name)")),
    "me_district_rank_by_year": (
        measured("district_rank", {"is_bangkok_district": [True]}, ["year_be", "district_name"]),
        detail("SELECT year_be, district_name, CAST(dense_rank() OVER (PARTITION BY year_be ORDER BY sum(total_cases) DESC) AS INTEGER) "
               "AS district_rank FROM detail WHERE is_bangkok_district GROUP BY year_be, district_name")),
    "me_previous_month": (
        measured("cases_previous_month", None, ["month_start", "disease_name"]),
        detail("SELECT d.month_start, t.disease_name, CAST(sum(t.total_cases) AS BIGINT) AS cases_previous_month FROM dim_date d "
               "JOIN detail t ON t.month_start = d.month_start - INTERVAL 1 MONTH GROUP BY d.month_start, t.disease_name")),
    "me_mom": (measured("mom_change", None, ["month_start"]), change_sql(1, "mom_change")),
    "me_mom_of_year": (
        measured("mom_change", {"year_be": [2541]}),
        detail("SELECT ((SELECT sum(total_cases) FROM detail WHERE year_be = 2541) - n) / CAST(n AS DOUBLE) AS mom_change "
               "FROM monthly WHERE month_start = DATE '1998-11-01'")),
    "me_same_month_last_year": (
        measured("cases_same_month_last_year", {"district_name": ["NATION_1", "NATION_2"]}, ["month_start", "district_name"]),
        detail("SELECT d.month_start, t.district_name, CAST(sum(t.total_cases) AS BIGINT) AS cases_same_month_last_year FROM dim_date d "
               "JOIN detail t ON t.month_start = d.month_start - INTERVAL 12 MONTH WHERE t.district_name IN ('NATION_1', 'NATION_2') "
               "GROUP BY d.month_start, t.district_name")),
    "me_yoy": (measured("yoy_change", None, ["month_start"]), change_sql(12, "yoy_change")),
    "me_failed_rules": (
        over_report(lambda star, quality: Mart(star, quality).measure("failed_rules")),
        feed_report("SELECT count(*) FILTER (WHERE status = 'FAIL') AS failed_rules FROM report")),
    # page datasets
    "rp_overview_cards": (
        paged(reports.overview_cards, {"year_be": [2541]}),
        detail("SELECT CAST(n AS BIGINT) AS total_cases, n * 100000 / CAST(p AS DOUBLE) AS incidence_per_100k, "
               f"CASE WHEN c >= {SCOPE} THEN {o.text(COVERAGE_COMPLETE)} ELSE {o.text(COVERAGE_PARTIAL)} END AS coverage_status "
               "FROM (SELECT (SELECT sum(total_cases) FROM detail WHERE year_be = 2541) AS n, (SELECT sum(population) FROM people WHERE year_be = 2541) AS p, "
               "(SELECT count(*) FROM people WHERE year_be = 2541 AND is_bangkok_district) AS c)")),
    "rp_overview_trend": (
        paged(reports.overview_trend), detail(f"SELECT month_start, month_label, disease_name, {CASES} FROM detail GROUP BY ALL")),
    "rp_overview_by_disease": (
        paged(reports.overview_by_disease), detail(f"SELECT disease_name, {CASES} FROM detail GROUP BY ALL")),
    "rp_trend_by_month": (
        paged(reports.trend_by_month, {"disease_name": ["5-LOW"], "district_name": ["NATION_4"]}),
        detail(f"SELECT month_start, month_label, {CASES} FROM detail WHERE disease_name = '5-LOW' AND district_name = 'NATION_4' GROUP BY ALL")),
    "rp_trend_cards": (
        paged(reports.trend_cards),
        detail("SELECT (t - a) / CAST(a AS DOUBLE) AS mom_change, (t - b) / CAST(b AS DOUBLE) AS yoy_change FROM (SELECT (SELECT sum(n) FROM monthly) AS t, "
               "(SELECT n FROM monthly WHERE month_start = (SELECT max(month_start) - INTERVAL 1 MONTH FROM dim_date)) AS a, "
               "(SELECT n FROM monthly WHERE month_start = (SELECT max(month_start) - INTERVAL 12 MONTH FROM dim_date)) AS b)")),
    "rp_district_table": (
        paged(reports.district_table, {"year_be": [2541], "disease_name": ["2-HIGH"]}),
        detail("SELECT district_name, CAST(n AS BIGINT) AS total_cases, p AS population, n * 100000 / CAST(p AS DOUBLE) AS incidence_per_100k, "
               "CAST(dense_rank() OVER (ORDER BY coalesce(n, 0) DESC) AS INTEGER) AS district_rank FROM dim_district "
               "LEFT JOIN (SELECT district_name, sum(total_cases) AS n FROM detail WHERE year_be = 2541 AND disease_name = '2-HIGH' GROUP BY ALL) USING (district_name) "
               "LEFT JOIN (SELECT district_name, CAST(sum(population) AS BIGINT) AS p FROM people WHERE year_be = 2541 GROUP BY ALL) USING (district_name)")),
    "rp_age_sex": (
        paged(reports.age_sex_counts, {"year_be": [2541]}),
        detail(f"SELECT age_group_key, age_group, sex_label, {CASES} FROM detail WHERE year_be = 2541 GROUP BY ALL")),
    "rp_share_matrix": (
        paged(reports.age_sex_share_matrix, {"year_be": [2541]}),
        detail("SELECT age_group_key, age_group, " + ", ".join(
            f"sum(total_cases) FILTER (WHERE sex = '{s}') / CAST((SELECT sum(total_cases) FROM detail WHERE year_be = 2541) AS DOUBLE) AS share_{s.lower()}"
            for s in ("F", "M", "U")) + " FROM detail WHERE year_be = 2541 GROUP BY age_group_key, age_group")),
    "rp_quality": (
        over_report(lambda star, quality: reports.quality_table(Mart(star, quality))), feed_report("SELECT * FROM report")),
}
