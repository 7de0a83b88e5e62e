"""SQL building blocks for DuckDB: the same stand-ins and operators, written independently as text."""

from __future__ import annotations

from casemart import reference_values as ref
from workload.frames import PLACE_ALIASES, PLACES, TYPE_ALIASES

MARKS = [0x0E31, *range(0x0E34, 0x0E3B), *range(0x0E47, 0x0E4F)]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def numeric(x: str) -> str:
    digits = f"regexp_replace({x}, '[,\\s\\x{{00A0}}]+', '', 'g')"
    return f"CASE WHEN regexp_full_match({digits}, '-?[0-9]+([.][0-9]+)?') THEN try_cast({digits} AS DOUBLE) END"


def year_be(x: str) -> str:
    n = f"CAST(trunc({numeric(x)}) AS INTEGER)"
    return f"({n} + CASE WHEN {n} BETWEEN 1900 AND 2200 THEN 543 ELSE 0 END)"


def date(x: str) -> str:
    t, shape = f"trim({x})", "^([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})$"
    part = [f"regexp_extract({t}, '{shape}', {g})" for g in (1, 2, 3)]
    y = f"try_cast({part[2]} AS INTEGER)"
    common = f"CAST({y} - CASE WHEN {y} > 2400 THEN 543 ELSE 0 END AS VARCHAR)"
    rebuilt = f"lpad({common}, 4, '0') || '-' || lpad({part[1]}, 2, '0') || '-' || lpad({part[0]}, 2, '0')"
    head = f"substr({t}, 1, 10)"
    return (
        f"CASE WHEN regexp_matches({t}, '{shape}') THEN try_cast({rebuilt} AS DATE) "
        f"WHEN regexp_matches({head}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN try_cast({head} AS DATE) "
        f"WHEN regexp_matches({head}, '^[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}$') THEN try_cast(replace({head}, '/', '-') AS DATE) END"
    )


def mapped(x: str, values: dict[str, str], default: str) -> str:
    cases = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in values.items())
    return f"(CASE {x} {cases} ELSE {default} END)"


def place_text(x: str, marks: bool = False) -> str:
    """The name repairs, without the alias table. RE2 has no back-references, so each doubled mark has its
    own step; the feed has none, so its queries leave them out."""
    out = f"regexp_replace(trim({x}), '\\s+', ' ', 'g')"
    out = f"regexp_replace({out}, '^(เขต|ข\\.?)\\s*', '')"
    out = f"regexp_replace({out}, '\\s*(กรุงเทพมหานคร|กรุงเทพฯ|กทม\\.?)$', '')"
    out = f"replace({out}, 'เเ', 'แ')"
    for mark in MARKS if marks else []:
        out = f"regexp_replace({out}, '{chr(mark)}{chr(mark)}+', '{chr(mark)}', 'g')"
    return f"regexp_replace({out}, '\\s+', '', 'g')"


def place(x: str) -> str:
    return mapped(place_text(x), PLACE_ALIASES, place_text(x))


def key(x: str) -> str:
    return f"regexp_replace(lower(trim({x})), '[\\s_./-]+', '', 'g')"


def disease(x: str) -> str:
    return mapped(key(x), TYPE_ALIASES, f"trim({x})")


def sex(x: str) -> str:
    return mapped(key(x), ref.SEX_ALIASES, "'U'")


def band(x: str) -> str:
    steps = " ".join(
        f"WHEN floor({x}) >= {low}" + ("" if high is None else f" AND floor({x}) <= {high}") + f" THEN {k}"
        for k, _, low, high in ref.AGE_BANDS if low is not None
    )
    return f"CAST(CASE {steps} ELSE 10 END AS INTEGER)"


def in_scope(x: str) -> str:
    return f"({x} IN ({', '.join(map(text, PLACES))}))"


def incidence(cases: str, population: str) -> str:
    return f"CASE WHEN {population} > 0 THEN round(CAST({cases} AS DOUBLE) / {population} * 100000, 2) END"


def rate(cases: str, population: str, digits: int = 2) -> str:
    return f"CASE WHEN {population} > 0 THEN round(CAST({cases} AS DOUBLE) * 100000.0 / {population}, {digits}) END"


# -- orders as clean cases -------------------------------------------------------------------------

ORDER_CASES = f"""cases AS MATERIALIZED (
  SELECT CAST(o_orderkey AS VARCHAR) AS case_id, CAST(o_orderdate AS DATE) AS report_date,
         CAST(year(o_orderdate) + 543 AS INTEGER) AS year_be, n_name AS district_name, o_orderpriority AS disease_name,
         CAST(o_orderkey % 3 + 1 AS DOUBLE) AS case_count,
         CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'U' END AS sex, c_acctbal / 100 AS age,
         {band('(c_acctbal / 100)')} AS age_group_key
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

ORDER_POPULATION = """known_population AS (
  SELECT CAST(y + 543 AS INTEGER) AS year_be, n_name AS district_name,
         CAST(1000 * (n_nationkey + 1) + 37 * (y - 1990) AS DOUBLE) AS population
  FROM nation, (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS y FROM orders)
  WHERE NOT ((y % 3 = 0 AND n_nationkey % 11 = 5) OR y % 4 = 0))"""

FILLED = """population AS (
  SELECT year_be, district_name, population, FALSE AS filled FROM known_population
  UNION ALL
  SELECT m.year_be, p.district_name, p.population, TRUE
  FROM known_population p,
       (SELECT DISTINCT year_be FROM cases WHERE year_be NOT IN (SELECT year_be FROM known_population)) m
  WHERE p.year_be = (SELECT max(year_be) FROM known_population))"""

GOLD = f"""gold AS (
  SELECT c.year_be, c.district_name, c.disease_name, CAST(c.n AS BIGINT) AS total_cases,
         CAST(p.population AS BIGINT) AS population, {incidence('c.n', 'p.population')} AS incidence_rate_per_100k,
         c.records AS source_records
  FROM (SELECT year_be, district_name, disease_name, sum(case_count) AS n, count(DISTINCT case_id) AS records
        FROM cases GROUP BY ALL) c
  LEFT JOIN population p ON p.year_be = c.year_be AND p.district_name = c.district_name)"""

MONTH_LABEL = "CASE month(m) " + " ".join(
    f"WHEN {i} THEN '{label}'" for i, label in enumerate(ref.MONTH_LABELS, 1)) + " END || ' ' || CAST(year(m) + 543 AS VARCHAR)"

STAR = f"""dim_date AS (
  SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS date_key, CAST(m AS DATE) AS month_start,
         CAST(year(m) + 543 AS INTEGER) AS year_be, CAST(year(m) AS INTEGER) AS year_ce,
         CAST(quarter(m) AS INTEGER) AS quarter, CAST(month(m) AS INTEGER) AS month, {MONTH_LABEL} AS month_label
  FROM (SELECT unnest(generate_series(date_trunc('month', min(report_date)), date_trunc('month', max(report_date)),
                                      INTERVAL 1 MONTH)) AS m FROM cases)),
dim_district AS (
  SELECT CAST(dense_rank() OVER (ORDER BY district_name) AS INTEGER) AS district_key, district_name,
         {in_scope('district_name')} AS is_bangkok_district
  FROM (SELECT unnest([{', '.join(map(text, PLACES))}]) AS district_name
        UNION SELECT district_name FROM cases UNION SELECT district_name FROM population)),
dim_disease AS (
  SELECT CAST(dense_rank() OVER (ORDER BY disease_name) AS INTEGER) AS disease_key, disease_name
  FROM (SELECT DISTINCT disease_name FROM cases)),
dim_age_group AS (
  SELECT * FROM (VALUES {', '.join(
      f"({k}, {text(label)}, CAST({'NULL' if low is None else low} AS INTEGER), CAST({'NULL' if high is None else high} AS INTEGER))"
      for k, label, low, high in ref.AGE_BANDS)}) AS t(age_group_key, age_group, min_age, max_age)),
dim_sex AS (
  SELECT * FROM (VALUES {', '.join(f"({text(k)}, {text(v)})" for k, v in ref.SEX_LABELS.items())}) AS t(sex, sex_label)),
fact_disease_cases AS (
  SELECT CAST(year(report_date) * 100 + month(report_date) AS INTEGER) AS date_key, district_key, disease_key,
         age_group_key, sex, CAST(round(sum(case_count)) AS BIGINT) AS total_cases,
         count(DISTINCT case_id) AS source_records
  FROM cases JOIN dim_district USING (district_name) JOIN dim_disease USING (disease_name)
  GROUP BY ALL),
fact_population AS (
  SELECT year_be, district_key, CAST(round(population) AS BIGINT) AS population
  FROM population JOIN dim_district USING (district_name))"""

VIEWS = f"""vw_disease_overview AS (
  SELECT month_start, year_be, year_ce, quarter, month, month_label, district_name, disease_name, age_group_key,
         age_group, sex, sex_label, total_cases, source_records
  FROM fact_disease_cases JOIN dim_date USING (date_key) JOIN dim_district USING (district_key)
  JOIN dim_disease USING (disease_key) JOIN dim_age_group USING (age_group_key) JOIN dim_sex USING (sex)),
vw_monthly_trend AS (
  SELECT d.month_start, d.month_label, d.year_be, s.disease_name, CAST(coalesce(sum(f.total_cases), 0) AS BIGINT) AS total_cases
  FROM dim_date d CROSS JOIN dim_disease s
  LEFT JOIN fact_disease_cases f ON f.date_key = d.date_key AND f.disease_key = s.disease_key
  GROUP BY d.month_start, d.month_label, d.year_be, s.disease_name),
vw_year_period AS (
  SELECT year_be, count(*) AS months_covered,
         min(month_label) FILTER (WHERE month_start = lo) || ' – ' || min(month_label) FILTER (WHERE month_start = hi) AS period_label
  FROM (SELECT *, min(month_start) OVER (PARTITION BY year_be) AS lo, max(month_start) OVER (PARTITION BY year_be) AS hi
        FROM dim_date) GROUP BY year_be),
vw_year_disease AS (
  SELECT c.year_be, c.year_be - 543 AS year_ce, months_covered, period_label, disease_name, c.total_cases,
         c.source_records, p.population, coalesce(p.covered, 0) AS districts_with_population,
         CASE WHEN p.covered = (SELECT count(*) FROM dim_district WHERE is_bangkok_district)
              THEN {rate('c.total_cases', 'p.population')} END AS cumulative_incidence_per_100k
  FROM (SELECT year_be, disease_key, CAST(sum(total_cases) AS BIGINT) AS total_cases,
               CAST(sum(source_records) AS BIGINT) AS source_records
        FROM fact_disease_cases JOIN dim_date USING (date_key) GROUP BY ALL) c
  JOIN dim_disease USING (disease_key) JOIN vw_year_period USING (year_be)
  LEFT JOIN (SELECT year_be, CAST(sum(population) AS BIGINT) AS population,
                    count(*) FILTER (WHERE is_bangkok_district) AS covered
             FROM fact_population JOIN dim_district USING (district_key) GROUP BY year_be) p ON p.year_be = c.year_be),
vw_district_disease_year AS (
  SELECT year_be, months_covered, period_label, district_name, disease_name, total_cases, population,
         {rate('total_cases', 'population')} AS cumulative_incidence_per_100k
  FROM (SELECT year_be, district_key, disease_key, CAST(sum(total_cases) AS BIGINT) AS total_cases
        FROM fact_disease_cases JOIN dim_date USING (date_key) GROUP BY ALL)
  JOIN dim_district USING (district_key) JOIN dim_disease USING (disease_key) JOIN vw_year_period USING (year_be)
  LEFT JOIN fact_population USING (year_be, district_key)),
vw_district_ranking AS (
  SELECT year_be, district_name, CAST(sum(total_cases) AS BIGINT) AS total_cases,
         CAST(sum(source_records) AS BIGINT) AS source_records,
         CAST(rank() OVER (PARTITION BY year_be ORDER BY sum(total_cases) DESC) AS INTEGER) AS cases_rank
  FROM fact_disease_cases JOIN dim_date USING (date_key) JOIN dim_district USING (district_key)
  GROUP BY year_be, district_name),
vw_demographics AS (
  SELECT year_be, disease_name, age_group_key, age_group, sex_label, CAST(sum(total_cases) AS BIGINT) AS total_cases,
         round(100.0::DOUBLE * sum(total_cases) / sum(sum(total_cases)) OVER (PARTITION BY year_be, disease_name), 2) AS share_pct
  FROM fact_disease_cases JOIN dim_date USING (date_key) JOIN dim_disease USING (disease_key)
  JOIN dim_age_group USING (age_group_key) JOIN dim_sex USING (sex)
  GROUP BY year_be, disease_name, age_group_key, age_group, sex_label)"""

# -- line items as untidy raw records --------------------------------------------------------------

FEED = """feed AS (
  SELECT
    CASE WHEN l_linenumber = 7 AND l_suppkey % 5 = 0 THEN '  ' ELSE l_orderkey || '-' || l_linenumber END AS id,
    CASE WHEN l_linenumber = 6 AND l_suppkey % 10 = 3 THEN '31/02/2024'
         WHEN l_linenumber = 6 AND l_suppkey % 10 = 4 THEN NULL
         WHEN l_orderkey % 6 = 0 THEN day(d) || '/' || month(d) || '/' || (year(d) + 543)
         WHEN l_orderkey % 6 = 1 THEN strftime(d, '%d-%m-%Y')
         WHEN l_orderkey % 6 = 2 THEN strftime(d, '%Y-%m-%d')
         WHEN l_orderkey % 6 = 3 THEN strftime(d, '%Y/%m/%d')
         WHEN l_orderkey % 6 = 4 THEN strftime(d, '%Y-%m-%d') || ' 08:30:00'
         ELSE ' ' || day(d) || '/' || month(d) || '/' || year(d) || ' ' END AS onset,
    CASE WHEN l_suppkey % 40 = 39 THEN '1800'
         WHEN l_partkey % 4 = 1 THEN CAST(year(d) AS VARCHAR)
         WHEN l_partkey % 4 = 2 THEN CAST(year(d) + 543 AS VARCHAR)
         WHEN l_partkey % 4 = 3 THEN substr(CAST(year(d) + 543 AS VARCHAR), 1, 1) || ',' || substr(CAST(year(d) + 543 AS VARCHAR), 2, 3)
    END AS stated_year,
    CASE WHEN l_linenumber = 5 AND l_suppkey % 20 = 11 THEN NULL
         WHEN l_orderkey % 4 = 0 THEN p_type WHEN l_orderkey % 4 = 1 THEN lower(p_type)
         WHEN l_orderkey % 4 = 2 THEN substr(p_type, 1, 2) || '-' || substr(p_type, 3)
         ELSE ' ' || p_type || ' ' END AS disease,
    CASE WHEN l_linenumber = 4 AND l_suppkey % 20 = 12 THEN NULL
         WHEN l_suppkey % 50 = 7 THEN 'เมือง' || n_name
         WHEN l_partkey % 6 = 0 THEN n_name WHEN l_partkey % 6 = 1 THEN 'เขต' || n_name
         WHEN l_partkey % 6 = 2 THEN 'ข. ' || n_name WHEN l_partkey % 6 = 3 THEN n_name || ' กทม.'
         WHEN l_partkey % 6 = 4 THEN '  ' || replace(n_name, '_', ' _ ') || ' '
         ELSE 'N' || n_nationkey END AS district,
    CASE WHEN l_linenumber = 1 THEN '?' WHEN l_returnflag = 'A' THEN 'M' WHEN l_returnflag = 'N' THEN 'Female'
         WHEN l_linestatus = 'O' THEN 'ชาย' ELSE '2' END AS sex,
    CASE WHEN l_linenumber = 3 AND l_suppkey % 10 = 6 THEN ' 1,0' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0')
         WHEN l_suppkey % 25 = 8 THEN '-5' WHEN l_linenumber = 2 AND l_suppkey % 4 = 1 THEN NULL
         WHEN l_linenumber = 7 THEN 'abc'
         WHEN l_linenumber = 5 THEN CAST(l_quantity AS INTEGER) || '.5'
         ELSE CAST(l_quantity AS INTEGER) || ' ' END AS age,
    CASE WHEN l_suppkey % 30 = 13 THEN 'x' WHEN l_suppkey % 30 = 14 THEN '0' WHEN l_suppkey % 100 = 99 THEN '1,000'
         WHEN l_orderkey % 5 = 0 THEN '2' ELSE '1' END AS cases,
    'lake/raw/disease/disease_cases_' || (year(d) + 543 + CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END) || '_full.csv' AS source_file
  FROM (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem)
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

CANONICAL = f"""typed AS (
  SELECT id AS case_id, {date('onset')} AS report_date, {year_be('stated_year')} AS explicit_year,
         trim(disease) AS disease_name_raw, trim(district) AS district_name_raw, {numeric('cases')} AS case_count,
         trim(sex) AS sex, {numeric('age')} AS age, source_file
  FROM feed),
canonical AS (
  SELECT case_id, report_date,
         CAST(coalesce(explicit_year, try_cast(regexp_extract(source_file, 'disease_cases_([0-9]{{4}})', 1) AS INTEGER),
                       year(report_date) + 543) AS INTEGER) AS year_be,
         disease_name_raw, district_name_raw, case_count, sex, age, source_file
  FROM typed)"""

TAGGED = f"""tagged AS MATERIALIZED (
  SELECT *, CASE
    WHEN year_be IS NULL OR year_be NOT BETWEEN 2400 AND 2700 THEN 'invalid_year'
    WHEN coalesce(trim(disease_name_raw), '') = '' THEN 'missing_disease_name'
    WHEN coalesce(trim(district_name_raw), '') = '' THEN 'missing_district_name'
    WHEN NOT {in_scope(place('district_name_raw'))} THEN 'district_not_in_bangkok'
    WHEN case_count IS NULL OR case_count <= 0 THEN 'invalid_case_count'
    WHEN age IS NOT NULL AND age NOT BETWEEN 0 AND 120 THEN 'invalid_age'
    WHEN report_date IS NULL THEN 'invalid_or_missing_report_date' END AS _quarantine_reason
  FROM canonical)"""

BUSINESS = ("year_be", "report_date", "disease_name_raw", "district_name_raw", "case_count", "sex", "age", "source_file")
SURROGATE = "sha256(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in BUSINESS) + "))"

IDENTIFIED = f"""identified AS (
  SELECT * EXCLUDE (_quarantine_reason) REPLACE (
    CASE WHEN coalesce(trim(case_id), '') = '' THEN {SURROGATE}
         ELSE CAST(year_be AS VARCHAR) || ':' || trim(case_id) END AS case_id)
  FROM tagged WHERE _quarantine_reason IS NULL)"""

LATEST_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "report_date", "source_file", "year_be", "disease_name_raw", "district_name_raw", "case_count", "sex", "age"))

DEDUPLICATED = f"""deduplicated AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY {LATEST_ORDER}) AS rn FROM identified)
  WHERE rn = 1)"""

STANDARDIZED = f"""cases AS MATERIALIZED (
  SELECT case_id, report_date, year_be, disease_name_raw, district_name_raw, case_count, {sex('sex')} AS sex, age,
         source_file, {place('district_name_raw')} AS district_name, {disease('disease_name_raw')} AS disease_name,
         {band('age')} AS age_group_key
  FROM deduplicated)"""

FEED_POPULATION = f"""raw_population AS (
  SELECT CAST(y + CASE WHEN y % 2 = 0 THEN 543 ELSE 0 END AS VARCHAR) AS year,
         CASE WHEN n_nationkey = 19 THEN 'รวม' WHEN n_nationkey % 2 = 0 THEN 'เขต' || n_name ELSE n_name END AS district,
         CASE WHEN (n_nationkey + y) % 13 = 0 THEN '0'
              WHEN n_nationkey % 3 = 0 THEN substr(CAST(people AS VARCHAR), 1, 1) || ',' || substr(CAST(people AS VARCHAR), 2)
              ELSE CAST(people AS VARCHAR) END AS people
  FROM (SELECT *, 1000 * (n_nationkey + 1) + 37 * (y - 1990) + CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 500 * (copy - 1) END AS people
        FROM (SELECT n_nationkey, n_name, y, unnest(generate_series(1, CASE WHEN n_nationkey % 5 = 0 OR n_nationkey % 7 = 3 THEN 2 ELSE 1 END)) AS copy
              FROM nation, (SELECT unnest(generate_series(min(year(l_shipdate)), max(year(l_shipdate)))) AS y FROM lineitem)
              WHERE y % 4 <> 0))),
known_population AS (
  SELECT year_be, district_name, sum(population) AS population
  FROM (SELECT DISTINCT {year_be('year')} AS year_be, {place('district')} AS district_name, {numeric('people')} AS population
        FROM raw_population)
  WHERE year_be BETWEEN 2400 AND 2700 AND district_name <> '' AND population > 0
    AND NOT regexp_matches(district_name, '^(รวม|ทั้งหมด|total)')
  GROUP BY ALL)"""


def reasons() -> list[str]:
    """The reasons that `TAGGED` gives."""
    return ["district_not_in_bangkok", "invalid_age", "invalid_case_count", "invalid_or_missing_report_date", "invalid_year", "missing_disease_name",
            "missing_district_name"]


def quality() -> str:
    """The report as CTEs `metrics` and `report`."""
    reason_metrics = ", ".join(
        f"(SELECT count(*) FROM tagged WHERE _quarantine_reason = '{r}') AS reason_{r}" for r in reasons())
    exact = "total_cases / CAST(population AS DOUBLE) * 100000"
    rows = [
        ("raw", "raw_rows_not_empty", "raw_rows", "'> 0'", "raw_rows > 0"),
        ("clean", "clean_rows_not_empty", "clean_rows", "'> 0'", "clean_rows > 0"),
        ("clean", "clean_retention_rate", "printf('%.4f', clean_rows / CAST(raw_rows AS DOUBLE))", "'>= 0.5'",
         "clean_rows / CAST(raw_rows AS DOUBLE) >= 0.5"),
        ("clean", "duplicate_rows_removed", "removed", None, None),
        ("standardized", "standardized_rows_not_empty", "standardized_rows", "'> 0'", "standardized_rows > 0"),
        ("standardized", "district_in_bangkok_master", "outside_master", "'= 0'", "outside_master = 0"),
        ("gold", "curated_rows_not_empty", "gold_rows", "'> 0'", "gold_rows > 0"),
        ("gold", "missing_population_rate", "printf('%.4f', uncovered / CAST(gold_rows AS DOUBLE))", "'<= 0.0500'",
         "uncovered / CAST(gold_rows AS DOUBLE) <= 0.05"),
        ("gold", "population_coverage_rate", "printf('%.4f', covered / CAST(gold_rows AS DOUBLE))", None, None),
        ("gold", "population_uncovered_rows", "uncovered", None, None),
        ("gold", "population_uncovered_rate", "printf('%.4f', uncovered / CAST(gold_rows AS DOUBLE))", None, None),
        ("gold", "population_coverage_accounting", "covered + uncovered - gold_rows", "'= 0'", "covered + uncovered = gold_rows"),
        ("gold", "non_positive_total_case_rows", "non_positive", "'= 0'", "non_positive = 0"),
        ("gold", "primary_key_unique", "gold_duplicates", "'= 0'", "gold_duplicates = 0"),
        ("gold", "incidence_rate_unavailable_rows", "without_rate", None, None),
        ("gold", "incidence_unavailable_matches_uncovered", "without_rate - uncovered", "'= 0'", "without_rate = uncovered"),
        ("gold", "incidence_formula_mismatch_rows", "off_formula", "'= 0'", "off_formula = 0"),
        ("dq", "required_schema_columns", "'complete'", "'complete'", "TRUE"),
        ("dq", "missing_report_date_rows", "missing_dates", None, None),
        ("dq", "invalid_age_rows_after_clean", "invalid_ages", "'= 0'", "invalid_ages = 0"),
        ("clean", "quarantined_rows", "quarantined", None, None),
        ("clean", "year_be_vs_report_date_mismatch_rows", "mismatches", None, None),
        ("raw", "identical_source_rows_kept", "identical", None, None),
        ("gold", "population_years_filled_from_latest", "coalesce(filled_years, 'none')", None, None),
        ("warehouse", "fact_cases_reconcile_with_standardized", "fact_cases - standardized_cases", "'= 0'", "fact_cases = standardized_cases"),
        ("warehouse", "fact_primary_key_unique", "fact_duplicates", "'= 0'", "fact_duplicates = 0"),
        ("warehouse", "fact_date_key_in_dim_date", "unmatched", "'= 0'", "unmatched = 0"),
        *[("clean", f"quarantined_{r}", f"nullif(reason_{r}, 0)", None, None) for r in reasons()],
    ]
    union = "\n  UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{rule}' AS rule, CAST({value} AS VARCHAR) AS observed, "
        f"{threshold or chr(39) + 'informational' + chr(39)} AS threshold, "
        f"{'CASE WHEN ' + ok + ' THEN ' + repr('PASS') + ' ELSE ' + repr('FAIL') + ' END' if ok else repr('PASS')} AS status FROM metrics"
        for layer, rule, value, threshold, ok in rows)
    return f"""metrics AS (SELECT
  (SELECT count(*) FROM feed) AS raw_rows,
  (SELECT count(*) FROM feed) - (SELECT count(*) FROM (SELECT DISTINCT onset, stated_year, disease, district, sex, age, cases FROM feed)) AS identical,
  (SELECT count(*) FROM tagged WHERE _quarantine_reason IS NULL) AS clean_rows,
  (SELECT count(*) FROM tagged WHERE _quarantine_reason IS NOT NULL) AS quarantined,
  (SELECT count(*) FROM tagged WHERE report_date IS NULL) AS missing_dates,
  (SELECT count(*) FROM tagged WHERE _quarantine_reason IS NULL AND age NOT BETWEEN 0 AND 120) AS invalid_ages,
  (SELECT count(*) FROM tagged WHERE _quarantine_reason IS NULL AND year_be <> year(report_date) + 543) AS mismatches,
  (SELECT count(*) - count(DISTINCT case_id) FROM identified) AS removed,
  (SELECT count(*) FROM cases) AS standardized_rows,
  (SELECT count(*) FROM cases WHERE NOT {in_scope('district_name')}) AS outside_master,
  (SELECT CAST(round(sum(case_count)) AS BIGINT) FROM cases) AS standardized_cases,
  (SELECT count(*) FROM gold) AS gold_rows,
  (SELECT count(*) FROM gold WHERE population > 0) AS covered,
  (SELECT count(*) FROM gold WHERE population IS NULL OR population <= 0) AS uncovered,
  (SELECT count(*) FROM gold WHERE total_cases <= 0) AS non_positive,
  (SELECT count(*) FROM (SELECT 1 FROM gold GROUP BY year_be, district_name, disease_name HAVING count(*) > 1)) AS gold_duplicates,
  (SELECT count(*) FROM gold WHERE incidence_rate_per_100k IS NULL) AS without_rate,
  (SELECT count(*) FROM gold WHERE population > 0 AND (incidence_rate_per_100k IS NULL OR abs(incidence_rate_per_100k - {exact}) > 0.01)) AS off_formula,
  (SELECT CAST(sum(total_cases) AS BIGINT) FROM fact_disease_cases) AS fact_cases,
  (SELECT count(*) FROM (SELECT 1 FROM fact_disease_cases GROUP BY date_key, district_key, disease_key, age_group_key, sex HAVING count(*) > 1)) AS fact_duplicates,
  (SELECT count(*) FROM fact_disease_cases WHERE date_key NOT IN (SELECT date_key FROM dim_date)) AS unmatched,
  (SELECT string_agg(CAST(year_be AS VARCHAR), ', ' ORDER BY year_be) FROM (SELECT DISTINCT year_be FROM population WHERE filled)) AS filled_years,
  {reason_metrics}),
report AS (SELECT * FROM (
  {union}) WHERE observed IS NOT NULL)"""


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def over_orders(select: str, *extra: str) -> str:
    return query(ORDER_CASES, ORDER_POPULATION, FILLED, STAR, VIEWS, *extra, select=select)


#: The layers of orders under the names that the report uses.
ORDER_LAYERS = """feed AS (SELECT case_id AS onset, report_date AS stated_year, disease_name AS disease, district_name AS district, sex, age, case_count AS cases FROM cases),
tagged AS (SELECT *, CAST(NULL AS VARCHAR) AS _quarantine_reason FROM cases),
identified AS (SELECT * FROM cases)"""


def over_feed(select: str, *extra: str) -> str:
    return query(FEED, CANONICAL, TAGGED, IDENTIFIED, DEDUPLICATED, STANDARDIZED, FEED_POPULATION, FILLED, GOLD, STAR,
                 *extra, select=select)
