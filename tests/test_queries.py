import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tools.check_queries import TABLES, compare  # noqa: E402

DATA = "/root/testdata/sf0.001"
FAST = (
    "gold_incidence", "fn_month", "fn_standardize_name", "fn_age_band", "quarantine_reasons", "dedup_latest",
    "record_identity", "population_clean", "population_contract", "ck_primary_key", "ck_foreign_key",
    "vw_monthly_trend", "vw_year_disease", "demo_top10", "me_mom", "me_district_rank", "rp_share_matrix",
    "raw_versions", "raw_landing_status", "raw_profile", "raw_contract_csv", "src_csv", "json_snapshot", "json_document",
    "raw_contract_csv_faults", "raw_contract_json_files", "src_mixed_files", "src_population_scan", "run_resumed", "ck_star_broken", "so_gold_positions",
)
PLANNED = ("vw_monthly_trend", "vw_year_disease", "population_fill_years", "dedup_items", "me_case_share", "demo_age_sex")

pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    own = {name for name in entry.queries() if name != "pipeline" and not re.match(r"op\d", name)}
    assert own <= set(entry.oracle_sql())


def test_the_flagship_query_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", FAST)
def test_query_equals_its_sql(spark, db, name):
    verdict, *_ = compare(spark, db, name, entry.queries()[name], entry.oracle_sql()[name], DATA)
    assert verdict == "ok"


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_cross_product(spark, name):
    plan = entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_deduplication_limits_each_key_before_the_shuffle(spark):
    plan = entry.queries()["dedup_items"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning") < partial


def test_only_needed_columns_are_read(spark):
    plan = entry.queries()["demo_audit"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>", plan)
