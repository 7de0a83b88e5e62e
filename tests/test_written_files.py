"""Files that queries write before they read them."""

import pytest

from workload import run_queries


@pytest.fixture
def late_broadcast(spark):
    """Joins are planned as sort-merge joins and turned into broadcast joins while they run, as on large tables with few files."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "64KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_sheet_is_one_file_whatever_join_runs(spark, tmp_path, late_broadcast):
    events = spark.range(0, 40_000, numPartitions=24).selectExpr("id AS event_id", "concat('type', id % 3) AS event_type")
    events.write.parquet(f"{tmp_path}/events.parquet")
    paths = run_queries.write_lines(run_queries.event_lines(spark, str(tmp_path)).where("kind = 0"), f"{tmp_path}/sheets")
    assert len(paths) == 3
    found = run_queries.json_records(spark, str(tmp_path))
    assert sorted(int(row.k) for row in found.collect()) == list(range(0, 40_000, 5))
