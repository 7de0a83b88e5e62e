"""What readers send between tasks."""

import re

from pyspark.sql import functions as F

from casemart.operators.identity import record_identity
from casemart.sources.records import csv_records


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_records_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,t\n1,"x\ny"\n2,z\n\n', encoding="utf-8")
    records = csv_records(spark, [str(tmp_path / "a.csv")])
    assert "Exchange hashpartitioning" not in plan(records) and "SortMergeJoin" not in plan(records)
    assert [tuple(r)[1:3] for r in records.orderBy("line").collect()] == [(1, "k,t"), (2, '1,"x\ny"'), (4, "2,z"), (5, "")]


def test_fingerprints_are_made_after_the_shuffle_and_copies_are_numbered(spark):
    copies = {"a": 1, "b": 3, "c": 16, "d": 17, "e": 41}
    rows = spark.createDataFrame([(name, "f") for name, n in copies.items() for _ in range(n)], "k string, file string")
    found = record_identity(rows, ["k"], "file", block=7)
    assert not re.search(r"Exchange hashpartitioning\([^)]*_print", plan(found))
    assert found.columns == ["k", "file", "_print", "_occurrence", "_record_id"]
    numbers = {r.k: r.n for r in found.groupBy("k").agg(F.sort_array(F.collect_list("_occurrence")).alias("n")).collect()}
    assert numbers == {name: list(range(1, n + 1)) for name, n in copies.items()}
    assert found.select("_record_id").distinct().count() == sum(copies.values())
