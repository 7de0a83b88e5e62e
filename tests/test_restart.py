"""Publishers side by side, runs that go on where another one ended, and reports over any set of reasons."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from casemart import CaseDomain, Layout, Settings
from casemart.operators.cases import canonical_cases
from casemart.operators.denominators import yearly_reference
from casemart.operators.quality import case_metrics
from casemart.operators.ranking import positioned
from casemart.operators.rules import Rule, case_rules, tag
from casemart.plans.progress import Progress, fingerprint
from casemart.plans.run import Input, run_layers
from casemart.sinks import publish
from casemart.sinks.small_files import create_exclusively, read_text, remove, write_text
from casemart.sources.paths import list_files


def test_publishers_side_by_side_get_different_numbers(spark, tmp_path):
    root = str(tmp_path / "mart")
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda n: publish.append_audit(spark, root, f"run{n}", "test", {"t": n}), range(8)))
    assert sorted(taken) == list(range(1, 9))
    audit = {r.load_id: (r.run_id, r.row_counts) for r in publish.read_audit(spark, root).collect()}
    assert audit == {number: (f"run{n}", {"t": n}) for n, number in enumerate(taken)}


def test_the_loser_of_a_number_takes_the_next(spark, tmp_path, monkeypatch):
    root, listed = str(tmp_path / "mart"), publish.last_load
    assert publish.append_audit(spark, root, "a", "test", {}) == 1
    stale = iter([0, 0])  # listings from before the other writer's commit
    monkeypatch.setattr(publish, "last_load", lambda s, r: next(stale, listed(s, r)))
    assert publish.append_audit(spark, root, "b", "test", {}) == 2
    assert publish.read_audit(spark, root).agg(F.max_by("run_id", "load_id")).first()[0] == "b"


def test_a_commit_that_was_never_filled_is_no_load(spark, tmp_path):
    root = str(tmp_path / "mart")
    publish.append_audit(spark, root, "a", "test", {"t": 1})
    assert create_exclusively(spark, publish.commit_path(root, 2), "")
    assert [r.load_id for r in publish.read_audit(spark, root).collect()] == [1]
    assert publish.append_audit(spark, root, "c", "test", {}) == 3
    assert sorted(r.load_id for r in publish.read_audit(spark, root).collect()) == [1, 3]


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "sub" / "note.txt")
    assert read_text(spark, path) is None
    assert create_exclusively(spark, path, "one") and not create_exclusively(spark, path, "two") and read_text(spark, path) == "one"
    write_text(spark, path, "three")
    assert read_text(spark, path) == "three"
    remove(spark, path)
    assert read_text(spark, path) is None


def test_steps_are_made_again_only_when_something_changed(spark, tmp_path):
    calls = []

    def go(basis="a", digest="x"):
        calls.clear()
        run = Progress(spark, Layout(str(tmp_path)), basis)
        run.start("input", digest)
        first = run.layer("first", ("input",), lambda: calls.append("first") or spark.range(5))
        second = run.layer("second", ("first",), lambda: calls.append("second") or first.where("id > 1"))
        run.output("out", ("second",), lambda: calls.append("out"))
        assert second.columns == ["id"] and second.count() == 3
        return list(calls), [(name, rows) for name, rows, _ in run.made]

    assert go() == (["first", "second", "out"], [("first", 5), ("second", 3), ("out", None)])
    assert go() == ([], [("first", 5), ("second", 3), ("out", None)])
    assert go(digest="y")[0] == ["first", "second", "out"] and go(basis="b")[0] == ["first", "second", "out"]
    remove(spark, f"{tmp_path}/processed/_manifests/second.json")  # as if the driver was lost while it wrote
    assert go(basis="b")[0] == ["second"]


def test_a_changed_file_has_another_fingerprint(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("1")
    before = fingerprint(list_files(spark, str(tmp_path)))
    assert fingerprint(list_files(spark, str(tmp_path))) == before
    path.write_text("12")
    assert fingerprint(list_files(spark, str(tmp_path))) != before


def cases(spark):
    rows = [("1", "1/2/2568", "flu", "เขตสาทร", "M", "30"), ("2", "3/2/2568", "flu", "เขตสาทร", "F", "31"), ("3", "3/2/2568", "flu", "เมืองระยอง", "F", "31")]
    return spark.createDataFrame([(*r, "disease_cases_2568_full.csv") for r in rows], "_id string, `วันที่เริ่มป่วย` string, `ชื่อกลุ่มโรค` string, `อำเภอ/เขต` string, `เพศ` string, `อายุ (เต็ม) ปี` string, _source_file string")


def test_the_gate_holds_a_failed_run_back(spark, tmp_path):
    layout, data = Layout(str(tmp_path)), cases(spark)
    held = run_layers(spark, layout, Input("1", lambda: data), None, Settings(min_retention_rate=0.9))
    assert held.failed and not held.row_counts and publish.read_audit(spark, layout.mart).count() == 0
    opened = run_layers(spark, layout, Input("1", lambda: data), None, Settings(min_retention_rate=0.9), publish_failed=True)
    assert opened.failed and opened.row_counts["fact_disease_cases"] == 2 and all(reused for *_, reused in opened.layers)
    passed = run_layers(spark, layout, Input("1", lambda: data), None, Settings(min_retention_rate=0.5))
    assert not passed.failed and not any(reused for *_, reused in passed.layers)
    assert [r.load_id for r in publish.read_audit(spark, layout.mart).orderBy("load_id").collect()] == [1, 2]


def test_an_eighth_reason_is_counted(spark):
    rules = [*case_rules(Settings(), CaseDomain()), Rule("thirty_one", F.col("age") == 31)]
    tagged = tag(canonical_cases(cases(spark), CaseDomain()), rules)
    found = case_metrics(tagged, Settings()).first()
    assert [tuple(r) for r in found.reasons] == [("district_not_in_bangkok", 1), ("thirty_one", 1)] and (found.clean_rows, found.quarantined_rows) == (1, 2)
    none = case_metrics(tagged.limit(0), Settings()).first()
    assert (none.reasons, none.clean_rows, none.quarantined_rows, none.missing_dates) == ([], 0, 0, 0)


def test_a_file_of_another_year_is_no_reference(spark):
    def file(*years):
        return spark.createDataFrame([(y, f"เขต{n}", "1,000") for n, y in enumerate(years)], "`ปี` string, `เขต` string, `ประชากร` string")

    assert yearly_reference(file("2564", "2564"), 2564).count() == 2
    assert yearly_reference(file(None, None), 2564).count() == 0  # no year stated anywhere
    for years, said in ((("2564", "2561", "2561"), "2561 \\(2 rows\\)"), (("2564", None), "none \\(1 rows\\)")):
        with pytest.raises(Exception, match=f"expected the year 2564, found {said}"):
            yearly_reference(file(*years), 2564).collect()


def test_positions_follow_the_order(spark, tmp_path):
    data = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), F.col("id").cast("string").alias("_x.y")).repartition(7)
    out = positioned(data, [F.col("k").desc()], str(tmp_path / "p"))
    assert out.columns == ["k", "_x.y", "position"]
    assert [r.k for r in out.orderBy("position").collect()] == sorted((r.k for r in data.collect()), reverse=True)
    assert [r.position for r in out.orderBy("position").collect()] == list(range(1, 3001))
    assert positioned(data.limit(0), ["k"], str(tmp_path / "q")).count() == 0
