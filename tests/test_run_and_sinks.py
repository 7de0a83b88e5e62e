import json

import pytest
from pyspark.sql import functions as F

from casemart import Layout, Settings
from casemart.operators.denominators import no_population
from casemart.plans import measures, reports, run, statements, views
from casemart.reference_values import CASE_CSV_FIELDS, DISTRICTS
from casemart.sinks import files, publish, snapshot
from casemart.sources.paths import SourceNotFound

DISEASES = ["Dengue Fever", "flu", "โควิด-19 (COVID-19)"]


def case_line(i, year, district=None):
    cells = dict.fromkeys(CASE_CSV_FIELDS, "x")
    cells.update({
        "ชื่อกลุ่มโรค": DISEASES[i % 3], "อายุ (เต็ม) ปี": str(i % 90), "เพศ": ["ชาย", "หญิง", "?"][i % 3],
        "อำเภอ/เขต": district or f"เขต{DISTRICTS[i % 7]}", "วันที่เริ่มป่วย": f"{i % 27 + 1}/{i % 12 + 1}/{year}"})
    return ",".join(cells.values())


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for year in (2568, 2569):
        folder = root / "raw" / "disease" / f"year={year}"
        folder.mkdir(parents=True)
        lines = [case_line(i, year) for i in range(400)] + [case_line(1, year), case_line(5, year, "เมืองระยอง")]
        (folder / f"disease_cases_{year}_full.csv").write_text(
            "\r\n".join([",".join(CASE_CSV_FIELDS), *lines]) + "\r\n", encoding="utf-8-sig")
    folder = root / "raw" / "population" / "year=2568"
    folder.mkdir(parents=True)
    body = "ปี,เขต,ประชากรรวม\n" + "".join(f"2568,{n},{1000 + i}\n" for i, n in enumerate(DISTRICTS))
    (folder / "population_summary_2568.csv").write_text(body, encoding="utf-8-sig")
    return root


@pytest.fixture(scope="module")
def published(spark, lake):
    result = run.run_batch(spark, Layout(str(lake)))
    star, quality = publish.current_mart(spark, Layout(str(lake)).mart)
    return result, star, quality


def test_run_publishes_a_reconciled_mart(spark, lake, published):
    result, star, quality = published
    assert not result.failed
    rules = {r.rule: r.observed for r in quality.collect()}
    assert rules["raw_rows_not_empty"] == "804" and rules["quarantined_rows"] == "2"
    assert rules["quarantined_district_not_in_bangkok"] == "2"
    assert rules["identical_source_rows_kept"] == "2" and rules["duplicate_rows_removed"] == "0"
    assert rules["population_years_filled_from_latest"] == "2569"
    assert star.fact_disease_cases.agg(F.sum("total_cases")).first()[0] == 802
    assert statements.reconciliation(star, quality).first().verdict == "ตรงกัน"
    assert (lake / "processed" / "gold_csv").is_dir() and (lake / "processed" / "quality_errors.csv").is_file()
    counts = {r.table_name: r.rows for r in statements.mart_counts(star, quality).collect()}
    assert counts == result.row_counts


def test_a_second_run_gives_the_same_mart(spark, lake, published, rows):
    _, star, _ = published
    again = run.run_batch(spark, Layout(str(lake)))
    newer, _ = publish.current_mart(spark, Layout(str(lake)).mart)
    for name, table in star.tables().items():
        assert rows(table) == rows(newer.tables()[name]), name
    history = statements.load_history(publish.read_audit(spark, Layout(str(lake)).mart)).collect()
    assert [r.load_id for r in history] == [2, 1]
    assert history[0].fact_rows == again.row_counts["fact_disease_cases"]


def test_a_broken_mart_leaves_the_published_one(spark, lake, published):
    _, star, quality = published
    mart = Layout(str(lake)).mart
    before = publish.read_audit(spark, mart).count()
    doubled = publish.Star.of({**star.tables(), "dim_disease": star.dim_disease.unionByName(star.dim_disease)})
    with pytest.raises(publish.PublishError, match="dim_disease UNIQUE"):
        publish.publish(doubled, quality, mart, "test")
    assert publish.read_audit(spark, mart).count() == before


def test_population_may_be_required(spark, lake, tmp_path):
    cases_only = tmp_path / "raw"
    cases_only.mkdir()
    (cases_only / "disease").symlink_to(lake / "raw" / "disease")
    with pytest.raises(SourceNotFound):
        run.run_batch(spark, Layout(str(tmp_path)))
    result = run.run_batch(spark, Layout(str(tmp_path)), require_population=False)
    star, quality = publish.current_mart(spark, Layout(str(tmp_path)).mart)
    assert not result.failed and result.row_counts["fact_population"] == 0
    assert quality.where("status = 'SKIP'").count() == 1
    assert views.year_disease(star).where("cumulative_incidence_per_100k is not null").count() == 0


def test_rates_need_every_district(spark, published):
    _, star, _ = published
    assert views.year_disease(star).where("cumulative_incidence_per_100k is null").count() == 0
    gap = publish.Star.of({**star.tables(), "fact_population": star.fact_population.where("district_key > 1")})
    out = views.year_disease(gap).collect()
    assert all(r.cumulative_incidence_per_100k is None and r.districts_with_population == 49 for r in out)


def test_trend_is_zero_filled(published):
    _, star, _ = published
    trend = views.monthly_trend(star)
    assert trend.count() == star.dim_date.count() * 3
    assert trend.agg(F.sum("total_cases")).first()[0] == 802


def test_measures_read_their_context(published):
    _, star, quality = published
    mart = measures.Mart(star, quality)
    one = lambda name, filters=None: mart.measure(name, filters).first()[0]
    year = {"year_be": [2568]}
    assert one("total_cases") == 802 and one("total_cases", year) == 401 and one("source_records") == 802
    whole = sum(1000 + i for i in range(50))
    assert one("population", year) == whole
    assert one("population") == 2 * whole
    assert one("population", {**year, "disease_name": ["ไข้เลือดออก"], "sex": ["M"]}) == whole
    assert one("incidence_per_100k", year) == pytest.approx(401 * 100_000 / whole)
    assert one("incidence_per_100k", {**year, "sex": ["M"]}) is None
    assert one("population_coverage", year) == 1.0 and one("coverage_status", year) == "ครบถ้วน"
    assert one("failed_rules") == 0
    shares = mart.measure("case_share", year, ["sex"]).collect()
    assert sum(r.case_share for r in shares) == pytest.approx(1.0)
    march = {"date_key": [202503]}
    feb, mar = one("total_cases", {"date_key": [202502]}), one("total_cases", march)
    assert one("cases_previous_month", march) == feb
    assert one("mom_change", march) == pytest.approx((mar - feb) / feb)
    assert one("cases_same_month_last_year", march) is None and one("yoy_change", march) is None
    by_month = {r.date_key: r.yoy_change for r in mart.measure("yoy_change", None, ["date_key"]).collect()}
    assert by_month[202503] is None and by_month[202603] == 0.0
    with pytest.raises(KeyError):
        mart.measure("nothing")


def test_coverage_status_has_every_group(spark, published):
    _, star, quality = published
    years = star.dim_date.select("year_be").distinct().count()
    gap = publish.Star.of({**star.tables(), "fact_population": star.fact_population.where("year_be = 2568")})
    out = {r.year_be: r.coverage_status for r in measures.Mart(gap, quality).measure("coverage_status", None, ["year_be"]).collect()}
    assert len(out) == years > 1 and [y for y, text in out.items() if text == "ครบถ้วน"] == [2568]
    none = measures.Mart(publish.Star.of({**star.tables(), "fact_population": star.fact_population.limit(0)}), quality)
    assert none.measure("coverage_status", None, ["year_be"]).where("coverage_status <> 'ครบถ้วน'").count() == years
    assert none.measure("coverage_status", None, ["year_be", "district_name"]).count() == years * star.dim_district.count()
    assert none.measure("coverage_status").first()[0] != "ครบถ้วน"


def test_ranks_include_places_without_cases(published):
    _, star, quality = published
    mart = measures.Mart(star, quality)
    ranks = mart.measure("district_rank", {"year_be": [2568]}, ["district_name"]).collect()
    assert len(ranks) == 50 and min(r.district_rank for r in ranks) == 1
    table = reports.district_table(mart, {"year_be": [2568]})
    assert table.count() == 50 and table.where("total_cases is null").count() == 43
    matrix = reports.age_sex_share_matrix(mart)
    assert matrix.columns == ["age_group_key", "age_group", "share_f", "share_m", "share_u"]
    cards = reports.overview_cards(mart, {"year_be": [2568]}).first()
    assert (cards.total_cases, cards.coverage_status) == (401, "ครบถ้วน")


def test_snapshot_sections_add_up(published, tmp_path):
    _, star, quality = published
    parts = snapshot.snapshot(star, quality).collect()
    records = {}
    for part in parts:
        parsed = json.loads(part.payload)
        assert len(parsed) == part.records
        records.setdefault(part.section, []).extend(parsed)
    assert len(records["fact"]) == star.fact_disease_cases.count()
    assert sum(r[5] for r in records["fact"]) == 802
    assert records["dim_sex"][0] == {"k": "F", "label": "หญิง"}
    assert {r["y"] for r in records["period"]} == {2568, 2569}
    assert len(records["dim_district"]) == 50 and len(records["population"]) == 100
    snapshot.write_snapshot(star, quality, str(tmp_path / "snapshot"))
    assert (tmp_path / "snapshot" / "section=fact").is_dir()


def test_pieces_join_to_one_document(spark, lake, published, tmp_path):
    _, star, quality = published
    audit = publish.read_audit(spark, Layout(str(lake)).mart)
    pieces = snapshot.document(star, quality, audit, str(tmp_path / "pieces"))
    snapshot.write_document(pieces, str(tmp_path / "document"))
    text = "".join(part.read_text(encoding="utf-8") for part in sorted((tmp_path / "document").glob("part-*")))
    for piece in pieces.collect():
        assert text.encode()[piece.offset:].startswith(piece.text.encode() + b"\n")
    found = json.loads(text)
    assert list(found) == [*snapshot.SECTIONS, "loaded_at"] and len(found["dq"]) == quality.count()
    assert sum(r[5] for r in found["fact"]) == 802 and found["fact"] == sorted(found["fact"])
    assert [d["k"] for d in found["dim_district"]] == list(range(1, 51)) and len(found["loaded_at"]) == 16
    none = publish.Star.of({**star.tables(), "fact_population": star.fact_population.limit(0)})
    empty = json.loads("\n".join(r.text for r in snapshot.document(none, quality, audit.limit(0), str(tmp_path / "other")).orderBy("position").collect()))
    assert empty["population"] is None and empty["loaded_at"] is None
    with pytest.raises(snapshot.EmptyMart):
        snapshot.document(publish.Star.of({**star.tables(), "fact_disease_cases": star.fact_disease_cases.limit(0)}), quality, audit, str(tmp_path / "none"))


def test_a_filter_on_years_reaches_the_files_of_the_facts(published):
    _, star, quality = published
    asked = measures.Mart(star, quality).measure("total_cases", {"year_be": [2568]}, ["disease_name"])
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [isnotnull(date_key" in plan
    assert asked.agg(F.sum("total_cases")).first()[0] == 401


def test_time_of_the_newest_load(spark):
    audit = spark.createDataFrame([(0,), (86_400,)], "t long").select(F.timestamp_seconds("t").alias("loaded_at"))
    assert snapshot.loaded_at(audit).first().loaded_at == "1970-01-02 07:00"


def test_exports(spark, published, tmp_path):
    _, star, quality = published
    path = tmp_path / "sex.csv"
    files.write_export(files.ordered_export("dim_sex", star.dim_sex), str(path), "csv", single_file=True)
    assert sorted(p.name for p in tmp_path.glob("*sex.csv*")) == [".sex.csv.crc", "sex.csv"]
    assert path.read_text(encoding="utf-8").splitlines() == ["sex,sex_label", "F,หญิง", "M,ชาย", "U,ไม่ระบุ"]
    with pytest.raises(FileExistsError):
        files.write_export(star.dim_sex, str(path), "csv", overwrite=False, single_file=True)
    with pytest.raises(ValueError):
        files.write_export(star.dim_sex, str(path), "xlsx")
    files.write_tables({"dim_sex": star.dim_sex}, str(tmp_path / "pq"), str(tmp_path / "csv"))
    assert spark.read.parquet(str(tmp_path / "pq" / "dim_sex")).count() == 3
    assert files.select_by_header(star.dim_sex, ["﻿sex "]).columns == ["sex"]
    with pytest.raises(ValueError):
        files.select_by_header(star.dim_sex, ["sex; drop"])


def test_exports_are_directories_unless_one_file_is_asked_for(spark, tmp_path):
    data = spark.range(100).repartition(4)
    files.write_export(data, str(tmp_path / "big.csv"), "csv")
    assert len(list((tmp_path / "big.csv").glob("part-*.csv"))) == 4


def test_empty_population_gives_null_rates(spark, published, domain):
    _, star, _ = published
    assert no_population(star.dim_date).count() == 0


def test_a_failing_run_leaves_the_mart_of_the_run_before(spark, lake, published, tmp_path):
    layout = Layout(str(lake))
    before = [tuple(r) for r in publish.current_mart(spark, layout.mart)[0].fact_disease_cases.orderBy(*"date_key district_key".split()).limit(5).collect()]
    strict = Settings(max_missing_population_rate=-1.0)
    result = run.run_batch(spark, layout, strict, publish_failed=False)
    assert result.failed and not result.row_counts
    star, _ = publish.current_mart(spark, layout.mart)
    assert [tuple(r) for r in star.fact_disease_cases.orderBy(*"date_key district_key".split()).limit(5).collect()] == before
