import json

import pytest
from pyspark.sql import functions as F

from casemart.functions import parse_report_date
from casemart.reference_values import CASE_CSV_FIELDS, CASE_JSON_FIELDS, DISTRICTS, POPULATION_FIELDS
from casemart.sources import contract, landing, profile
from casemart.sources.catalog import chosen_files, latest_full, latest_per_year, versioned_name
from casemart.sources.files import flatten_envelope, read_case_files, read_cases, thai_code_page
from casemart.sources.paths import SourceNotFound, found, list_files
from casemart.sources.population import read_population

HEADER = ",".join(CASE_CSV_FIELDS)
ROW = ",".join((
    "หัด", "6", "3", "11", "หญิง", "หม้าย", "ลาว", "นักเรียน", "กรุงเทพมหานคร", "จตุจักร", "ลาดยาว", "23/2/2024", "หายแล้ว", "ผู้ป่วยใน", "สถานพยาบาลหนึ่ง"))
RECORD = dict(zip(CASE_JSON_FIELDS, ["a-512", *ROW.split(",")]))


def write_csv(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\r\n".join([HEADER, *lines]) + "\r\n", encoding="utf-8-sig")
    return str(path)


def paths_frame(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def full(year, *version):
    return "_".join(["disease_cases", str(year), "full", *version]) + ".csv"


def test_the_newest_complete_file_of_each_year_is_chosen(spark):
    names = {
        2561: [full(2561, "20180305"), full(2561, "20180304"), full(2561)],
        2562: [full(2562)],
        2563: ["disease_cases_2563_sample.json", "notes.txt"],
        2564: [full(2564, "20210630"), full(2564, "20210701") + ".part", "_metadata/" + full(2564, "20210702").replace(".csv", ".manifest.json")],
    }
    paths = [f"/data/lake/year={year}/{name}" for year, found in names.items() for name in found]
    listed = paths_frame(spark, *paths, "E:\\export\\" + full(2565, "20220101"))
    newest = {r.year: r.path.replace("\\", "/").rsplit("/", 1)[-1] for r in latest_per_year(listed).collect()}
    assert newest == {"2561": full(2561, "20180305"), "2562": full(2562), "2563": "disease_cases_2563_sample.json",
                      "2564": full(2564, "20210630"), "2565": full(2565, "20220101")}
    assert latest_full(listed).count() == 4 and latest_full(listed, "2563").count() == 0


def test_version_names():
    assert versioned_name("2562", "20190214") == full(2562, "20190214")
    with pytest.raises(ValueError):
        versioned_name("2562", "2019/02/14")


def test_csv_and_json_years_read_as_one_table(spark, tmp_path):
    broken = ROW.replace("สถานพยาบาลหนึ่ง", '"สถานพยาบาล\nหนึ่ง"')
    write_csv(tmp_path / "year=2568" / "disease_cases_2568_full.csv", ROW, ROW, broken)
    (tmp_path / "year=2568" / "disease_cases_2568_sample.json").write_text("[]", encoding="utf-8")
    (tmp_path / "year=2569").mkdir()
    (tmp_path / "year=2569" / "disease_cases_2569_sample.json").write_text(
        json.dumps({"data": [RECORD, RECORD]}, ensure_ascii=False), encoding="utf-8")
    glob = str(tmp_path / "year=*" / "disease_cases_*")
    assert [p.rsplit("/", 1)[-1] for p in chosen_files(spark, glob)] == [
        "disease_cases_2568_full.csv", "disease_cases_2569_sample.json"]
    table = read_cases(spark, glob)
    assert set(CASE_JSON_FIELDS) | {"_source_file", "_record_id"} == set(table.columns)
    out = table.collect()
    assert len(out) == 5
    ids = {r._record_id for r in out if r._record_id}
    assert len(ids) == 3 and all(i.startswith("year=2568/disease_cases_2568_full.csv:") for i in ids)
    assert sum(r["สถานที่รักษา"] == "สถานพยาบาล\nหนึ่ง" for r in out) == 1
    assert {r._source_file.rsplit("/", 1)[-1] for r in out} == {
        "disease_cases_2568_full.csv", "disease_cases_2569_sample.json"}
    again = {r._record_id for r in read_cases(spark, glob).collect() if r._record_id}
    assert again == ids


def test_nothing_to_read_is_not_found(spark, tmp_path):
    with pytest.raises(SourceNotFound):
        read_cases(spark, str(tmp_path / "*.csv"))
    with pytest.raises(SourceNotFound):
        read_case_files(spark, [])
    with pytest.raises(SourceNotFound):
        read_population(spark, str(tmp_path / "none" / "*.csv"))
    assert not found(spark, str(tmp_path / "none"))


def test_envelope_keys_in_order(spark):
    data = spark.createDataFrame([([("1", "x")], "f")], "items array<struct<a:string,b:string>>, _source_file string")
    assert [tuple(r) for r in flatten_envelope(data).collect()] == [("1", "x", "f")]
    bare = spark.createDataFrame([("1",)], "data string")
    assert flatten_envelope(bare).columns == ["data"]


def test_population_files_in_three_encodings(spark, tmp_path):
    text = "ปี,เขต,ประชากรรวม\n{},หนองจอก,7301\n{},สายไหม,9417\n"
    folder = tmp_path / "my data"
    folder.mkdir()
    for year, encoding in ((2566, "cp874"), (2567, "utf-8"), (2568, "utf-8-sig")):
        (folder / f"population_summary_{year}.csv").write_text(text.format(year, year), encoding=encoding)
    (folder / "other_2569.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    out = read_population(spark, str(folder / "*.csv"))
    assert {tuple(r) for r in out.select("ปี", "เขต", "_source_year", "_source_file").collect()} == {
        (str(y), d, y, f"population_summary_{y}.csv") for y in (2566, 2567, 2568) for d in ("หนองจอก", "สายไหม")}


def test_thai_code_page_rule():
    latin, thai = thai_code_page()
    sample = "ประชากรเขตบางกะปิ ๑๒๓ “…”"
    assert sample.encode("cp874").decode("latin-1").translate(str.maketrans(latin, thai)) == sample


def test_json_contract(spark, tmp_path):
    short = {k: v for k, v in RECORD.items() if k != "เพศ"}
    cases = {"ok": [RECORD, RECORD], "empty": [], "wrong_fields": [RECORD, short], "not_json": "oops", "trailing": json.dumps([RECORD]) + " tail"}
    for name, content in cases.items():
        body = content if isinstance(content, str) else json.dumps(content, ensure_ascii=False)
        (tmp_path / f"{name}.json").write_text(body, encoding="utf-8")
    out = contract.json_contract(spark, [str(tmp_path / f"{n}.json") for n in cases]).collect()
    assert {r.path.rsplit("/", 1)[-1].removesuffix(".json"): r.status for r in out} == {n: n for n in cases} | {"trailing": "not_json"}
    assert {r.status: (r.records, r.wrong_records) for r in out}["wrong_fields"] == (2, 1)


def test_csv_contract(spark, tmp_path):
    quoted = ROW.replace("หญิง", '"หญิง, ชาย\nอื่น"')
    files = {
        "ok": write_csv(tmp_path / "ok.csv", ROW, quoted),
        "ragged": write_csv(tmp_path / "ragged.csv", ROW, ROW + ",extra", ROW.rsplit(",", 1)[0]),
        "empty": write_csv(tmp_path / "empty.csv"),
    }
    other = tmp_path / "wrong_header.csv"
    other.write_text(f"_id,{HEADER}\n1,{ROW}\n", encoding="utf-8")
    files["wrong_header"] = str(other)
    (tmp_path / "zero.csv").touch()
    zero = contract.csv_contract(spark, [str(tmp_path / "zero.csv")]).collect()
    assert [(r.records, r.status) for r in zero] == [(0, "empty")]
    assert contract.csv_contract(spark, [files["ok"], str(tmp_path / "zero.csv")]).count() == 2
    out = contract.csv_contract(spark, list(files.values())).collect()
    assert {r.path.rsplit("/", 1)[-1].removesuffix(".csv"): r.status for r in out} == {n: n for n in files}
    by_status = {r.status: (r.records, r.ragged_records) for r in out}
    assert by_status["ok"] == (2, 0) and by_status["ragged"] == (3, 2)


def test_population_contract(spark):
    good = [("2568", name, "1000") for name in DISTRICTS]
    frame = lambda data: spark.createDataFrame(data, list(POPULATION_FIELDS))
    assert contract.population_contract(frame(good), 2568).count() == 0
    bad = good[2:] + [("2567", "ดุสิต", "x"), ("2568", "ระยอง", "0"), ("2568", "", "5"), good[5]]
    out = {(r.rule, r.value): r.rows for r in contract.population_contract(frame(bad), 2568).collect()}
    assert out == {
        ("year", "2567"): 1, ("district_blank", ""): 1, ("population_not_integer", "x"): 1,
        ("population_not_positive", "0"): 1, ("duplicate_district", good[5][1]): 2, ("missing_district", "พระนคร"): 0,
        ("unexpected_district", "ระยอง"): 1}
    wrong = spark.createDataFrame([("1",)], ["x"])
    assert contract.population_contract(wrong, 2568).first().rule == "columns"


def test_fingerprints_and_landing(spark, tmp_path):
    import hashlib

    path = write_csv(tmp_path / "disease_cases_2568_full.csv", ROW)
    prints = landing.fingerprints(spark, str(tmp_path / "*.csv"))
    row = prints.first()
    body = open(path, "rb").read()
    assert (row.sha256, row.size_bytes, row.filename, row.format) == (
        hashlib.sha256(body).hexdigest(), len(body), "disease_cases_2568_full.csv", "csv")
    counts = contract.csv_contract(spark, [r.path for r in prints.select("path").collect()])
    manifest = landing.manifest(prints, counts, "disease_cases", "test", F.lit("2568"), F.col("filename")).first()
    assert (manifest.record_count, manifest.object_key) == (1, "disease_cases_2568_full.csv")
    keyed = "object_key string, sha256 string"
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("e", None)], keyed)
    old = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4"), ("e", None)], keyed)
    assert {r.object_key: r.status for r in landing.landing_status(new, old).collect()} == {
        "a": "unchanged", "b": "conflict", "c": "new", "d": "kept", "e": "conflict"}


def test_repeated_content_is_unchanged(spark):
    files = "path string, sha256 string"
    landed = spark.createDataFrame([("disease_cases_2568_full_20250101.csv", "x"), ("disease_cases_2568_full_20250201.csv", "y")], files)
    offered = spark.createDataFrame([("disease_cases_2568_full_20250301.csv", "y"), ("disease_cases_2569_full_20250301.csv", "y")], files)
    assert {r.year: r.status for r in landing.content_status(offered, landed).collect()} == {
        "2568": "unchanged", "2569": "new"}


def test_profile(spark):
    data = spark.createDataFrame(
        [("a", "1/1/2025"), ("a", "1/1/2025"), (None, "oops"), ("b", None)], "k string, d string")
    assert tuple(profile.table_profile(data).first()) == (4, 2, 2, 1)
    assert {r.column_name: r.missing_cells for r in profile.missing_cells(data).collect()} == {"k": 1, "d": 1}
    assert {(r.value, r.rows) for r in profile.value_counts(data, ["k"]).collect()} == {("a", 2), (None, 1), ("b", 1)}
    assert {r.column_name: r.distinct_values for r in profile.distinct_values(data, ["k", "d"]).collect()} == {"k": 2, "d": 2}
    dates = profile.date_range(data, "d", parse_report_date).first()
    assert str(dates.earliest) == str(dates.latest) == "2025-01-01" and dates.unreadable == 2
    sums = spark.createDataFrame([("x", "10"), ("y", "5"), ("total", "15")], "k string, n string")
    assert tuple(profile.subset_sums(sums, "k", ["x", "y"], ["n"]).first()) == (2, 15.0)


def test_listing(spark, tmp_path):
    write_csv(tmp_path / "sub" / "one.csv", ROW)
    (tmp_path / "note.txt").write_text("x")
    assert list_files(spark, str(tmp_path), "*.csv", recursive=True).count() == 1


def test_a_single_byte_file_does_not_break_the_contract_of_the_others(spark, tmp_path):
    good = write_csv(tmp_path / "good.csv", ROW)
    thai = tmp_path / "thai.csv"
    thai.write_bytes(f"{HEADER}\r\n{ROW}\r\n".encode("cp874"))
    found = {r.path.rsplit("/", 1)[-1]: r.status for r in contract.csv_contract(spark, [good, str(thai)]).collect()}
    assert set(found) == {"good.csv", "thai.csv"} and found["good.csv"] == "ok"
