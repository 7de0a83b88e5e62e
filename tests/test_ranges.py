"""CSV records and JSON arrays from files that are cut into small ranges, against readers of whole files."""

import csv
import io
import json
import random

import pytest

from casemart.sources import contract
from casemart.sources.files import read_case_files
from casemart.sources.json_arrays import array_elements, read_json_arrays
from casemart.sources.ranges import file_pieces
from casemart.sources.records import csv_faults, csv_records, read_csv_records

FIELDS = ("k", "t", "note")


@pytest.fixture
def small_ranges(spark):
    """Every file is cut after some forty bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(name, None) for name in names]
    for name, value in zip(names, ("40", "1", "64")):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before):
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plain(path):
    return "/" + path.removeprefix("file:").lstrip("/")


def messy_rows(seed, count):
    draw = random.Random(seed)
    parts = ["a", "b c", ",", "\n", '"', "\n\n", "ก", "", " x ", "\\"]
    return [["".join(draw.choice(parts) for _ in range(draw.randrange(6))) for _ in FIELDS] for _ in range(count)]


def write_csv(path, rows, end="\r\n"):
    with open(path, "w", encoding="utf-8", newline="") as out:
        csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL).writerows([FIELDS, *rows])
    return str(path)


def test_records_with_breaks_equal_a_reader_of_whole_files(spark, tmp_path, small_ranges):
    files = {write_csv(tmp_path / f"{seed}.csv", messy_rows(seed, 60), ("\r\n", "\n")[seed % 2]): messy_rows(seed, 60) for seed in range(3)}
    assert file_pieces(spark, list(files)).rdd.getNumPartitions() > 3 * len(files)
    found = {}
    for row in csv_records(spark, list(files)).orderBy("line").collect():
        found.setdefault(plain(row.path), []).append((row.line, row.text))
    for path, rows in files.items():
        texts = [text for _, text in found[path]]
        assert [next(csv.reader(io.StringIO(text, newline=""))) for text in texts] == [list(FIELDS), *rows]
        starts = [1]
        for text in texts[:-1]:
            starts.append(starts[-1] + text.count("\n") + 1)
        assert [line for line, _ in found[path]] == starts
    (names, table), = read_csv_records(spark, list(files), "file")
    assert names == FIELDS
    cells = sorted([cell or "" for cell in row[:3]] for row in table.collect())
    assert cells == sorted(row for rows in files.values() for row in rows)


def test_faults_and_their_lines(spark, tmp_path, small_ranges):
    texts = {
        "good": 'k,t,note\n1,2,"a\nb"\n4,5,6\n', "ragged": 'k,t,note\n1,2,"x\ny"\n1,2\n1,2,3\n1,2,3,4\n', "blank": "k,t,note\n1,2,3\n\n4,5,6\n",
        "header": 'k,"t\nu",note\n1,2,3\n', "nothing": "k,t,note\n", "open": 'k,t,note\n1,"2,3\n4,5,6\n', "zero": "", "empty_cells": "k,t,note\n,,\n1,2,3",
        "order": "note,k,t\n1,2,3\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8-sig" if name == "good" else "utf-8")
    (tmp_path / "thai.csv").write_bytes("k,t,note\nก,ข,\"ค\nง\"\n".encode("cp874"))
    paths = [str(tmp_path / f"{name}.csv") for name in [*texts, "thai"]]
    out = {r.path.rsplit("/", 1)[-1][:-4]: (r.status, r.records, r.ragged_records, r.blank_records, r.blank_lines, r.first_fault)
           for r in contract.csv_contract(spark, paths, FIELDS).collect()}
    assert out == {
        "good": ("ok", 2, 0, 0, 0, None), "ragged": ("ragged", 4, 2, 0, 0, 4), "blank": ("ragged", 2, 0, 0, 1, 3), "header": ("wrong_header", 1, 0, 0, 0, None),
        "nothing": ("empty", 0, 0, 0, 0, None), "open": ("open_quote", 2, 1, 0, 0, 2), "zero": ("empty", 0, 0, 0, 0, None), "empty_cells": ("ok", 2, 0, 1, 0, None),
        "order": ("ok", 1, 0, 0, 0, None), "thai": ("not_utf8", 1, 0, 0, 0, None)}
    assert {r.header for r in csv_faults(spark, paths[3:4]).collect()} == {'k,"t\nu",note'}


def test_encodings_of_files_in_one_scan(spark, tmp_path, small_ranges):
    for name, encoding in (("a", "cp874"), ("b", "utf-8"), ("c", "utf-8-sig")):
        (tmp_path / f"{name}.csv").write_text("k,t,note\n" + 'เขต,"บาง\nรัก",x\n' * 20, encoding=encoding)
    (_, table), = read_csv_records(spark, [str(tmp_path / f"{n}.csv") for n in "abc"], "file")
    assert {tuple(r)[:3] for r in table.collect()} == {("เขต", "บาง\nรัก", "x")} and table.count() == 60


def messy_json(seed):
    draw = random.Random(seed)
    strings = ["a,b", "[", "]}", '"', "\\", "ก\n", "{,", "", "\\\"", "x" * 60]

    def value(depth=0):
        kind = draw.randrange(6 if depth < 3 else 3)
        if kind == 3:
            return [value(depth + 1) for _ in range(draw.randrange(4))]
        if kind == 4:
            return {draw.choice(strings): value(depth + 1) for _ in range(draw.randrange(4))}
        return draw.choice([1, None, True, 2.5]) if kind == 0 else "".join(draw.choice(strings) for _ in range(draw.randrange(4)))
    return [{name: value() for name in FIELDS} for _ in range(30)]


def test_elements_equal_a_reader_of_whole_files(spark, tmp_path, small_ranges):
    arrays = {}
    for seed in range(4):
        path = tmp_path / f"{seed}.json"
        arrays[str(path)] = messy_json(seed)
        path.write_text(json.dumps(arrays[str(path)], ensure_ascii=seed % 2 == 0, indent=(None, 1)[seed // 2]), encoding="utf-8")
    assert file_pieces(spark, list(arrays), ",").rdd.getNumPartitions() > 3 * len(arrays)
    found = {}
    for row in array_elements(spark, list(arrays)).orderBy("at").collect():
        assert row.is_array
        found.setdefault(plain(row.path), []).append(json.loads(row.text))
    assert found == arrays
    assert {r.status for r in contract.json_contract(spark, list(arrays), FIELDS).collect()} == {"ok"}


def test_arrays_that_are_none(spark, tmp_path, small_ranges):
    texts = {
        "ok": ' [{"k":1,"t":"[","note":"a\\"],"}]\n', "empty": " [ ]", "tail": '[{"k":1,"t":2,"note":3}] and more', "open": '[{"k":1,"t":2,"note":3}', "two": "[1] [2]",
        "twice": '[{"k":1,"t":2,"note":3}]]', "gap": '[{"k":1,"t":2,"note":3},,{"k":1,"t":2,"note":3}]', "comma": '[{"k":1,"t":2,"note":3},]', "scalar": "7", "quote": '["a]',
        "wrong": '[{"k":1,"t":2,"note":3},{"k":1}]', "scalars": "[1,2,3]", "mixed": '[{"k":1]}', "word": "[word]", "object": '{"data":[{"k":1}]}', "zero": "", "nested": '[[{"k":1}],{"k":1,"t":2,"note":[1,{"z":"]"}]}]'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    (tmp_path / "thai.json").write_bytes('[{"k":"ก","t":2,"note":3}]'.encode("cp874"))
    out = {r.path.rsplit("/", 1)[-1][:-5]: (r.status, r.records, r.wrong_records) for r in contract.json_contract(spark, [str(tmp_path / f"{n}.json") for n in [*texts, "thai"]], FIELDS).collect()}
    good = {"ok": ("ok", 1, 0), "empty": ("empty", 0, 0), "wrong": ("wrong_fields", 2, 1), "scalars": ("wrong_fields", 3, 3), "nested": ("wrong_fields", 2, 1)}
    assert out == {name: good.get(name, ("not_json", 0, 0)) for name in [*texts, "thai"]}


def test_arrays_envelopes_and_csv_are_read_together(spark, tmp_path, small_ranges):
    (tmp_path / "a.json").write_text(json.dumps([{"k": n, "t": None, "note": "x,\n" * 5} for n in range(20)]), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"data": [{"k": "7", "z": "q"}]}), encoding="utf-8")
    (tmp_path / "e.json").write_text("[]", encoding="utf-8")
    write_csv(tmp_path / "c.csv", messy_rows(1, 10))
    paths = [str(tmp_path / name) for name in ("a.json", "b.json", "c.csv", "e.json")]
    table = read_case_files(spark, paths)
    assert table.count() == 31 and set(table.columns) == {"k", "t", "note", "z", "_source_file", "_record_id"}
    assert table.where("note = 'x,\n" + "x,\n" * 4 + "'").count() == 20
    arrays, others = read_json_arrays(spark, paths[:2] + paths[3:], "f")
    assert [p.rsplit("/", 1)[-1] for p in others] == ["b.json"] and {r.f.rsplit("/", 1)[-1] for r in arrays.collect()} == {"a.json"}
    assert sorted(int(r.k) for r in arrays.collect()) == list(range(20))
