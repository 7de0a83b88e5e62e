"""Revisits of URLs with many captures on one day, in one second and without a time, against a plain search."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from casemart.llm import warc_revisits

SCHEMA = "record_id {kind}, url string, captured_at timestamp_ntz, kind string, status int, headers map<string,string>, body string, row int, day string, slot string"


def captures(seed, count):
    draw, start, rows = random.Random(seed), datetime(2024, 3, 1), []
    for k in range(count):
        time = draw.choice([None, start + timedelta(days=draw.randrange(3), seconds=draw.randrange(4) * 7, microseconds=draw.randrange(3)), start])
        kind = draw.choice(["response", "revisit", "revisit"])
        number = draw.choice([k * 1000, k * 1000, None])
        rows.append((number, f"http://{draw.choice('ab')}.org/", time, kind, 200 if kind == "response" else 304, {"etag": str(draw.randrange(2))}, f"body {k}" if kind == "response" else None, 1, "d", "s"))
    return rows


def by_search(rows):
    """(record_id, response_id, outcome, body) of each revisit; None where rows of equal time and id make it open which response is taken."""
    def place(row):
        return row[2] is None, row[2] or datetime.min, row[0] is None, row[0] or 0

    out = []
    for row in rows:
        if row[3] != "revisit":
            continue
        before = [r for r in rows if r[3] == "response" and r[1] == row[1] and place(r) < place(row)]
        if not before:
            out.append((row[0], None, "no_response", None))
            continue
        last = max(before, key=place)
        if [place(r) for r in before].count(place(last)) > 1 or any(place(r) == place(row) for r in rows if r[3] == "response" and r[1] == row[1]):
            out.append(None)
            continue
        same = last[5] == row[5]
        out.append((row[0], last[0], "resolved" if same else "mismatch", last[6] if same else None))
    return out


@pytest.mark.parametrize("kind", ["long", "string"])
def test_revisits_equal_a_plain_search(spark, kind):
    rows = [r for r in captures(5, 400) if r[0] is not None] + [r for r in captures(6, 30) if r[0] is None and r[3] == "revisit" and r[2] is not None]
    given = [(None if r[0] is None else r[0] if kind == "long" else f"{r[0]:09d}", *r[1:]) for r in rows]
    data = spark.createDataFrame(given, SCHEMA.format(kind=kind)).repartition(5)
    out = sorted(((None if r.record_id is None else int(r.record_id), None if r.response_id is None else int(r.response_id), r.outcome, r.body)
                  for r in warc_revisits.resolve_revisits(data).collect()), key=str)
    expected = by_search(rows)
    assert len(out) == len(expected)
    known = sorted((e for e in expected if e is not None), key=str)
    assert len(known) > 150 and all(k in out for k in known)


def test_a_day_is_spread_over_its_seconds(spark):
    day = datetime(2024, 1, 1)
    rows = [(k, "http://x.org/", day + timedelta(seconds=k % 5000), "response" if k % 2 else "revisit", 200 if k % 2 else 304, None, "b" if k % 2 else None, 1, "", "") for k in range(5000)]
    plan = warc_revisits.resolve_revisits(spark.createDataFrame(rows, SCHEMA.format(kind="long")))
    assert plan.count() == 2500 and plan.where("outcome = 'no_response'").count() == 1
    assert plan.where(F.col("response_id") == F.col("record_id") - 1).count() == 2499
