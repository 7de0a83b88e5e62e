import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from casemart.llm.queries import op1_substring_dedup
from casemart.llm.substring_dedup import COVER, PERIOD, remove_repeats

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key string, copies string"


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    return sorted(map(tuple, remove_repeats(df, window).collect()), key=str)


def test_the_cover_holds_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_equals_brute_force_on_the_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op1_substring_dedup(spark, DATA).collect()), key=str) == brute(rows, 35)


def test_matches_at_all_alignments(spark):
    shared = [f"s{i}" for i in range(30)]
    rows = [(k, " ".join([f"a{k}_{i}" for i in range(k)] + shared[:24 + k % 5] + [f"z{k}_{i}" for i in range(40)])) for k in range(45)]
    rows += [(100, " ".join(shared[:23])), (101, "\t".join(f"q{i % 7}" for i in range(80)))]
    assert run(spark, rows, 25) == brute(rows, 25)


def test_nulls_empty_repeated_and_long(spark):
    long = " ".join(f"w{i}" for i in range(60_000)) + " " + "x" * 100_000
    rows = [(1, None), (None, ""), (2, " \n\t"), (3, "a b"), (4, long), (4, long), (5, "é ü x " * 40), (None, "one two")]
    assert run(spark, rows, 35) == brute(rows, 35)


def test_no_rows(spark):
    assert run(spark, [], 35) == []


def test_texts_come_back(spark):
    df = spark.createDataFrame([(1, "a  b\nc", "", "")], SCHEMA)
    assert remove_repeats(df, 21, with_text=True).select(F.col("kept_text")).first()[0] == "a b c"
