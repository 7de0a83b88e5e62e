"""Targets are met with null and repeated ids, and rows pass unchanged whatever their other columns are called."""

import duckdb
import pytest
from pyspark.sql import functions as F

from casemart.llm import mixing

INNER = ("row", "own", "hash", "limit", "base", "budget", "target", "size", "times", "copy", "source_size", "number", "prefix", "at", "weight", "bucket")


def table(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{name} string" for name in INNER)
    return spark.createDataFrame([(i, t, "en", s, 1, *[f"{name} of {k}" for name in INNER]) for k, (i, t, s) in enumerate(rows)], schema)


ROWS = ([(None, "ten words of a text that has no own id", "n")] * 700 + [(7, "one row that is there again and again so", "r")] * 900
        + [(None, f"text {k} of many without any id at all", "m") for k in range(500)] + [(9, f"text {k} of many with the same id here and now", "s") for k in range(500)]
        + [(1000 + k, "w " * (k % 60 + 1), "u") for k in range(800)] + [(5, None, None), (6, "", None), (5, None, None), (8, "last source of all", None)])


@pytest.fixture(scope="module")
def mixed(spark):
    return mixing.mix_sources(table(spark, ROWS).repartition(5)).cache()


def test_every_source_comes_within_a_document_of_its_target(mixed):
    sums = mixed.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("largest")).collect()
    assert len(sums) == 6 and all(0 <= r.target - r.taken < r.largest for r in sums if r.target)
    assert mixed.where("taken > 2 * size OR taken < 0").count() == 0 and mixed.count() == len(ROWS)


def test_reruns_and_the_sql_agree(spark, mixed, tmp_path):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    table(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    again = mixing.mix_sources(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    ours = sorted(map(tuple, mixed.select(*columns).collect()), key=str)
    assert sorted(map(tuple, again.select(*columns).collect()), key=str) == ours
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(db.sql(f"SELECT {', '.join(columns)} FROM ({mixing.MIX_SQL})").fetchall(), key=str) == ours


def test_rows_are_taken_whole(spark, mixed):
    docs = table(spark, ROWS)
    taken = mixing.take_mix(docs)
    assert taken.columns == docs.columns and taken.dtypes == docs.dtypes
    assert taken.subtract(docs).count() == 0
    words = {r[0]: r[1] for r in taken.groupBy("source").agg(F.sum(mixing.word_count(F.col("text")))).collect()}
    assert sum(words.values()) == mixed.agg(F.sum("taken")).first()[0]


def test_one_source_one_row_no_rows(spark):
    assert mixing.mix_sources(table(spark, [])).count() == 0 and mixing.take_mix(table(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix_sources(table(spark, [(1, "a b c", "x")])).collect()] == [3]
    assert [r.taken for r in mixing.mix_sources(table(spark, [(1, None, None)])).collect()] == [0]
