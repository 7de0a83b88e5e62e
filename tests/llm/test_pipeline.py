"""Every stage of the pipeline against a brute-force version on its own input, and the whole against its stages."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from casemart.llm.mixing import MIX_SQL
from tests.llm.test_edge_cases import KINDS

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
JUNK = "WIN!!! $$$ CLICK!!! ### BUY!!! NOW!!! $$$ FREE!!! ### WIN!!! CLICK!!! {}"


def corpus():
    """Prose with near and exact copies and personal data, junk, and rows without text, id or source."""
    draw = np.random.default_rng(11)
    words = np.array(["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), draw.integers(3, 9))) for _ in range(900)])
    rows, labels = [], []
    for k in range(360):
        if k % 4 == 0:
            text = JUNK.format(f"a{k} b{k * 3}")
        elif k % 10 == 3:
            near = rows[k - 2][1].split(" ")
            near[int(draw.integers(len(near)))] = f"changed{k}"
            text = " ".join(near) if k % 20 == 3 else rows[k - 2][1]
        else:
            text = " ".join(draw.choice(words, int(draw.integers(60, 400)))) + "."
            if k % 6 == 1:
                text += f" write to user{k}@mail{k}.example.org or call +49 30 1234{k:03d} from 10.0.{k % 250}.7"
        rows.append((k, text, "en", (None, "books", "web", "web")[k % 4] if k % 9 else "news", len(text)))
        labels.append((k, int(k % 4 != 0), 0))
    return rows + [(900, None, None, "web", None), (901, "", "en", None, 0), (None, " ".join(words[:80]) + ".", "en", "web", 1)], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each one, and the folder with the tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    kept = [f"{folder}/documents.parquet"]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, spark.read.parquet(kept[-1]), folder).write.parquet(f"{folder}/{number}")
        kept.append(f"{folder}/{number}")
    return [spark.read.parquet(path) for path in kept], kept, folder


def texts(df):
    return {row.doc_id: row.text for row in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    frames, *_ = stages
    assert all(df.columns == frames[0].columns and df.dtypes == frames[0].dtypes for df in frames[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "minhash near-dedup", "pii", "mixing sources", "best-fit packing"]


def test_only_junk_is_rejected(stages):
    before, after = (texts(df) for df in stages[0][:2])
    prose = {i for i in before if i is not None and i < 900 and i % 4}
    assert {i for i in after if i is not None and i < 900} == prose


def test_one_document_of_each_group_stays(stages):
    before, after = stages[0][1].collect(), stages[0][2].collect()
    sets = []
    for row in before:
        words = (row.text or "").lower().split()
        sets.append(set(zip(*[words[i:] for i in range(5)])) or ({tuple(words)} if words else set()))
    group = list(range(len(before)))
    for a in range(len(before)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    of_id = {row.doc_id: g for row, g in zip(before, group)}
    assert len(set(group)) < len(before)
    assert sorted(of_id[row.doc_id] for row in after) == sorted(set(group))
    assert all(row in before for row in after)


def test_personal_data_goes_and_other_texts_stay(stages):
    before, after = (texts(df) for df in stages[0][2:4])
    assert before.keys() == after.keys()
    marked = 0
    for i, text in before.items():
        values = [m[0] for p, ok in KINDS.values() for m in re.finditer(p, text or "") if ok(m[0])]
        marked += bool(values)
        assert all(value not in after[i] for value in values), i
        assert values or after[i] == text
    assert marked


def test_the_mix_takes_what_sorted_hashes_give(stages):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{stages[1][3]}/*.parquet'")
    size = {row.doc_id: len((row.text or "").split()) for row in stages[0][3].collect()}
    expected = {i: taken // size[i] for i, taken in db.sql(f"SELECT doc_id, taken FROM ({MIX_SQL})").fetchall() if size[i]}
    copies = Counter(row.doc_id for row in stages[0][4].collect())
    assert {i: n for i, n in copies.items() if size[i]} == {i: n for i, n in expected.items() if n}


def test_packed_pieces_hold_every_token_once(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, pieces = Counter(), stages[0][5].collect()
    for row in stages[0][4].collect():
        ids = np.array(plain.encode(row.text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        expected.update((row.doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == expected
    filled = Counter()
    for row in sorted(pieces, key=lambda r: r.offset):
        assert filled[row.sequence_id] == row.offset
        filled[row.sequence_id] += row.length
    assert max(filled.values()) <= 1024


def test_the_run_gives_what_its_stages_give(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, stages[2]).select(*columns)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, stages[0][5].select(*columns).collect()))


#: Names that operators use inside.
INNER = ("key", "row", "size", "hash", "label", "found", "marked", "target", "base", "limit", "own", "source_size", "copy", "number", "component", "score", "rid", "content",
         "times", "held_out", "predicted", "n_shingles", "__row", "budget", "doc", "of", "id", "first")


def test_stages_pass_columns_of_any_name(spark, stages, tmp_path):
    rows, _ = corpus()
    schema = DOCS + ", " + ", ".join(f"{name} string" for name in INNER)
    docs = spark.createDataFrame([(*row, *[f"{name} of {row[0]}" for name in INNER]) for row in rows], schema)
    kinds, plain = docs.dtypes, stages[0]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, stages[2]).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < 4:
            assert docs.dtypes == kinds
            assert all(row[name] == f"{name} of {row.doc_id}" for row in docs.collect() for name in INNER)
            assert Counter(row.doc_id for row in docs.collect()) == Counter(row.doc_id for row in plain[number + 1].collect())


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
