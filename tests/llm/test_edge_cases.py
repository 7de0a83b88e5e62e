"""Nulls in any column, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from casemart.llm import embedding_dedup, minhash_dedup, mixing, packing, privacy, quality, top_k, toxicity, warc_revisits
from casemart.llm.minhash_dedup import shingles, super_minhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, size string, hash string, label int"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
GOOD = "the river runs past the old mill and the children walk home in the evening light of autumn every day {}"
BAD = "WIN!!! $$$ CLICK!!! ### BUY!!! NOW!!! $$$ FREE!!! ### WIN!!! CLICK!!! {}"
CALM = "it was a quiet day. you are a good friend {}. the weather was fine."
TOXIC = "it was a quiet day. you are a stupid clown {}. the weather was fine."


def docs(spark, rows):
    full = [(*row, *[None] * (10 - len(row))) for row in rows]
    return spark.createDataFrame(full, DOCS)


ODD = [(1, None, None, None), (None, "", "en", "a"), (2, " \n\t ", "en", None), (2, " \n\t ", "en", None), (3, "ü" * 200_000, "de", "b"),
       (4, "a b c d e f " * 20_000, None, "b"), (4, "a b c d e f " * 20_000, None, "b"), (5, "one two", "en", "a")]


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = [], []
    for k in range(400):
        text = (GOOD, BAD)[k % 4 == 0].format(f"w{k} x{k * 7}") if k % 2 else TOXIC.format(f"q{k}") if k % 8 == 2 else CALM.format(f"z{k}") if k % 4 else BAD.format(k)
        rows.append((k, text, "en", f"s{k % 3}"))
        labels.append((k, 0 if text.startswith("WIN") else 1, int("stupid" in text)))
    table = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    return docs(spark, rows), table


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_classifiers_tell_held_out_rows_apart(spark, labelled, name):
    data, labels = labelled
    if name == "quality":
        scored = quality.score_quality(data, quality.train_quality(data, labels))
    else:
        scored = toxicity.score_toxicity(data, toxicity.train_toxicity(data, labels))
    out = scored.join(labels.where("quality IS NOT NULL"), "doc_id").collect()
    assert len(out) == 400
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(r.predicted == r[name] and 0 <= r.score <= 1 for r in out)


def test_offending_sentences_are_located(spark, labelled):
    data, labels = labelled
    row = toxicity.score_toxicity(data, toxicity.train_toxicity(data, labels)).where("predicted = 1").join(data.select("doc_id", "text"), "doc_id").first()
    assert row.offending and all("stupid" in row.text[a:b] for a, b in row.offending)


def test_classifiers_take_odd_rows_and_no_labels(spark, labelled):
    data, labels = labelled
    none = labels.limit(0)
    for source, rows in ((docs(spark, ODD), len(ODD)), (docs(spark, []), 0)):
        model = quality.train_quality(data, labels)
        assert quality.score_quality(source, model).count() == rows
        assert quality.keep_good(source, model).columns == source.columns
        assert {r.score for r in quality.score_quality(source, quality.train_quality(source, none)).collect()} <= {0.5}
        assert toxicity.score_toxicity(source, toxicity.train_toxicity(data, labels)).count() == rows
        assert {round(r.score, 6) for r in toxicity.score_toxicity(source, toxicity.train_toxicity(source, none)).collect()} <= {0.0}


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(re.sub("[^0-9]", "", v)) <= 19 and luhn(re.sub("[^0-9]", "", v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15),
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def test_base_spans_equal_plain_patterns(spark):
    texts = [
        "a@b.c_d@e.f x.y@z.w-1.q é mail: ü.x@y.zz, 1.2.3.4.5.6.7.8 0256.1.1.1 255.255.0.1", "4111 1111 1111 1111-2 4111-1111-1111-1111 41111111111111111",
        "+49 (30) 123-4567. +1 2 3 +123456789012345678", "@@a@b@c.d 1.2.3 ..1.1.1.1..", "x" * 50_000 + "@y.z", "1" * 50_000, "9." * 5_000, None, ""]
    out = {r.doc_id: r for r in privacy.private_report(docs(spark, list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        spans = [f"{kind}:{m.start()}:{m.end()}" for kind, (p, ok) in KINDS.items() for m in re.finditer(p, text or "") if ok(m[0])]
        assert out[k].spans == ",".join(spans), k
        assert [out[k].n_email, out[k].n_ip, out[k].n_card, out[k].n_phone] == [sum(s.startswith(kind) for s in spans) for kind in KINDS]


def test_a_term_that_gives_a_value_away_is_marked_and_removed(spark):
    rows = [(k, f"note{k * 7} from jaguarundi about item{k} to me@there.org again number{k * 3}. Jaguarundi was here") for k in range(6)]
    rows += [(100 + k, f"note{k} from plain text number{k} about item{k} and again what was here") for k in range(60)]
    data = docs(spark, rows)
    out = {r.doc_id: r for r in privacy.private_report(data).collect()}
    assert [s.split(":")[0] for s in out[0].spans.split(",")] == ["email", "term", "term"] and out[100].spans == ""
    clean = {r.doc_id: r.text for r in privacy.sanitise(data).collect()}
    assert "jaguarundi" not in clean[0].lower() and "[EMAIL]" in clean[0] and clean[100] == rows[6][1]


def test_terms_count_over_whole_documents(spark):
    def far(k, term, value):
        return f"{term} wrote this. " + " ".join(f"filler number{k}x{j} of plain text" for j in range(40)) + f". Reach {value}"

    rows = [(k, far(k, "Quetzal", "far@there.org")) for k in range(6)] + [(10, far(10, "Quetzal", "nobody"))]
    rows += [(20 + k, far(20 + k, "Axolotl", "two@there.org")) for k in range(2)]  # below the support of 3
    rows += [(30 + k, far(30, "Numbat", "copy@there.org")) for k in range(4)]  # copies of one document
    rows += [(100 + k, far(100 + k, "Somebody", "nobody")) for k in range(60)]
    out = {r.doc_id: r.spans for r in privacy.private_report(docs(spark, rows)).collect()}
    assert all(out[k].endswith(",term:0:7") for k in range(6))
    assert out[10] == out[100] == ""
    assert not any("term" in out[k] for k in (20, 21, 30, 31, 32, 33))


def test_private_data_in_odd_rows(spark):
    assert privacy.private_report(docs(spark, ODD)).count() == len(ODD)
    assert privacy.private_report(docs(spark, [])).count() == 0
    assert privacy.sanitise(docs(spark, ODD)).columns == docs(spark, ODD).columns


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, row string, copies string")


ODD_VECTORS = [(1, None), (2, [0.0] * 8), (3, [1.0, None] + [0.0] * 6), (4, [float("nan")] * 8), (5, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (7, [])]


def test_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 8))
    x = np.concatenate([base, base[:30] + 0.05 * draw.normal(size=(30, 8)), base[:5]]).astype(np.float32)
    rows = [(10 + k, v.tolist()) for k, v in enumerate(x)] + ODD_VECTORS
    out = {r.vec_id: r for r in embedding_dedup.vector_duplicates(vectors(spark, rows)).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    own = np.append(unit @ (np.ones(8) / np.sqrt(8)) >= 0.95, False)[:-1]
    assert [out[10 + k].n_links for k in range(len(x))] == [int(n.sum() - 1 + own[k]) for k, n in enumerate(near)]
    assert all((out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True) for i in (1, 2, 3, 4, 5, 7))
    assert embedding_dedup.vector_duplicates(vectors(spark, [])).count() == 0


def test_pairs_are_found_beside_a_large_group(spark):
    draw = np.random.default_rng(2)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    hot = unit(unit(draw.normal(size=(1, 16))) + 0.001 * draw.normal(size=(3000, 16)))
    one = unit(draw.normal(size=(600, 16)))
    side = draw.normal(size=(600, 16))
    other = 0.955 * one + np.sqrt(1 - 0.955 ** 2) * unit(side - (side * one).sum(1, keepdims=True) * one)
    x = np.concatenate([one, other, hot, unit(draw.normal(size=(4800, 16)))]).astype(np.float32)
    out = {r.vec_id: r.n_links for r in embedding_dedup.vector_duplicates(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)])).collect()}
    assert sum(out[k] == 0 for k in range(1200)) <= 6
    assert all(out[k] >= 2999 for k in range(1200, 4200))


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    x = np.round(draw.normal(size=(90, 8)) / 2, 1).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + ODD_VECTORS[:5] + [(None, [1.0] * 8)]
    out = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k.top_k(vectors(spark, rows), k=5, chunk=16, block=2).collect())
    ints = np.floor(64 * x.astype(float)).astype(int)
    expected = []
    for q in range(0, 90, 20):
        best = sorted((-int(ints[q] @ ints[c]), c) for c in range(90) if c != q)[:5]
        expected += [(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    assert out == expected
    assert top_k.top_k(vectors(spark, [])).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    draw = np.random.default_rng(8)
    base = [[f"w{x}" for x in draw.integers(0, 10**6, size=120)] for _ in range(12)]
    rows = []
    for k in range(150):
        words = list(base[k % 12])
        for _ in range(k % 4):
            words[draw.integers(len(words))] = f"n{draw.integers(10**6)}"
        rows.append((k, " ".join(words).upper() if k % 5 == 0 else "\n".join(words)))
    rows += [(500, None), (501, ""), (502, "  "), (503, "A b"), (504, "a B"), (503, "A b"), (None, "a b")]
    out = [tuple(r) for r in minhash_dedup.near_duplicates(docs(spark, rows), percent=85).collect()]
    sets = [frozenset(zip(*[(t or "").lower().split()[i:] for i in range(5)])) or frozenset([tuple((t or "").lower().split())] if (t or "").split() else []) for _, t in rows]
    parent = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                old, new = parent[a], parent[b]
                parent = [new if p == old else p for p in parent]
    ids = [min(rows[j][0] for j in range(len(rows)) if parent[j] == parent[k] and rows[j][0] is not None) for k in range(len(rows))]
    assert sorted(out, key=str) == sorted([(i, len(sets[k]), ids[k], i == ids[k]) for k, (i, _) in enumerate(rows)], key=str)
    one = minhash_dedup.keep_one_of_each(docs(spark, rows), percent=85)
    assert one.columns == docs(spark, []).columns and one.count() == len(set(p for k, p in enumerate(parent)))
    assert minhash_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_super_minhash_estimates_similarity():
    a, b = [f"x{k}" for k in range(600)], [f"x{k}" for k in range(60, 660)]
    doc, h = shingles([" ".join(a), " ".join(b)], 1)
    signature = super_minhash(doc, h, 2, 256)
    assert abs((signature[0] == signature[1]).mean() - 540 / 660) < 0.08
    small = super_minhash(*shingles(["p q"], 1), 1, 64)
    assert np.isfinite(small).all() and set(np.floor(small[0])) <= set(range(64))


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, None), (None, ""), (2, "word " * 3000), (2, "word " * 3000), (3, "x" * 100_000), (4, "a <|endoftext|> b"), (5, "é ü" * 300)]
    rows += [(10 + k, "some words " * (k * 7 % 200)) for k in range(60)]
    out = packing.pack_documents(docs(spark, rows), VOCABULARY, group_size=16).collect()
    expected = []
    for i, text in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        expected += [(i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out], key=str) == sorted(expected, key=str)
    filled = {}
    for r in sorted(out, key=lambda r: r.offset):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024
    assert packing.pack_documents(docs(spark, []), VOCABULARY).count() == 0


def test_packing_takes_very_long_runs_of_blanks(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, " " * 2_000_000), (2, "a" + "\n" * 1_100_000 + "<|endoftext|> b"), (3, "a b")]
    out = packing.pack_documents(docs(spark, rows), VOCABULARY).orderBy("doc_id", "piece").collect()
    for i, text in rows:
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [2], "<u4")
        pieces = [(r.start, r.length, r.ids_crc32) for r in out if r.doc_id == i]
        assert pieces[-1][0] + pieces[-1][1] == len(ids)
        assert all(zlib.crc32(ids[a:a + n].tobytes()) == crc for a, n, crc in pieces)


def test_local_search_empties_bins():
    lengths = [600, 600, 600, 424, 300, 124, 400, 24]
    bins = packing.pack(lengths, 1024)
    assert sorted(i for b in bins for i in b) == list(range(8)) and len(bins) == 3
    start = [[0, 3], [1, 4], [2, 5, 7], [6]]
    free = [1024 - sum(lengths[i] for i in b) for b in start]
    assert len([b for b in packing._local_search(start, free, lengths, 1024, 40) if b]) == 3


@pytest.mark.parametrize("low, high, most", [(260, 420, 704), (250, 520, 808)])
def test_local_search_goes_on_where_the_emptiest_bin_is_stuck(low, high, most):
    lengths = np.random.default_rng(1).integers(low, high + 1, 2000).tolist()
    bins = packing.pack(lengths, 1024)
    assert sorted(i for b in bins for i in b) == list(range(2000)) and max(sum(lengths[i] for i in b) for b in bins) <= 1024
    assert len(bins) <= most


def test_mix_targets_and_odd_rows(spark):
    rows = [(k, "w " * (k % 50 + 1), "en", "abc"[k % 3] if k % 7 else None) for k in range(3000)] + ODD
    out = mixing.mix_sources(docs(spark, rows))
    table = {r.source_size: (r.target, r.taken) for r in out.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()}
    total = sum(table)
    assert abs(sum(t for t, _ in table.values()) - 1.5 * total) < 1e-6 * total
    assert all(0 <= target - taken <= 100_050 * 2 and target <= 2 * size for size, (target, taken) in table.items())
    assert out.where("taken > 2 * size").count() == 0 and out.count() == len(rows)
    taken = mixing.take_mix(docs(spark, rows))
    assert taken.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == out.agg(F.sum("taken")).first()[0]
    assert mixing.mix_sources(docs(spark, [])).count() == 0


def test_revisits_with_odd_headers_and_urls(spark):
    rows = [
        (1, "http://www.X.org:80/a/?utm_source=q&b=2&a=1#f", "2024-01-01 00:00:00", "response", 200, {"etag": "1", "server": "s"}, "body"),
        (2, "https://x.org/a?a=1&b=2", "2024-01-03 00:00:00", "revisit", 304, {"etag": "1", "date": "d", "server": "t"}, None),
        (3, "https://x.org/a?a=1&b=2", "2024-01-03 00:00:00", "revisit", 304, {"etag": "2"}, None), (4, None, None, "revisit", 304, None, None),
        (5, "https://x.org/a?a=1&b=2", "2024-01-02 00:00:00", "response", 404, None, "no"), (6, "https://x.org/a?b=2&a=1", "2023-12-31 00:00:00", "revisit", 304, None, None),
        (7, "https://x.org/a?a=1&b=2", "2024-01-01 10:00:00", "revisit", 304, None, None)]
    schema = "record_id long, url string, captured_at string, kind string, status int, headers map<string,string>, body string"
    data = spark.createDataFrame(rows, schema).withColumn("captured_at", F.col("captured_at").cast("timestamp_ntz"))
    out = {r.record_id: r for r in warc_revisits.resolve_revisits(data).collect()}
    assert {k: r.outcome for k, r in out.items()} == {2: "resolved", 3: "mismatch", 4: "no_response", 6: "no_response", 7: "unchecked"}
    assert out[2].headers == {"etag": "1", "date": "d", "server": "s"} and (out[2].body, out[3].body) == ("body", None)
    assert warc_revisits.resolve_revisits(data.limit(0)).count() == 0


def test_revisits_with_null_and_repeated_ids_and_times(spark):
    url, full = "http://x.org/a", ("response", 200, {"etag": "1"})
    rows = [(1, url, "2024-01-01 00:00:00", *full, "old"), (3, url, "2024-01-02 00:00:00", *full, "new"), (None, "http://y.org", None, *full, "no id")]
    rows += [(1, url, "2024-01-01 00:00:00", *full, "old")] * 2
    rows += [(2, url, "2024-01-01 05:00:00", "revisit", 304, {"etag": "1"}, None)] * 3
    rows += [(None, url, None, "revisit", 304, None, None), (None, "http://y.org/", None, "revisit", 304, {"etag": "1"}, None), (8, None, None, "revisit", 304, None, None)]
    schema = "record_id long, url string, captured_at string, kind string, status int, headers map<string,string>, body string"
    data = spark.createDataFrame(rows, schema).withColumn("captured_at", F.col("captured_at").cast("timestamp_ntz")).coalesce(1)
    out = sorted(((r.record_id, r.canonical_url, r.response_id, r.outcome, r.body) for r in warc_revisits.resolve_revisits(data).collect()), key=str)
    assert out == sorted([(2, "x.org/a", 1, "resolved", "old")] * 3 + [
        (None, "x.org/a", 3, "unchecked", "new"), (None, "y.org", None, "resolved", "no id"), (8, None, None, "no_response", None)], key=str)


def test_revisits_of_null_and_repeated_pages_equal_the_sql(spark, tmp_path):
    import duckdb

    pages = [(k, f"http://x.org/{k % 7}", f"<p>{k}</p>") for k in range(40)] + [(5, "http://x.org/5", "<p>5</p>")] * 3
    pages += [(None, "http://x.org/1", "<p>n</p>"), (None, None, None), (41, None, "<p>u</p>"), (42, "http://x.org/2", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = [tuple(r) for r in warc_revisits.revisit_report(warc_revisits.page_captures(spark, str(tmp_path))).collect()]
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(out, key=str) == sorted(db.sql(warc_revisits.REVISIT_SQL).fetchall(), key=str)
