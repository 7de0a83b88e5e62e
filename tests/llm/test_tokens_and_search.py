"""Lexical search, alignment of tokenizers and byte-level BPE against brute force, with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casemart.llm import alignment, byte_bpe, lexical

DOCS = "doc_id long, text string, item string, rank int, score double, ids string, decoded string, chunk long, pairs string, doc_ids string, terms int"
RANKS, JSON, PIECES = (public_tokenizers.path(name) for name in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [(1, None), (None, ""), (2, " \n\t "), (2, " \n\t "), (3, "ü" * 200_000), (4, "a b c d e f " * 20_000), (4, "a b c d e f " * 20_000), (5, "one Two"),
       (None, "Two two"), (6, "<|endoftext|> <s>▁ <0x41>"), (7, "x\x00y\x85z\x1c ")]
PARTS = ["a", "b", "the", " ", "  ", "\n", "é", "漢", "🙂", "1", "23", "'s", "'ll", "_", "-", "ü", "͸", "\x1c", "\x85", "ing", "er", "tion", "=", "==", "▁", "𐐀", "ⅷ"]


def docs(spark, rows):
    return spark.createDataFrame([(*row, *[None] * 9) for row in rows], DOCS)


def mixed(count, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randrange(40))) for _ in range(count)]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.byte_bpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_pairs_follow_each_other_as_merging_says(bpe):
    draw, tokens = random.Random(4), list(bpe.ids)
    runs = [t for t in tokens if len(set(t)) == 1]
    for k in range(6000):
        a, b = (draw.choice(runs), draw.choice(runs)) if k % 2 else (draw.choice(tokens), draw.choice(tokens))
        assert bpe.follows[a, b] == (bpe.merged(a + b) == [a, b]), (a, b)


def test_ids_equal_the_tokenizer_library(bpe, plain):
    draw = random.Random(5)
    anywhere = ["".join(chr(draw.choice([draw.randrange(0x250), draw.randrange(0xD800), draw.randrange(0xE000, 0x110000)])) for _ in range(50)) for _ in range(400)]
    letters = ["".join(draw.choice("abcdeinrst") for _ in range(n)) for n in (3, 99, 100, 101, 5000, 60_000)]
    for text in mixed(2000, 1) + anywhere + letters:
        ids = bpe.encode(text)
        assert ids.tolist() == plain.encode_ordinary(text), text[:80]
        assert bpe.decode(ids) == text.encode()


def test_a_vocabulary_whose_ranks_do_not_rise(tmp_path):
    import base64
    import tiktoken

    draw = random.Random(6)
    ranks = {bytes([b]): b for b in range(256)}
    for n, word in enumerate(sorted({"".join(draw.choice("ab") for _ in range(draw.randrange(2, 7))) for _ in range(60)}, key=lambda w: hashlib.md5(w.encode()).digest())):
        ranks[word.encode()] = 256 + n
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(token) + b" %d" % rank for token, rank in ranks.items()))
    own, theirs = byte_bpe.ByteBpe(str(path), public_tokenizers.PATTERN), tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert not all(own.rising[t] for t in own.ids)
    for _ in range(800):
        text = "".join(draw.choice("ab") for _ in range(draw.randrange(1, 30)))
        assert own.encode(text).tolist() == theirs.encode_ordinary(text), text


def test_encoding_report_of_odd_rows(spark, bpe, plain):
    rows = ODD + [(20 + k, text) for k, text in enumerate(mixed(60, 2))] + [(99, " " * 1_500_000 + "a")]
    out = byte_bpe.encoding_report(docs(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    assert [r.doc_id for r in out] == [i for i, _ in rows]
    for row, (_, text) in zip(out, rows):
        ids = bpe.encode(text or "").tolist() if len(text or "") > 10**6 else plain.encode_ordinary(text or "")
        assert row[1:] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert byte_bpe.encoding_report(docs(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def aligned(text):
    """Figures of one text, and its links by pair of ids, by definition."""
    from tokenizers import Tokenizer

    a_side, b_side = aligned.sides = getattr(aligned, "sides", None) or (Tokenizer.from_file(JSON), alignment.PieceSide(PIECES))
    a_side.encode_special_tokens = True
    table = aligned.table = getattr(aligned, "table", None) or alignment.ByteSide(JSON).bytes_of
    whole = " " + (text or "")
    a, b = a_side.encode(whole, add_special_tokens=False).ids, b_side.encode([text or ""])[0]
    if not text or any(b"".join(of[i] for i in ids) != whole.encode() for of, ids in ((table, a), (b_side.bytes_of, b))):
        return (0, 0, 0, 0, ""), Counter()
    ends_a, ends_b = np.cumsum([len(table[i]) for i in a]).tolist(), np.cumsum([len(b_side.bytes_of[i]) for i in b]).tolist()
    links, written, i, j = Counter(), [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        left, right = a[i:ends_a.index(end) + 1], b[j:ends_b.index(end) + 1]
        i, j = i + len(left), j + len(right)
        links.update((x, y) for x in left for y in right)
        written.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
    return (len(a), len(b), len(written), links.total(), hashlib.sha256(";".join(written).encode()).hexdigest()), links


def test_alignment_equals_brute_force(spark):
    rows = [row for row in ODD if len(row[1] or "") < 1000] + [(20 + k, text) for k, text in enumerate(mixed(150, 3))] + [(500, "words and more words " * 40)] * 2
    out = alignment.alignment_report(docs(spark, rows).repartition(3), JSON, PIECES, chunk=600).collect()
    found = [aligned(text) for _, text in rows]
    held = Counter(pair for _, links in found for pair in links)
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    expected = [(i, *figures[:4], sum(t for p, t in links.items() if held[p] == most[p[0]]), sum(t * held[p] for p, t in links.items()), figures[4])
                for (i, _), (figures, links) in zip(rows, found)]
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
    assert any(row[1] == 0 and row[0] == 6 for row in expected) and any(row[1] for row in expected)


def test_alignment_takes_long_texts_and_empty_tables(spark):
    long = docs(spark, [row for row in ODD if len(row[1] or "") >= 1000] + [(9, "0123456789" * 30_000)])
    out = alignment.alignment_report(long, JSON, PIECES).collect()
    assert len(out) == 4 and all(r.n_links >= r.n_groups > 0 and r.n_best <= r.n_links for r in out)
    assert alignment.alignment_report(docs(spark, []), JSON, PIECES).count() == 0
    assert {r.n_links for r in alignment.alignment_report(docs(spark, [(1, None), (2, "")]), JSON, PIECES).collect()} == {0}


def test_alignment_rows_stay_small_in_large_chunks():
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices("aeinorst", k=draw.randrange(1, 9))) for _ in range(600)) for _ in range(700)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([None, *range(1, len(texts))], pa.int64()), "text": pa.array(texts)})
    out = list(alignment._Chunks(JSON, PIECES, 2 << 20)(iter([batch.slice(0, 100), batch.slice(100)])))
    assert sum(map(len, texts)) > 2 << 20 and max(row.nbytes for row in out) < 1 << 20
    assert [i for row in out for i in row.column("doc_ids")[0].as_py()] == [None, *range(1, len(texts))]
    # a chunk goes on from batch to batch, and its parts share its distinct pairs
    chunks = Counter(row.column("chunk")[0].as_py() for row in out)
    assert list(chunks) == [0, 1] and chunks[0] > 10
    pairs = [p for row in out if row.column("chunk")[0].as_py() == 0 for p in row.column("pairs")[0].as_py()]
    assert pairs == sorted(set(pairs)) and max(max(row.column("links")[0].as_py(), default=0) for row in out[:chunks[0]]) < len(pairs)


def test_alignment_does_not_depend_on_parts(spark):
    rows = docs(spark, [row for row in ODD if len(row[1] or "") < 1000] + [(20 + k, text) for k, text in enumerate(mixed(150, 3))]).withColumn("doc_id", F.col("doc_id").cast("string"))
    sizes = [{"chunk": 1 << 20, "part": 1 << 20}, {"chunk": 6000, "part": 500}, {"chunk": 1, "part": 1}]
    whole, *cut = (sorted(map(tuple, alignment.alignment_report(rows.repartition(2), JSON, PIECES, **size).collect()), key=str) for size in sizes)
    assert [whole, whole] == cut and any(row[1] for row in whole)
    chunks, _ = alignment.align_documents(rows.coalesce(1), JSON, PIECES, **sizes[1])
    found = [row["count"] for row in chunks.groupBy("chunk").count().collect()]
    assert len(found) > 1 and max(found) > 5


def test_alignment_keeps_ids_of_other_types(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        stamped = docs(spark, [(1, "one two"), (2, None), (2, "three")]).selectExpr("timestamp_seconds(doc_id) AS doc_id", "text")
        out = alignment.alignment_report(stamped, JSON, PIECES)
        assert out.dtypes[0] == ("doc_id", "timestamp")
        assert sorted((r[0], r.n_a > 0) for r in out.selectExpr("unix_seconds(doc_id)", "n_a").collect()) == [(1, True), (2, False), (2, True)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_overlaps_join_both_directions():
    lengths = np.array([1, 2, 3, 4])
    a, b = alignment.token_frame([np.array([3, 1]), np.array([0])], lengths, "a"), alignment.token_frame([np.array([1, 2, 0]), np.array([0])], lengths, "b")
    met = alignment.overlaps(a, b)  # 4 + 2 bytes against 2 + 3 + 1 bytes, then one byte each
    assert list(zip(met["a"], met["b"])) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 3)]
    group_a, group_b, groups = alignment.groups_of(a, b)
    assert (group_a.tolist(), group_b.tolist(), groups) == ([0, 0, 1], [0, 0, 0, 1], 2)


def ranked(rows, items, k):
    """All scores by definition."""
    def split(text):
        return re.findall(lexical.SEPARATED, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counts = [Counter(split(text)) for _, text in rows]
    n_docs, n_terms = sum(bool(c) for c in counts), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for (i, _), c in zip(rows, counts):
            m = 50 + 50 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(split(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return out


@pytest.mark.parametrize("options", [{}, {"pass_terms": 30, "item_tile": 2, "doc_tile": 7, "tile_terms": 5}])
def test_lexical_search_equals_brute_force(spark, options):
    draw = random.Random(7)
    words = [f"{p}{n}" for n in range(40) for p in ("w", "É", "x-y")]
    rows = ODD + [(100 + k % 90, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 30)))) for k in range(120)] + [(300 + k, "W1 w2 the same") for k in range(30)]
    items = [(k, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 12)))) for k in range(20)]
    items += [(None, "w1 W1 w2"), (3, "w1 same"), (50, None), (51, " .,"), (52, "nowhere"), (53, "two a A ü" + "ü" * 199_999)]
    out = lexical.rank_documents(docs(spark, rows).repartition(3), docs(spark, items).withColumnRenamed("item", "x").withColumnRenamed("doc_id", "item_id"), k=12, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(ranked(rows, items, 12), key=str)


def test_lexical_search_of_empty_tables(spark):
    items = docs(spark, [(1, "a b")]).withColumnRenamed("doc_id", "item_id")
    assert lexical.rank_documents(docs(spark, []), items).count() == 0
    assert lexical.rank_documents(docs(spark, ODD), items.limit(0)).count() == 0
    assert lexical.rank_documents(docs(spark, [(1, None), (2, " ")]), items).count() == 0


def test_products_are_cut_below_the_exact_bound():
    weights = np.full(4096, 1 << 41, np.int64)
    tile = lexical.ItemTile([(0, np.arange(4096))], weights, 4096)
    assert all(len(own) == 1 or int(weights[own].sum()) * 10**6 < 1 << 53 for own, _ in tile.blocks)
    weights = np.full(4096, 1 << 30, np.int64)
    tile = lexical.ItemTile([(0, np.arange(4096)), (1, np.arange(0, 4096, 3))], weights, 4096)
    assert len(tile.blocks) > 1 and all(int(weights[own].sum()) * 10**6 < 1 << 53 for own, _ in tile.blocks)
    impact = np.full(4096, 999_983)
    assert tile.scores(np.zeros(4096, np.int64), np.arange(4096), impact, 1, 4096).tolist() == [[4096 * (1 << 30) * 999_983], [1366 * (1 << 30) * 999_983]]
