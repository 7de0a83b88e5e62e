"""The quality model learns from every labelled text that isn't held out."""

import zlib

import numpy as np

from casemart.llm import quality
from casemart.llm.storage import Scratch


def test_moments_and_cut_are_of_all_texts(spark):
    draw = np.random.default_rng(3)
    words = np.array(["tree", "House", "is", "42", "!!", "||", "$$", "river.", "AND"])
    texts = [" ".join(draw.choice(words[: 9 if n % 2 else 6], size=draw.integers(4, 12))) for n in range(8_200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(n, n % 2) for n in range(len(texts))], "doc_id long, quality int")
    model = quality.train_quality(docs, labels)
    used = [n for n in range(len(texts)) if zlib.crc32(str(n).encode()) % 5]
    zeros = sum(n % 2 == 0 for n in used)
    assert zeros > 3_000 and len(used) - zeros > 3_000
    x = quality.features([texts[n] for n in used])
    assert np.allclose(model.mean, x.mean(0), atol=1e-12)
    raw = np.sort(((x - model.mean) / model.scale) @ model.weights)
    assert np.isclose(model.cut, (raw[zeros - 1] + raw[zeros]) / 2, atol=1e-9)
    again = quality.train_quality(docs, labels)
    assert np.array_equal(again.weights, model.weights) and again.cut == model.cut


def test_cut_with_ties_and_rare_labels(spark):
    values = [0.5] * 70 + [0.25, 0.75, 0.75 + 1e-12] + [-3.0] * 4
    scores = spark.createDataFrame([(0, v) for v in values], "label int, raw double")
    ordered = sorted(values)
    for rank in (1, 4, 5, 6, 75, 76):
        assert quality._cut_after(scores, rank, min(values), max(values)) == (ordered[rank - 1] + ordered[rank]) / 2
    rows = [(n, int(n == 7), quality.features(["good tree here" if n == 7 else f"$$ {n} ||"])[0].tobytes()) for n in range(1_500)]
    stored = spark.createDataFrame(rows, "id long, label int, x binary")
    model = quality.fit_bradley_terry(stored, Scratch(spark, "test"), 0.3)
    score = model.score(quality.features(["good tree here", "$$ 12 ||"]))
    assert score[0] >= 0.3 > score[1]
