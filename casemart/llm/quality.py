"""Quality scores from pairwise preferences (Bradley-Terry), cut at a quantile of the scores.

A preference pair says that a text labelled 1 is better than one labelled 0. Each text is a vector of shares and means (of symbols,
capitals, digits, repeated words and so on). Weights minimise the logistic loss of feature differences over pairs. The
cut is the quantile of the labelled scores at the share of label 0; `score` is a logistic curve through that cut.

Every labelled text that isn't held out is learned from. Texts become feature rows where they are read; rows are dealt into blocks of about 512 by a hash of
their id, and all pairs inside of a block count, so each text is compared with hundreds of the other label (texts of a rare label stand in several blocks).
Newton steps sum gradients and Hessians over stored blocks; the cut is an exact order statistic of all scores, found by narrowing histograms. Only sums
come to the driver, one row for each task. Scoring reads every whole text in one pass without a shuffle.

Edge cases. Null and empty texts count as no words and are scored as such. Without both labels, every score
is 0.5. Rows with null or repeated ids each get a row; of the texts of a repeated id, one teaches. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.labelled import held_out, usable_labels
from casemart.llm.storage import Scratch
from casemart.llm.words import mix, sequences, split, split_batches

_CHUNK = 2 << 20
_KIND = np.zeros(256, dtype=np.int64)  # 0: everything else
for _n, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"!", b"|", b"*$%&#@~^=<>_{}[]\\/+`"), 1):
    _KIND[list(_bytes)] = _n
_KINDS = 7


def features(texts: list[str | None]) -> np.ndarray:
    """One row for each text: shares of characters and words, each between 0 and about 1."""
    words = split(texts)
    n_texts = len(texts)
    f = words.fingerprints()
    sizes = np.diff(words.text_at) - 1
    text_of_byte = np.repeat(np.arange(n_texts, dtype=np.int64), sizes + 1)
    kinds = np.bincount(text_of_byte * _KINDS + _KIND[words.data], minlength=n_texts * _KINDS).reshape(n_texts, _KINDS)
    count = np.diff(words.first)
    safe_bytes, safe = np.maximum(sizes, 1), np.maximum(count, 1)

    def per_text(values: np.ndarray, at: np.ndarray = words.doc) -> np.ndarray:
        return np.bincount(at, weights=values, minlength=n_texts)

    length = words.end - words.start
    last = _KIND[words.data[words.end - 1]] if len(words) else np.zeros(0, np.int64)
    again = np.zeros(len(words))
    again[1:] = (f[1:] == f[:-1]) & (words.doc[1:] == words.doc[:-1])

    def distinct(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        order = np.argsort(mix(h ^ (doc.astype(np.uint64) << np.uint64(40))))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        return np.bincount(doc[new], minlength=n_texts)

    runs = sequences(f, 4)
    within = words.doc[:len(runs)] == words.doc[3:] if len(runs) else np.zeros(0, dtype=bool)
    run_count = np.bincount(words.doc[:len(runs)][within], minlength=n_texts)
    shares = [kinds[:, k] / safe_bytes for k in range(1, _KINDS)]
    shares += [
        np.minimum(per_text(length) / safe, 20) / 20, np.minimum(length_max(length, words.doc, n_texts), 100) / 100,
        per_text(last >= 4) / safe, per_text(again) / safe,
        1 - distinct(f, words.doc) / safe, 1 - distinct(runs[within], words.doc[:len(runs)][within]) / np.maximum(run_count, 1),
        np.minimum(np.log1p(count) / 10, 1), (count == 0).astype(float), (count < 5).astype(float),
    ]
    return np.column_stack(shares)


def length_max(length: np.ndarray, doc: np.ndarray, n_texts: int) -> np.ndarray:
    """The longest word of each text."""
    out = np.zeros(n_texts, dtype=np.int64)
    np.maximum.at(out, doc, length)
    return out


def _all_features(texts: list[str]) -> np.ndarray:
    return np.concatenate([features(texts[a:b]) for a, b in split_batches(texts, _CHUNK)])


@dataclass
class QualityModel:
    """Weights over standardised features, the cut of their sum, and the slope and level of the curve through it."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    level: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.mean) / self.scale) @ self.weights
        z = np.log(self.level / (1 - self.level)) + self.slope * (raw - self.cut)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def map(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, text) to (id, score)."""
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in split_batches(texts, _CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(self.score(features(texts[a:b])))], names=["id", "score"])


def _constant(width: int) -> QualityModel:
    return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0, 0.5)


_BLOCK = 512
_RARE = 64
_SLOPES = 40


class _Featurer:
    """(id, text) to (id, features as bytes)."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in split_batches(texts, _CHUNK):
                rows = [row.tobytes() for row in features(texts[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.binary())], names=["id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def _one_row(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.tolist()], pa.list_(pa.float64()))], names=["sums"])


def _total(rows: DataFrame, per_task) -> np.ndarray:
    """The sum of what the tasks return, one row each, added in order of their values so that reruns agree."""
    found = sorted(row["sums"] for row in rows.mapInArrow(per_task, "sums array<double>").collect())
    return np.sum(np.array(found), axis=0)


class _Moments:
    """Sums of features and of their squares over each text once."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * features([""]).shape[1])
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                total += np.concatenate([x.sum(0), (x * x).sum(0)])
        yield _one_row(total)


class _Pairs:
    """Loss, number of pairs, gradient and Hessian over all pairs of each block; rows come by block."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def of_block(self, label: np.ndarray, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        better, worse = x[label == 1], x[label == 0]
        z = (better @ self.weights)[:, None] - (worse @ self.weights)[None, :]
        wrong = 1 / (1 + np.exp(np.clip(z, -30, 30)))
        curve = wrong * (1 - wrong)
        gradient = worse.T @ wrong.sum(0) - better.T @ wrong.sum(1)
        crossed = better.T @ (curve @ worse)
        hessian = better.T @ (better * curve.sum(1)[:, None]) + worse.T @ (worse * curve.sum(0)[:, None]) - crossed - crossed.T
        return np.concatenate([[np.logaddexp(0, -z).sum(), z.size], gradient, hessian.ravel()])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(self.mean)
        total, now, held = np.zeros(2 + width + width * width), None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            block, label, x = batch.column("block").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("x"))
            bounds = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for a, b in zip(bounds, bounds[1:]):
                if block[a] != now and held:
                    total += self.of_block(*(np.concatenate(part) for part in zip(*held)))
                    held = []
                now = block[a]
                held.append((label[a:b], x[a:b]))
        if held:
            total += self.of_block(*(np.concatenate(part) for part in zip(*held)))
        yield _one_row(total)


class _RawScores:
    """Rows of features to (label, raw)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = ((_matrix(batch.column("x")) - self.mean) / self.scale) @ self.weights
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(raw)], names=["label", "raw"])


class _Losses:
    """The loss of every slope."""

    def __init__(self, cut: float, start: float, slopes: np.ndarray):
        self.cut, self.start, self.slopes = cut, start, slopes

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(self.slopes))
        for batch in batches:
            sign, raw = 1 - 2 * batch.column("label").to_numpy(), batch.column("raw").to_numpy()
            total += [np.logaddexp(0, sign * (self.start + k * (raw - self.cut))).sum() for k in self.slopes]
        yield _one_row(total)


def _cut_after(scores: DataFrame, rank: int, low: float, high: float, bins: int = 1024) -> float:
    """The middle between the `rank`-th smallest score and the next one. Every round keeps one bin of the last."""
    before = 0
    while low < high:
        place = F.least(F.floor((F.col("raw") - low) / (high - low) * bins), F.lit(bins - 1))
        counted = scores.where(F.col("raw").between(low, high)).groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))
        for row in counted.orderBy("bin").collect():
            if before + row["n"] >= rank:
                break
            before += row["n"]
        low, high = row["low"], row["high"]
    known = scores.agg(F.count_if(F.col("raw") <= low).alias("n"), F.min(F.when(F.col("raw") > low, F.col("raw"))).alias("above")).first()
    return low if known["n"] > rank or known["above"] is None else (low + known["above"]) / 2


def fit_bradley_terry(rows: DataFrame, scratch: Scratch, level: float, steps: int = 12, penalty: float = 1e-3) -> QualityModel:
    """Weights from all pairs of a block, the cut and slope from the scores of all rows (`id, label, x`, stored)."""
    width = features([""]).shape[1]
    counts = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return _constant(width)
    total = sum(counts.values())
    sums = _total(rows.select("x"), _Moments())
    mean = sums[:width] / total
    scale = np.sqrt(np.maximum(sums[width:] / total - mean * mean, 0)) + 1e-6

    blocks = -(-total // _BLOCK)
    copies = {label: min(blocks, -(-_RARE * blocks // count)) for label, count in counts.items()}
    many = F.when(F.col("label") == 1, copies[1]).otherwise(copies[0])
    number = F.explode(F.sequence(F.lit(0), many - 1)).alias("number")
    placed = rows.select("label", "x", F.xxhash64("id", F.lit("quality")).alias("hash"), many.alias("many"), number)
    block = F.pmod(F.pmod("hash", F.lit(blocks)) + F.floor(F.col("number") * blocks / F.col("many")), F.lit(blocks)).cast("long")
    placed = placed.select(block.alias("block"), "label", "x").repartition("block").sortWithinPartitions("block", "label", "x")
    placed = scratch.store(placed, "blocks")

    w, best, least = np.zeros(width), np.zeros(width), np.inf
    step = np.zeros(width)
    for _ in range(steps):
        found = _total(placed, _Pairs(mean, scale, w))
        if not found[1]:
            return _constant(width)
        loss = found[0] / found[1] + penalty / 2 * w @ w
        if loss > least:  # too far
            step = step / 2
            w = best + step
            continue
        done = least - loss < 1e-9
        best, least = w, loss
        if done:
            break
        gradient = found[2:2 + width] / found[1] + penalty * w
        hessian = found[2 + width:].reshape(width, width) / found[1] + penalty * np.eye(width)
        step = -np.linalg.solve(hessian, gradient)
        w = best + step
    scores = scratch.store(rows.select("label", "x").mapInArrow(_RawScores(mean, scale, best), "label int, raw double"), "scores")
    ends = scores.agg(F.min("raw").alias("low"), F.max("raw").alias("high"), F.stddev_pop("raw").alias("spread")).first()
    cut = _cut_after(scores, counts[0], ends["low"], ends["high"])
    slopes = np.geomspace(0.05, 20, _SLOPES) / (ends["spread"] + 1e-9)
    loss = _total(scores, _Losses(cut, np.log(level / (1 - level)), slopes))
    scratch.drop("blocks", "scores")
    return QualityModel(mean, scale, best, float(cut), float(slopes[int(np.argmin(loss))]), level)


def train_quality(docs: DataFrame, labels: DataFrame, level: float = 0.3) -> QualityModel:
    """A model from the texts of all rows that have a label and aren't held out. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "quality")
    kind = docs.schema["doc_id"].dataType.simpleString()
    teaching = docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")).select(F.col("doc_id").alias("id"), "text")
    found = teaching.mapInArrow(_Featurer(), f"id {kind}, x binary").join(usable_labels(labels, "quality", [0, 1]), "id")
    rows = scratch.store(found.groupBy("id", "label").agg(F.min("x").alias("x")), "rows")
    model = fit_bradley_terry(rows, scratch, level)
    scratch.drop("rows")
    return model


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from `threshold` on) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(model.map, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that reach `threshold`, with all their columns."""
    at = docs.columns.index("text")

    def good(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in split_batches(texts, _CHUNK):
                yield batch.slice(a, b - a).filter(pa.array(model.score(features(texts[a:b])) >= threshold))

    return docs.mapInArrow(good, docs.schema)
