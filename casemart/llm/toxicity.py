"""Toxicity by multiple-instance learning: a text is a bag of sentences, and only the bag carries a label.

A sentence's probability is logistic in the terms it holds; a text's is the noisy-or of its sentences, 1 - prod(1 - p). The
weights are trained on labels of texts alone, through the noisy-or, so they say which sentences are to blame. Terms are
letter runs in lower case and their first 3 to 7 and last 4 to 6 bytes; the terms that tell labels apart best in the sample are kept.

Sentences end at `.`, `!`, `?` or a line break. Fitting uses a bounded sample (`toxic_rows`, `clean_rows`, `terms`);
scoring reads every whole text in one pass without a shuffle.

Edge cases. Null and empty texts have no sentence: score 0. Without both labels, every score is 0. Rows with
null or repeated ids each get a row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.labelled import held_out, labelled_sample
from casemart.llm.words import mix, split, split_batches

_CHUNK = 2 << 20
_PARTS = (("head", 3), ("head", 4), ("head", 5), ("head", 6), ("head", 7), ("tail", 4), ("tail", 5), ("tail", 6))
_OTHER = np.ones(256, dtype=bool)
_OTHER[97:123] = False
_OTHER[65:91] = False
_OTHER[128:] = False
_END = np.zeros(256, dtype=bool)
_END[list(b".!?\n")] = True
_BITS = 22
#: Nats of information about the sample's labels that a term must carry: with 10**5 terms none does by chance.
_SURE = 12.0


def _terms(words, f: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, fingerprints) of whole words, their beginnings and their ends."""
    yield np.arange(len(words)), f
    padded = np.concatenate([words.data, np.zeros(8, dtype=np.uint8)])
    loads = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
    length = words.end - words.start
    for number, (side, size) in enumerate(_PARTS, 1):
        at = np.flatnonzero(length >= size)
        where = words.start[at] if side == "head" else words.end[at] - size
        yield at, mix((loads[where] & np.uint64((1 << (8 * size)) - 1)) ^ np.uint64(number << 58))


def _split(texts):
    words = split(texts, lower=True, between=_OTHER)
    ends = np.flatnonzero(_END[words.data])
    return words, np.searchsorted(ends, words.start), ends


@dataclass
class ToxicityModel:
    """Sorted term fingerprints with their weights, and the weight of every sentence."""

    terms: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self._maybe: np.ndarray | None = None

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "bias": self.bias, "_maybe": None}

    def sentences(self, texts: list[str | None]):
        """Of the sentences with at least one known term: text, number of the sentence, sum of weights; and the split texts."""
        if self._maybe is None:
            self._maybe = np.zeros(1 << _BITS, dtype=bool)
            self._maybe[self.terms >> np.uint64(64 - _BITS)] = True
        words, sentence, ends = _split(texts)
        at, weight = [], []
        for numbers, h in _terms(words, words.fingerprints()):
            hit = np.flatnonzero(self._maybe[h >> np.uint64(64 - _BITS)])
            place = np.minimum(np.searchsorted(self.terms, h[hit]), max(len(self.terms) - 1, 0))
            same = self.terms[place] == h[hit] if len(self.terms) else np.zeros(len(hit), dtype=bool)
            # a term counts once in a sentence
            pairs = np.unique(np.column_stack([sentence[numbers[hit[same]]], place[same]]), axis=0)
            at.append(pairs[:, 0])
            weight.append(self.weights[pairs[:, 1]])
        known, which = np.unique(np.concatenate(at), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate(weight), minlength=len(known))
        starts = np.concatenate([[0], ends + 1])[known]
        doc = np.searchsorted(words.text_at, starts, side="right") - 1
        return words, sentence, ends, known, doc, total

    def score(self, texts: list[str | None], spans: bool = False):
        """Noisy-or of each text; with `spans` also [start, end) characters of sentences at 0.5 or more."""
        words, sentence, ends, known, doc, total = self.sentences(texts)
        with_words = np.unique(sentence) if len(words) else np.zeros(0, np.int64)
        owner = np.searchsorted(words.text_at, np.concatenate([[0], ends + 1])[with_words], side="right") - 1
        plain = np.bincount(owner, minlength=len(texts)) - np.bincount(doc, minlength=len(texts))
        z = self.bias + total
        lost = np.bincount(doc, weights=np.logaddexp(0, z), minlength=len(texts)) + plain * np.logaddexp(0, self.bias)
        score = 1 - np.exp(-lost)
        found: list[list[list[int]]] = [[] for _ in texts]
        if spans:
            lead = (words.data & 0xC0) != 0x80
            bounds = np.concatenate([[0], ends + 1, [len(words.data)]])
            for k in np.flatnonzero(z >= 0):
                d, base = int(doc[k]), words.text_at[doc[k]]
                a, b = bounds[known[k]], min(bounds[known[k] + 1], words.text_at[d + 1] - 1)
                begin = int(lead[base:a].sum())
                found[d].append([begin, begin + int(lead[a:b].sum())])
        return score, found

    def map(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, text) to (id, score, offending sentences)."""
        kind = pa.list_(pa.list_(pa.int32()))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in split_batches(texts, _CHUNK):
                score, found = self.score(texts[a:b], spans=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score), pa.array(found, kind)],
                                                 names=["id", "score", "sentences"])


def _choose_terms(toxic: list[str], clean: list[str], terms: int, support: int) -> np.ndarray:
    """The terms whose presence in texts tells most about the label, in `support` texts at least."""
    def in_texts(texts: list[str]) -> Iterator[np.ndarray]:
        """Terms of one chunk after the other, once for each text that has them."""
        for a, b in split_batches(texts, _CHUNK):
            words = split(texts[a:b], lower=True, between=_OTHER)
            for numbers, h in _terms(words, words.fingerprints()):
                yield h[np.unique(mix(h) ^ mix(words.doc[numbers].astype(np.uint64)), return_index=True)[1]]

    h, n1 = np.zeros(0, np.uint64), np.zeros(0)
    for part in in_texts(toxic):
        h, which = np.unique(np.concatenate([h, part]), return_inverse=True)
        n1 = np.bincount(which, weights=np.concatenate([n1, np.ones(len(part))]), minlength=len(h))
    h, n1 = h[n1 >= support], n1[n1 >= support]
    n0 = np.zeros(len(h))
    for part in in_texts(clean) if len(h) else ():
        place = np.minimum(np.searchsorted(h, part), len(h) - 1)
        n0 += np.bincount(place[h[place] == part], minlength=len(h))

    def entropy(a, b):
        p = np.clip(a / np.maximum(a + b, 1), 1e-12, 1 - 1e-12)
        return -(a + b) * (p * np.log(p) + (1 - p) * np.log(1 - p))

    gain = entropy(len(toxic), len(clean)) - entropy(n1, n0) - entropy(len(toxic) - n1, len(clean) - n0)
    telling = (n1 / len(toxic) > 3 * n0 / len(clean)) & (gain > _SURE)
    best = np.lexsort((h, -np.where(telling, gain, -np.inf)))[:terms]
    return np.sort(h[best[telling[best]]])


def train_toxicity(docs: DataFrame, labels: DataFrame, toxic_rows: int = 2500, clean_rows: int = 4000, terms: int = 600,
                   support: int = 4, steps: int = 300, penalty: float = 1e-4) -> ToxicityModel:
    """A model from at most `toxic_rows` and `clean_rows` texts of rows that aren't held out, over at most `terms` terms."""
    sample, _ = labelled_sample(docs, labels, "toxic", {1: toxic_rows, 0: clean_rows})
    return fit_noisy_or(sample[1], sample[0], terms, support, steps, penalty)


def fit_noisy_or(toxic: list[str], clean: list[str], terms: int = 600, support: int = 4, steps: int = 300,
                 penalty: float = 1e-4) -> ToxicityModel:
    """Weights that maximise the likelihood of the labels of whole texts."""
    nothing = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    if not toxic or not clean:
        return nothing
    chosen = _choose_terms(toxic, clean, terms, support)
    if not len(chosen):
        return nothing
    texts = toxic + clean
    label = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    bags, columns, owner, plain, so_far = [], [], [], [], 0
    for a, b in split_batches(texts, _CHUNK):
        words, sentence, _ = _split(texts[a:b])
        rows, cols = [], []
        for numbers, h in _terms(words, words.fingerprints()):
            place = np.minimum(np.searchsorted(chosen, h), len(chosen) - 1)
            hit = np.flatnonzero(chosen[place] == h)
            rows.append(sentence[numbers[hit]])
            cols.append(place[hit])
        pairs = np.unique(np.column_stack([np.concatenate(rows), np.concatenate(cols)]), axis=0)
        of_sentence = np.zeros(int(sentence[-1]) + 1 if len(sentence) else 1, dtype=np.int64)
        of_sentence[sentence] = words.doc
        known, which = np.unique(pairs[:, 0], return_inverse=True)
        bags.append(which + so_far)
        columns.append(pairs[:, 1])
        owner.append(of_sentence[known] + a)
        every = np.unique(sentence)
        plain.append(np.bincount(of_sentence[every], minlength=b - a) - np.bincount(of_sentence[known], minlength=b - a))
        so_far += len(known)
    bags, columns, owner, plain = map(np.concatenate, (bags, columns, owner, plain))
    w, bias = np.zeros(len(chosen)), -7.0
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    # sentences without any known term must not make a long text toxic: together they may add 0.05 at most
    sentences = plain + np.bincount(owner, minlength=len(texts))
    highest = np.log(0.05 / max(float(np.quantile(sentences, 0.99)), 1.0))
    balance = np.where(label == 1, 0.5 / len(toxic), 0.5 / len(clean))
    for step in range(1, steps + 1):
        z = bias + np.bincount(bags, weights=w[columns], minlength=so_far)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
        lost = np.bincount(owner, weights=np.logaddexp(0, z), minlength=len(texts)) + plain * np.logaddexp(0, bias)
        none = np.exp(-lost)
        pull = balance * np.where(label == 1, -none / np.maximum(1 - none, 1e-9), 1.0)
        of_bag = pull[owner] * p
        gradient = np.append(np.bincount(columns, weights=of_bag[bags], minlength=len(w)) + penalty * w / len(w),
                             of_bag.sum() + (pull * plain).sum() * p0)
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        move = 0.08 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
        w, bias = w - move[:-1], min(bias - move[-1], highest)
    return ToxicityModel(chosen, w, float(bias))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences ([start, end) in characters) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(model.map, f"doc_id {kind}, score double, sentences array<array<int>>")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), F.col("sentences").alias("offending"))
