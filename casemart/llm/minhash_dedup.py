"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets, and connected components.

A text's set holds its distinct shingles of `words` words in lower case (A-Z); a text with fewer words is one shingle, one without words
has an empty set and is linked with nothing. Two texts are linked if 100 |A n B| >= `percent` |A u B|.

Method. SuperMinHash gives each shingle a random permutation of the signature's slots and puts r_j + j into the j-th of them;
a slot keeps its minimum. A value of round j is at least j, so a text is done as soon as every slot is filled
(early stopping: one or two rounds for long texts), and slots share their permutation, which makes them vary
less than independent ones. Equal bands of `rows` slots propose pairs; a pair is confirmed on the full shingle sets.

Scale. Equal texts are merged before all else. A bucket of equal bands never gives all its pairs: each member is compared
with the bucket's leader, the text that shares most buckets with others. Members outside of the leader's component are then compared with a leader
of their own, and at last with those members of other components to which set sizes, known distances and 512-byte sketches allow
a link. That last sifting goes over blocks of a bucket inside of tasks, and only pairs that pass leave them; members of large buckets that have too many
shingles of their own to be linked with anyone drop out before it, so families of one template don't cost their pairs. So groups of near copies
take about as many comparisons as they have members, and no proposed link between different texts is lost, but for a chance
of about one in a million where sketches differ by more than five standard deviations. Links, components and signatures stay in stored tables.

Edge cases. Null text counts as empty. Rows with equal ids and equal texts each get a row; component_id is the smallest id of
the component, null only if none of its rows has an id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.components import components, merged_components
from casemart.llm.storage import Scratch
from casemart.llm.texts import distinct_texts, text_key
from casemart.llm.words import chain, mix, sequences, split, split_batches

_CHUNK = 2 << 20
_GOLD = 0x9E3779B97F4A7C15
_BINS = 512
_BLOCK = 1024


def shingles(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, fingerprint) of the distinct shingles of all texts, by text."""
    w = split(texts, lower=True)
    f = w.fingerprints()
    runs = sequences(f, words)
    inside = w.doc[:len(runs)] == w.doc[words - 1:] if len(runs) else np.zeros(0, dtype=bool)
    doc, h = w.doc[:len(runs)][inside], runs[inside]
    count = np.diff(w.first)
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        whole = np.array([sequences(f[w.first[d]:w.first[d + 1]], int(count[d]))[0] for d in few], dtype=np.uint64)
        doc, h = np.concatenate([doc, few]), np.concatenate([h, whole])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def super_minhash(doc: np.ndarray, h: np.ndarray, texts: int, slots: int) -> np.ndarray:
    """Signatures, one row for each text; rows of texts without shingles stay infinite."""
    signature = np.full(texts * slots, np.inf)
    swaps: list[np.ndarray] = []
    for j in range(slots):
        u = mix(h + np.uint64((_GOLD * (j + 1)) & 0xFFFFFFFFFFFFFFFF))
        r = (u >> np.uint64(24)).astype(np.float64) / float(1 << 40)
        k = j + (((u & np.uint64(0xFFFFFF)) * np.uint64(slots - j)) >> np.uint64(24)).astype(np.int64)
        slot = k
        for s in range(j - 1, -1, -1):  # what the swaps so far have brought to place k
            slot = np.where(slot == swaps[s], s, np.where(slot == s, swaps[s], slot))
        np.minimum.at(signature, doc * slots + slot, r + j)
        open_ = np.isinf(signature.reshape(texts, slots)).any(axis=1)[doc]
        if not open_.any():
            break
        doc, h = doc[open_], h[open_]
        swaps = [x[open_] for x in swaps] + [k[open_]]
    return signature.reshape(texts, slots)


def sketches(doc: np.ndarray, h: np.ndarray, texts: int) -> np.ndarray:
    """One byte for each of `_BINS` bins of a text: of the smallest shingle that falls into it, 0 if none does."""
    u = mix(h + np.uint64(0x632BE59BD9B4E019))
    place = doc * _BINS + (u % np.uint64(_BINS)).astype(np.int64)
    least = np.full(texts * _BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, place, u)
    value = (1 + (least >> np.uint64(32)) % np.uint64(255)).astype(np.uint8)
    value[least == np.iinfo(np.uint64).max] = 0
    return value.reshape(texts, _BINS)


class _Signer:
    def __init__(self, words: int, bands: int, rows: int):
        self.words, self.bands, self.rows = words, bands, rows

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, text) to (key, n_shingles, bands, sketch)."""
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in split_batches(texts, _CHUNK):
                doc, h = shingles(texts[a:b], self.words)
                signature = super_minhash(doc, h, b - a, self.bands * self.rows).view(np.uint64).reshape(-1, self.rows)
                band = np.tile(np.arange(1, self.bands + 1, dtype=np.uint64), b - a) * np.uint64(_GOLD)
                for k in range(self.rows):
                    band = chain(band, signature[:, k])
                count = np.bincount(doc, minlength=b - a)
                offsets = np.concatenate([[0], np.cumsum(np.where(count > 0, self.bands, 0))]).astype(np.int32)
                values = band.view(np.int64).reshape(b - a, self.bands)[count > 0].ravel()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(count, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                     pa.array([row.tobytes() for row in sketches(doc, h, b - a)], pa.binary())],
                    names=["key", "n_shingles", "bands", "sketch"])


class _Verifier:
    def __init__(self, words: int, percent: int):
        self.words, self.percent = words, percent

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(u, v, text_u, text_v) to (u, v, linked, similarity); equal texts in a row are cut up once."""
        last_text, last_set = None, None
        for batch in batches:
            rows = batch.to_pydict()
            linked, similarity = [], []
            for begin, end in split_batches(rows["text_v"], _CHUNK):
                doc, h = shingles(rows["text_v"][begin:end], self.words)
                first = np.searchsorted(doc, np.arange(end - begin + 1))
                for k in range(begin, end):
                    if rows["text_u"][k] != last_text:
                        last_text = rows["text_u"][k]
                        last_set = shingles([last_text], self.words)[1]
                    other = h[first[k - begin]:first[k - begin + 1]]
                    if not len(other) or not len(last_set):
                        linked.append(False)
                        similarity.append(0.0)
                        continue
                    place = np.minimum(np.searchsorted(last_set, other), len(last_set) - 1)
                    both = int((last_set[place] == other).sum())
                    union = len(last_set) + len(other) - both
                    linked.append(100 * both >= self.percent * union)
                    similarity.append(both / union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), pa.array(similarity, pa.float64())],
                                             names=["u", "v", "linked", "similarity"])


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5, bands: int = 16, rows: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs`. Runs jobs; the result reads stored tables."""
    scratch = Scratch(docs.sparkSession, "minhash")
    texts = _groups(docs, scratch, percent, words, bands, rows)
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    named = scratch.store(keyed.join(texts, "key").drop("key"), "named")
    least = named.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    result = named.join(least, "component", "left").withColumn("component_id", component)
    return result.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one_of_each(docs: DataFrame, percent: int = 80, words: int = 5, bands: int = 16, rows: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id, with all columns; texts without words all stay."""
    scratch = Scratch(docs.sparkSession, "minhash")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    stored = scratch.store(docs.select(F.monotonically_increasing_id().alias("number"), whole.alias("row")), "numbered")
    numbered = stored.select("number", "row.doc_id", "row.text")
    texts = _groups(numbered, scratch, percent, words, bands, rows)
    keyed = numbered.select("number", "doc_id", text_key(F.col("text")).alias("key"))
    named = scratch.store(keyed.join(texts, "key").select("number", "doc_id", "n_shingles", "component"), "named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "number"))
    chosen = named.where("n_shingles > 0").groupBy("component").agg(first.alias("first")).select(F.col("first.number").alias("number"))
    chosen = scratch.store(chosen.unionAll(named.where("n_shingles = 0").select("number")), "chosen")
    kept = stored.join(chosen, "number", "left_semi")
    return kept.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def _groups(docs: DataFrame, scratch: Scratch, percent: int, words: int, bands: int, rows: int) -> DataFrame:
    """key, n_shingles and component of every distinct text."""
    texts = scratch.store(distinct_texts(docs), "texts").where("text IS NOT NULL").select("key", "text")
    signed = scratch.store(texts.mapInArrow(_Signer(words, bands, rows), "key binary, n_shingles bigint, bands array<bigint>, sketch binary"), "signed")
    member = signed.select("key", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = scratch.store(member.join(shared, "bucket"), "members")
    # a text that others were made from shares more buckets with them than they share with each other: it leads its buckets
    weight = members.groupBy("key").agg(F.sum("size").alias("weight"))
    weighed = members.join(weight, "key").select("bucket", "band", "size", "key", "n_shingles", "weight")
    lead = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "key")).alias("lead"))
    buckets = scratch.store(weighed.join(lead, "bucket").select("bucket", "band", "size", "key", "n_shingles", "weight", F.col("lead.key").alias("first")), "buckets")
    scratch.drop("members")

    verify = _Verifier(words, percent)

    def compare(pairs: DataFrame, table: str) -> DataFrame:
        of_v = pairs.join(texts.select(F.col("key").alias("v"), F.col("text").alias("text_v")), "v")
        both = of_v.join(texts.select(F.col("key").alias("u"), F.col("text").alias("text_u")), "u").select("u", "v", "text_u", "text_v")
        return scratch.store(both.mapInArrow(verify, "u binary, v binary, linked boolean, similarity double"), table)

    def links(compared: DataFrame) -> DataFrame:
        return compared.where("linked").select("u", "v")

    first = compare(buckets.where("key <> first").select(F.col("first").alias("u"), F.col("key").alias("v")).distinct(), "compared-1")
    label = scratch.store(components(links(first), scratch, "component-1"), "component-1-all")
    outside = scratch.store(_outside(buckets, label).where("own <> main"), "outside-1")
    lead = outside.groupBy("bucket").agg(F.max(F.struct("weight", "key")).alias("lead"))
    star = outside.join(lead, "bucket").select(F.col("lead.key").alias("u"), F.col("key").alias("v")).where("u <> v").distinct()
    second = compare(star.join(first, ["u", "v"], "left_anti"), "compared-2")
    label = merged_components(label, links(second), scratch, "component-2")
    mixed = scratch.store(_mixed(_outside(buckets, label), texts, words, percent), "mixed")
    crossing = _crossing(mixed, first, signed.select("key", "bands", "sketch"), percent)
    known = first.select("u", "v").unionAll(second.select("u", "v"))
    third = compare(crossing.join(known, ["u", "v"], "left_anti"), "compared-3")
    label = merged_components(label, links(third), scratch, "component-3")
    named = signed.select("key", "n_shingles").join(label.withColumnRenamed("node", "key"), "key", "left")
    groups = scratch.store(named.withColumn("component", F.coalesce("component", "key")), "groups")
    scratch.drop("texts", "signed", "buckets")
    return groups


def _outside(buckets: DataFrame, label: DataFrame) -> DataFrame:
    """Members of buckets with their own component and that of the bucket's first member."""
    of_member = label.select(F.col("node").alias("key"), F.col("component").alias("own"))
    of_first = label.select(F.col("node").alias("first"), F.col("component").alias("main"))
    named = buckets.join(of_member, "key", "left").join(of_first, "first", "left")
    return named.select("bucket", "band", "size", "first", "key", "n_shingles", "weight", F.coalesce("own", "key").alias("own"), F.coalesce("main", "first").alias("main"))


class _Shingler:
    def __init__(self, words: int):
        self.words = words

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, text) to one row for each distinct shingle."""
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in split_batches(texts, _CHUNK):
                doc, h = shingles(texts[a:b], self.words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(h.view(np.int64))], names=["key", "shingle"])


def _mixed(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Members of the buckets that hold several components, without those that no other member of a large bucket can be linked to.

    A bucket is large if more than `_BLOCK` of its members are outside of its first member's component: only their pairs can be many.
    Shingles that only one text of all large buckets holds can't be shared. If a text of s shingles has h others, two texts share at most c = min(h, h') of s + s' - c, so
    families that share a template and differ in the rest drop out whole, without a look at their pairs. Texts are
    compared as classes of s and h (steps of 2 %, the bound taken at the ends that allow more), of which a bucket has few.
    """
    outside = members.where("own <> main").groupBy("bucket").agg(F.count(F.lit(1)).alias("outside"))
    placed = members.join(outside, "bucket")
    large = placed.where(F.col("outside") > _BLOCK).drop("outside")
    held = texts.join(large.select("key").distinct(), "key").select("key", "text").mapInArrow(_Shingler(words), "key binary, shingle bigint")
    alone = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")).where("n = 1").groupBy("key").agg(F.count(F.lit(1)).alias("alone"))
    step, shared = float(np.log(1.02)), F.greatest(F.col("n_shingles") - F.coalesce("alone", F.lit(0)), F.lit(1))
    classed = large.join(alone, "key", "left").withColumns({
        "s": F.floor(F.log("n_shingles") / step), "h": F.floor(F.log(shared.cast("double")) / step)}).drop("alone")
    classes = classed.groupBy("bucket", "s", "h").agg(F.count(F.lit(1)).alias("n"))
    other = classes.select(F.col("bucket").alias("of"), F.col("s").alias("s2"), F.col("h").alias("h2"))
    most = F.exp((F.least("h", "h2") + 1) * step)
    least = F.exp(F.col("s") * step) + F.exp(F.col("s2") * step)
    can = (most * (100 + percent) * (1 + 1e-9) >= least * percent) & ((F.col("n") > 1) | (F.col("s") != F.col("s2")) | (F.col("h") != F.col("h2")))
    open_ = classes.join(other, F.col("bucket") == F.col("of")).where(can).select("bucket", "s", "h").distinct()
    left = classed.join(open_, ["bucket", "s", "h"], "left_semi").drop("s", "h", "size")
    sizes = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    return placed.where(F.col("outside") <= _BLOCK).drop("outside").unionByName(left.join(sizes, "bucket"))


def _crossing(members: DataFrame, star: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Pairs of a mixed bucket's members in different components that may still be linked.

    A link needs set sizes in proportion and, as 1 - similarity is a metric, about equal distances to the bucket's first member, which are known; and sketches
    must agree as much as linked texts do but for five standard deviations. Members meet in blocks of `_BLOCK`, and only pairs
    that pass all this leave the task, each in the first of the buckets that it shares.
    """
    distance = star.select(F.col("u").alias("first"), F.col("v").alias("key"), (1 - F.col("similarity")).alias("distance"))
    placed = members.join(distance, ["first", "key"], "left").join(signed, "key")
    blocks = F.ceil(F.col("size") / _BLOCK).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    paired = placed.withColumn("block", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = paired.select(
        "bucket", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "band", "key", "n_shingles", "own", "bands",
        "sketch", F.coalesce("distance", F.lit(0.0)).alias("distance"))
    return rows.groupBy("bucket", "low", "high").applyInArrow(_sifter(percent), "u binary, v binary")


def _sifter(percent: int):
    def sift(table: pa.Table) -> pa.Table:
        """Pairs of different components, of one block or between two, that pass all bounds."""
        share, band = percent / 100, table.column("band")[0].as_py()
        keys, own = table.column("key").to_pylist(), table.column("own").to_pylist()
        number = {name: k for k, name in enumerate(dict.fromkeys(own))}
        component = np.array([number[name] for name in own])
        size, distance = table.column("n_shingles").to_numpy(), table.column("distance").to_numpy()
        bands = np.array(table.column("bands").to_pylist(), dtype=np.int64)[:, :band]
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(keys), _BINS)
        low, high, block = table.column("low")[0].as_py(), table.column("high")[0].as_py(), table.column("block").to_numpy()
        pairs = []
        for x in range(len(keys)):
            if low != high and block[x] != low:
                continue
            other = np.arange(x + 1, len(keys)) if low == high else np.flatnonzero(block == high)
            fits = (component[other] != component[x]) & (np.abs(distance[other] - distance[x]) <= 1 - share + 1e-9)
            fits &= np.minimum(size[other], size[x]) * 100 >= percent * np.maximum(size[other], size[x])
            other = other[fits]
            other = other[~(bands[other] == bands[x]).any(axis=1)]
            if len(other):
                theirs = sketch[other]
                same = ((theirs == sketch[x]) & (theirs > 0)).sum(axis=1)
                either = ((theirs > 0) | (sketch[x] > 0)).sum(axis=1)
                # filled bins are drawn from the union without replacement; a linked pair's union has at most this size
                union = (size[other] + size[x]) / (1 + share)
                spread = share * (1 - share) / np.maximum(either, 1) * np.maximum(1 - either / union, 0)
                least = share - 5 * np.sqrt(spread) - 0.03
                pairs += [(min(keys[x], keys[y]), max(keys[x], keys[y])) for y in other[same >= least * either]]
        return pa.table({"u": pa.array([u for u, _ in pairs], pa.binary()), "v": pa.array([v for _, v in pairs], pa.binary())})
    return sift
