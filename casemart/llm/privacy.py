"""Personal data: base patterns, and terms that give protected values away, in DataFrame operations only.

*Base spans* are e-mail addresses, IPv4 addresses, card numbers and phone numbers, found by leftmost non-overlapping matches of one pattern for each
kind; matches that fail their check are dropped.

*Disclosing terms.* Each distinct base value is a protected entity e. A term t (a run of 4 letters or more, in lower case) anywhere in a document that
mentions e tells PMI(t; e) = log N n(t, e) / (n(t) n(e)) about it, where n counts whole documents of the whole corpus; e itself holds
IC(e) = log N / n(e). Terms with PMI / IC of at least `disclosure` that stand together with e in at least `support` different documents are spans of
kind `term` in every document that mentions e, wherever they stand in it. Documents are compared by their text, so that copies of one are no evidence.
A value with fewer different documents has no terms: in a single document, every word that is rare would count. Documents without a
value keep the term, since they hold nothing that it gives away.
In `sanitise`, terms at `removal` or more disappear, others become `[TERM]`.

Scale. Matching is local to a row; offsets come from prefix sums over the pieces between matches. Copies of a text count as one document with a
weight. Values that stand in the same documents have the same figures with every term, so they are one class; so are terms that stand in the
same documents with values and are equally frequent. Only pairs of classes are counted, as (classes of a document) x (classes of a document), and of these only
pairs whose term is rare enough for its value (n(t) <= N^(1-d) n(e)^d, which every disclosing pair meets, as n(t, e) <= n(e)): a list of a thousand addresses in three
versions is one class of values and a few of terms. Words of a text meet its disclosing terms in an equi-join, spans of both kinds in one sorted pass.
Counts are combined before the shuffle.

Edge cases. Null text counts as empty. Rows with null or repeated ids each get a row. Without rows, no rows. Rows pass as a whole, so other columns may
have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.storage import Scratch

#: Kinds in order, with patterns that find what the plain ones find. A match starts at the beginning of its run of characters or where the last
#: match ended, and runs are never given back, so that texts without blanks take linear time.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TERM = r"\p{L}{4,}"
_SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _prefix_sums(values: Column) -> Column:
    """Running sums of an array of longs, by doubling."""
    def step(sums: Column, k: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - _shift(k)), F.lit(0).cast("bigint")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int"))
    return F.when(F.size(values) > 0, F.aggregate(steps, values, step)).otherwise(values)


def _shift(k: Column) -> Column:
    return F.pow(F.lit(2.0), k).cast("int")


def _accepted(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda span: _accepted(kind, span["value"])


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def spans_of(df: DataFrame, text: str, patterns: dict[str, str], out: str = "found") -> DataFrame:
    """`df` with `out`: all matches of all patterns as (kind, start, end, value), by kind as listed, then start."""
    parts = []
    for kind, pattern in patterns.items():
        values, gaps, sums = f"__{kind}", f"__{kind}_gaps", f"__{kind}_sums"
        df = df.withColumn(values, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        some = F.size(values) > 0
        pieces = F.when(some, F.split(text, pattern, -1))
        # start of match i: the pieces up to i and the matches before i
        lengths = F.zip_with(
            F.transform(F.slice(pieces, F.lit(1), F.size(values)), lambda x: F.length(x).cast("bigint")),
            F.concat(F.array(F.lit(0).cast("bigint")), F.transform(F.slice(F.col(values), F.lit(1), F.size(values) - 1), lambda x: F.length(x).cast("bigint"))),
            lambda a, b: a + b)
        df = df.withColumn(gaps, F.when(some, lengths))
        df = df.withColumn(sums, F.when(some, _prefix_sums(F.col(gaps))))
        spans = F.zip_with(values, sums, lambda v, s: F.struct(
            F.lit(kind).alias("kind"), s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value")))
        kept = F.filter(spans, _check(kind))
        parts.append(F.when(some, kept).otherwise(F.array().cast(_SPAN)))
    df = df.withColumn(out, F.concat(*parts))
    return df.drop(*[f"__{kind}{end}" for kind in patterns for end in ("", "_gaps", "_sums")])


def _terms_of(text: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(_TERM), F.lit(0)))


def _documents_of(what: str) -> list[Column]:
    """Aggregates over (doc, copies): different documents, documents with their copies, and a fingerprint of which documents they are."""
    marks = [F.bit_xor(F.xxhash64("doc", F.lit(seed))).cast("string") for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("different"), F.sum("copies").alias(f"n_{what}"), F.concat_ws(":", *marks).alias("where")]


def _disclosing(base: DataFrame, texts: DataFrame, scratch: Scratch, disclosure: float, support: int) -> DataFrame:
    """doc, term and strength: for each different text with base spans, the terms that give one of its values away. `doc` is the smallest rid of that text."""
    said = F.array_distinct(F.transform("found", lambda s: F.lower(s["value"])))
    holders = scratch.store(base.where("content IS NOT NULL").select("rid", "content", said.alias("values"), _terms_of("text").alias("terms")), "holders")
    firsts = holders.groupBy("content").agg(F.min("rid").alias("doc"), F.count(F.lit(1)).alias("copies"))
    docs = scratch.store(holders.join(firsts.drop("content"), F.col("rid") == F.col("doc")).select("doc", "copies", "values", "terms"), "docs")
    rows = float(base.count())
    mentions = docs.select("doc", "copies", F.explode("values").alias("value"))
    values = mentions.groupBy("value").agg(*_documents_of("value")).where((F.col("different") >= support) & (F.col("n_value") < rows))
    entities = values.select("value", "n_value", F.concat_ws(":", "where", "n_value").alias("value_class"))
    doc_values = scratch.store(mentions.join(entities, "value").select("doc", "copies", "value_class", "n_value").distinct(), "doc-values")
    # terms move once for each different document that has a protected value
    near = docs.join(doc_values.select(F.col("doc").alias("of")).distinct(), F.col("doc") == F.col("of")).select("doc", "copies", F.explode("terms").alias("term"))
    known = near.groupBy("term").agg(*_documents_of("near")).where(F.col("different") >= support)
    term_count = texts.select(F.explode(_terms_of("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    terms = known.join(term_count, "term").select("term", "n_term", F.concat_ws(":", "where", "n_term").alias("term_class"))
    doc_terms = scratch.store(near.join(terms, "term").select("doc", "term", "n_term", "term_class"), "doc-terms")
    classes = doc_terms.select("doc", "n_term", "term_class").distinct()
    rare = F.col("n_term") <= F.pow(F.lit(rows), F.lit(1 - disclosure)) * F.pow("n_value", F.lit(disclosure)) * (1 + 1e-9)
    pairs = doc_values.join(classes, "doc").where(rare)
    both = pairs.groupBy("value_class", "term_class").agg(
        F.count(F.lit(1)).alias("different"), F.sum("copies").alias("n_both"), F.first("n_value").alias("n_value"), F.first("n_term").alias("n_term"))
    strength = F.log(F.lit(rows) * F.col("n_both") / (F.col("n_term") * F.col("n_value"))) / F.log(F.lit(rows) / F.col("n_value"))
    strong = both.where(F.col("different") >= support).withColumn("strength", strength).where(F.col("strength") >= disclosure).select(
        "value_class", "term_class", "strength")
    told = pairs.select("doc", "value_class", "term_class").join(strong, ["value_class", "term_class"]).groupBy("doc", "term_class").agg(F.max("strength").alias("strength"))
    out = scratch.store(told.join(doc_terms.select("doc", "term_class", "term"), ["doc", "term_class"]).select("doc", "term", "strength"), "told")
    scratch.drop("holders", "docs", "doc-values", "doc-terms")
    return out


def find_private(docs: DataFrame, keep: list[str] | None = None, disclosure: float = 0.9, support: int = 3) -> DataFrame:
    """`row` (a struct of the columns `keep`, or all, of `docs`), `text`, `found` (base spans) and `marked` (disclosing terms with `strength`). Runs jobs.

    `text` is the row's text where it has base spans, null elsewhere.
    """
    scratch = Scratch(docs.sparkSession, "privacy")
    names = docs.columns if keep is None else keep
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    spans = spans_of(row, "text", PATTERNS)
    # texts are kept for rows with base spans alone; the rest of the work needs no other text but for term frequencies
    some = F.size("found") > 0
    base = scratch.store(spans.select(
        F.monotonically_increasing_id().alias("rid"), F.col("row"), "found", F.when(some, F.col("text")).alias("text"),
        F.when(some, F.md5(F.col("text").cast("binary"))).alias("content")), "base")
    return _mark(base, row.select("text"), scratch, disclosure, support).select("row", "text", "found", "marked")


def _mark(base: DataFrame, texts: DataFrame, scratch: Scratch, disclosure: float, support: int) -> DataFrame:
    """`base` with `marked`: terms are looked for once in each different text, and all its copies get the spans."""
    told = _disclosing(base, texts, scratch, disclosure, support)
    asked = base.join(told.select(F.col("doc").alias("rid")).distinct(), "rid").select("rid", "content", "text", "found")
    words = spans_of(asked, "text", {"term": _TERM}, "all_terms").select("rid", F.explode("all_terms").alias("t"))
    hits = words.join(told, (F.col("rid") == F.col("doc")) & (F.lower("t.value") == F.col("term"))).select(
        "rid", F.col("t.start").alias("start"), F.col("t.end").alias("end"), "strength")
    taken = asked.select("rid", F.explode("found").alias("s")).select("rid", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.lit(None).cast("double").alias("strength"))
    # a term overlaps a base span that starts before and ends behind its start, or that starts behind its start and before its end
    by_start = Window.partitionBy("rid").orderBy("start")
    base_end, base_start = F.when(F.col("strength").isNull(), F.col("end")), F.when(F.col("strength").isNull(), F.col("start"))
    reached = F.coalesce(F.max(base_end).over(by_start.rangeBetween(Window.unboundedPreceding, 0)) <= F.col("start"), F.lit(True))
    follows = F.coalesce(F.min(base_start).over(by_start.rangeBetween(0, Window.unboundedFollowing)) >= F.col("end"), F.lit(True))
    free = hits.unionAll(taken).withColumn("free", reached & follows).where(F.col("free") & F.col("strength").isNotNull())
    spans = free.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(F.lit("term").alias("kind"), "start", "end", "strength"))).alias("marked"))
    marked = scratch.store(spans.join(asked.select("rid", "content"), "rid").select(F.col("content").alias("of"), "marked"), "marked")
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,strength:double>>")
    return base.join(marked, F.col("content") == F.col("of"), "left").withColumn("marked", F.coalesce("marked", empty))


def _text_of_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def private_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, the number of spans of each kind, the digest of the base spans, and all spans, for every row."""
    found = find_private(docs, ["doc_id"], **options)
    counts = [F.size(F.filter("found", _is_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in PATTERNS]
    base, terms = _text_of_spans(F.col("found")), _text_of_spans(F.col("marked"))
    both = F.concat_ws(",", F.when(base != "", base), F.when(terms != "", terms))
    return found.select("row.doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), both.alias("spans"))


def sanitise(docs: DataFrame, removal: float = 0.97, **options) -> DataFrame:
    """`docs` with the same columns, and texts in which base spans are replaced by their kind and disclosing terms are generalised or removed.

    Where spans overlap, the first one's replacement stands for all of them. A null text stays null.
    """
    found = find_private(docs, **options)
    base = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put")))
    terms = F.transform("marked", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.when(s["strength"] >= removal, F.lit("")).otherwise(F.lit("[TERM]")).alias("put")))
    spans = F.array_sort(F.concat(base, terms))

    def step(state: Column, span: Column) -> Column:
        at = state["at"]
        between = F.substr("text", (at + 1).cast("int"), (span["start"] - at).cast("int"))
        more = F.when(span["start"] >= at, F.concat(state["out"], between, span["put"])).otherwise(state["out"])
        return F.struct(F.greatest(at, span["end"]).alias("at"), more.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substr("text", (s["at"] + 1).cast("int"), F.length("text"))))
    clean = F.when(F.size("found") > 0, done).otherwise(F.col("row.text"))
    return found.select(*[clean.alias("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in docs.columns])
