"""Disclosing terms against their definition, many values in few documents, and columns of any name."""

import math
import re
import time

import numpy as np

from casemart.llm import privacy
from tests.llm.test_edge_cases import KINDS

INNER = ("found", "marked", "row", "rid", "content", "doc", "copies", "of", "t", "s", "strength", "term", "value", "kind")


def table(spark, rows):
    schema = "doc_id long, text string, " + ", ".join(f"{name} string" for name in INNER)
    return spark.createDataFrame([(i, t, *[f"{name} of {k}" for name in INNER]) for k, (i, t) in enumerate(rows)], schema)


def spans(text):
    return [(kind, m.start(), m.end(), m[0].lower()) for kind, (p, ok) in KINDS.items() for m in re.finditer(p, text or "") if ok(m[0])]


def by_definition(rows, disclosure=0.9, support=3):
    """All spans of each row, from document frequencies of whole texts."""
    texts = [t or "" for _, t in rows]
    base = [spans(t) for t in texts]
    terms = [set(re.findall(r"[^\W\d_]{4,}", t.lower())) for t in texts]
    n, out = len(rows), []
    values = {v for found in base for *_, v in found}
    holds = {v: [k for k in range(n) if any(s[3] == v for s in base[k])] for v in values}
    frequency = {}
    for words in terms:
        for t in words:
            frequency[t] = frequency.get(t, 0) + 1
    strong = {}
    for v, docs in holds.items():
        if len({texts[k] for k in docs}) < support or len(docs) == n:
            continue
        for t in set().union(*(terms[k] for k in docs)):
            both = [k for k in docs if t in terms[k]]
            if len({texts[k] for k in both}) >= support and math.log(n * len(both) / (frequency[t] * len(docs))) / math.log(n / len(docs)) >= disclosure - 1e-12:
                strong.setdefault(v, set()).add(t)
    for text, found in zip(texts, base):
        wanted = set().union(*(strong.get(v, set()) for *_, v in found)) if found else set()
        marked = [("term", m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{4,}", text)
                  if m[0].lower() in wanted and not any(a < m.end() and b > m.start() for _, a, b, _ in found)]
        out.append(",".join(f"{kind}:{a}:{b}" for kind, a, b in [s[:3] for s in found] + marked))
    return out


def test_terms_equal_their_definition(spark):
    draw = np.random.default_rng(4)
    words = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(60)]
    values = [f"{w}@{v}.org" for w, v in zip(words[:12], words[12:24])] + ["10.0.0.1", "+49 30 1234567"]
    rows = []
    for k in range(160):
        chosen = list(draw.choice(words, 8)) + (list(draw.choice(values, draw.integers(1, 4))) if k % 2 else [])
        if k % 10 == 1:
            chosen += [values[0], "Quagga", "okapi"]
        draw.shuffle(chosen)
        rows.append((k if k % 7 else None, ". ".join(chosen)))
    rows += rows[:9] * 2 + [(500, None), (501, "")]
    data = table(spark, rows).repartition(4)
    out = sorted((str(r.doc_id), r.spans) for r in privacy.private_report(data).collect())
    assert out == sorted((str(i), s) for (i, _), s in zip(rows, by_definition(rows)))
    assert any("term" in s for _, s in out)


def test_columns_pass_unchanged(spark):
    rows = [(k, f"note{k} from jaguarundi{'' if k < 4 else k} to me@there.org") for k in range(8)] + [(20 + k, f"plain text {k}") for k in range(30)]
    data = table(spark, rows)
    clean = privacy.sanitise(data)
    assert clean.columns == data.columns and clean.dtypes == data.dtypes
    others = [c for c in data.columns if c != "text"]
    assert sorted(map(tuple, clean.select(*others).collect())) == sorted(map(tuple, data.select(*others).collect()))
    assert all("me@there.org" not in r.text for r in clean.collect())


def test_many_values_and_terms_in_few_documents(spark):
    letters = "abcdefghijklmnopqrst"
    names = ["".join(letters[(k // 20**j) % 20] for j in range(4)) + "zz" for k in range(10_000)]
    mails = " ".join(f"user{k}@list.org" for k in range(1000))
    rows = [(k, f"version{k} {mails} " + " ".join(names)) for k in range(3)] + [(10 + k, f"plain text number{k}") for k in range(50)]
    started = time.time()
    out = {r.doc_id: r for r in privacy.private_report(table(spark, rows)).collect()}
    assert time.time() - started < 120
    assert all(out[k].n_email == 1000 and out[k].spans.count("term:") == 10_001 for k in range(3)) and out[10].spans == ""
