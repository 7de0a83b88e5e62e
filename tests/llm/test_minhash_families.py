"""Families of one template whose members aren't linked, with linked pairs among them; rows pass whole."""

import random

import pytest

from casemart.llm import minhash_dedup

INNER = ("row", "number", "key", "component", "first", "n_shingles", "__row")


def table(spark, rows):
    schema = "doc_id long, text string, " + ", ".join(f"{name} string" for name in INNER)
    return spark.createDataFrame([(i, t, *[f"{name} of {k}" for name in INNER]) for k, (i, t) in enumerate(rows)], schema)


def family(count, changed, seed):
    """Texts of 100 words that differ from one template in a run of words of their own; every tenth one has a near copy."""
    draw = random.Random(seed)
    template = [f"t{n}" for n in range(100)]
    rows = []
    for k in range(count):
        at = draw.randrange(100 - changed)
        words = template[:at] + [f"own{k}x{n}" for n in range(changed)] + template[at + changed:]
        rows.append((k, " ".join(words)))
        if k % 10 == 0:
            rows.append((count + k, " ".join(words[:-1] + [f"end{k}"])))
    return rows


def brute(rows, percent):
    sets = [frozenset(zip(*[t.split()[i:] for i in range(5)])) for _, t in rows]
    name = {i: i for i, _ in rows}
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                old, new = sorted((name[rows[a][0]], name[rows[b][0]]))[::-1]
                name = {i: new if n == old else n for i, n in name.items()}
    return name


@pytest.mark.parametrize("changed", [8, 12, 15])
def test_families_equal_brute_force(spark, monkeypatch, changed):
    monkeypatch.setattr(minhash_dedup, "_BLOCK", 16)
    rows = family(220, changed, changed)
    out = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(table(spark, rows), percent=85).collect()}
    assert out == brute(rows, 85)


def test_rows_pass_unchanged(spark):
    rows = family(30, 12, 1) + [(500, None), (None, "a b c d e f g")]
    data = table(spark, rows)
    kept = minhash_dedup.keep_one_of_each(data, percent=85)
    assert kept.columns == data.columns and kept.dtypes == data.dtypes
    assert kept.subtract(data).count() == 0 and kept.count() == len(rows) - 3
