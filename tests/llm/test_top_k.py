"""Exact top-k: components of any size, chunks of likeness, and lists that are left unread."""

import numpy as np
import pytest

from casemart.llm import top_k


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def expected(ints, ids, k, every):
    out = []
    for a in range(len(ids)):
        if ids[a] % every == 0:
            best = sorted((-int(np.dot(ints[a], ints[c])), ids[c]) for c in range(len(ids)) if c != a)[:k]
            out += [(ids[a], rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 2.0**14, 2.0**22])
def test_components_of_any_size(spark, size):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(700, 8)) * size
    ids = list(range(700))
    out = top_k.top_k(vectors(spark, [(i, v.tolist()) for i, v in zip(ids, x)]), k=7, chunk=150, block=8)
    ints = np.floor(64 * x).astype(np.int64)
    assert sorted(map(tuple, out.select("query_id", "rank", "vec_id", "score").collect())) == expected(ints, ids, 7, 20)


def test_groups_copies_and_few_rows(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(6, 12)) * 4
    x = np.concatenate([centres[k % 6] + 0.1 * draw.normal(size=(1, 12)) for k in range(500)] + [np.tile(centres[:1], (200, 1))])
    ids = [*range(500), *range(2000, 2200)]
    out = top_k.top_k(vectors(spark, [(i, v.tolist()) for i, v in zip(ids, x)]), k=9, chunk=100, block=4)
    assert sorted(map(tuple, out.collect())) == expected(np.floor(64 * x).astype(np.int64), ids, 9, 20)
    few = top_k.top_k(vectors(spark, [(20, [1.0]), (20, [1.0, 2.0]), (3, [-1.0, 0.0])]), k=9)
    assert sorted(map(tuple, few.collect())) == [(20, 1, 20, 4096), (20, 1, 20, 4096), (20, 2, 3, -4096), (20, 2, 3, -4096)]


def test_a_far_chunk_is_not_read():
    draw = np.random.default_rng(3)
    values = np.floor(64 * (draw.normal(size=(400, 8)) - 9)).astype(np.int64)
    lists = top_k.SortedLists(np.arange(400), np.arange(400), values)
    query = np.full((1, 8), 64)
    assert len(lists.search(query, 5, np.array([0]), np.array([-1]))[0][0]) == 0 and not lists.known
    assert len(lists.search(query, 5, np.array([top_k._NONE]), np.array([-1]))[0][0]) == 5 and lists.known
