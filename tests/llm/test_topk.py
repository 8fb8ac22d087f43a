"""Exact top-k against all inner products."""

from __future__ import annotations

import math
import random

import pytest

from cdmloom.llm.vector_topk import top_k


def brute(rows, queries, k):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]

    known = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for i, v in queries:
        if i is None or (q := whole(v)) is None:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, w, strict=True)), j) for j, w in known if j != i and len(w) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def vectors(n, dim, seed):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(0, 0.2) * 64) / 64 for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "blocks"), [(400, 8, (50, 3)), (30, 3, (1000, 1000)), (5, 2, (2, 1))])
def test_against_all_products(spark, n, dim, blocks):
    rows = vectors(n, dim, n)
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1000, rows[1][1]), (2000, None), (2001, [None] * dim), (2002, [float("nan")] * dim), (2003, [float("inf")] * dim)]
    rows += [(None, rows[0][1]), (3000, [1.0] * (dim + 1)), (3001, [-0.0] * dim)]
    queries = [r for r in rows if r[0] is None or r[0] % 10 == 0 and r[0] != 1000]
    got = top_k(made(spark, rows), made(spark, queries), k=7, candidates=blocks[0], query_rows=blocks[1])
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, queries, 7)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)]
    got = top_k(made(spark, rows), made(spark, rows[:2]), k=3, candidates=7)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, rows[:2], 3)


def test_coarse_cells_are_still_exact(spark):
    rows = vectors(200, 6, 9)
    got = top_k(made(spark, rows), made(spark, rows[::20]), k=5, cells=2)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, rows[::20], 5)


def test_empty_tables(spark):
    empty = made(spark, []) if False else spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty, empty).count() == 0
    assert top_k(made(spark, vectors(5, 2, 1)), empty).count() == 0


def test_large_components_are_refused(spark):
    rows = [(0, [1e30, 0.0]), (1, [0.0, 1.0])]
    with pytest.raises(Exception, match="2\\^24"):
        top_k(made(spark, rows), made(spark, rows)).collect()
