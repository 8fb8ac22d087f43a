"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdmloom.llm import queries
from cdmloom.llm.hard_negatives import mine, products
from tests.llm import samples
from workload.compare import duck, normal

LARGE = (1 << 63) - 1


def brute(rows, anchor, k=5, negatives=5, floor=80, scale=256):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(scale * x) for x in v]

    known = [(i, label, w) for i, label, v in rows if i is not None and label is not None and (w := whole(v)) is not None]
    out = []
    for i, label, q in known:
        if not anchor(i):
            continue
        scored = [(max(min(sum(a * b for a, b in zip(q, w, strict=True)), LARGE), -LARGE - 1), j, other) for j, other, w in known if j != i and len(w) == len(q)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2] == label][:k]:
            fit = [s for s in scored if s[2] != label and floor * ps <= 100 * s[0] <= 100 * ps][:negatives]
            out += [(i, p, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, label, v, "x", 1.0) for i, label, v in rows], "vec_id long, label int, embedding array<float>, anchor string, score double")


def vectors(n, dim, seed, labels=3, spread=64):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [round(abs(rng.gauss(0, 0.3)) * spread) / spread for _ in range(dim)]) for i in range(n)]


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("n", "dim", "blocks"), [(300, 6, (40, 3)), (120, 3, (1000, 1000)), (60, 2, (7, 1))])
def test_against_all_pairs(spark, n, dim, blocks):
    rows = vectors(n, dim, n, spread=4 if dim == 2 else 64)
    rows += [(1000, 1, rows[0][2]), (1001, 2, rows[0][2]), (1000, 2, rows[1][2]), (2000, 1, None), (2001, 1, [None] * dim), (2002, 1, [float("nan")] * dim)]
    rows += [(None, 1, rows[0][2]), (3000, 1, [1.0] * (dim + 1)), (3001, None, rows[0][2]), (3002, 1, [float("inf")] * dim), (3003, 2, [-1.0] * dim)]
    rows += [(4000, 1, rows[3][2])] * 4
    result = mine(made(spark, rows), F.col("vec_id") % 10 == 0, candidate_rows=blocks[0], anchor_rows=blocks[1])
    assert got(result) == brute(rows, lambda i: i % 10 == 0)
    assert result.count()


def test_equal_scores_open_windows_backwards(spark):
    """A negative that scores as its positive does, with a smaller id, comes before it in the stream."""
    rows = [(i, i % 2, [1.0, 0.0]) for i in range(40)]
    assert got(mine(made(spark, rows), F.col("vec_id") == 39, candidate_rows=7)) == brute(rows, lambda i: i == 39)


def test_negative_and_zero_scores_have_defined_windows(spark):
    rows = [(0, 0, [1.0])] + [(i, i % 2, [-i / 8]) for i in range(1, 9)] + [(20, 1, [0.0]), (21, 0, [0.0]), (22, 1, [0.0])]
    assert got(mine(made(spark, rows), F.col("vec_id") == 0)) == brute(rows, lambda i: i == 0)


def test_large_components(spark):
    rows = [(0, 0, [1e30, 1.0]), (1, 0, [1.0, 0.0]), (2, 1, [0.9, 0.0]), (3, 1, [0.0, 1.0]), (4, 0, [0.0, 1.0]), (5, 1, [0.0, 0.9]), (6, 0, [3e38, 3e38])]
    assert got(mine(made(spark, rows), F.lit(True))) == brute(rows, lambda i: True)


def test_products_are_exact():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-(1 << 40), 1 << 40, (5, 3)).astype(float), rng.integers(-9, 9, (4, 3)).astype(float)
    both = np.concatenate([a, b])
    plain = [[max(min(sum(int(x) * int(y) for x, y in zip(r, c, strict=True)), LARGE), -LARGE - 1) for c in both] for r in both]
    assert products(both, both).tolist() == plain
    assert products(np.zeros((2, 0)), np.zeros((3, 0))).tolist() == [[0] * 3] * 2


def test_empty_tables(spark):
    rows = made(spark, vectors(20, 2, 1))
    assert mine(rows.where(F.lit(False)), F.lit(True)).count() == 0
    assert mine(rows, F.lit(False)).count() == 0
    assert mine(rows, F.lit(None).cast("boolean")).count() == 0


def test_one_label_has_no_negatives(spark):
    assert mine(made(spark, [(i, 1, [1.0]) for i in range(9)]), F.lit(True)).count() == 0


def test_query_against_its_twin(spark):
    try:
        con = duck(samples.TABLES)
    except Exception:
        pytest.skip("test tables not present")
    df = queries.QUERIES["op13_hard_negatives"](spark, samples.TABLES)
    cursor = con.execute(queries.ORACLES["op13_hard_negatives"])
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal([d[0] for d in cursor.description], cursor.fetchall())
