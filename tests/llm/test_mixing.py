"""Mixing to target weights."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from cdmloom.llm import mixing
from tests.llm import samples


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def check(rows, plan):
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for _, t, _, s, _ in rows:
        n = len(samples.words(t))
        sizes[s] += n
        largest[s] = max(largest[s], n)
    for r in plan:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
        assert r["source_size"] == sizes[r["source"]]
    want = brute_targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    assert len(plan) == len(rows)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6


def test_targets_and_rounding(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), None, rng.choice(["a"] * 20 + ["b", "B", "é", "z", "𐀀", None, "￿"]), 0) for i in range(800)]
    rows += samples.ROWS
    docs = samples.clashing(samples.documents(spark, rows))
    check(rows, mixing.plan_mix(docs).collect())


def test_tree_of_several_levels_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing.round_copies, "__defaults__", (16, 4, mixing.SEED))
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), None, "hot" if i % 3 else f"s{i % 5}", 0) for i in range(600)]
    first = mixing.plan_mix(samples.documents(spark, rows)).collect()
    check(rows, first)
    again = mixing.plan_mix(samples.documents(spark, rows[::-1]).repartition(3)).collect()
    assert {(r["id"], r["copies"]) for r in first} == {(r["id"], r["copies"]) for r in again}


def test_small_sources_stay_in_one_block(spark, monkeypatch):
    monkeypatch.setattr(mixing.round_copies, "__defaults__", (16, 4, mixing.SEED))
    groups = []
    plain = mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: groups.append(plain(df, name)) or groups[-1])
    rows = [(i, "w " * (1 + i % 7), None, "hot" if i % 3 else (None, "s", "t")[i % 9 // 3], 0) for i in range(900)]
    plan = mixing.plan_mix(samples.documents(spark, rows)).collect()
    check(rows, plan)
    first = next(df for df in groups if "draw" in df.columns)
    seen = {r["source"]: (r["n"], r["b"]) for r in first.groupBy("source").agg({"*": "count", "block": "max"}).toDF("source", "n", "b").collect()}
    assert all(b < -(-n // 16) for n, b in seen.values())
    few = [(1, "w w w", None, "a", 0), (2, "w", None, "b", 0), *((i, "w " * (i % 5), None, "c", 0) for i in range(3, 90))]
    check(few, mixing.plan_mix(samples.documents(spark, few)).collect())


def test_pivot_keeps_mass_and_mean():
    rng = random.Random(7)
    sizes = [float(rng.randint(1, 50)) for _ in range(9)]
    shares = [rng.random() for _ in sizes]
    mean = [0.0] * len(sizes)
    for _ in range(4000):
        out, left = mixing.pivot(sizes, shares, [rng.random() for _ in sizes])
        assert sum(o != 0 and o != 1 for o in out) <= 1
        assert sum(a * b for a, b in zip(sizes, out, strict=True)) == pytest.approx(sum(a * b for a, b in zip(sizes, shares, strict=True)))
        mean = [m + o / 4000 for m, o in zip(mean, out, strict=True)]
    assert mean == pytest.approx(shares, abs=0.05)


def test_nothing_to_mix(spark):
    assert mixing.plan_mix(samples.documents(spark, [])).count() == 0
    rows = [(1, None, None, "a", 0), (2, "", None, None, 0)]
    out = mixing.plan_mix(samples.documents(spark, rows)).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in out] == [(0, 0.0, 0)] * 2
