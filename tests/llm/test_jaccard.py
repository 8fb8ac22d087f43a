"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from cdmloom.llm import jaccard_join as jj
from cdmloom.llm.components import components
from tests.llm import samples


def grams(text):
    w = samples.words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    sets = [grams(t) for _, t in rows]
    owner = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            owner[g].append(i)
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in owner[g] if j > i}:
            both = len(s & sets[j])
            if both >= 0.8 * (len(s) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[top(j)] = top(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, least.get(top(i)), links[i]) for i, (d, _) in enumerate(rows)), key=str)


def found(spark, rows):
    docs = samples.clashing(samples.documents(spark, [(i, t, None, None, 0) for i, t in rows]))
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jj.near_duplicates(docs).collect()), key=str)


def near_copies(seed, groups, each, words=60, edits=2):
    rng = random.Random(seed)
    out, n = [], 0
    shared = [f"common{i}" for i in range(12)]
    for _ in range(groups):
        text = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
        if rng.random() < 0.5:
            text = shared + text
        for _ in range(rng.randint(1, each)):
            copy = list(text)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 9)}"
            out.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(out)
    return out


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in samples.ROWS]
    assert found(spark, rows) == brute(rows)


def test_small_table(spark):
    rows = [(r[0], r[1]) for r in samples.texts()]
    assert found(spark, rows) == brute(rows)


def test_planted_copies(spark):
    rows = near_copies(1, 60, 6)
    assert found(spark, rows) == brute(rows)


def test_large_and_dense_nodes(spark, monkeypatch):
    monkeypatch.setattr(jj, "LEAF", 4)
    monkeypatch.setattr(jj, "BLOCK", 8)
    rows = near_copies(2, 4, 50, words=80, edits=1) + [(10_000 + i, t) for i, t in near_copies(3, 30, 3)]
    assert found(spark, rows) == brute(rows)


def test_runs_meet_the_recall():
    assert jj.runs_needed(1) < jj.runs_needed(3)
    assert (1 - 0.8**3) ** jj.runs_needed(3) <= 1 - jj.RECALL


def test_one_document_of_each_class_stays(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in near_copies(4, 20, 5)]
    rows += [rows[0], rows[0], (None, rows[1][1], None, None, None), (77_000, None, None, "s", None), (77_001, "", None, "s", 0)]
    docs = samples.documents(spark, rows)
    kept = jj.without_duplicates(docs)
    assert kept.columns == docs.columns
    classes = {c for _, c, _ in brute([(r[0], r[1]) for r in rows])}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(classes)


def test_empty_table(spark):
    empty = samples.documents(spark, [])
    assert jj.near_duplicates(empty).count() == 0
    assert jj.without_duplicates(empty).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (4, 5), (9, 9)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)]])
def test_components(spark, edges):
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges or [(1, 1)], "u long, v long")).collect()}
    parent = {}
    for a, b in sorted(edges):
        for x in (a, b):
            parent.setdefault(x, x)
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {k: v for k, v in parent.items() if k != v}


def test_a_recall_out_of_reach_is_refused():
    with pytest.raises(ValueError, match="takes"):
        jj.runs_needed(5, threshold=0.5)
