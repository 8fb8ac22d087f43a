"""Runs against plain comparison of words at every distance."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdmloom.llm import periodic_runs as pr
from tests.llm import samples


def brute(words, least=2):
    """(start, length, period) of all runs: for each distance the stretches of equal words, smallest period each."""
    best, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                best.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in best.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def doubled(n, rng, letters):
    """Words made of copies of parts of themselves, so that runs lie in runs."""
    out = [rng.randrange(letters) for _ in range(3)]
    while len(out) < n:
        k = rng.randint(1, len(out))
        part = out[-k:]
        out += part * rng.randint(1, 3)
        if rng.random() < 0.5:
            out.append(rng.randrange(letters))
    return out[:n]


def near_powers(n, rng):
    """A highly periodic stretch, broken, and again: the runs that contexts alone would miss."""
    root = [rng.randrange(2) for _ in range(rng.randint(1, 4))]
    out = []
    while len(out) < n:
        k = rng.randint(5, 40)
        out += (root * k)[rng.randrange(len(root)) : rng.randint(10, len(root) * k + 10)]
        if rng.random() < 0.2:
            out.append(rng.randrange(3))
    return out[:n]


@pytest.mark.parametrize("seed", range(6))
def test_against_all_distances(seed):
    rng = random.Random(seed)
    texts = [fibonacci(rng.randint(0, 300)), [0] * rng.randint(0, 90), [], [3], [1, 1]]
    for _ in range(40):
        n = rng.randint(1, 400)
        texts += [[rng.randrange(2) for _ in range(n)], doubled(n, rng, 2), doubled(n, rng, 50), near_powers(n, rng)]
        p = rng.randint(1, n)
        texts.append([i % p for i in range(n)])
    found = pr.find_runs([np.array(t, np.int64) for t in texts])
    for t, runs in zip(texts, found, strict=True):
        assert [tuple(r) for r in runs.tolist()] == brute(t)


@pytest.mark.parametrize("seed", range(3))
def test_squares_that_end_where_their_period_does(seed):
    """x u u y for every u of a high power and its neighbours: the run is exactly two periods long."""
    rng = random.Random(100 + seed)
    texts = []
    for _ in range(150):
        root = [rng.randrange(3) for _ in range(rng.randint(1, 5))]
        u = (root * 60)[: rng.randint(7, 150)]
        texts.append([rng.randrange(4) for _ in range(rng.randint(0, 2))] + u + u + [rng.randrange(4) for _ in range(rng.randint(0, 2))])
    for t, runs in zip(texts, pr.find_runs([np.array(t, np.int64) for t in texts]), strict=True):
        assert [tuple(r) for r in runs.tolist()] == brute(t)


def test_a_clash_of_hashes_does_not_pass(monkeypatch):
    words = np.array([i % 7 for i in range(40)] + list(range(20)))
    right = pr.reported([words])[0].tolist()
    monkeypatch.setattr(pr, "find_runs", lambda texts: [np.array([[0, 50, 7]])])
    assert pr.reported([words])[0].tolist() == right == [[0, 40, 7]]


def test_long_periodic_texts_are_no_trouble():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 1000, 100_000)
    for words, run in ((np.zeros(400_000, np.int64), (0, 400_000, 1)), (np.tile(part, 3), (0, 300_000, 100_000)), (np.tile(part[:50], 9000), (0, 450_000, 50))):
        assert run in [tuple(r) for r in pr.reported([words])[0].tolist()]


def expected(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, n, len(runs), *four, sha(listed), sha(kept))


def short(rows):
    return [(r[0], r[1] if r[1] is None or len(r[1]) < 9000 else r[1][:9000], *r[2:]) for r in rows]


def test_documents(spark):
    rows = short(samples.ROWS) + [(i, samples.PROSE + f" end {i}", "en", "a", 1) for i in range(100, 160)]
    rows += [(200, "la la la la la la la la la la la la", "en", "a", 1), (201, "a b " * 30 + "c " * 30 + "a b " * 30, "en", "a", 1)]
    docs = samples.clashing(samples.documents(spark, rows))
    got = samples.plain(pr.periodic_runs(pr.with_planted_runs(docs)))
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert any(r[2] for r in got)


def test_the_test_table(spark):
    rows = short(samples.texts())
    if not rows:
        pytest.skip("test tables not present")
    got = samples.plain(pr.periodic_runs(pr.with_planted_runs(samples.documents(spark, rows))))
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)


def test_collapsed_texts_and_empty_tables(spark):
    docs = samples.documents(spark, [(1, "x a b c a b c a b c a b c y", "en", "a", 1), (2, None, "en", "a", 0)])
    got = {r["doc_id"]: r["collapsed"] for r in pr.periodic_runs(docs, collapsed=True).collect()}
    assert got == {1: "x a b c y", 2: ""}
    assert pr.periodic_runs(pr.with_planted_runs(docs.where(F.lit(False)))).count() == 0
