"""Span hashes, extensions and fingerprints against plain comparisons."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdmloom.llm import span_hashes
from cdmloom.llm.span_hashes import Fingerprint, Prefixes, common_extensions, edited_fingerprints, fingerprints, fingerprints_of, laid_out, likeness, likeness_of
from tests.llm import samples


def made(text: str) -> Fingerprint:
    return fingerprints_of(*laid_out([text]))[0]


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words))


@pytest.mark.parametrize("size", [1, 50, span_hashes.BLOCK - 1, span_hashes.BLOCK, 3 * span_hashes.BLOCK + 7])
def test_spans_are_equal_as_their_content_is(size):
    rng = np.random.default_rng(size)
    codes = rng.integers(0, 3, size)
    prefixes = Prefixes(codes)
    a, b, n = (rng.integers(0, size + 1, 3000) for _ in range(3))
    n = np.minimum(n % 9, np.minimum(size - a, size - b))
    same = prefixes.spans(a, a + n) == prefixes.spans(b, b + n)
    assert same.tolist() == [codes[i : i + k].tolist() == codes[j : j + k].tolist() for i, j, k in zip(a, b, n, strict=True)]


def test_a_prefix_hash_is_the_polynomial():
    codes = [5, 7, 11, 2]
    prefixes = Prefixes(np.array(codes))
    for k, base in enumerate(span_hashes.BASES):
        plain = 0
        for c in codes:
            plain = (plain * base + c) % span_hashes.MODULUS
        assert int(prefixes.part(k, np.array([0]), np.array([4]))[0]) == plain


def test_extensions_both_ways():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2, 400)
    prefixes = Prefixes(codes)
    a, b = rng.integers(0, 401, 500), rng.integers(0, 401, 500)

    def plain(i, j, step):
        n = 0
        while 0 <= min(i, j) + (0 if step > 0 else -1) and max(i, j) < 400 + (step < 0) and codes[i if step > 0 else i - 1] == codes[j if step > 0 else j - 1]:
            i, j, n = i + step, j + step, n + 1
        return n

    assert prefixes.extensions(a, b, 400 - np.maximum(a, b)).tolist() == [plain(i, j, 1) for i, j in zip(a, b, strict=True)]
    assert prefixes.extensions(a, b, np.minimum(a, b), back=True).tolist() == [plain(i, j, -1) for i, j in zip(a, b, strict=True)]


def test_common_extensions_of_texts(spark):
    rows = [("abcdef", "xxabcdeg", 0, 2), ("same", "same", 0, 0), (None, "a", 0, 0), ("ab", "ab", 5, 0), ("🙂🙂a", "🙂🙂b", 0, 0), ("ab", "ab", None, 0)]
    frame = spark.createDataFrame(rows, "a string, b string, i int, j int")
    assert [r["extension"] for r in common_extensions(frame, "a", "b", "i", "j").collect()] == [5, 4, 0, 0, 2, 0]


def test_likeness_follows_what_is_shared():
    text, other = prose(400, 1), prose(400, 2)
    assert likeness(made(text), made(text)) == 1
    assert likeness(made(text), made(other)) < 0.1
    assert likeness(made(text), made(text[: len(text) // 2] + other[: len(text) // 2])) == pytest.approx(0.5, abs=0.2)
    assert likeness(made(text), made("moved by a few words " + text)) > 0.75
    assert likeness(made(text), made(text * 9)) > 0
    assert likeness(made(""), made("")) == 1 and likeness(made(""), made("a")) == 0
    assert likeness(made("a" * 5000), made("a" * 4999)) <= 1


def test_fingerprints_are_bounded_and_read_back():
    for text in ("", "short", prose(30_000, 3), "a" * 100_000, samples.LONG):
        one = made(text)
        assert len(one.cuts) < span_hashes.PIECES
        again = Fingerprint.of(one.text())
        assert again.text() == one.text() and likeness(one, again) == 1 and again.pieces(one.level + 1) == one.pieces(one.level + 1)
        assert sum(size * times for (_, size), times in one.pieces(one.level).items()) == len(text)


def test_pieces_hash_what_lies_between_cuts():
    text = prose(500, 5)
    prefixes, starts = laid_out(["before", text])
    one = fingerprints_of(prefixes, starts)[1]
    assert one.text() == made(text).text()
    ends = [*[c[0] for c in one.cuts], len(text)]
    spans = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    assert one.pieces(one.level).total() == len(spans)
    assert {int(laid_out([s])[0].spans(np.array([0]), np.array([len(s)]))[0]) for s in spans} == {h for h, _ in one.pieces(one.level)}


def brute(rows):
    """(id, n_chars, sha of the edited text, common starts) by plain slices; rows alike in id must be alike in text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    out = []
    for i, (id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        alike = [next((k for k, (x, y) in enumerate(zip(text, o, strict=False)) if x != y), min(len(text), len(o))) for o in (edited, after)]
        out.append((id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *alike))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "alike_edited", "alike_next")


@pytest.mark.parametrize("range_rows", [2048, 3, 1])
def test_edited_texts(spark, range_rows):
    rows = [r for r in samples.ROWS if r[0] is not None] + [(None, "a null id comes last", "en", "a", 1)]
    docs = samples.clashing(samples.documents(spark, rows))
    got = edited_fingerprints(docs, range_rows=range_rows)
    assert samples.plain(got.select(*COLUMNS)) == brute([r[:2] for r in rows])
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints(docs).collect()}
    for r in got.collect():
        assert r["fingerprint"] == plain[r["doc_id"]] and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_one_row_and_no_rows(spark):
    one = samples.documents(spark, [(7, "abcdef", "en", "a", 6)])
    assert samples.plain(edited_fingerprints(one).select(*COLUMNS)) == brute([(7, "abcdef")])
    none = samples.documents(spark, [])
    assert edited_fingerprints(none).count() == 0 and fingerprints(none).count() == 0
    nulls = samples.documents(spark, [(None, None, None, None, None)] * 3)
    assert [r["near_next"] for r in edited_fingerprints(nulls).collect()] == [1.0] * 3


def test_the_test_table(spark):
    rows = samples.texts()
    if not rows:
        pytest.skip("test tables not present")
    got = edited_fingerprints(samples.documents(spark, rows), range_rows=17)
    assert samples.plain(got.select(*COLUMNS)) == brute([r[:2] for r in rows])
    again = got.withColumn("again", likeness_of("fingerprint", "edited_fingerprint")).where(F.abs(F.col("again") - F.col("near_edited")) > 1e-12)
    assert again.count() == 0
