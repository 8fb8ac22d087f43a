"""The pipeline against its stages done plainly, and the registered queries against their SQL."""

from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline as cp
from cdmloom.llm import language_id as li
from cdmloom.llm import mixing
from cdmloom.llm.common import fold, table
from cdmloom.llm.queries import ORACLES, QUERIES
from tests.llm import samples
from tests.llm.test_jaccard import brute as brute_classes
from tests.llm.test_secrets import LINKED
from tests.llm.test_secrets import brute as brute_spans
from tests.llm.test_tokens import library
from workload.compare import duck, normal

pytestmark = pytest.mark.skipif(not Path(samples.TABLES).exists(), reason="test tables not present")


def masked(text):
    spans = sorted(tuple(map(int, x.split(":")[1:])) for x in brute_spans(text or "")[1].split(",") if x)
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[REDACTED]"
        at = max(at, b)
    return out + text[at:] if spans else text


def test_stages_against_plain_versions(spark):
    docs = table(spark, samples.TABLES, "documents")
    rows = samples.texts()
    classify = li.Classifier(li.learn(docs.where(fold("doc_id", 4) != 2)))
    good = []
    for i, t, _, s, n in rows:
        code, _, margin = classify(t)
        if code != li.UNDETERMINED and margin >= li.MARGIN:
            good.append((i, t, code, s, n))
    after = cp.language_stage(spark, docs, samples.TABLES)
    assert after.columns == docs.columns
    assert samples.plain(after.select("doc_id", "text", "lang", "source", "n_chars")) == sorted(good, key=str)

    classes = brute_classes([(r[0], r[1]) for r in good])
    single = [r for r in good if any(d == r[0] == c for d, c, _ in classes)]
    docs = samples.documents(spark, good)
    after = cp.near_duplicate_stage(spark, docs, samples.TABLES)
    assert samples.plain(after) == sorted(single, key=str)

    single += [(9_000_000 + r[0], r[1], "en", single[0][3], len(r[1])) for r in LINKED]
    clean = [(i, m := masked(t), code, s, n if m == t else len(m)) for i, t, code, s, n in single]
    assert any(a != b for a, b in zip(clean, single, strict=True))
    after = cp.secret_stage(spark, samples.documents(spark, single), samples.TABLES)
    assert samples.plain(after) == sorted(clean, key=str)

    docs = samples.documents(spark, clean)
    copies = {r["id"]: r["copies"] for r in mixing.plan_mix(docs).collect()}
    mixed = [r for r in clean for _ in range(copies[r[0]])]
    assert samples.plain(cp.mix_stage(spark, docs, samples.TABLES)) == sorted(mixed, key=str)

    lib = library()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = Counter((r[0], len(ids := lib.encode(r[1])), sha(",".join(map(str, ids))), sha(lib.decode(ids))) for r in mixed)
    assert Counter(tuple(r)[:4] for r in cp.encoding_stage(spark, samples.documents(spark, mixed), samples.TABLES).collect()) == want


def test_run_applies_the_stages(spark):
    docs = table(spark, samples.TABLES, "documents")
    for _, stage in cp.STAGES:
        out = stage(spark, docs, samples.TABLES)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert samples.plain(cp.run(spark, samples.TABLES)) == samples.plain(docs)


def test_stages_take_awkward_rows(spark):
    for rows in (samples.ROWS, []):
        for name, stage in cp.STAGES:
            docs = samples.documents(spark, rows).selectExpr("*", "'x' as size", "'y' as found", "'z' as id")
            out = stage(spark, docs, samples.TABLES)
            if name != "encoding":
                assert out.columns == docs.columns
            out.collect()


def test_mix_shares_copies_of_repeated_rows(spark):
    rows = [(1, "a b c", None, "s", 5)] * 3 + [(2, "d e", None, "t", 3)]
    plan = mixing.plan_mix(samples.documents(spark, rows)).collect()
    out = cp.mix_stage(spark, samples.documents(spark, rows), samples.TABLES).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(x for r in plan for x in [r["id"]] * r["copies"])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, name):
    df = QUERIES[name](spark, samples.TABLES)
    cursor = duck(samples.TABLES).execute(ORACLES[name])
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_give_a_row_for_each_document(spark, name):
    assert QUERIES[name](spark, samples.TABLES).count() == table(spark, samples.TABLES, "documents").count()


def test_columns_of_any_name_are_carried_along(spark):
    rows = [r for r in samples.ROWS if r[0] != 6]
    plain = samples.documents(spark, rows)
    docs = samples.clashing(plain)
    docs = docs.select("*", *[docs["source"].alias(c) for c in samples.INTERNAL])
    for name, stage in cp.STAGES:
        one, other = stage(spark, plain, samples.TABLES), stage(spark, docs, samples.TABLES)
        if name != "encoding":
            assert other.columns == docs.columns
            kept = other.select(*plain.columns, "first_id", "__kept_0").collect()
            assert all((r["first_id"], r["__kept_0"]) == ("x", r["source"]) for r in kept)
            other = other.select(*plain.columns)
        assert samples.plain(one) == samples.plain(other)


def test_empty_documents(spark):
    docs = samples.documents(spark, [])
    for _, stage in cp.STAGES:
        assert stage(spark, docs, samples.TABLES).count() == 0


def test_a_text_of_many_labels_passes_the_secret_stage(spark):
    docs = samples.documents(spark, [(1, "a." * 1_000_000 + " token=abcdef1", "en", "a", 1)])
    assert cp.secret_stage(spark, docs, samples.TABLES).collect()[0]["text"] == "a." * 1_000_000 + " [REDACTED]"
