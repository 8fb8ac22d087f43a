"""Quality rules, languages and the class model."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdmloom.llm import class_lm as lm
from cdmloom.llm import language_id as li
from cdmloom.llm import quality_rules as q
from cdmloom.llm.common import fold
from tests.llm import samples

SF = "/root/testdata/sf0.01"


def brute_counts(t):
    w = samples.words(t)
    times = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + d for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeats = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), repeats, len(inside)


@pytest.mark.parametrize("text", ["", "a", "a b c", "a b c a b c", "a a a a", "x y x y x y\nx y\n \nx y", "#* <|> $%&", "é\x0bü ö", "b c d a b c\n\n\n"])
def test_base_counts(text):
    assert q.base_counts(text) == brute_counts(text)


def test_base_counts_of_whole_tables():
    for _, t, *_ in samples.texts() + samples.ROWS:
        if t is not None and len(t) < 50_000:
            assert q.base_counts(t) == brute_counts(t)


def test_rules_and_edge_rows(spark):
    docs = samples.clashing(samples.documents(spark))
    rows = q.apply_rules(docs, None).collect()
    assert len(rows) == len(samples.ROWS)
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed) and r["probability"] is None
    assert q.apply_rules(samples.documents(spark, []), None).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert q.learn(docs, labels) is None


def test_quality_on_rows_not_learned_from():
    import duckdb

    rows = duckdb.sql(f"select text, quality from '{SF}/documents.parquet' join '{SF}/labels.parquet' using (doc_id) where text is not null order by hash(doc_id)").fetchall()
    model = q.fit([r[0] for r in rows[:250]], [r[1] for r in rows[:250]])
    p = np.array([model.probability(t) for t, _ in rows[250:]])
    y = np.array([label for _, label in rows[250:]])
    assert ((p >= 0) & (p <= 1)).all()
    assert (p[y == 1] >= q.THRESHOLD).mean() > 0.97
    assert (p[y == 0] < q.THRESHOLD).mean() > 0.5
    assert model.probability("") == model.probability("")


def test_word_grams_do_not_depend_on_place():
    a, b = (list(q.families(t)) for t in ("alpha beta", "  alpha\n beta"))
    assert (a[3] == b[3]).all() and (a[4] == b[4]).all()


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = li.learn(docs.where(fold("doc_id", 4) != 2))
    assert max(map(len, dictionaries.values())) <= li.CONTENT
    out = li.identify(docs, dictionaries, keep=(F.col("lang"), (fold("doc_id", 4) == 2).alias("held_out"))).collect()
    held = [r for r in out if r["held_out"] and not r["rejected"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert np.mean([r["rejected"] for r in out]) < 0.03
    assert all(0 <= r["score"] <= 1 for r in out)
    for r in out[:5]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_language_edge_rows(spark):
    docs = samples.clashing(samples.documents(spark))
    dictionaries = li.learn(docs)
    out = li.identify(docs, dictionaries).collect()
    assert len(out) == len(samples.ROWS)
    for r in out:
        assert r["lang_pred"] in {*dictionaries, li.UNDETERMINED}
    unknown = [r for r in out if r["lang_pred"] == li.UNDETERMINED]
    assert len(unknown) == 4 and all(r["rejected"] and r["score"] == 0 for r in unknown)
    assert li.learn(samples.documents(spark, [])) == {}
    assert li.identify(samples.documents(spark, []), {}).count() == 0
    assert {r["lang_pred"] for r in li.identify(docs, {}).collect()} == {li.UNDETERMINED}


def brute_scores(rows, training, model):
    """Scores from plain counts and the model's classes."""
    trained = [lm.tokens(t or "") for (_, t), used in zip(rows, training, strict=True) if used]
    counts = Counter(w for t in trained for w in t)
    n, v = sum(counts.values()) + len(trained), len(counts) + (len(trained) > 0)
    clustered = [w for w, _ in model.frequent[: model.clustered]]
    symbol = lm.Symbols(clustered, lm.OPEN)
    of = lambda w: int(model.class_of[symbol[w]])
    size, types = Counter(), Counter()
    for w, k in counts.items():
        size[of(w)] += k
        types[of(w)] += 1
    classes = int(model.class_of.max()) + 1
    pairs = np.zeros((classes, classes))
    for t in trained:
        path = [0, *map(of, t), 0]
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += 1
    alone = (pairs.sum(0) + 1) / (pairs.sum() + classes)
    smooth = (pairs + lm.GAMMA * alone) / (pairs.sum(1, keepdims=True) + lm.GAMMA)
    out = []
    for i, t in rows:
        w = lm.tokens(t or "")
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(trained) + 1) / (n + v + 1))
        path = [0, *map(of, w), 0]
        score = sum(math.log10(smooth[a, b]) for a, b in zip(path, path[1:], strict=False))
        score += sum(math.log10((counts[x] + lm.ALPHA) / (size[of(x)] + lm.ALPHA * (types[of(x)] + 1))) for x in w)
        out.append((i, len(w) + 1, sum(counts[x] > 0 for x in w) + (len(trained) > 0), n, base, score))
    return out


@pytest.mark.parametrize("frequent", [30, 1 << 18])
def test_class_model_against_plain_counts(spark, frequent):
    rows = [(r[0], r[1]) for r in samples.ROWS if r[0] != 6] + [(r[0] + 100, r[1]) for r in samples.texts()[:60]]
    docs = samples.clashing(samples.documents(spark, [(i, t, None, None, 0) for i, t in rows]))
    model = lm.learn(docs, fold("doc_id", 7) != 2, clustered=20, classes=4, frequent=frequent)
    training = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for i, _ in rows]
    want = sorted(brute_scores(rows, training, model), key=str)
    got = sorted((tuple(r)[:6] for r in lm.score(docs, model).collect()), key=str)
    key = lambda r: (str(r[0]), r[1], round(r[4], 3))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_class_model_of_nothing(spark):
    empty = samples.documents(spark, [])
    model = lm.learn(empty)
    assert model.train_tokens == 0 and lm.score(empty, model).count() == 0
    rows = lm.score(samples.documents(spark), model).collect()
    assert len(rows) == len(samples.ROWS) and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert all(r["base_score"] == pytest.approx(0) for r in rows)


def test_exchange_raises_likelihood():
    rng = np.random.default_rng(3)
    size, kinds = 41, 4
    true = rng.dirichlet(np.full(kinds, 0.2), kinds)
    of = rng.integers(0, kinds, size)
    bigrams = rng.poisson(40 * true[of][:, of])

    def likelihood(c):
        onto = np.zeros((size, c.max() + 1))
        onto[np.arange(size), c] = 1
        n = onto.T @ bigrams @ onto
        return lm._xlogx(n).sum() - lm._xlogx(n.sum(0)).sum() - lm._xlogx(n.sum(1)).sum()

    values = [likelihood(lm.exchange(bigrams, size - 1, kinds, sweeps)) for sweeps in range(6)]
    assert values == sorted(values) and values[-1] > values[0]


@pytest.mark.parametrize("scale", [1, 10**9])
@pytest.mark.parametrize("seed", range(4))
def test_exchange_ends_where_no_move_helps(seed, scale):
    rng = np.random.default_rng(seed)
    size, words, kinds = 41, 36, 4
    share = 1 / np.arange(1, size + 1)
    bigrams = rng.poisson(4000 * np.outer(share, share) * rng.gamma(0.5, 2, (size, size))) + np.diag(rng.poisson(300 * share))
    bigrams[7], bigrams[:, 7] = bigrams[6], bigrams[:, 6]  # words alike, so ties
    bigrams *= scale

    def likelihood(c):
        onto = np.zeros((size, c.max() + 1))
        onto[np.arange(size), c] = 1
        n = onto.T @ bigrams @ onto
        return lm._xlogx(n).sum() - lm._xlogx(n.sum(0)).sum() - lm._xlogx(n.sum(1)).sum()

    values = [likelihood(lm.exchange(bigrams, words, kinds, sweeps)) for sweeps in range(60)]
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(values, values[1:], strict=False))
    of = lm.exchange(bigrams, words, kinds, 60)
    assert (of == lm.exchange(bigrams, words, kinds, 61)).all()
    for w in range(1, 1 + words):
        for c in range(1, 1 + kinds):
            other = of.copy()
            other[w] = c
            assert likelihood(other) <= values[-1] + 1e-9 * abs(values[-1])


def test_held_out_perplexity_beats_unigrams(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = lm.score(docs, lm.learn(docs, fold("doc_id", 7) != 2), keep=((fold("doc_id", 7) == 2).alias("held_out"),)).where("held_out")
    base, score = out.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_dictionaries_do_not_depend_on_parts(spark, monkeypatch):
    rows = [(i, f"text number {i * i} of language {i % 2}", f"l{i % 2}", None, 0) for i in range(600)]
    docs = samples.documents(spark, rows)
    made = li.learn(docs, sample=40)
    monkeypatch.setattr(li, "PARTS", 1)
    assert li.learn(docs.repartition(7), sample=40) == made
    assert {c: d.count(b"\n") for c, d in made.items()} == {"l0": 39, "l1": 39}


@pytest.mark.parametrize(
    "text", ["the first of these languages", "und dies ist die zweite Sprache", "THE " * 3000, "a", "\u00e9\U0001f642 mixed"]
)
def test_language_choice_equals_plain_compression(text):
    import zstandard

    dictionaries = {"en": b"the first of these languages is english", "de": b"und dies ist die zweite sprache"}
    data = text.lower().encode()
    plain = []
    for code in sorted(dictionaries):
        known = zstandard.ZstdCompressionDict(dictionaries[code], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total = 0
        for begin in range(0, len(data), li.BLOCK):
            one = zstandard.ZstdCompressor(level=li.LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)
            total += len(one.compress(data[begin : begin + li.BLOCK]))
        plain.append((total, code))
    classify = li.Classifier(dictionaries)
    assert classify.sizes(text) == sorted(plain)
    assert classify(text)[0] == min(plain)[1]


def test_languages_of_long_texts_or_many_copies(spark):
    long = {"la": "gallia est omnis divisa in partes tres quarum unam incolunt belgae ", "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan "}
    rows = [(i, " ".join(f"{t}{1000 * i + k}" for k in range(400)), code, None, 0) for i, (code, t) in enumerate(list(long.items()) * 3)]
    # Copies that hold most of a language, and null ids alike; few are learned from, and no row of them is wanted twice.
    rows += [(None if i % 2 else 50, samples.PROSE, "en", None, 0) for i in range(400)]
    rows += [(1000 + i, f"number {i} of the english texts that are told apart", "en", None, 0) for i in range(20)]
    docs = samples.documents(spark, rows)
    dictionaries = li.learn(docs)
    assert dictionaries.keys() == {"la", "fi", "en"}
    assert all(li.CONTENT // 2 < len(dictionaries[c]) <= li.CONTENT for c in long)
    assert dictionaries["en"].count(b"\n") == 20 and dictionaries["en"].count(samples.PROSE.encode()) == 1
    got = {r["doc_id"]: r for r in li.identify(samples.documents(spark, [(i, t * 2, None, None, 0) for i, t in enumerate(long.values())]), dictionaries).collect()}
    assert [got[i]["lang_pred"] for i in range(2)] == list(long) and not got[0]["rejected"]


@pytest.mark.parametrize("text", ["漢字仮名交じり文", "кириллица", "naïve 🙂", "plain"])
def test_character_grams_are_of_code_points(text):
    found = list(q.families(text))[:3]
    assert [len(x) for x in found] == [len(text), len(text) - 1, len(text) - 2]
    grams = [len({text[i : i + n] for i in range(len(text) - n + 1)}) for n in (1, 2, 3)]
    assert [len(set(x.tolist())) for x in found] == grams


def test_most_frequent_words_without_a_sort(spark):
    rows = [(b"a", 9), (b"b", 5), (b"c", 5), (b"x" * 65, 50)] + [(b"t%d" % i, 2) for i in range(3000)] + [(b"once%d" % i, 1) for i in range(50)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    assert lm.most_frequent(counts, 1000000) == sorted((r for r in rows if len(r[0]) < 65), key=lambda r: (-r[1], r[0]))
    some = lm.most_frequent(counts, 1003)
    assert some[:3] == [(b"a", 9), (b"b", 5), (b"c", 5)] and 900 < len(some) <= 1003 and {n for _, n in some[3:]} == {2}
    assert some == lm.most_frequent(counts.repartition(7), 1003)
    assert lm.most_frequent(counts, 2) == [(b"a", 9)] or lm.most_frequent(counts, 2) in ([(b"a", 9), (b"b", 5)], [(b"a", 9), (b"c", 5)])
    assert lm.most_frequent(counts.limit(0), 5) == []


def test_exchange_of_the_second_tier_against_plain_counts(spark):
    rng = np.random.default_rng(5)
    known = [b"w%d" % i for i in range(30)]
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.4, 12) if i < 40) for _ in range(200)] + ["", "w29", "w3 W4"]
    paths = lm.symbol_paths(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), known, 2)
    class_of = np.concatenate([[0], 1 + np.arange(8) % 3, 4 + np.arange(22) % 2, [4, 5]])
    got = lm.exchange_round(paths, class_of, 9, 31, 3)
    symbol = lm.Symbols(known, 2)
    pairs, around = np.full((6, 6), 0.5), {}
    for t in texts:
        s = [0, *(symbol[w] for w in lm.tokens(t)), 0]
        for a, b in zip(s, s[1:], strict=False):
            pairs[class_of[a], class_of[b]] += 1
            around.setdefault(a, []).append((0, class_of[b]))
            around.setdefault(b, []).append((1, class_of[a]))
    want = class_of.copy()
    for w in range(9, 31):
        gain = [sum(math.log(pairs[c, o] / pairs[c].sum()) if not side else math.log(pairs[o, c] / pairs[:, c].sum()) for side, o in around.get(w, [])) for c in (1, 2, 3)]
        if w in around:
            want[w] = 1 + int(np.round(gain, 6).argmax())
    assert (got == want).all() and (got[:9] == class_of[:9]).all()


def test_second_tier_lowers_held_out_perplexity(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = fold("doc_id", 7) == 2
    sums = [lm.score(docs, lm.learn(docs, ~held, clustered=100, rounds=r), keep=(held.alias("h"),)).where("h").agg(F.sum("score")).first()[0] for r in (0, 1)]
    assert sums[1] > sums[0]


def brute_score(model, text):
    """The score of a text from its n-grams one by one."""
    size, low, wide = len(model.weights), (1 << 32) - 1, (1 << 64) - 1

    def bucket(h, family, bits=low):
        return (((h + family) * 0x9E3779B1 & bits) >> 8) & (size - 1)

    def hashed(points):
        h = 0
        for p in points:
            h = (h * 0x01000193 + p) & low
        return h

    points = [ord(c) for c in text]
    found = [[bucket(hashed(points[i : i + n]), n) for i in range(len(points) - n + 1)] for n in q.CHARACTER_GRAMS]
    words = []
    for w in text.encode().split():
        h = sum((b + 1) * pow(0x01000193, i, 1 << 64) for i, b in enumerate(w)) * 0x9E3779B1 & wide
        words.append(h ^ (h >> 15))
    found += [[bucket(h, 101, wide) for h in words], [bucket((a * 31 + b) & wide, 102, wide) for a, b in zip(words, words[1:], strict=False)]]
    return model.bias + sum(float(np.mean([model.weights[b] for b in f], dtype=np.float64)) for f in found if f)


def test_verdict_against_plain_scoring(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, (_, t, *_) in enumerate(samples.ROWS) if t is None or len(t) < 10_000] + [
        (100 + i, f"{samples.PROSE} number {i} " * 3 + " ".join(f"w{i}x{k}" for k in range(60 + i)), "en", "s", 1) for i in range(40)
    ], samples.SCHEMA)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = q.learn(docs, labels)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = q.apply_rules(docs, model).collect()
    assert len(got) == len(texts)
    for r in got:
        p = 1 / (1 + math.exp(-(model.slope * brute_score(model, texts[r["doc_id"]]) + model.shift)))
        assert r["probability"] == pytest.approx(p, rel=1e-6)
        assert r["kept"] == (not r["base_failed"] and r["probability"] >= q.THRESHOLD)


def test_learning_takes_features_of_whole_rows(spark):
    rows = [(i, f"{'good words follow' if i % 2 else '# * $ |'} {i} " * 5, "en", "s", 1) for i in range(30)]
    # Ids repeat, with equal and with other texts; the sample stays within its bound.
    rows += [(3, rows[3][1], "en", "s", 1), (3, "other", "en", "s", 1), (4, None, "en", "s", 1), (None, "x", "en", "s", 1)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    docs = samples.clashing(samples.documents(spark, rows))
    one, two = q.learn(docs, labels), q.learn(docs.repartition(5), labels)
    assert (one.weights == two.weights).all() and one[1:] == two[1:]
    plain = q.fit([t for _, t, *_ in rows[:30]], [i % 2 for i in range(30)])
    assert plain.probability("good words follow 7") > 0.5 > plain.probability("# * $ | 8")
    assert one.probability("good words follow 7") > 0.5 > one.probability("# * $ | 8")
