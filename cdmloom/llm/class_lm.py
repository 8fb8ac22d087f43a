"""Scores of a class-based bigram language model.

P(word | word before) = P(class | class before) * P(word | class). Words get their classes by exchange, in two
tiers. The ``CLUSTERED`` most frequent words are put into ``CLASSES`` classes one by one: each goes to the class
that raises the likelihood of the class bigrams most, until none moves. All other words of at least ``LEAST``
training tokens, up to ``FREQUENT`` in all, are exchanged together, in Spark: how often each has which class before and after it is
counted in a shuffle, and each goes to the class whose likelihood it raises most, to first order in its own
counts, which are small against those of a class. That is repeated until none moves, ``ROUNDS`` times at most.
Words rarer than that, seen or not, are in one of ``OPEN`` classes by a hash of their last two bytes, so that
their class needs no table. Transitions are smoothed towards the classes' own frequencies, emissions by an added
``ALPHA``, with one share for words not seen.

All training texts are counted, in passes over the texts or over their numbers:

1. words: each task counts in bounded tables and the counts are summed in a shuffle;
2. paths: texts as numbers of words, stored, which the passes of the exchange read in place of the texts;
3. bigrams of symbols (a clustered word, an open class, or the text's edge), for the first tier;
4. classes before and after each word of the second tier, once a round, and bigrams of classes;
5. scores: the frequent words' counts are broadcast, a table of fixed size, of words of at most ``WORD_BYTES``
   bytes. The rest of the words are joined with the table of counts by a shuffle.

Tokens are words in lower case (A to Z only), then one end for each text. Defined results: a null text counts as
empty and has its end as only token; without training texts all counts are 0; null ids and repeated rows come
out as they went in; an empty table gives no rows; only the id, the text and what ``training`` names are read, so
other columns may have any name.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import count
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import small_batches, stored, whole_text

CLUSTERED = 1024
CLASSES = 32
OPEN = 32
FREQUENT = 1 << 18
#: Distinct words a task counts before it hands its counts on.
COUNTED = 400_000
#: Neighbours of words a task gathers before it adds them up.
GATHERED = 1 << 21
#: Paths a task looks at together.
PATHS = 64
#: Bytes of the longest word that a table on the driver may hold.
WORD_BYTES = 64
#: Training tokens of a word of the second tier, at least: with fewer, a class of its own choice says more of chance than of the word.
LEAST = 8
#: Exchanges of the words of the second tier.
ROUNDS = 2
ALPHA = 0.1
GAMMA = 10.0


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()


def open_class(word: bytes, n: int = OPEN) -> int:
    return zlib.crc32(word[-2:]) % n


def _open_class(word: str, n: int) -> Column:
    return F.pmod(F.crc32(F.substring(word, -2, 2)), F.lit(n)).cast("int")


# Counting


def word_counts(texts: DataFrame, counted: int = COUNTED) -> DataFrame:
    """(word, n) over the column ``text``. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def counts() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return made

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(tokens(text))
                if len(seen) > counted:
                    yield counts()
        yield counts()

    small_batches(texts.sparkSession)
    return stored(texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def most_frequent(counts: DataFrame, frequent: int = FREQUENT) -> list[tuple[bytes, int]]:
    """At most ``frequent`` words, the most frequent first, found by counts of counts and not by a sort of all words.

    Of the words of the last count, those of the first slots of a hash are taken, as many slots as fit.
    """
    short = counts.where(F.length("word") <= WORD_BYTES)
    left, least, slots = frequent, 0, 0
    for n, words in sorted(((r[0], r[1]) for r in short.groupBy("n").count().collect()), reverse=True):
        if words > left:
            slot = F.pmod(F.xxhash64("word"), F.lit(1024))
            for _, some in sorted((r[0], r[1]) for r in short.where(F.col("n") == n).groupBy(slot).count().collect()):
                if some > left:
                    break
                left, slots = left - some, slots + 1
            least = n
            break
        left -= words
    if slots:
        places = [r[0] for r in short.where(F.col("n") == least).select(slot.alias("slot")).distinct().orderBy("slot").limit(slots).collect()]
        chosen = (F.col("n") > least) | (F.col("n") == least) & (slot <= places[-1])
    else:
        chosen = F.col("n") > least
    table = short.where(chosen).select("word", "n").toArrow()
    return sorted(zip(table["word"].to_pylist(), table["n"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))


class Symbols(dict):
    """Word to symbol: 0 is the edge of a text, then the known words, then the open classes."""

    def __init__(self, known: list[bytes], n_open: int) -> None:
        super().__init__((w, i + 1) for i, w in enumerate(known))
        self.first_open, self.n_open = len(known) + 1, n_open

    def __missing__(self, word: bytes) -> int:
        return self.first_open + open_class(word, self.n_open)


_CACHE: dict[str, Any] = {}


def _kept(token: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, once in a worker; a new token takes the place of the last one."""
    if token not in _CACHE:
        _CACHE.clear()
        _CACHE[token] = make()
    return _CACHE[token]


def symbol_paths(texts: DataFrame, known: list[bytes], n_open: int = OPEN) -> DataFrame:
    """(path): the symbols of each text behind the edge, packed as 32-bit numbers. Stored."""
    shared, token = texts.sparkSession.sparkContext.broadcast(known), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol = _kept(token, lambda: Symbols(shared.value, n_open))
        for batch in batches:
            paths = [np.array([0, *map(symbol.__getitem__, tokens(t))], np.int32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(paths, pa.binary())], ["path"])

    small_batches(texts.sparkSession)
    return stored(texts.mapInArrow(run, "path binary"), "paths")


def _steps(batch: pa.RecordBatch) -> np.ndarray:
    """The symbols of a batch of paths; as each begins at the edge, only the last needs one behind it."""
    return np.append(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), np.int32(0))


def symbol_bigrams(paths: DataFrame, onto: np.ndarray) -> np.ndarray:
    """Counts of symbols one after the other, the texts' edges included, after ``onto`` has put symbols together."""
    spark, size = paths.sparkSession, int(onto.max(initial=0)) + 1
    shared = spark.sparkContext.broadcast(onto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, PATHS):
                s = shared.value[_steps(batch.slice(begin, PATHS))].astype(np.int64)
                total += np.bincount(s[:-1] * size + s[1:], minlength=size * size)
        at = np.flatnonzero(total)
        for begin in range(0, len(at), 1 << 16):
            some = at[begin : begin + (1 << 16)]
            yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], ["cell", "n"])

    cells = paths.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(size * size, np.int64)
    table = cells.toArrow()
    out[table["cell"].to_numpy()] = table["n"].to_numpy()
    return out.reshape(size, size)


def neighbours(paths: DataFrame, class_of: np.ndarray, begin: int, end: int) -> DataFrame:
    """(word, cells) of the symbols from ``begin`` to ``end``, several rows a word.

    Cells are pairs of 32-bit numbers: the class behind, or the class before plus the number of classes, and how often.
    """
    spark, n_classes = paths.sparkSession, int(class_of.max()) + 1
    shared = spark.sparkContext.broadcast(class_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []

        def counts() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate([np.zeros(0, np.int64), *gathered]), return_counts=True)
            gathered.clear()
            word, cell = np.divmod(key, 2 * n_classes)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            packed = np.stack([cell, n], 1).astype(np.int32)
            places = (np.append(first, len(key)) * packed.itemsize * 2).astype(np.int32)
            cells = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(places), pa.py_buffer(packed)])
            return pa.record_batch([pa.array(word[first].astype(np.int32)), cells], ["word", "cells"])

        held = 0
        for batch in batches:
            for first in range(0, batch.num_rows, PATHS):
                s = _steps(batch.slice(first, PATHS))
                c = shared.value[s]
                at = np.flatnonzero((s >= begin) & (s < end))
                key = s[at].astype(np.int64) * (2 * n_classes)
                # A word is never the first or last symbol, as edges are around every text.
                gathered += [key + c[at + 1], key + n_classes + c[at - 1]]
                held += 2 * len(at)
                if held > GATHERED:
                    yield counts()
                    held = 0
        yield counts()

    return paths.mapInArrow(run, "word int, cells binary")


# Classes


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, n_words: int, classes: int = CLASSES, sweeps: int | None = None) -> np.ndarray:
    """The class of every symbol: the edge is 0, words have 1 to ``classes``, open classes follow.

    Words start in turn by frequency; each move raises the likelihood of the class bigrams by more than rounding
    can, so no state comes twice and it ends by itself when none moves, or after ``sweeps``.
    """
    size, n_classes = len(bigrams), 1 + classes + (len(bigrams) - 1 - n_words)
    of = np.zeros(size, np.int64)
    of[1 : 1 + n_words] = 1 + np.arange(n_words) % classes
    of[1 + n_words :] = 1 + classes + np.arange(size - 1 - n_words)
    onto = np.zeros((size, n_classes))
    onto[np.arange(size), of] = 1
    counts = onto.T @ bigrams @ onto
    after, before = bigrams @ onto, bigrams.T @ onto  # of each symbol: what follows, what precedes, by class
    targets = np.arange(1, 1 + classes)
    rounding = 1e-13 * float(_xlogx(bigrams.sum(dtype=float)))
    for _ in count() if sweeps is None else range(sweeps):
        moved = 0
        for w in range(1, 1 + n_words):
            own, itself = of[w], float(bigrams[w, w])
            r, l = after[w].copy(), before[w].copy()
            r[own] -= itself
            l[own] -= itself
            counts[own] -= r
            counts[:, own] -= l
            counts[own, own] -= itself
            rows, columns = counts[targets], counts[:, targets].T
            # Bigrams of a class with the word on the other side are in that class's sum wherever the word goes.
            out_sum, in_sum = (counts.sum(1) + l)[targets], (counts.sum(0) + r)[targets]
            diagonal = counts[targets, targets]
            gain = (_xlogx(rows + r) - _xlogx(rows)).sum(1) + (_xlogx(columns + l) - _xlogx(columns)).sum(1)
            gain -= _xlogx(diagonal + r[targets]) + _xlogx(diagonal + l[targets]) - _xlogx(diagonal)
            gain += _xlogx(diagonal + r[targets] + l[targets] + itself)
            gain -= _xlogx(out_sum + r.sum() + itself) - _xlogx(out_sum) + _xlogx(in_sum + l.sum() + itself) - _xlogx(in_sum)
            new = int(targets[gain.argmax()]) if gain.max() - gain[own - 1] > rounding else own
            counts[new] += r
            counts[:, new] += l
            counts[new, new] += itself
            if new != own:
                of[w] = new
                after[:, own] -= bigrams[:, w]
                after[:, new] += bigrams[:, w]
                before[:, own] -= bigrams[w]
                before[:, new] += bigrams[w]
                moved += 1
        if not moved:
            break
    return of


def exchange_round(paths: DataFrame, class_of: np.ndarray, begin: int, end: int, classes: int = CLASSES) -> np.ndarray:
    """``class_of`` with each symbol from ``begin`` to ``end`` in the class from 1 to ``classes`` that gains most by it.

    The gain is that of the likelihood of the class bigrams to first order: the sum over the word's neighbours
    of the log share that their class has behind and before the class it goes to.
    """
    pairs = symbol_bigrams(paths, class_of) + 0.5
    n_classes = len(pairs)
    own = slice(1, 1 + classes)
    behind = np.log(pairs[own] / pairs[own].sum(1, keepdims=True)).T
    before = np.log(pairs[:, own] / pairs[:, own].sum(0))
    shared = paths.sparkSession.sparkContext.broadcast(np.concatenate([behind, before]))

    def chosen(words: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        best = 1 + (seen @ shared.value).round(6).argmax(1)
        return pa.record_batch([pa.array(words.astype(np.int32)), pa.array(best.astype(np.int32))], ["word", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums the rows of each word, which come one after the other; only the last word's sums are held."""
        words, seen = np.zeros(0, np.int64), np.zeros((0, 2 * n_classes))
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.concatenate([words, batch.column(0).to_numpy()])
            begins = np.flatnonzero(np.diff(found, prepend=-1))
            place = (np.cumsum(np.diff(found, prepend=-1) != 0) - 1)[len(words) :]
            lists = batch.column(1).to_pylist()
            cells = np.frombuffer(b"".join(lists), np.int32).reshape(-1, 2)
            at = np.repeat(place, [len(x) // 8 for x in lists]) * (2 * n_classes) + cells[:, 0]
            total = np.bincount(at, cells[:, 1], len(begins) * 2 * n_classes).reshape(len(begins), -1)
            total[: len(words)] += seen
            yield chosen(found[begins[:-1]], total[:-1])
            words, seen = found[begins[-1:]], total[-1:]
        yield chosen(words, seen)

    rows = neighbours(paths, class_of, begin, end).repartition("word").sortWithinPartitions("word")
    best = rows.mapInArrow(run, "word int, class int").toArrow()
    out = class_of.copy()
    out[best["word"].to_numpy()] = best["class"].to_numpy()
    return out


class Model(NamedTuple):
    counts: DataFrame  # (word, n) of all training words
    frequent: list[tuple[bytes, int]]  # the most frequent first
    clustered: int  # how many of them have a class by exchange, in either tier
    train_tokens: int
    train_types: int
    train_texts: int
    class_of: np.ndarray  # of each symbol
    transition: np.ndarray  # log10, by class before and class
    class_tokens: np.ndarray
    class_types: np.ndarray
    alpha: float

    def emission(self, n: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 P(word | class) of words with n training tokens."""
        return np.log10((n + self.alpha) / (self.class_tokens[of] + self.alpha * (self.class_types[of] + 1)))

    def base(self, n: np.ndarray) -> np.ndarray:
        """log10 of the add-one unigram share."""
        return np.log10((n + 1) / (self.train_tokens + 1 * (self.train_types + 1)))


def learn(
    docs: DataFrame, training: Column | None = None, text: str = "text", clustered: int = CLUSTERED, classes: int = CLASSES, n_open: int = OPEN,
    frequent: int = FREQUENT, alpha: float = ALPHA, gamma: float = GAMMA, rounds: int = ROUNDS, least: int = LEAST,
) -> Model:
    """The model of the texts of the rows that ``training`` selects; of all rows by default.

    ``clustered`` is the size of the first tier; without ``rounds``, the words of the second stay in their open classes.
    """
    texts = (docs if training is None else docs.where(training)).select(whole_text(text).alias("text"))
    counts = word_counts(texts)
    sums = counts.agg(F.sum("n"), F.count("*")).first()
    known = most_frequent(counts, frequent)
    words = [w for i, (w, n) in enumerate(known) if i < clustered or n >= least]
    paths = symbol_paths(texts, words, n_open)
    # First tier: the words beyond it count as their open classes.
    n_first = min(clustered, len(words))
    opened = 1 + n_first + np.array([open_class(w, n_open) for w in words[n_first:]], np.int64)
    onto = np.concatenate([np.arange(1 + n_first), opened, 1 + n_first + np.arange(n_open)])
    bigrams = symbol_bigrams(paths, onto)
    class_of = exchange(bigrams, n_first, classes)[onto]
    # Second tier.
    for _ in range(rounds if len(words) > n_first else 0):
        moved = exchange_round(paths, class_of, 1 + n_first, 1 + len(words), classes)
        if (moved == class_of).all():
            break
        class_of = moved
    n_classes = int(class_of.max()) + 1
    pairs = symbol_bigrams(paths, class_of)
    n_texts = int(pairs[0].sum())
    alone = (pairs.sum(0) + 1) / (pairs.sum() + n_classes)
    transition = np.log10((pairs + gamma * alone) / (pairs.sum(1, keepdims=True) + gamma))
    tokens_of, types_of = np.zeros(n_classes), np.zeros(n_classes)
    np.add.at(tokens_of, class_of[1 : 1 + len(words)], [n for _, n in known[: len(words)]])
    np.add.at(types_of, class_of[1 : 1 + len(words)], 1)
    # What is not clustered is counted by open class; the clustered words are taken off again.
    for c, n, types in counts.groupBy(_open_class("word", n_open)).agg(F.sum("n"), F.count("*")).collect():
        tokens_of[class_of[1 + len(words) + c]] += n
        types_of[class_of[1 + len(words) + c]] += types
    for w, n in known[: len(words)]:
        tokens_of[class_of[1 + len(words) + open_class(w, n_open)]] -= n
        types_of[class_of[1 + len(words) + open_class(w, n_open)]] -= 1
    return Model(
        counts, known, len(words), (sums[0] or 0) + n_texts, sums[1] + (n_texts > 0), n_texts, class_of, transition, tokens_of, types_of, alpha
    )


# Scores


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", keep: tuple[Column, ...] = (), n_open: int = OPEN) -> DataFrame:
    """(id, *keep, n_tokens, n_known, base_score, score, perplexity) of every whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    lean = model._replace(counts=None)  # type: ignore[arg-type]
    shared = spark.sparkContext.broadcast(lean)
    first_open = 1 + model.clustered
    end_base = float(model.base(np.array(model.train_texts))) if model.train_tokens else 0.0
    names = ["n_tokens", "n_known", "base_score", "score"]

    token = uuid.uuid4().hex

    def tables() -> tuple:
        m: Model = shared.value
        place = {w: i for i, (w, _) in enumerate(m.frequent)}
        n = np.array([n for _, n in m.frequent], np.int64)
        symbol = np.array([i + 1 if i < m.clustered else first_open + open_class(w, n_open) for i, (w, _) in enumerate(m.frequent)], np.int64)
        klass = m.class_of[symbol] if len(symbol) else symbol
        return m, place, klass, m.base(n), m.emission(n, klass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, place, klass, base, emission = _kept(token, tables)
        edge = np.zeros(1, np.int64)
        for batch in batches:
            made, offsets, missing, times = [], [0], [], []
            for t in batch.column("__text").to_pylist():
                found = tokens(t)
                at = np.array([place.get(w, -1) for w in found], np.int64)
                known = at >= 0
                of = np.zeros(len(at), np.int64)
                of[known] = klass[at[known]]
                rare = [found[i] for i in np.flatnonzero(~known)]
                of[~known] = m.class_of[[first_open + open_class(w, n_open) for w in rare]]
                path = np.concatenate([edge, of, edge])
                seen = at[known]
                made.append(
                    (
                        len(found) + 1,
                        int(known.sum()) + (m.train_texts > 0),
                        float(base[seen].sum()) + end_base,
                        float(emission[seen].sum() + m.transition[path[:-1], path[1:]].sum()),
                    )
                )
                for w, k in Counter(rare).items():
                    missing.append(w)
                    times.append(k)
                offsets.append(len(missing))
            kept = [x for x in batch.schema.names if x != "__text"]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            columns = [pa.array([x[i] for x in made], kind) for i, kind in enumerate(kinds)]
            pairs = pa.StructArray.from_arrays([pa.array(missing, pa.binary()), pa.array(times, pa.int64())], ["word", "times"])
            rare_lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
            yield pa.record_batch([*map(batch.column, kept), *columns, rare_lists], [*kept, *names, "rare"])

    rows = docs.select(F.col(id), *keep, F.monotonically_increasing_id().alias("__row"), whole_text(text).alias("__text"))
    kinds = ", ".join(f"`{n}` {k}" for n, k in rows.dtypes if n != "__text")
    # Stored, so that rows and their rare words carry the same numbers whatever is repeated later.
    part = stored(
        rows.mapInArrow(run, f"{kinds}, n_tokens long, n_known long, base_score double, score double, rare array<struct<word: binary, times: bigint>>"), "scores"
    )
    rare = part.select("__row", F.explode("rare").alias("r")).select("__row", "r.word", "r.times")
    n = F.coalesce(F.col("n"), F.lit(0))
    denominators = model.class_tokens + model.alpha * (model.class_types + 1)
    by_open = [float(denominators[model.class_of[first_open + c]]) for c in range(n_open)]
    share = (n + F.lit(model.alpha)) / F.element_at(F.array(*map(F.lit, by_open)), _open_class("word", n_open) + 1)
    unigram = (n + F.lit(1)) / F.lit(float(model.train_tokens + model.train_types + 1))
    more = (
        rare.join(model.counts, "word", "left")
        .select("__row", F.when(n > 0, F.col("times")).otherwise(0).alias("k"), (F.col("times") * F.log10(unigram)).alias("b"), (F.col("times") * F.log10(share)).alias("s"))
        .groupBy("__row")
        .agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("s").alias("s"))
    )
    joined = part.drop("rare").join(more, "__row", "left")
    zero = F.lit(0.0)
    return joined.select(
        *[F.col(c) for c in rows.columns if c not in ("__row", "__text")],
        "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("s", zero)).alias("score"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


