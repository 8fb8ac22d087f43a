"""Quality rules: countable rules on words, and a classifier whose probability meets a fixed threshold.

The classifier is a logistic regression over hashed n-grams of words (1 and 2) and of characters (code points) in
words and between them (1 to 3). A feature is the share of its family's n-grams that fall in its
bucket, so a text's score is a mean of weights over all its n-grams, whatever its length. It is
fitted on a bounded sample of labelled rows (``SAMPLE``, by a hash of the id); a third of the
sample is kept apart to calibrate the probability (Platt). Texts are scored whole, in Arrow
batches where they lie; nothing but the sample moves.

Defined results: a null text has no words, so its counts are 0 and it fails the base rules. Without
labels of both kinds there is no verdict beyond the base rules. Labels that are null or whose text is
null are not learned from; a document with several labels counts once for each. Null ids and repeated
rows come out as they went in; an empty table gives no rows; only the id and the text are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import small_batches, whole_text

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 2000
#: Buckets that all n-grams share; a power of two.
BUCKETS = 1 << 16
WORD_GRAMS = (1, 2)
CHARACTER_GRAMS = (1, 2, 3)
#: A text whose calibrated probability of good quality is lower is not kept.
THRESHOLD = 0.35
#: Base rules: words needed, and the share of repeated words in per cent that is too much.
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = list(b"#*$%&|<>")
WHITE = list(b" \t\n\x0b\x0c\r")

ROUNDS = 100
PENALTY = 1e-3
STEP = 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    pair = w[:-1] * len(numbers) + w[1:]
    if len(numbers) > 1 << 20:  # else three numbers fit in 63 bits as they are
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(numbers) + w[2:]
    order = np.argsort(window)
    same = np.diff(window[order]) == 0
    twice = np.zeros(len(w), bool)
    twice[order[:-1][same]] = True
    twice[order[1:][same]] = True
    inside = twice.copy()
    inside[1:] |= twice[:-1]
    inside[2:] |= twice[:-2]
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    of_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    return (
        len(words),
        len(text) - int(of_byte[WHITE].sum()),
        int(of_byte[SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


_MIX = np.uint32(0x9E3779B1)


def _buckets(hashes: np.ndarray, family: int, buckets: int) -> np.ndarray:
    return ((hashes + np.uint32(family)) * _MIX >> np.uint32(8)) & np.uint32(buckets - 1)


def families(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """The bucket of every n-gram, one array for each family."""
    raw = np.frombuffer(text.encode(), np.uint8)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    rolled = points
    for n in CHARACTER_GRAMS:
        if len(points) < n:
            break
        rolled = points if n == 1 else rolled[:-1] * np.uint32(0x01000193) + points[n - 1 :]
        yield _buckets(rolled, n, buckets)
    data = raw.astype(np.uint32)
    inside = _IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    if not len(begins):
        return
    # A word's polynomial hash: the sum of (byte + 1) * r^place over its bytes.
    place = np.arange(len(raw))
    place[begins[0] :] -= np.repeat(begins, np.diff(begins, append=len(raw)))
    powers = _powers(int((ends - begins).max()) + 1)
    valued = (data + np.uint32(1)) * powers[np.minimum(place, len(powers) - 1)]
    valued[~inside] = 0
    words = np.add.reduceat(valued, begins) * _MIX
    words ^= words >> np.uint32(15)
    for n in WORD_GRAMS:
        if len(words) < n:
            break
        yield _buckets(words if n == 1 else words[:-1] * np.uint32(31) + words[1:], 100 + n, buckets)


_IN_WORD = np.ones(256, bool)
_IN_WORD[WHITE] = False
_POWERS = np.ones(1, np.uint32)


def _powers(n: int) -> np.ndarray:
    """1, r, r^2, ... modulo 2^64, kept from text to text."""
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 64), 0x01000193, np.uint32)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS[:n]


class Model(NamedTuple):
    """Weights over buckets; slope and shift turn a score into a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str) -> float:
        found = [np.take(self.weights, b).mean(dtype=np.float64) for b in families(text, len(self.weights))]
        return self.bias + float(sum(found))

    def probability(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.score(text) + self.shift, -500, 500))))


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression, by full-batch Adam."""
    index = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows]).astype(np.float64)
    begins = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])[:-1]])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    # Features are brought to like size, so that frequent and rare ones can both count.
    scale = 1 / np.sqrt(np.bincount(index, value**2, buckets) / len(rows) + 1e-6)
    value = value * scale[index]
    balance = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    w, bias = np.zeros(buckets), 0.0
    m, v = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for step in range(1, ROUNDS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(value * w[index], begins) + bias, -30, 30)))
        error = (p - labels) * balance
        gradient = np.append(np.bincount(index, value * error[owner], buckets) + PENALTY * w, error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = STEP * 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w * scale, float(bias)


def _calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt's sigmoid over standardised scores, with his softened targets.

    A ridge on the slope keeps it finite where the scores part the labels without error.
    """
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    middle, spread = scores.mean(), scores.std() + 1e-12
    x = np.stack([(scores - middle) / spread, np.ones(len(scores))], 1)
    at = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (p - target) + 0.1 * at
        curvature = x.T @ x / 4 + 0.1 * np.eye(2)  # bounds the Hessian, so no step overshoots
        at = at - np.linalg.solve(curvature, gradient)
    return float(at[0] / spread), float(at[1] - at[0] * middle / spread)


def features(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and the shares of n-grams in them, summed over the families."""
    dense = np.zeros(buckets)
    for b in families(text, buckets):
        dense += np.bincount(b, minlength=buckets) / len(b)
    at = np.flatnonzero(dense)
    return (at, dense[at].astype(np.float32)) if len(at) else (np.zeros(1, np.int64), np.zeros(1, np.float32))


def fit(texts: list[str], labels: list[int], buckets: int = BUCKETS) -> Model | None:
    """A calibrated model, or None unless both kinds occur. Every third row is for calibration."""
    return fit_features([features(t, buckets) for t in texts], labels, buckets)


def fit_features(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], buckets: int = BUCKETS) -> Model | None:
    """The same from the texts' features."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return None
    apart = np.arange(len(y)) % 3 == 2
    if y[apart].min(initial=1) == y[apart].max(initial=0) or y[~apart].min(initial=1) == y[~apart].max(initial=0):
        apart[:] = False
    w, bias = _fit([r for r, a in zip(rows, apart, strict=True) if not a], y[~apart], buckets)
    held = apart if apart.any() else ~apart
    scores = np.array([bias + float(w[i] @ v) for (i, v), h in zip(rows, held, strict=True) if h])
    slope, shift = _calibrate(scores, y[held])
    return Model(w.astype(np.float32), bias, slope, shift)


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """The model of a sample of ``sample`` labelled rows, the same at every run.

    Texts stay on the executors: the driver gets features, at most 8 bytes for each of ``BUCKETS`` a row, of
    ``sample`` rows at most, also where ids repeat.
    """
    known = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).where(F.col("label").isNotNull() & F.col("id").isNotNull())
    picked = known.orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(picked), "id").select(
        F.xxhash64("id").alias("h"), F.xxhash64("id", "text").alias("t"), F.when(F.col("label") > 0, 1).otherwise(0).alias("label"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(3).to_pylist()]
            packed = [pa.array([x.astype(kind).tobytes() for x in part], pa.binary()) for part, kind in zip(zip(*found), (np.int32, np.float32))]
            yield pa.record_batch([*batch.columns[:3], *(packed or [pa.array([], pa.binary())] * 2)], ["h", "t", "label", "at", "value"])

    small_batches(docs.sparkSession)
    made = rows.mapInArrow(run, "h long, t long, label int, at binary, value binary").orderBy("h", "t", "label").limit(sample).collect()
    unpacked = [(np.frombuffer(r["at"], np.int32).astype(np.int64), np.frombuffer(r["value"], np.float32)) for r in made]
    return fit_features(unpacked, [r["label"] for r in made])


def apply_rules(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_counts(t) for t in texts]
            failed = [base_failed(b[0], b[4]) for b in base]
            p = [None if model is None else model.probability(t) for t in texts]
            kept = [not f and (x is None or x >= threshold) for f, x in zip(failed, p, strict=True)]
            made = [pa.array([b[i] for b in base], pa.int64()) for i in range(5)]
            yield pa.record_batch(
                [batch.column(0), *made, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(p, pa.float64())],
                ["id", *counts, "base_failed", "kept", "probability"],
            )

    kind = dict(docs.dtypes)[id]
    return (
        docs.select(F.col(id).alias("id"), whole_text(text).alias("text"))
        .mapInArrow(run, f"id {kind}, {', '.join(f'{c} long' for c in counts)}, base_failed boolean, kept boolean, probability double")
        .withColumnRenamed("id", id)
    )
