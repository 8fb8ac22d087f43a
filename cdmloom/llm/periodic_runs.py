"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period q and length of 2 q at least that no neighbouring word extends. Periods
up to ``DIRECT`` are read off by comparing words q apart. Longer ones come in dyadic scales: scale t finds the
periods from 2 t - 1 to 4 t - 2 in this way.

- A context is t words. Contexts with a period of t / 3 at most are left out: each lies in a run of that period, which a
  smaller scale has found already.
- The others get a hash; a place whose context has the least hash of some t neighbouring places is selected. Whether
  a place is selected depends on the words around it alone, so what repeats is selected alike.
- Two selected places with equal contexts, as far apart as the scale's periods go, propose their distance as a period.
  Equal contexts that are not periodic lie more than t / 3 apart, so each place has at most 12 partners.
- Common extensions to both sides, by binary search on prefix hashes, give the run with the proposed period.

This misses no run but those whose first q words have a period p of t / 3 at most. Such a run leads from one run of period p
into the next one that touches it, and q is known modulo p from how the two lie to each other, so these pairs propose
their periods too. Of the periods proposed for one stretch the smallest is its period. At the end every reported run is
compared word by word, so a clash of hashes cannot pass; if one occurs its text is done again by plain comparison.

The words of many texts are laid end to end, with a mark of its own after each; a scale looks at the texts that are long enough for it.
The work is words x scales, whatever repeats, and a task holds one batch of texts.

Defined results: null and empty texts, and texts without words, have no runs and collapse to the empty text; null ids
and repeated rows come out as they went in; of runs of one length the one that starts first counts as the greatest, then
the one of smaller period; an empty table gives no rows; only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import WORD, lists, small_batches, whole_text
from cdmloom.llm.span_hashes import Prefixes

#: Periods found by comparing words; the first scale goes on from here.
DIRECT = 6
#: Words of a run at least.
LEAST = 12
#: Words that are worked on together; a longer text is a batch of its own.
BATCH_WORDS = 1 << 18

_GONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of each number that orders them at random."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(1)


def _least_ahead(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i : i + width], for a width that is a power of two; past the end nothing counts."""
    out, step = x.copy(), 1
    while step < width:
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        step *= 2
    return out


def _most_behind(x: np.ndarray, width: int) -> np.ndarray:
    out, step = x.copy(), 1
    while step < width:
        out[step:] = np.maximum(out[step:], out[: len(out) - step].copy())
        step *= 2
    return out


class _Runs:
    """Runs found so far as (start, end, period), the smallest period for each stretch."""

    def __init__(self) -> None:
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        whole = end - start >= 2 * period
        start, end, period = (np.concatenate([old, new[whole]]) for old, new in ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), bool)
        first[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
        self.start, self.end, self.period = start[first], end[first], period[first]


def _direct(words: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches in which words q apart are alike."""
    same = np.zeros(max(0, len(words) - q) + 2, np.int8)
    same[1:-1] = words[q:] == words[: len(words) - q] if len(words) > q else 0
    edges = np.diff(same)
    start, stop = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    return start, stop + q, np.full(len(start), q)


def _extended(prefixes: Prefixes, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretch of each period around a place and the place one period on."""
    on = place + period
    ahead = prefixes.extensions(place, on, prefixes.size - on)
    behind = prefixes.extensions(place, on, place, back=True)
    return place - behind, on + ahead, period


def _synchronised(prefixes: Prefixes, inside: np.ndarray, runs: _Runs, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of selected places with equal contexts of t words; ``inside`` marks places with a whole context."""
    context = np.zeros(len(inside), np.uint64)
    for (begin, one), (_, two) in zip(prefixes.windows(0, t), prefixes.windows(1, t), strict=True):
        context[begin : begin + len(one)] = (one << np.uint64(31)) | two
    open_ = inside.copy()
    # Contexts within a run of a small period are left out.
    small = (runs.period <= t // 3) & (runs.end - runs.start >= t)
    covered = np.zeros(len(inside) + 1, np.int64)
    np.add.at(covered, runs.start[small], 1)
    np.add.at(covered, runs.end[small] - t + 1, -1)
    open_ &= np.cumsum(covered[:-1]) == 0
    order = np.where(open_, _mixed(context), _GONE)
    # A place is selected if it is the least of some window, so if the greatest least of the windows on it is its own.
    chosen = np.nonzero(open_ & (_most_behind(_least_ahead(order, t), t) == order))[0]
    if not len(chosen):
        return chosen, chosen
    chosen = chosen[np.argsort(context[chosen], kind="stable")]
    places, distances, lag = [], [], 1
    known = context[chosen]
    while lag < len(chosen):
        apart = chosen[lag:] - chosen[:-lag]
        near = (known[lag:] == known[:-lag]) & (apart < 4 * t - 1)
        if not near.any():
            break
        found = near & (apart >= 2 * t - 1)
        places.append(chosen[:-lag][found])
        distances.append(apart[found])
        lag += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *distances])


def _from_touching(prefixes: Prefixes, runs: _Runs, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) from pairs of runs of one small period that touch."""
    long = np.nonzero((runs.period <= t // 3) & (runs.end - runs.start >= 2 * t - 1))[0]
    long = long[np.lexsort((runs.start[long], runs.period[long]))]
    a, b = long[:-1], long[1:]
    touch = (runs.period[a] == runs.period[b]) & (runs.start[b] <= runs.end[a])
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in zip(a[touch].tolist(), b[touch].tolist(), strict=True):
        p, first, second = int(runs.period[i]), int(runs.start[i]), int(runs.start[j])
        turns = second + np.arange(p)
        alike = np.nonzero(prefixes.spans(turns, turns + p) == prefixes.spans(np.array([first]), np.array([first + p])))[0]
        if not len(alike):
            continue
        most = min(4 * t - 2, int(runs.end[i]) - first, int(runs.end[j]) - second)
        shift = (second + int(alike[0]) - first) % p
        low = 2 * t - 1
        period = np.arange(low + (shift - low) % p, most + 1, p)
        places.append(np.maximum(first, second - period))
        periods.append(period)
    return np.concatenate(places), np.concatenate(periods)


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text of word numbers (from 0), its runs of two periods or more: rows (start, length, period), in order."""
    sizes = np.array([len(x) for x in texts], np.int64)
    found = [np.zeros((0, 3), np.int64) for _ in texts]
    here = np.nonzero(sizes > 1)[0]
    if not len(here):
        return found
    mark = max(int(texts[i].max()) for i in here) + 1

    def lay(of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of these texts with a mark after each, where each starts, and how many words of the text follow each place."""
        parts, left = [], []
        for n, i in enumerate(of.tolist()):
            parts += [texts[i], np.array([mark + n])]
            left.append(np.arange(len(texts[i]), -1, -1))
        starts = np.concatenate([[0], np.cumsum(sizes[of] + 1)])
        return np.concatenate(parts).astype(np.int64), starts, np.concatenate(left)

    words, starts, left = lay(here)
    runs = _Runs()
    for q in range(1, DIRECT + 1):
        runs.add(*_direct(words, q))
    t, done = 4, []
    while True:
        # Texts too short for this scale are complete; the others go on without them.
        long = sizes[here] >= 2 * (2 * t - 1)
        if not long.all():
            owner = np.searchsorted(starts, runs.start, "right") - 1
            ready = ~long[owner]
            done.append((here[owner[ready]], runs.start[ready] - starts[owner[ready]], runs.end[ready] - runs.start[ready], runs.period[ready]))
            kept = ~ready
            where, begin, length, period = owner[kept], runs.start[kept] - starts[owner[kept]], (runs.end - runs.start)[kept], runs.period[kept]
            number = np.cumsum(long) - 1
            here = here[long]
            if not len(here):
                break
            words, starts, left = lay(here)
            runs = _Runs()
            runs.add(starts[number[where]] + begin, starts[number[where]] + begin + length, period)
        prefixes = Prefixes(words + 1)
        place, period = _synchronised(prefixes, left >= t, runs, t)
        more, other = _from_touching(prefixes, runs, t)
        runs.add(*_extended(prefixes, np.concatenate([place, more]), np.concatenate([period, other])))
        t *= 2
    owner, start, length, period = (np.concatenate([d[k] for d in done]) for k in range(4))
    order = np.lexsort((period, start, owner))
    table = np.stack([start, length, period], 1)[order]
    bounds = np.searchsorted(owner[order], np.arange(len(texts) + 1))
    return [table[bounds[i] : bounds[i + 1]] for i in range(len(texts))]


def _holds(words: np.ndarray, runs: np.ndarray) -> bool:
    for start, length, q in runs.tolist():
        here = words[start : start + length]
        if not np.array_equal(here[q:], here[:-q]):
            return False
    return True


def _plain_runs(words: np.ndarray) -> np.ndarray:
    """All runs by comparing words at every distance."""
    runs = _Runs()
    for q in range(1, len(words) // 2 + 1):
        runs.add(*_direct(words, q))
    order = np.lexsort((runs.period, runs.start))
    return np.stack([runs.start, runs.end - runs.start, runs.period], 1)[order]


def reported(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text that have ``least`` words or more, compared word by word."""
    out = []
    for words, runs in zip(texts, find_runs(texts), strict=True):
        runs = runs[runs[:, 1] >= least]
        if not _holds(words, runs):
            runs = _plain_runs(words)
            runs = runs[runs[:, 1] >= least]
        out.append(runs)
    return out


def _kept(size: int, runs: np.ndarray) -> np.ndarray:
    """Words that no run repeats."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, collapsed: bool = False) -> DataFrame:
    """(id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every document.

    ``start`` to ``exponent_milli`` are of the greatest run. With ``collapsed`` the text without the words that a run
    repeats follows, as column ``collapsed``.
    """
    schema = f"`{id}` long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    schema += ", collapsed string" if collapsed else ""

    def work(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        codes = [np.array([number.setdefault(w, len(number)) for w in words], np.int64) for words in texts]
        rows = []
        for doc, words, runs in zip(ids, texts, reported(codes, least), strict=True):
            listed = "".join(f"{start},{length},{q}\n" for start, length, q in runs.tolist())
            kept = words
            best: tuple = (None,) * 4
            if len(runs):
                start, length, q = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
                best = start, length, q, 1000 * length // q
                kept = [words[i] for i in np.nonzero(_kept(len(words), runs))[0]]
            short = b" ".join(kept)
            row = (doc, len(words), len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(short).hexdigest())
            rows.append((*row, short.decode()) if collapsed else row)
        names = [id, "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed"]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if n < 7 else pa.string()) for n, c in enumerate(columns)], names=names[: len(columns)]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, words = [], [], 0
        for batch in lists(batches):
            for doc, text_ in zip(*batch, strict=True):
                one = text_.encode().split()
                if words and words + len(one) > BATCH_WORDS:
                    yield work(ids, texts)
                    ids, texts, words = [], [], 0
                ids.append(doc)
                texts.append(one)
                words += len(one)
        if ids:
            yield work(ids, texts)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id).cast("long").alias("id"), whole_text(text).alias("text")).mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where a tenth of the texts, chosen by id, is made periodic from some word on. A null id is not chosen."""
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    words = F.regexp_extract_all(whole_text(text), F.lit(WORD), F.lit(0))

    def planted(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))), " ")

    # Bound as a variable, so that the words are cut once and not once for each of them.
    once = F.transform(F.array(words), planted)[0]
    chosen = (h % 10 == 0) & whole_text(text).rlike(WORD)
    return docs.withColumn(text, F.when(chosen, once).otherwise(F.col(text)))
