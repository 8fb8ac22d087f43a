"""Hard negatives of anchors, mined from a secondary-sort shuffle.

An anchor's positives are its best rows of the same label; a negative of a positive is a row of another label whose
score is close below the positive's. Scores travel under the key (anchor, descending score, id): rows are partitioned by the
anchor alone and sorted by the whole key within partitions, which is what ``repartitionAndSortWithinPartitions`` does, here
by the engine's own sort that spills. One pass over a sorted partition then does the rest: a positive opens a window, each
negative that follows is emitted into the windows that it still fits, and a window closes when it is full or the scores fall
below its floor. An iterator holds the open windows and a few negatives of the present score, never an anchor's rows.

Anchors meet candidates in a grid of blocks of bounded size, scored as matrices. A block hands on what may still count and no
more: first its best rows of the anchor's label, from which the same kind of shuffle finds each anchor's positives; then, their
scores being known, its first negatives in each of their windows. So a block sends a few rows for each anchor, however many it holds.

Defined results: a row whose id, label or vector is null, or whose vector has a null or non-finite component, takes no part;
rows of the anchor's own id are neither its positives nor its negatives; each row with an anchor's id is an anchor
of its own; an anchor meets rows of its own dimension; equal scores go to the smaller id; repeated rows count each; an anchor
without positives or without negatives has no rows; an empty table gives no rows. Scores are exact whatever the components;
one beyond 64 bits counts as the largest or smallest number of 64 bits. Only id, label and vector are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import lists, stored
from cdmloom.llm.vector_topk import usable

POSITIVES = 5
NEGATIVES = 5
SCALE = 256
#: A negative's score is at least this many hundredths of the positive's, and at most as high.
FLOOR = 80
#: Rows of a block of candidates, and of anchors; anchors scored at once.
CANDIDATES = 8192
ANCHORS = 2048
AT_ONCE = 128

_ENDS = (-(1 << 63), (1 << 63) - 1)
_EXACT = 1 << 53
_LARGEST = 1.7976931348623157e308


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two tables of whole numbers given as floats, as 64-bit numbers.

    Rows whose numbers are too large for exact floats are multiplied as whole numbers of any size.
    """
    out = np.zeros((len(a), len(b)), np.int64)
    most = (_EXACT / max(1, a.shape[1])) ** 0.5
    near, other = (np.abs(x).max(axis=1, initial=0) <= most for x in (a, b))
    out[np.ix_(near, other)] = (a[near] @ b[other].T).astype(np.int64)
    for mine, theirs in ((~near, np.ones(len(b), bool)), (near, ~other)):
        if mine.any() and theirs.any():
            left, right = ([[int(x) for x in row] for row in side.tolist()] for side in (a[mine], b[theirs]))
            exact = [[min(max(sum(x * y for x, y in zip(r, c, strict=True)), _ENDS[0]), _ENDS[1]) for c in right] for r in left]
            out[np.ix_(mine, theirs)] = exact
    return out


def _whole(x: Column, scale: int) -> Column:
    """floor(scale * x) as a double; what is beyond 2^53 has no fraction."""
    scaled = F.greatest(F.least(x.cast("double") * F.lit(float(scale)), F.lit(_LARGEST)), F.lit(-_LARGEST))
    return F.when(F.abs(scaled) < float(_EXACT), F.floor(scaled).cast("double")).otherwise(scaled)


def _rows(vectors: DataFrame, id: str, label: str | Column, vector: str, scale: int) -> DataFrame:
    """(id, label, dim, v) of the rows that take part; v holds whole numbers as doubles."""
    key = F.col(label) if isinstance(label, str) else label
    rows = vectors.where(usable(vector) & F.col(id).isNotNull() & key.isNotNull())
    v = F.transform(F.col(vector), lambda x: _whole(x, scale))
    return rows.select(F.col(id).cast("long").alias("id"), key.cast("long").alias("label"), F.size(vector).alias("dim"), v.alias("v"))


def _dealt(rows: DataFrame, blocks: int, name: str, other: str, others: int) -> DataFrame:
    """Each row in a block, dealt in turn, once for each block of the other side."""
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
    return rows.withColumn(name, F.monotonically_increasing_id() % blocks).withColumn(other, every)


def _scored(mine: pd.DataFrame, theirs: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame, np.ndarray]]:
    """(anchors, candidates in the order of ids, scores) of a pair of blocks, a few anchors at once."""
    for dim, anchors in theirs.groupby("dim"):
        there = mine[mine["dim"] == dim].sort_values("id", kind="stable")
        if not len(there):
            continue
        table = np.array(there["v"].tolist(), np.float64).reshape(len(there), int(dim))
        for begin in range(0, len(anchors), AT_ONCE):
            some = anchors.iloc[begin : begin + AT_ONCE]
            yield some, there, products(np.array(some["v"].tolist(), np.float64).reshape(len(some), int(dim)), table)


def _first(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best allowed scores, the smaller place first of equal ones."""
    at = np.nonzero(allowed)[0]
    if len(at) > 4 * k:
        least = np.partition(scores[at], -k)[-k]
        at = at[scores[at] >= least]
    return at[np.argsort(~scores[at], kind="stable")][:k]


def _best_positives(k: int):
    def run(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for anchors, there, scores in _scored(mine, theirs):
            ids, labels = there["id"].to_numpy(np.int64), there["label"].to_numpy(np.int64)
            for row, (anchor, own, label) in enumerate(zip(anchors["anchor"], anchors["id"], anchors["label"], strict=True)):
                at = _first(scores[row], (labels == label) & (ids != own), k)
                out += [(anchor, own, i, s) for i, s in zip(ids[at].tolist(), scores[row][at].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["anchor", "anchor_id", "id", "score"]).astype("int64")

    return run


def _window(score: int, floor: int) -> tuple[int, int]:
    """Least and greatest score of a positive's negatives; empty if least is above greatest."""
    return -(-floor * score // 100), score


def _window_negatives(k: int, floor: int):
    def run(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for anchors, there, scores in _scored(mine, theirs):
            ids, labels = there["id"].to_numpy(np.int64), there["label"].to_numpy(np.int64)
            for row, (anchor, own, label, known) in enumerate(zip(anchors["anchor"], anchors["id"], anchors["label"], anchors["positives"], strict=True)):
                other = (labels != label) & (ids != own)
                at: set[int] = set()
                for positive in {int(p) for p in known}:
                    least, most = _window(positive, floor)
                    if least <= most:
                        at.update(_first(scores[row], other & (scores[row] >= least) & (scores[row] <= most), k).tolist())
                out += [(anchor, own, ids[i], scores[row][i]) for i in at]
        return pd.DataFrame(out, columns=["anchor", "anchor_id", "id", "score"]).astype("int64")

    return run


def _secondary_sort(rows: DataFrame) -> DataFrame:
    """Rows by anchor, each anchor's by descending score and ascending id; positives before negatives of the same key."""
    order = ("anchor", F.desc("score"), "id", F.desc("positive"))
    return rows.repartition("anchor").sortWithinPartitions(*order)


def _leading(k: int):
    """The first k rows of every anchor of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, taken = None, 0
        for batch in batches:
            keep = []
            for i, anchor in enumerate(batch.column(0).to_pylist()):
                present, taken = (present, taken) if anchor == present else (anchor, 0)
                if taken < k:
                    keep.append(i)
                    taken += 1
            yield batch.take(pa.array(keep, pa.int64()))

    return run


class _Window:
    def __init__(self, id: int, score: int, floor: int) -> None:
        self.id, self.score, self.given = id, score, 0
        self.least = _window(score, floor)[0]


def _stream(k: int, floor: int):
    """Open a window at each positive and emit the negatives that follow into it, over one sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, score_now = None, None
        open_: list[_Window] = []
        level: list[int] = []  # the first negatives of the present score: a positive of that score may follow them
        for batch in lists(batches):
            out: list[tuple] = []

            def emit(window: _Window, id: int, score: int, anchor_id: int, out: list = out) -> None:
                window.given += 1
                out.append((anchor_id, window.id, window.given, id, window.score, score))

            for anchor, anchor_id, id, score, positive in zip(*batch, strict=True):
                if anchor != present:
                    present, score_now, open_ = anchor, None, []
                if score != score_now:
                    score_now, level = score, []
                    open_ = [w for w in open_ if w.given < k and w.least <= score]
                if positive:
                    window = _Window(id, score, floor)
                    if window.least <= score:
                        for n in level:
                            emit(window, n, score, anchor_id)
                        open_.append(window)
                    continue
                for window in open_:
                    if window.given < k:
                        emit(window, id, score, anchor_id)
                if len(level) < k:
                    level.append(id)
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

    return run


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
_SCORES = "anchor long, anchor_id long, id long, score long"


def mine(
    vectors: DataFrame, anchors: Column, id: str = "vec_id", label: str | Column = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, floor: int = FLOOR, scale: int = SCALE,
    candidate_rows: int = CANDIDATES, anchor_rows: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` tells which rows are anchors. For each of an anchor's ``positives`` best rows of its label: the first
    ``negatives`` rows of other labels that score from ``floor`` hundredths of the positive's score up to that score.
    """
    rows = stored(_rows(vectors, id, label, vector, scale), "vectors")
    asked = _rows(vectors.where(F.coalesce(anchors, F.lit(False))), id, label, vector, scale)
    asked = stored(asked.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    blocks = max(1, -(-rows.count() // candidate_rows))
    anchor_blocks = max(1, -(-asked.count() // anchor_rows))
    left = _dealt(rows, blocks, "b", "a", anchor_blocks).groupBy("b", "a")

    right = _dealt(asked, anchor_blocks, "a", "b", blocks).groupBy("b", "a")
    best = left.cogroup(right).applyInPandas(_best_positives(positives), _SCORES).withColumn("positive", F.lit(True))
    best = stored(_secondary_sort(best).mapInArrow(_leading(positives), best.schema), "positives")

    known = best.groupBy("anchor").agg(F.collect_list("score").alias("positives"))
    right = _dealt(asked.join(known, "anchor"), anchor_blocks, "a", "b", blocks).groupBy("b", "a")
    found = left.cogroup(right).applyInPandas(_window_negatives(negatives, floor), _SCORES).withColumn("positive", F.lit(False))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return _secondary_sort(best.unionByName(found)).mapInArrow(_stream(negatives, floor), schema)
