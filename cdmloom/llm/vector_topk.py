"""Exact top-k inner products with a vector-approximation file.

Vectors become whole numbers, floor(scale * x). A uniform grid of ``CELLS`` cells a dimension gives each
vector an approximation of one byte a dimension; approximations and exact vectors are stored apart.
The scan reads approximations only: from a vector's cells follow a lower and an upper bound of its score
with a query. A vector whose upper bound is below the kth largest lower bound cannot be among the best.
The rest are read exactly in the order of their bounds, best first, in growing batches, until each query's
kth exact score is above every bound not yet read.

The scan is dealt in a grid of candidate blocks and query blocks of bounded size, so neither side is ever
held whole and any number of queries works. In each pair of blocks only what beats the block's own kth
lower bound is handed on.

Defined results: a vector that is null, or has a null or non-finite component, takes no part; a query meets
the vectors of its own dimension; equal scores go to the smaller id; repeated ids are rows of their own, and
all rows with a query's id are its own; null ids take no part; an empty table gives no rows; only the id and
the vector are read, so other columns may have any name. Components must fit 2^24 after scaling, else an error says so.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdmloom.llm.common import stored

K = 10
SCALE = 1024
CELLS = 256
#: Rows of a block of candidates, and of queries.
CANDIDATES = 8192
QUERIES = 1024
#: Vectors read exactly for each query in the first round, in units of k; later rounds read FACTOR times more.
FIRST = 3
FACTOR = 4
LARGEST = 1 << 24


def usable(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def whole_numbers(vectors: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(id, dim, v) of the rows that take part; v is packed as 32-bit numbers by the scan."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    checked = F.when(F.exists(scaled, lambda x: F.abs(x) > LARGEST), F.raise_error(F.lit("a component is beyond 2^24 after scaling"))).otherwise(scaled)
    return vectors.where(usable(vector) & F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("id"), F.size(vector).alias("dim"), checked.cast("array<int>").alias("v")
    )


def grid(exact: DataFrame, cells: int = CELLS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each dimension of vectors: the least value and the width of a cell in every place."""
    places = exact.select("dim", F.posexplode("v").alias("place", "x")).groupBy("dim", "place").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim, rows in places.toPandas().groupby("dim"):
        rows = rows.sort_values("place")
        low, high = rows["low"].to_numpy(np.int64), rows["high"].to_numpy(np.int64)
        out[int(dim)] = low, (high - low) // cells + 1
    return out


def _bounds(cells: np.ndarray, low: np.ndarray, width: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of scores, a row for each query. Whole numbers below 2^53, so floats are exact."""
    least = low + cells.astype(np.int64) * width
    most = (least + (width - 1)).astype(np.float64).T
    least = least.astype(np.float64).T
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    return up @ least + down @ most, up @ most + down @ least


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
    candidates: int = CANDIDATES, query_rows: int = QUERIES, cells: int = CELLS,
) -> DataFrame:
    """(query_id, rank, id, score): each query's k largest inner products with rows of other ids."""
    spark = vectors.sparkSession
    exact = stored(whole_numbers(vectors, id, vector, scale), "exact")
    asked = stored(whole_numbers(queries, id, vector, scale).withColumn("query", F.monotonically_increasing_id()), "queries")
    grids = grid(exact.unionByName(asked.drop("query")), cells)
    # The approximation file: one byte a place.
    shared = spark.sparkContext.broadcast(grids)

    def approximate(frames):
        for frame in frames:
            packed = []
            for dim, v in zip(frame["dim"], frame["v"], strict=True):
                if not dim:
                    packed.append(b"")
                    continue
                low, width = shared.value[dim]
                packed.append(((np.asarray(v, np.int64) - low) // width).astype(np.uint8).tobytes())
            yield pd.DataFrame({"id": frame["id"], "dim": frame["dim"], "cells": packed})

    n, n_asked = exact.count(), asked.count()
    deal = max(1, -(-n // candidates))
    deal_asked = max(1, -(-n_asked // query_rows))
    approximation = stored(exact.mapInPandas(approximate, "id long, dim int, cells binary"), "cells")

    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    left = approximation.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(deal))).withColumn("q", each(deal_asked))
    right = asked.withColumn("q", F.pmod(F.xxhash64("query"), F.lit(deal_asked))).withColumn("b", each(deal))

    def scan(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        """Candidates that beat the block's own kth lower bound, with their bounds."""
        parts = [(np.zeros(0, np.int64),) * 5]
        for dim, rows in theirs.groupby("dim"):
            there = mine[mine["dim"] == dim]
            if not len(there):
                continue
            ids = there["id"].to_numpy(np.int64)
            low, width = shared.value.get(int(dim), (np.zeros(0, np.int64), np.ones(0, np.int64)))
            packed = np.frombuffer(b"".join(there["cells"]), np.uint8).reshape(len(ids), int(dim))
            for begin in range(0, len(rows), 128):
                some = rows.iloc[begin : begin + 128]
                q = np.array(some["v"].tolist(), np.int64).reshape(len(some), int(dim))
                lower, upper = _bounds(packed, low, width, q)
                own = ids[None, :] == some["id"].to_numpy(np.int64)[:, None]
                lower[own] = -np.inf
                kth = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] >= k else np.full(len(some), -np.inf)
                r, c = np.nonzero((upper >= kth[:, None]) & ~own)
                parts.append((some["query"].to_numpy()[r], some["id"].to_numpy()[r], ids[c], lower[r, c].astype(np.int64), upper[r, c].astype(np.int64)))
        columns = [np.concatenate([p[i] for p in parts]) for i in range(5)]
        return pd.DataFrame(dict(zip(("query", "query_id", "id", "lower", "upper"), columns, strict=True)))

    bounded = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInPandas(scan, "query long, query_id long, id long, lower long, upper long")
    bounded = stored(bounded, "bounds")
    by_lower = Window.partitionBy("query").orderBy(F.desc("lower"))
    kth = bounded.withColumn("r", F.row_number().over(by_lower)).where(F.col("r") == k).select("query", F.col("lower").alias("kth"))
    by_upper = Window.partitionBy("query").orderBy(F.desc("upper"), "id")
    left_over = bounded.join(kth, "query", "left").where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth")))
    # Rows of one id are read together, so the id counts once, with its best bound.
    left_over = left_over.groupBy("query", "query_id", "id").agg(F.max("upper").alias("upper"))
    order = stored(left_over.select("query", "query_id", "id", "upper", F.row_number().over(by_upper).alias("place")), "order")
    return _read_in_order(order, exact, asked, k, id)


def _read_in_order(order: DataFrame, exact: DataFrame, asked: DataFrame, k: int, id: str) -> DataFrame:
    """Exact scores in the order of the bounds, round by round, until no unread bound can change the best k."""
    done, begin, size = [], 0, FIRST * k
    waiting = order.select("query").distinct()
    dot = F.aggregate(F.zip_with("v", "qv", lambda a, b: a.cast("long") * b.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    dealt = asked.select("query", F.col("v").alias("qv"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    while True:
        batch = order.where((F.col("place") > begin) & (F.col("place") <= begin + size)).join(waiting, "query")
        scored = batch.select("query", "query_id", "id").join(exact.select("id", "dim", "v"), "id").join(dealt, "query").where(F.size("v") == F.size("qv"))
        done.append(stored(scored.select("query", "query_id", "id", dot.alias("score")), "scores"))
        begin, size = begin + size, size * FACTOR
        read = done[0]
        for more in done[1:]:
            read = read.unionByName(more)
        read = read.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        kth = read.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
        next_bound = order.where(F.col("place") == begin + 1).select("query", "upper")
        waiting = stored(next_bound.join(kth, "query", "left").where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))).select("query"), "waiting")
        if waiting.isEmpty():
            return read.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")
