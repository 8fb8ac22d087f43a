"""Connected components of an edge table, by alternating stars.

Each round points every node's larger neighbours at its smallest one (large star), then its smaller
neighbours and itself (small star), until no edge changes. Minima are aggregates and hops are joins,
so a node with very many neighbours is never gathered in one place. Rounds are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) from edges (u, v): v is the smallest node of u's component; smallest nodes have no row."""
    edges = edges.where(F.col("u") != F.col("v"))
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hops = large.join(least, "u")
        small = hops.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        edges = stored(small.distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges
