"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cdmloom.operators.durable import durable


def key_text(*parts: str) -> str:
    """SQL text joining ``parts``, each behind its length in bytes, so that no two lists of parts give one text.

    A NULL part is ``~``, which no length begins with.
    """
    slots = ", ".join(f"coalesce(concat(octet_length(cast({p} as string)), ':', cast({p} as string)), '~')" for p in parts)
    return f"concat_ws('|', {slots})"


def hash_key(*parts: str) -> str:
    """64-bit key over SQL expressions; include every resolved concept id."""
    return f"xxhash64({key_text(*parts)})"


def md5_key(*parts: str) -> str:
    """60-bit key from the first 15 hex digits of an md5, reproducible in any SQL engine.

    It is never NULL. Written so that Catalyst knows, which then decides a rule on it without computing it once more.
    """
    return f"coalesce(cast(conv(substring(md5({key_text(*parts)}), 1, 15), 16, 10) as bigint), 0L)"


def wide_key(*parts: str) -> str:
    """128-bit key as 32 hex digits."""
    return f"md5({key_text(*parts)})"


def natural_key(key: Callable[..., str], natural: Sequence[str], *resolved: str) -> str:
    """``key`` over the parts that name a source row and those found for it; NULL where a part that names the row is."""
    missing = " or ".join(f"{p} is null" for p in natural)
    return f"case when {missing} then null else {key(*natural, *resolved)} end"


def key_collisions(df: DataFrame, key: str, *parts: str) -> DataFrame:
    """(key, rows, sources): values of a short key that stand for several lists of parts, told by their 128-bit keys."""
    both = df.select(F.col(key).alias("key"), F.expr(wide_key(*parts)).alias("wide")).groupBy("key", "wide").agg(F.count(F.lit(1)).alias("rows"))
    return both.groupBy("key").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("sources")).where("sources > 1 and key is not null")


def row_number_key(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Consecutive numbers along a total order, without sorting everything in one task.

    Rows are range-partitioned and sorted per partition; the position of each row
    is written down once, so the partition offsets added afterwards always belong
    to the same layout, also when a task has to be repeated. Only one row per
    partition takes part in the running sum of offsets.
    """
    place = "__place"
    ordered = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn(place, F.monotonically_increasing_id())
    )
    ordered = durable(ordered).withColumn("__part", F.expr(f"shiftright({place}, 33)"))
    sizes = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    return (
        ordered.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.expr(f"{place} & {(1 << 33) - 1}") + 1)
        .drop("__part", "__offset", place)
    )
