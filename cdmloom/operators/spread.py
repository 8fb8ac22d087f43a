"""Joins that survive a key holding a large share of all rows.

Two ways, chosen by measurement: a side measured as small is broadcast, so the
large side never moves; otherwise the join shuffles, with the rows of hot keys
(and of NULL keys, which match nothing) spread over several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_BYTES = 30 * 1024 * 1024
SPREAD = 32
HOT_KEYS = 64


# The most a task reads of files and of a shuffle. Its hash tables and sorts take some ten times that.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}
UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def _bytes(size: str) -> int:
    """A size as the engine's settings have it: 67108864, 67108864b, 64m, 64mb."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << UNITS[unit]


def configure(spark: SparkSession) -> SparkSession:
    """Session settings these jobs rely on: UTC, adaptive execution, skew splitting, small tasks.

    Sizes of tasks that are set smaller already stay.
    """
    for name, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }.items():
        spark.conf.set(name, value)
    for name, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    return spark


def _row_bytes(df: DataFrame) -> int:
    return 16 + 8 * len(df.columns)


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in memory: one aggregate over its rows, text counted by length."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    lengths = [F.sum(F.octet_length(F.col(f"`{c}`"))) for c in text]
    seen = df.agg(F.count(F.lit(1)), *lengths).first()
    return seen[0] * _row_bytes(df) + sum(n or 0 for n in seen[1:])


def fits_broadcast(df: DataFrame, limit: int, rows_first: bool = False) -> bool:
    """Whether ``df`` measures at most ``limit`` bytes.

    ``rows_first`` is for sides that may be huge: a row count, which a stored table
    answers from its file footers, rules most of them out before any text is read.
    """
    if limit <= 0 or (rows_first and df.count() * _row_bytes(df) > limit):
        return False
    return measured_bytes(df) <= limit


def _key_hash(keys: Sequence[Column]) -> Column:
    return F.xxhash64(*[k.cast("string") for k in keys])


def _row_hash(df: DataFrame) -> str:
    """SQL text hashing the whole row; maps have no hash of their own and go in as JSON."""
    mapped = any("map<" in f.dataType.simpleString() for f in df.schema.fields)
    return "xxhash64(to_json(struct(*)))" if mapped else "xxhash64(*)"


def hot_keys(df: DataFrame, keys: Sequence[Column], fraction: float = 0.01) -> list[int]:
    """Hashes of the most frequent keys, at most ``HOT_KEYS`` of them.

    A sample is enough: the list only decides where rows travel. A key left out
    holds at most a small share of the rows, and any choice gives the same result.
    """
    picked = df.select(_key_hash(keys).alias("k")).sample(fraction, seed=7)
    top = picked.groupBy("k").count().orderBy(F.desc("count"), "k").limit(HOT_KEYS)
    return [r["k"] for r in top.collect()]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[Column, Column]],
    how: str = "left",
    extra: Column | None = None,
    fraction: float = 0.01,
    spread: int = SPREAD,
) -> DataFrame:
    """Inner or left equi-join with hot and NULL keys of ``left`` spread over ``spread`` tasks.

    The salt is a hash of the row, so a key that lies in one input partition is spread too, and
    a repeated task sends every row where the first attempt sent it, whatever order it reads in.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot spread a {how} join")
    lkeys, rkeys = [p[0] for p in pairs], [p[1] for p in pairs]
    hot = hot_keys(left, lkeys, fraction)
    no_key = F.lit(False)
    for k in lkeys:
        no_key = no_key | k.isNull()
    scattered = F.expr(f"cast(pmod({_row_hash(left)}, {spread}) as int)")
    left = left.withColumn(
        "__salt", F.when(no_key | _key_hash(lkeys).isin(hot), scattered).otherwise(F.lit(0))
    )
    copies = F.when(_key_hash(rkeys).isin(hot), F.sequence(F.lit(0), F.lit(spread - 1)))
    right = right.withColumn("__copy", F.explode(copies.otherwise(F.array(F.lit(0)))))
    on = F.col("__salt") == F.col("__copy")
    for lk, rk in pairs:
        on = on & (lk == rk)
    if extra is not None:
        on = on & extra
    return left.join(right, on, how).drop("__salt", "__copy")


def attach(
    facts: DataFrame,
    side: DataFrame,
    pairs: Sequence[tuple[Column, Column]],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    extra: Column | None = None,
    fraction: float = 0.01,
    rows_first: bool = False,
) -> DataFrame:
    """Join ``side`` to facts: broadcast when measured small, spread otherwise."""
    if not fits_broadcast(side, broadcast_bytes, rows_first):
        return spread_join(facts, side, pairs, how, extra, fraction)
    on = F.lit(True) if extra is None else extra
    for lk, rk in pairs:
        on = on & (lk == rk)
    return facts.join(F.broadcast(side), on, how)


def attach_keeping_right(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[Column, Column]],
    how: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    fraction: float = 0.01,
) -> DataFrame:
    """Right or full equi-join of facts on the left, for which the engine cannot split a hot key.

    The matches (with the unmatched left rows, for ``outer``) are an inner or left join that
    :func:`attach` can broadcast or spread. The right rows without a match follow: they are told
    by the distinct keys of ``left``, which are reduced before they move.
    """
    if how not in ("right", "outer"):
        raise ValueError(f"{how} is neither a right nor a full join")
    inner = {"right": "inner", "outer": "left"}[how]
    found = attach(left, right, pairs, inner, broadcast_bytes, None, fraction, rows_first=True)
    names = [f"__key_{i}" for i in range(len(pairs))]
    keys = left.select(*[lk.alias(n) for (lk, _), n in zip(pairs, names)]).distinct()
    on = F.lit(True)
    for (_, rk), n in zip(pairs, names):
        on = on & (rk == F.col(n))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    return found.union(right.join(keys, on, "left_anti").select(*nulls, "*"))
