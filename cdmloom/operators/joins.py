"""Joining the sources of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.model.spec import Join
from cdmloom.operators.ranges import range_join
from cdmloom.operators.spread import BROADCAST_BYTES, attach, attach_keeping_right

# Accepted names of join types.
JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "full": "outer",
    "full_outer": "outer",
    "outer": "outer",
    "cross": "cross",
}


def join_type(name: str) -> str:
    try:
        return JOIN_TYPES[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unsupported join type {name!r}, use one of {sorted(JOIN_TYPES)}") from None


def join_sources(
    frames: Mapping[str, DataFrame],
    joins: Sequence[Join] = (),
    broadcast_bytes: int | None = None,
    fraction: float = 0.01,
) -> DataFrame:
    """Left fold of the aliased sources along ``joins``.

    Inner and left joins are left to Catalyst, which broadcasts by file sizes, and to AQE, which splits skewed
    partitions, unless ``broadcast_bytes`` is given: then those by ``keys`` measure the right side and spread hot keys beyond
    that size. A right or full join by ``keys`` alone always does so, as the engine cannot split its hot keys. Only the type
    ``cross`` may come without any condition, whatever the sizes: naming it is the opt-in. A join with ``between``, inner or
    left, is an equal join over bins of dates or numbers.
    """
    for alias in [j.left for j in joins[:1]] + [j.right for j in joins]:
        if alias not in frames:
            raise KeyError(f"join references unknown alias {alias!r}")
    if not joins:
        if len(frames) != 1:
            raise ValueError("without joins exactly one source is required")
        ((alias, only),) = frames.items()
        return only.alias(alias)

    out = frames[joins[0].left].alias(joins[0].left)
    for j in joins:
        right = frames[j.right].alias(j.right)
        how = join_type(j.type)
        extra = F.expr(j.condition) if j.condition else None
        if j.between:
            pairs = [(F.expr(a), F.expr(b)) for a, b in j.keys]
            out = range_join(out, right, tuple(j.between), pairs, how, extra)
            continue
        if j.keys and how in ("inner", "left") and broadcast_bytes is not None:
            pairs = [(F.expr(a), F.expr(b)) for a, b in j.keys]
            out = attach(out, right, pairs, how, broadcast_bytes, extra, fraction, rows_first=True)
            continue
        if j.keys and extra is None and how in ("right", "outer"):
            pairs = [(F.expr(a), F.expr(b)) for a, b in j.keys]
            limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
            out = attach_keeping_right(out, right, pairs, how, limit, fraction)
            continue
        on = extra
        for a, b in j.keys:
            equal = F.expr(a) == F.expr(b)
            on = equal if on is None else on & equal
        if on is not None:
            out = out.join(right, on, how)
        elif how == "cross":
            out = out.crossJoin(right)
        else:
            raise ValueError(f"join with {j.right!r} needs a condition or keys")
    return out
