"""Joining points to the spans that hold them, as an equal join on bins of the axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, TimestampNTZType, TimestampType

#: Days (of dates and timestamps) or units (of numbers) a bin holds.
BIN_WIDTH = 32


def _position(df: DataFrame, expr: str) -> Column:
    """Whole days or units of ``expr``, rounded down, so that what lies between two values lies between their positions."""
    kind = df.select(F.expr(expr)).schema[0].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_date(F.expr(expr).cast("date")).cast("long")
    if isinstance(kind, (IntegralType, DecimalType)):
        return F.floor(F.expr(expr)).cast("long")
    raise TypeError(f"cannot bin {expr!r} of type {kind.simpleString()}: dates, timestamps, integers and decimals only")


def range_join(
    points: DataFrame,
    spans: DataFrame,
    between: tuple[str, str, str],
    keys: Sequence[tuple[Column, Column]] = (),
    how: str = "inner",
    extra: Column | None = None,
    width: int = BIN_WIDTH,
) -> DataFrame:
    """``points`` joined with the ``spans`` whose begin and end enclose them, ends included.

    ``between`` is (point, begin, end), the first over ``points``. A point lies in one bin; a span is repeated
    for each bin it touches, so a pair meets once and a left join stays one. The spans are cut to the range of the
    points first, by a subquery, so an open end costs no more than that range; ``width`` should be about the length of a
    usual span. Adaptive execution splits a bin that holds many points.

    A NULL point, begin or end matches nothing, nor does a span that ends before it begins.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a range join is inner or left from its points, not {how}")
    point, begin, end = between
    at = _position(points, point)
    first, last = (points.select(f(at)).scalar() for f in (F.min, F.max))
    # A point's bin cannot overflow; of spans only the part within the points' range is repeated.
    low = F.floor(F.greatest(_position(spans, begin), first) / width)
    high = F.floor(F.least(_position(spans, end), last) / width)
    touched = spans.filter(F.expr(f"({begin}) <= ({end})")).withColumns({"__low": low, "__high": high})
    touched = touched.filter("__low <= __high").withColumn("__span_bin", F.explode(F.sequence("__low", "__high")))
    placed = points.withColumn("__point_bin", F.floor(at / width))
    on = (F.col("__point_bin") == F.col("__span_bin")) & F.expr(f"({point}) between ({begin}) and ({end})")
    for a, b in keys:
        on = on & (a == b)
    if extra is not None:
        on = on & extra
    return placed.join(touched, on, how).drop("__point_bin", "__low", "__high", "__span_bin")
