"""Value expressions that recipes share. None of them raises on bad text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Concept for rows recorded by an EHR, and the unknown concept.
EHR_RECORD = 32817
UNKNOWN = 0


def case_map(code: Column, targets: Mapping[str, int], otherwise: int = UNKNOWN) -> Column:
    """Inline map for a handful of codes."""
    out = None
    for value, concept in targets.items():
        out = (F if out is None else out).when(code == value, F.lit(concept))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def birth_parts(birth: Column) -> list[Column]:
    return [
        F.year(birth).alias("year_of_birth"),
        F.month(birth).alias("month_of_birth"),
        F.dayofmonth(birth).alias("day_of_birth"),
        birth.cast("timestamp").alias("birth_datetime"),
    ]


def event_date(moment: Column) -> Column:
    return moment.cast("date")


def safe_number(text: Column) -> Column:
    return text.try_cast("double")


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text to a date, NULL where it is not one."""
    return F.try_to_date(text.cast("string"), "yyyyMMdd")


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text.cast("string")) != "", text)


def source_value(code: Column) -> Column:
    """The whole code as text; ``long_source_values`` of the profiling operators counts what is over-long."""
    return code.cast("string")


def literal_concept(concept_id: int) -> Column:
    return F.lit(concept_id).cast("int")
