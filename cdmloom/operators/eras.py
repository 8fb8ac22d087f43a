"""Derived tables: observation periods and condition, drug and dose eras."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdmloom.functions.keys import hash_key
from cdmloom.functions.values import EHR_RECORD
from cdmloom.operators.ingredients import at_ingredients, daily_doses

# Fixed value: exposures at most this many days apart belong to one era.
ERA_GAP_DAYS = 30


def observation_period(visits: DataFrame, key=hash_key) -> DataFrame:
    """First to last visit day of every person."""
    spans = visits.groupBy("person_id").agg(
        F.min("visit_start_date").alias("observation_period_start_date"),
        F.max("visit_end_date").alias("observation_period_end_date"),
    )
    return spans.select(
        F.expr(key("person_id")).alias("observation_period_id"),
        "person_id",
        "observation_period_start_date",
        "observation_period_end_date",
        F.lit(EHR_RECORD).cast("int").alias("period_type_concept_id"),
    )


def islands(
    df: DataFrame, keys: Sequence[str], start: Column, end: Column, gap_days: int = ERA_GAP_DAYS
) -> DataFrame:
    """Merge date spans per key that overlap or lie at most ``gap_days`` apart.

    Spans are first reduced to one row per key and start day (latest end, number
    of spans). Days are few, so the window over one key stays small even where
    that key holds a large share of all rows. Gives ``era_start``, ``era_end``,
    ``spans`` and ``gap`` (days inside the era not covered by any span).
    """
    days = (
        df.select(*keys, start.alias("__start"), F.coalesce(end, start).alias("__end"))
        .groupBy(*keys, "__start")
        .agg(F.max("__end").alias("__end"), F.count(F.lit(1)).alias("__spans"))
    )
    by_day = W.partitionBy(*keys).orderBy("__start")
    earlier = by_day.rowsBetween(W.unboundedPreceding, -1)
    hole = F.datediff("__start", "__reach")
    marked = days.withColumn("__reach", F.max("__end").over(earlier)).withColumn(
        "__new", F.when(F.col("__reach").isNull() | (hole > gap_days), 1).otherwise(0)
    )
    return (
        marked.withColumn("__era", F.sum("__new").over(by_day))
        .groupBy(*keys, "__era")
        .agg(
            F.min("__start").alias("era_start"),
            F.max("__end").alias("era_end"),
            F.sum("__spans").alias("spans"),
            F.sum(F.when((F.col("__new") == 0) & (hole > 0), hole).otherwise(0)).alias("gap"),
        )
        .drop("__era")
    )


def _known(df: DataFrame, concept: str, keep_unmapped: bool) -> DataFrame:
    df = df.filter(F.col("person_id").isNotNull())
    return df if keep_unmapped else df.filter(F.col(concept) != 0)


def condition_era(
    conditions: DataFrame, gap_days: int = ERA_GAP_DAYS, keep_unmapped: bool = False, key=hash_key
) -> DataFrame:
    """Periods of one condition of one person; a missing end counts as the start."""
    eras = islands(
        _known(conditions, "condition_concept_id", keep_unmapped),
        ["person_id", "condition_concept_id"],
        F.col("condition_start_date"),
        F.col("condition_end_date") if "condition_end_date" in conditions.columns
        else F.lit(None).cast("date"),
        gap_days,
    )
    return eras.select(
        F.expr(key("person_id", "condition_concept_id", "era_start")).alias("condition_era_id"),
        "person_id",
        "condition_concept_id",
        F.col("era_start").alias("condition_era_start_date"),
        F.col("era_end").alias("condition_era_end_date"),
        F.col("spans").cast("int").alias("condition_occurrence_count"),
    )


def drug_era(
    exposures: DataFrame,
    gap_days: int = ERA_GAP_DAYS,
    keep_unmapped: bool = False,
    key=hash_key,
    ingredients: DataFrame | None = None,
    keep_products: bool = False,
) -> DataFrame:
    """Periods of one drug of one person: by ingredient where ``ingredients`` tells them, else by product."""
    if ingredients is not None:
        exposures = at_ingredients(exposures, ingredients, keep_products)
    eras = islands(
        _known(exposures, "drug_concept_id", keep_unmapped),
        ["person_id", "drug_concept_id"],
        F.col("drug_exposure_start_date"),
        F.col("drug_exposure_end_date"),
        gap_days,
    )
    return eras.select(
        F.expr(key("person_id", "drug_concept_id", "era_start")).alias("drug_era_id"),
        "person_id",
        "drug_concept_id",
        F.col("era_start").alias("drug_era_start_date"),
        F.col("era_end").alias("drug_era_end_date"),
        F.col("spans").cast("int").alias("drug_exposure_count"),
        F.col("gap").cast("int").alias("gap_days"),
    )


def dose_era(
    exposures: DataFrame,
    gap_days: int = ERA_GAP_DAYS,
    keep_unmapped: bool = False,
    key=hash_key,
    drug_strength: DataFrame | None = None,
) -> DataFrame:
    """Eras of one drug at one dose, by ingredient and daily dose where ``drug_strength`` is given.

    Else the exposures need ``unit_concept_id`` and ``dose_value`` columns.
    """
    if drug_strength is not None:
        exposures = daily_doses(exposures, drug_strength)
    keys = ["person_id", "drug_concept_id", "unit_concept_id", "dose_value"]
    eras = islands(
        _known(exposures, "drug_concept_id", keep_unmapped).filter(F.col("dose_value").isNotNull()),
        keys,
        F.col("drug_exposure_start_date"),
        F.col("drug_exposure_end_date"),
        gap_days,
    )
    return eras.select(
        F.expr(key(*keys, "era_start")).alias("dose_era_id"),
        *keys,
        F.col("era_start").alias("dose_era_start_date"),
        F.col("era_end").alias("dose_era_end_date"),
    )
