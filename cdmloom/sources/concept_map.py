"""The source-to-concept map: seed files, upsert, draft files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmloom.functions.values import blank_to_null, compact_date
from cdmloom.model.vocabulary import CONCEPT_MAP, CONCEPT_MAP_KEY
from cdmloom.sources.tables import StaleVersion, commits, read_target, write_target

MAP_COLUMNS = tuple(CONCEPT_MAP.names)


def normalize_seed_map(raw: DataFrame) -> DataFrame:
    """Seed rows as text to the typed map: ids, ``yyyyMMdd`` dates, blank reason to NULL."""
    return raw.select(
        "source_code",
        F.col("source_concept_id").try_cast("int").alias("source_concept_id"),
        "source_vocabulary_id",
        "source_code_description",
        F.col("target_concept_id").try_cast("int").alias("target_concept_id"),
        "target_vocabulary_id",
        compact_date(F.col("valid_start_date")).alias("valid_start_date"),
        compact_date(F.col("valid_end_date")).alias("valid_end_date"),
        blank_to_null(F.col("invalid_reason")).alias("invalid_reason"),
    )


def read_seed_map(spark: SparkSession, path: str) -> DataFrame:
    return normalize_seed_map(
        spark.read.option("header", True).option("inferSchema", False).csv(path)
    )


def upsert_concept_map(current: DataFrame, seed: DataFrame) -> DataFrame:
    """The map after the seed: matched keys take the seed's row, new keys are added.

    Applying the same seed twice changes nothing. A key given twice by the seed is an error.
    """
    keys = list(CONCEPT_MAP_KEY)
    twice = seed.groupBy(*keys).count().filter("count > 1").orderBy(*keys).limit(5).collect()
    if twice:
        raise ValueError(f"seed repeats keys: {[tuple(r)[:2] for r in twice]}")
    new = seed.select(*MAP_COLUMNS).withColumn("__new", F.lit(True)).alias("s")
    old = current.select(*MAP_COLUMNS).alias("t")
    on = (F.col("s.source_code") == F.col("t.source_code")) & (
        F.col("s.source_vocabulary_id") == F.col("t.source_vocabulary_id")
    )
    return old.join(new, on, "full_outer").select(
        *[F.when(F.col("s.__new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
          for c in MAP_COLUMNS]
    )


def store_upsert(spark: SparkSession, seed: DataFrame, path: str, tries: int = 5) -> DataFrame:
    """Upsert ``seed`` into the map stored at ``path``; the result is its next version.

    If another writer commits meanwhile, the seed goes into that writer's map, so that no upsert is lost.
    """
    for _ in range(tries):
        base = commits(spark, path)[-1]
        try:
            return write_target(upsert_concept_map(read_target(spark, path, number=base), seed), path, base=base)
        except StaleVersion:
            continue
    raise StaleVersion(f"{path}: other writers were first {tries} times")


def write_draft_map(draft: DataFrame, path: str) -> None:
    """The draft as headed CSV, columns in the map's order."""
    draft.select(*MAP_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
