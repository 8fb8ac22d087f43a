"""Drafting source-to-concept maps: one row per (code, vocabulary), resolved or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.model.vocabulary import CONCEPT_MAP
from cdmloom.operators.codes import lookup_concept_by_code, maps_to, targets

# The five outcomes.
DIRECT = "resolved_direct"
VIA_MAPS_TO = "resolved_via_maps_to"
NO_CONCEPT = "unresolved_no_concept"
NO_MAPS_TO = "unresolved_no_maps_to"
AMBIGUOUS = "unresolved_ambiguous"
BUCKETS = (DIRECT, VIA_MAPS_TO, NO_CONCEPT, NO_MAPS_TO, AMBIGUOUS)

# Validity dates and description texts of drafted rows.
VALID_FROM = "19700101"
VALID_TO = "20991231"
TEXT_NO_CONCEPT = "UNRESOLVED - no concept in OHDSI vocabulary; manual mapping required"
TEXT_NO_MAPS_TO = "%s - non-standard with no 'Maps to' relationship; manual mapping required"
TEXT_NOT_STANDARD = (
    "%s - 'Maps to' targets are non-standard (possible multi-hop); manual mapping required"
)
TEXT_SEVERAL = (
    "%s - multiple 'Maps to' standard targets (%d); chose lowest concept_id; "
    "manual review recommended"
)
TEXT_SINGLE_VOCABULARY = "UNRESOLVED — manual mapping required"


def is_resolved(bucket: Column) -> Column:
    return bucket.isin(DIRECT, VIA_MAPS_TO)


def classify_codes(codes: DataFrame, concept: DataFrame, edges: DataFrame) -> DataFrame:
    """Put every (vocabulary, code) into one of the five buckets.

    Targets that are missing from the concept table are ignored before counting.
    The codes are read once: edges and targets are attached to their hits.
    """
    hits = lookup_concept_by_code(codes, concept)
    is_standard = F.coalesce(F.col("standard_concept") == "S", F.lit(False))
    known, standard = F.col("g.target_concept_id"), F.col("target_standard_concept") == "S"
    # Codes without an edge to follow get keys of their own below zero, so that they do not meet in one task.
    alone = F.lit(-1).cast("long") - F.shiftrightunsigned(F.xxhash64("h.vocabulary_id", "h.source_code"), 1)
    start = F.coalesce(F.when(~is_standard, F.col("h.concept_id")).cast("long"), alone)
    goal = F.coalesce(F.col("m.target_concept_id").cast("long"), alone)
    counted = (
        hits.alias("h")
        .join(maps_to(edges).alias("m"), start == F.col("m.concept_id").cast("long"), "left")
        .join(targets(concept).alias("g"), goal == known.cast("long"), "left")
        .groupBy(*[F.col(f"h.{c}") for c in hits.columns])
        .agg(
            F.count(known).alias("targets"),
            F.count_if(standard).alias("standard_targets"),
            F.min(
                F.when(standard, F.struct(known.alias("id"), F.col("target_vocabulary_id")))
            ).alias("best"),
        )
    )
    bucket = (
        F.when(F.col("concept_id").isNull(), NO_CONCEPT)
        .when(is_standard, DIRECT)
        .when(F.col("targets") == 0, NO_MAPS_TO)
        .when(F.col("standard_targets") == 1, VIA_MAPS_TO)
        .otherwise(AMBIGUOUS)
    )
    via = F.col("bucket") == VIA_MAPS_TO
    direct = F.col("bucket") == DIRECT
    return (
        counted.withColumn("bucket", bucket)
        .select(
            "vocabulary_id",
            "source_code",
            "bucket",
            F.coalesce("concept_id", F.lit(0)).alias("source_concept_id"),
            F.col("concept_name").alias("source_name"),
            F.when(direct, F.col("concept_id"))
            .when(via, F.col("best.id"))
            .otherwise(0)
            .alias("target_concept_id"),
            F.when(direct, F.col("concept_vocabulary_id"))
            .when(via, F.col("best.target_vocabulary_id"))
            .otherwise("")
            .alias("target_vocabulary_id"),
            "standard_targets",
        )
    )


def _description() -> Column:
    name, several = F.col("source_name"), F.col("standard_targets")
    ambiguous = F.col("bucket") == AMBIGUOUS
    return (
        F.when(F.col("bucket") == NO_CONCEPT, TEXT_NO_CONCEPT)
        .when(F.col("bucket") == NO_MAPS_TO, F.format_string(TEXT_NO_MAPS_TO, name))
        .when(ambiguous & (several == 0), F.format_string(TEXT_NOT_STANDARD, name))
        .when(ambiguous, F.format_string(TEXT_SEVERAL, name, several))
        .otherwise(name)
    )


def _as_map(rows: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
    return rows.withColumns(
        {
            "valid_start_date": F.lit(valid_from),
            "valid_end_date": F.lit(valid_to),
            "invalid_reason": F.lit(""),
        }
    ).select(*CONCEPT_MAP.names)


def draft_concept_map(
    classified: DataFrame, valid_from: str = VALID_FROM, valid_to: str = VALID_TO
) -> DataFrame:
    """Draft map from classified codes; unresolved rows keep target 0 for manual work."""
    rows = classified.select(
        "source_code",
        "source_concept_id",
        F.col("vocabulary_id").alias("source_vocabulary_id"),
        _description().alias("source_code_description"),
        "target_concept_id",
        "target_vocabulary_id",
    )
    return _as_map(rows, valid_from, valid_to)


def draft_single_vocabulary(
    codes: DataFrame,
    concept: DataFrame,
    vocabulary_id: str,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """Draft from direct matches only; the matched id is the target even when not standard."""
    wanted = codes.select(F.lit(vocabulary_id).alias("vocabulary_id"), "source_code").distinct()
    hits = lookup_concept_by_code(wanted, concept)
    found = F.col("concept_id").isNotNull()
    rows = hits.select(
        "source_code",
        F.lit(0).alias("source_concept_id"),
        F.col("vocabulary_id").alias("source_vocabulary_id"),
        F.when(found, "").otherwise(TEXT_SINGLE_VOCABULARY).alias("source_code_description"),
        F.coalesce("concept_id", F.lit(0)).alias("target_concept_id"),
        F.coalesce("concept_vocabulary_id", F.lit("")).alias("target_vocabulary_id"),
    )
    return _as_map(rows, valid_from, valid_to)
