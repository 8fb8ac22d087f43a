"""What a vocabulary refresh changed, and which source codes it cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.operators.concepts import valid_concepts, valid_edges
from cdmloom.operators.drafting import is_resolved


def vocabulary_diff(
    concept_before: DataFrame,
    concept_after: DataFrame,
    edges_before: DataFrame,
    edges_after: DataFrame,
) -> DataFrame:
    """Changes between two loads as rows (kind, concept_id, other_concept_id).

    Kinds: new_code, de_standardised, promoted, deprecated, upgraded, new_maps_to,
    removed_maps_to. One concept may show several of them.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            "concept_id",
            F.lit(True).alias(f"has_{tag}"),
            F.coalesce(F.col("standard_concept") == "S", F.lit(False)).alias(f"std_{tag}"),
            F.coalesce("invalid_reason", F.lit("")).alias(f"bad_{tag}"),
        )

    both = side(concept_before, "b").join(side(concept_after, "a"), "concept_id", "full_outer")
    stays = F.col("has_b") & F.col("has_a")
    newly = F.col("bad_a") != F.col("bad_b")
    kinds = F.array(
        F.when(F.col("has_b").isNull(), "new_code"),
        F.when(stays & F.col("std_b") & ~F.col("std_a"), "de_standardised"),
        F.when(stays & ~F.col("std_b") & F.col("std_a"), "promoted"),
        F.when(stays & newly & (F.col("bad_a") == "D"), "deprecated"),
        F.when(stays & newly & (F.col("bad_a") == "U"), "upgraded"),
    )
    concepts = both.select(
        F.explode(F.array_compact(kinds)).alias("kind"),
        "concept_id",
        F.lit(None).cast("int").alias("other_concept_id"),
    )

    def hops(df: DataFrame, tag: str) -> DataFrame:
        return (
            valid_edges(df)
            .select("concept_id_1", "concept_id_2")
            .distinct()
            .withColumn(f"has_{tag}", F.lit(True))
        )

    paired = hops(edges_before, "b").join(
        hops(edges_after, "a"), ["concept_id_1", "concept_id_2"], "full_outer"
    )
    edges = paired.filter(F.col("has_b").isNull() | F.col("has_a").isNull()).select(
        F.when(F.col("has_b").isNull(), "new_maps_to").otherwise("removed_maps_to").alias("kind"),
        F.col("concept_id_1").alias("concept_id"),
        F.col("concept_id_2").alias("other_concept_id"),
    )
    return concepts.unionByName(edges)


def regressed_codes(
    classified_before: DataFrame,
    classified_after: DataFrame,
    concept_after: DataFrame,
    edges_after: DataFrame,
) -> DataFrame:
    """Codes resolved before and not after: where they pointed, why it broke, what replaces it.

    The reason looks at the former target in the new load; the replacement is its
    valid standard successor, the lowest id where several are named.
    """
    was = classified_before.filter(is_resolved(F.col("bucket"))).select(
        "vocabulary_id", "source_code", F.col("target_concept_id").alias("former_concept_id")
    )
    now = classified_after.filter(~is_resolved(F.col("bucket"))).select(
        "vocabulary_id", "source_code", F.col("bucket").alias("bucket_after")
    )
    state = concept_after.select(
        F.col("concept_id").alias("former_concept_id"),
        F.coalesce("invalid_reason", F.lit("")).alias("bad"),
        F.coalesce(F.col("standard_concept") == "S", F.lit(False)).alias("std"),
    )
    successors = (
        valid_edges(edges_after, "Concept replaced by")
        .join(
            valid_concepts(concept_after)
            .filter(F.col("standard_concept") == "S")
            .select(F.col("concept_id").alias("concept_id_2")),
            "concept_id_2",
        )
        .groupBy(F.col("concept_id_1").alias("former_concept_id"))
        .agg(F.min("concept_id_2").alias("replacement_concept_id"))
    )
    reason = (
        F.when(F.col("std").isNull(), "target_missing")
        .when(F.col("bad") == "U", "target_upgraded")
        .when(F.col("bad") == "D", "target_deprecated")
        .when(~F.col("std"), "target_de_standardised")
        .otherwise("mapping_changed")
    )
    return (
        was.join(now, ["vocabulary_id", "source_code"])
        .join(state, "former_concept_id", "left")
        .join(successors, "former_concept_id", "left")
        .select(
            "vocabulary_id",
            "source_code",
            "former_concept_id",
            "bucket_after",
            reason.alias("reason"),
            "replacement_concept_id",
        )
    )
