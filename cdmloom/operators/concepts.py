"""Filters on the vocabulary tables. All of them reach the file scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_concepts(concept: DataFrame) -> DataFrame:
    return concept.filter(F.col("invalid_reason").isNull())


def standard_concepts(concept: DataFrame) -> DataFrame:
    return concept.filter(F.col("standard_concept") == "S")


def concepts_in(
    concept: DataFrame, vocabulary_id: str | None = None, domain_id: str | None = None
) -> DataFrame:
    if vocabulary_id is not None:
        concept = concept.filter(F.col("vocabulary_id") == vocabulary_id)
    if domain_id is not None:
        concept = concept.filter(F.col("domain_id") == domain_id)
    return concept


def valid_edges(edges: DataFrame, relationship_id: str = "Maps to") -> DataFrame:
    return edges.filter(
        (F.col("relationship_id") == relationship_id) & F.col("invalid_reason").isNull()
    )
