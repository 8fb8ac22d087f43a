"""Distinct source codes and what the vocabulary says about them.

Everything after :func:`distinct_codes` works on one row per (vocabulary, code),
so it does not grow with the number of fact rows, only with the code sets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.model.spec import TableSpec
from cdmloom.operators.concepts import valid_edges


@dataclass(frozen=True)
class CodeRequest:
    """One code column of one target table's source."""

    table_name: str
    source_alias: str
    source_column: str
    vocabulary_id: str
    source_table: str


def mapping_requests(specs: Sequence[TableSpec]) -> list[CodeRequest]:
    """The code columns declared by the specs, each once; specs without any are skipped."""
    out = [
        CodeRequest(
            spec.table_name,
            c.source_alias,
            c.source_column,
            c.vocabulary_id,
            next(s.table for s in spec.sources if s.alias == c.source_alias),
        )
        for spec in specs
        for c in spec.source_vocabulary
    ]
    return list(dict.fromkeys(out))


def code_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column, as text."""
    code = F.col(column).cast("string").alias("source_code")
    return df.select(code).filter(F.col("source_code").isNotNull()).distinct()


def distinct_codes(
    tables: Mapping[str, DataFrame], requests: Sequence[CodeRequest]
) -> DataFrame:
    """Distinct codes per requested column.

    Requests that read the same source column share one scan; their labels are
    added after the distinct.
    """
    labels: dict[tuple[str, str], list[CodeRequest]] = {}
    for r in requests:
        labels.setdefault((r.source_table, r.source_column), []).append(r)
    out = None
    for (table, column), group in labels.items():
        tags = F.array(
            *[
                F.struct(
                    F.lit(r.table_name).alias("table_name"),
                    F.lit(r.source_alias).alias("source_alias"),
                    F.lit(r.source_column).alias("source_column"),
                    F.lit(r.vocabulary_id).alias("vocabulary_id"),
                )
                for r in group
            ]
        )
        one = code_values(tables[table], column).select(F.inline(tags), "source_code")
        out = one if out is None else out.unionByName(one)
    return out


def codes_by_vocabulary(codes: DataFrame) -> DataFrame:
    """One row per (vocabulary, code) over all columns."""
    return codes.select("vocabulary_id", "source_code").distinct()


def _concept_row() -> list:
    return [
        F.col("concept_id"),
        F.coalesce("concept_name", F.lit("")).alias("concept_name"),
        F.col("vocabulary_id").alias("concept_vocabulary_id"),
        F.col("standard_concept"),
    ]


def lookup_concept_by_code(codes: DataFrame, concept: DataFrame) -> DataFrame:
    """Every code with its concept, whatever its validity; the lowest id where several match."""
    known = concept.select(
        F.col("vocabulary_id"),
        F.col("concept_code").alias("source_code"),
        F.struct(*_concept_row()).alias("hit"),
    )
    return (
        codes.join(known, ["vocabulary_id", "source_code"], "left")
        .groupBy("vocabulary_id", "source_code")
        .agg(F.min("hit").alias("hit"))
        .select("vocabulary_id", "source_code", "hit.*")
    )


def maps_to(edges: DataFrame) -> DataFrame:
    """Valid "Maps to" edges as (concept_id, target_concept_id)."""
    return valid_edges(edges).select(
        F.col("concept_id_1").alias("concept_id"), F.col("concept_id_2").alias("target_concept_id")
    )


def targets(concept: DataFrame) -> DataFrame:
    return concept.select(
        F.col("concept_id").alias("target_concept_id"),
        F.col("vocabulary_id").alias("target_vocabulary_id"),
        F.col("standard_concept").alias("target_standard_concept"),
    )


def lookup_maps_to(sources: DataFrame, edges: DataFrame, concept: DataFrame) -> DataFrame:
    """Targets of "Maps to" for the distinct ``concept_id`` of ``sources``, standard or not."""
    start = sources.select("concept_id").distinct()
    return start.join(maps_to(edges), "concept_id").join(targets(concept), "target_concept_id")


def code_exists(codes: DataFrame, concept: DataFrame, vocabulary_id: str) -> DataFrame:
    """Concepts of one vocabulary whose code occurs in ``codes``."""
    return (
        concept.filter(F.col("vocabulary_id") == vocabulary_id)
        .select("concept_code", "concept_id", "concept_name", "standard_concept")
        .join(codes.select(F.col("source_code").alias("concept_code")), "concept_code", "left_semi")
    )
