"""From a table spec to the finished table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession

from cdmloom.model.cdm import CDM
from cdmloom.model.spec import ColumnMap, Rules, TableSpec
from cdmloom.model.vocabulary import Vocabulary
from cdmloom.operators.expectations import apply_expectations, observe_rules, observed_metrics
from cdmloom.operators.joins import join_sources
from cdmloom.operators.lookups import apply_lookups
from cdmloom.operators.projection import append_lookup_targets, map_columns
from cdmloom.sources.tables import read_sources, write_target


def project_table(
    spec: TableSpec,
    frames: Mapping[str, DataFrame],
    vocab: Vocabulary,
    broadcast_bytes: int | None = None,
    fraction: float = 0.01,
) -> DataFrame:
    """Join, resolve and project; row expectations not applied yet."""
    joined = join_sources(frames, spec.joins, broadcast_bytes, fraction)
    resolved = apply_lookups(joined, spec.vocabulary_lookups, vocab, broadcast_bytes, fraction, frames)
    columns = spec.column_mappings
    if columns:
        columns = append_lookup_targets(columns, spec.vocabulary_lookups)
    return map_columns(resolved, columns)


def build_table(
    spec: TableSpec,
    frames: Mapping[str, DataFrame],
    vocab: Vocabulary,
    broadcast_bytes: int | None = None,
    fraction: float = 0.01,
) -> DataFrame:
    """The target table: join, resolve, project, check rows."""
    rows = project_table(spec, frames, vocab, broadcast_bytes, fraction)
    return apply_expectations(rows, spec.expectations)


def refresh_table(
    spark: SparkSession,
    spec: TableSpec,
    vocab: Vocabulary,
    path: str,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read the sources of a spec, build its table and replace the snapshot at ``path``."""
    return refresh_with_metrics(spark, spec, vocab, path, names)[0]


def refresh_with_metrics(
    spark: SparkSession,
    spec: TableSpec,
    vocab: Vocabulary,
    path: str,
    names: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The refreshed table, and what its rules counted while it was written: warn rules too."""
    rows = project_table(spec, read_sources(spark, spec.sources, names), vocab)
    return store_with_metrics(rows, spec.expectations, path)


def store_with_metrics(rows: DataFrame, rules: Rules, path: str) -> tuple[DataFrame, DataFrame]:
    """Apply the rules, store what passes as the table's next version, and count in the same pass."""
    seen = Observation()
    observed = observe_rules(rows, rules, seen)
    table = write_target(apply_expectations(observed, rules), path)
    return table, observed_metrics(rows.sparkSession, rules, seen)


def null_columns(table: str, given: set[str]) -> tuple[ColumnMap, ...]:
    """Typed NULLs for the columns of a target table a recipe has no source for."""
    return tuple(
        ColumnMap(c.name, f"CAST(NULL AS {c.type})") for c in CDM[table] if c.name not in given
    )
