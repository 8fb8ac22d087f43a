"""Projection to the target columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cdmloom.model.spec import ColumnMap, Lookup


def map_columns(df: DataFrame, columns: Sequence[ColumnMap]) -> DataFrame:
    """Target columns in declared order; with none declared the input is unchanged."""
    if not columns:
        return df
    return df.selectExpr(*[f"{c.expr} AS `{c.target}`" for c in columns])


def append_lookup_targets(
    columns: Sequence[ColumnMap], lookups: Sequence[Lookup]
) -> tuple[ColumnMap, ...]:
    """Columns followed by the lookup targets that were not mapped explicitly."""
    named = {c.target for c in columns}
    rest = dict.fromkeys(x.target_column for x in lookups if x.target_column not in named)
    return (*columns, *(ColumnMap(t, f"`{t}`") for t in rest))
