"""Declarative description of one target table: sources, joins, lookups, columns, row rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

# The three ways a code column can be resolved.
BY_MAP = "source_to_concept_map"
BY_CONCEPT = "concept_table"
BY_RELATIONSHIP = "concept_table_mapped"


@dataclass(frozen=True)
class Source:
    """A source table under an alias; ``table`` may hold ``{placeholders}``."""

    alias: str
    table: str


@dataclass(frozen=True)
class Join:
    """One step of the left fold over sources.

    ``condition`` is a SQL predicate over the aliases. ``keys`` are pairs of
    equal expressions (left, right); giving them lets the join spread hot keys.
    ``between`` is (point, begin, end): an expression over the left and two over the
    right that must enclose it, joined over bins in place of a comparison of all pairs.
    """

    left: str
    right: str
    condition: str = ""
    type: str = "inner"
    keys: tuple[tuple[str, str], ...] = ()
    between: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.between and len(self.between) != 3:
            raise ValueError(f"join with {self.right!r}: between takes a point, a begin and an end")


@dataclass(frozen=True)
class Lookup:
    """How one source code column becomes one concept id column."""

    source_alias: str
    source_column: str
    target_column: str
    resolution: str = BY_MAP
    source_vocabulary_id: str | None = None
    vocabulary_id: str | None = None
    domain_id: str | None = None
    relationship_id: str = "Maps to"
    standard_only: bool = True
    fallback: int = 0
    source_invalid_reason: str | None = None

    def __post_init__(self) -> None:
        needed = {
            BY_MAP: self.source_vocabulary_id,
            BY_CONCEPT: self.vocabulary_id and self.domain_id,
            BY_RELATIONSHIP: (self.vocabulary_id or self.source_vocabulary_id) and self.domain_id,
        }
        if self.resolution not in needed:
            raise ValueError(f"{self.target_column}: unknown resolution {self.resolution!r}")
        if not needed[self.resolution]:
            raise ValueError(
                f"{self.target_column}: {self.resolution} needs a vocabulary"
                + ("" if self.resolution == BY_MAP else " and a domain_id")
            )

    @property
    def vocabulary(self) -> str:
        if self.resolution == BY_MAP:
            return self.source_vocabulary_id  # type: ignore[return-value]
        return self.vocabulary_id or self.source_vocabulary_id  # type: ignore[return-value]


@dataclass(frozen=True)
class ColumnMap:
    target: str
    expr: str


@dataclass(frozen=True)
class Rule:
    """Named SQL predicate; a row passes only where it is TRUE."""

    name: str
    expr: str


@dataclass(frozen=True)
class Rules:
    fail: tuple[Rule, ...] = ()
    drop: tuple[Rule, ...] = ()
    warn: tuple[Rule, ...] = ()


@dataclass(frozen=True)
class CodeColumn:
    """Names the vocabulary the raw codes of one source column belong to."""

    source_alias: str
    source_column: str
    vocabulary_id: str


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    sources: tuple[Source, ...]
    column_mappings: tuple[ColumnMap, ...]
    joins: tuple[Join, ...] = ()
    vocabulary_lookups: tuple[Lookup, ...] = ()
    source_vocabulary: tuple[CodeColumn, ...] = ()
    expectations: Rules = field(default_factory=Rules)
    target_schema: str = ""
    description: str = ""

    def __post_init__(self) -> None:
        aliases = {s.alias for s in self.sources}
        targets = [c.target for c in self.column_mappings]
        if len(aliases) != len(self.sources):
            raise ValueError(f"{self.table_name}: source aliases repeat")
        if len(set(targets)) != len(targets):
            raise ValueError(f"{self.table_name}: target columns repeat")
        used = {a for j in self.joins for a in (j.left, j.right)}
        used |= {x.source_alias for x in self.vocabulary_lookups}
        used |= {x.source_alias for x in self.source_vocabulary}
        if used - aliases:
            raise ValueError(f"{self.table_name}: unknown alias {sorted(used - aliases)}")


def _record(cls: type, given: Mapping[str, Any]) -> Any:
    known = {f.name for f in fields(cls)}
    if set(given) - known:
        raise ValueError(f"{cls.__name__}: unknown keys {sorted(set(given) - known)}")
    return cls(**given)


def table_spec(given: Mapping[str, Any]) -> TableSpec:
    """Build a :class:`TableSpec` from nested dicts and lists, as a config file holds them."""
    parts = dict(given)
    nested = {
        "sources": Source,
        "joins": Join,
        "vocabulary_lookups": Lookup,
        "source_vocabulary": CodeColumn,
        "column_mappings": ColumnMap,
    }
    for name, cls in nested.items():
        parts[name] = tuple(_record(cls, item) for item in parts.get(name) or ())
    groups = dict(parts.get("expectations") or {})
    parts["expectations"] = _record(
        Rules, {k: tuple(_record(Rule, r) for r in v or ()) for k, v in groups.items()}
    )
    return _record(TableSpec, parts)
