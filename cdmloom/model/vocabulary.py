"""Shapes of the vocabulary tables and of the source-to-concept map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cdmloom.model.types import layout

# Vocabulary table layouts. Validity dates stay text, as in the files.
_CONCEPT = (
    "concept_id INT, concept_name STRING, domain_id STRING, vocabulary_id STRING, "
    "concept_class_id STRING, standard_concept STRING, concept_code STRING, "
    "valid_start_date STRING, valid_end_date STRING, invalid_reason STRING"
)
_LAYOUTS = {
    "concept": _CONCEPT,
    "concept_relationship": (
        "concept_id_1 INT, concept_id_2 INT, relationship_id STRING, "
        "valid_start_date STRING, valid_end_date STRING, invalid_reason STRING"
    ),
    "concept_ancestor": (
        "ancestor_concept_id INT, descendant_concept_id INT, "
        "min_levels_of_separation INT, max_levels_of_separation INT"
    ),
    "concept_synonym": "concept_id INT, concept_synonym_name STRING, language_concept_id INT",
    "concept_class": "concept_class_id STRING, concept_class_name STRING, concept_class_concept_id INT",
    "vocabulary": (
        "vocabulary_id STRING, vocabulary_name STRING, vocabulary_reference STRING, "
        "vocabulary_version STRING, vocabulary_concept_id INT"
    ),
    "domain": "domain_id STRING, domain_name STRING, domain_concept_id INT",
    "relationship": (
        "relationship_id STRING, relationship_name STRING, is_hierarchical STRING, "
        "defines_ancestry STRING, reverse_relationship_id STRING, relationship_concept_id INT"
    ),
    "drug_strength": (
        "drug_concept_id INT, ingredient_concept_id INT, amount_value DOUBLE, "
        "amount_unit_concept_id INT, numerator_value DOUBLE, numerator_unit_concept_id INT, "
        "denominator_value DOUBLE, denominator_unit_concept_id INT, box_size INT, "
        "valid_start_date STRING, valid_end_date STRING, invalid_reason STRING"
    ),
    "concept_cpt4": _CONCEPT,
}
VOCABULARY_TABLES = {name: layout(columns) for name, columns in _LAYOUTS.items()}

# Fixed value: layout of the source-to-concept map, in file order.
CONCEPT_MAP = layout(
    "source_code STRING, source_concept_id INT, source_vocabulary_id STRING, "
    "source_code_description STRING, target_concept_id INT, target_vocabulary_id STRING, "
    "valid_start_date DATE, valid_end_date DATE, invalid_reason STRING"
)

CONCEPT_MAP_KEY = ("source_code", "source_vocabulary_id")


# The relationships table recipes look codes up by.
CROSSWALK_RELATIONSHIPS = ("Maps to", "Maps to unit", "Maps to value")


@dataclass(frozen=True)
class Vocabulary:
    """The vocabulary tables a lookup reads; ``crosswalk`` is the optional prepared form.

    Lookups over a relationship the crosswalk was not made for read the tables. ``sizes`` has, for a stored table, the
    rows and the longest code of each of its groups: vocabularies, relationships, or both as ``relationship|vocabulary``.
    """

    concept: DataFrame
    concept_relationship: DataFrame | None = None
    source_to_concept_map: DataFrame | None = None
    crosswalk: DataFrame | None = None
    crosswalk_relationships: tuple[str, ...] = CROSSWALK_RELATIONSHIPS
    sizes: Mapping[str, Mapping[str, Sequence[int]]] = field(default_factory=dict)
