"""Recipes for the target tables, over bronze tables with snake_case columns.

Each recipe returns a :class:`TableSpec` to adapt with ``dataclasses.replace``
or to feed to :func:`cdmloom.plans.build.build_table` as it is. ``key`` builds
the surrogate key expression; ``complete`` adds typed NULLs for every target
column the bronze tables cannot fill. ``orphans`` says what happens to facts
whose encounter, and so person, is unknown: ``"fail"``, ``"drop"`` or ``"keep"``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.functions.keys import hash_key, natural_key
from cdmloom.functions.values import EHR_RECORD
from cdmloom.model.spec import (
    BY_CONCEPT,
    BY_MAP,
    BY_RELATIONSHIP,
    CodeColumn,
    ColumnMap,
    Join,
    Lookup,
    Rule,
    Rules,
    Source,
    TableSpec,
)
from cdmloom.operators.projection import append_lookup_targets
from cdmloom.plans.build import null_columns

Key = Callable[..., str]


@dataclass(frozen=True)
class Style:
    """Choices shared by all recipes."""

    key: Key = hash_key
    complete: bool = False
    orphans: str = "fail"
    vocabulary_id: str = "ICD10CM"


def _columns(**exprs: str) -> tuple[ColumnMap, ...]:
    return tuple(ColumnMap(t, e) for t, e in exprs.items())


def _kept(expr: str) -> str:
    return f"cast({expr} as string)"


def _reference(style: Style, expr: str) -> str:
    """Key of another table's row, NULL where the source names none."""
    return f"if({expr} is null, null, {style.key(expr)})"


def _provenance() -> str:
    return f"cast({EHR_RECORD} as int)"


def _spec(
    style: Style,
    table: str,
    sources: dict[str, str],
    columns: tuple[ColumnMap, ...],
    lookups: tuple[Lookup, ...] = (),
    joins: tuple[Join, ...] = (),
    rules: Rules = Rules(),
    codes: tuple[CodeColumn, ...] = (),
) -> TableSpec:
    if style.complete:
        columns = append_lookup_targets(columns, lookups)
        columns = (*columns, *null_columns(table, {c.target for c in columns}))
    return TableSpec(
        table_name=table,
        sources=tuple(Source(a, t) for a, t in sources.items()),
        joins=joins,
        vocabulary_lookups=lookups,
        source_vocabulary=codes,
        column_mappings=columns,
        expectations=rules,
    )


def standard_and_source(
    alias: str, column: str, stem: str, vocabulary_id: str, domain_id: str
) -> tuple[Lookup, Lookup]:
    """The two lookups of a coded column: standard concept by mapping, source concept as is."""
    return (
        Lookup(
            alias, column, f"{stem}_concept_id", BY_RELATIONSHIP,
            vocabulary_id=vocabulary_id, domain_id=domain_id,
        ),
        Lookup(
            alias, column, f"{stem}_source_concept_id", BY_CONCEPT,
            vocabulary_id=vocabulary_id, domain_id=domain_id, standard_only=False,
        ),
    )


def _encounter_join(fact: str) -> tuple[Join, ...]:
    return (Join(fact, "enc", type="left", keys=((f"{fact}.encounter_id", "enc.encounter_id"),)),)


def _fact_rules(style: Style, pk: str, *more: Rule, concept: str | None = None) -> Rules:
    person = Rule("valid_person", "person_id IS NOT NULL")
    failing = (Rule("valid_pk", f"{pk} IS NOT NULL"),)
    dropping: tuple[Rule, ...] = tuple(more)
    if style.orphans == "drop":
        dropping = (person, *dropping)
    elif style.orphans == "fail":
        failing = (*failing, person)
    elif style.orphans != "keep":
        raise ValueError(f"orphans must be fail, drop or keep, not {style.orphans!r}")
    warn = (Rule("known_concept", f"{concept} != 0"),) if concept else ()
    return Rules(failing, dropping, warn)


def person(style: Style = Style()) -> TableSpec:
    return _spec(
        style,
        "person",
        {"pat": "patient", "id": "patient_identifier"},
        _columns(
            person_id="cast(pat.patient_id as bigint)",
            gender_concept_id="case pat.gender_code when 'M' then 8507 when 'F' then 8532 else 0 end",
            year_of_birth="year(pat.birth_date)",
            month_of_birth="month(pat.birth_date)",
            day_of_birth="day(pat.birth_date)",
            birth_datetime="cast(pat.birth_date as timestamp)",
            location_id=_reference(style, "pat.zip_code"),
            person_source_value=_kept("id.mrn"),
            gender_source_value=_kept("pat.gender_code"),
            race_source_value=_kept("pat.race_code"),
            race_source_concept_id="cast(0 as int)",
            ethnicity_source_value=_kept("pat.ethnicity_code"),
            ethnicity_source_concept_id="cast(0 as int)",
        ),
        (
            Lookup("pat", "race_code", "race_concept_id", BY_MAP, source_vocabulary_id="Race"),
            Lookup("pat", "ethnicity_code", "ethnicity_concept_id", BY_MAP, source_vocabulary_id="Ethnicity"),
        ),
        (
            Join(
                "pat", "id", type="left", condition="id.identity_type = 'MRN'",
                keys=(("pat.patient_id", "id.patient_id"),),
            ),
        ),
        Rules(
            (Rule("valid_person_id", "person_id IS NOT NULL"),),
            (Rule("valid_gender", "gender_concept_id IN (8507, 8532, 0)"),),
            (Rule("known_race_concept", "race_concept_id != 0"),),
        ),
        (CodeColumn("pat", "race_code", "Race"), CodeColumn("pat", "ethnicity_code", "Ethnicity")),
    )


def visit_occurrence(style: Style = Style()) -> TableSpec:
    return _spec(
        style,
        "visit_occurrence",
        {"enc": "encounter"},
        _columns(
            visit_occurrence_id="cast(enc.encounter_id as bigint)",
            person_id="cast(enc.patient_id as bigint)",
            visit_start_date="cast(enc.admit_datetime as date)",
            visit_start_datetime="cast(enc.admit_datetime as timestamp)",
            visit_end_date="cast(enc.discharge_date as date)",
            visit_end_datetime="cast(enc.discharge_date as timestamp)",
            visit_type_concept_id=_provenance(),
            provider_id="cast(enc.provider_id as bigint)",
            visit_source_value=_kept("enc.encounter_type"),
            visit_source_concept_id="cast(0 as int)",
        ),
        (Lookup("enc", "encounter_type", "visit_concept_id", BY_MAP, source_vocabulary_id="Visit"),),
        (),
        _fact_rules(
            style, "visit_occurrence_id", Rule("valid_dates", "visit_start_date <= visit_end_date"),
            concept="visit_concept_id",
        ),
        (CodeColumn("enc", "encounter_type", "Visit"),),
    )


def condition_occurrence(style: Style = Style()) -> TableSpec:
    return _spec(
        style,
        "condition_occurrence",
        {"dx": "encounter_diagnosis", "enc": "encounter"},
        _columns(
            condition_occurrence_id=natural_key(
                style.key, ("dx.encounter_id", "dx.line"), "dx.diagnosis_code", "condition_concept_id"
            ),
            person_id="cast(enc.patient_id as bigint)",
            condition_start_date="cast(dx.diagnosis_datetime as date)",
            condition_start_datetime="cast(dx.diagnosis_datetime as timestamp)",
            condition_type_concept_id=_provenance(),
            provider_id="cast(enc.provider_id as bigint)",
            visit_occurrence_id="cast(enc.encounter_id as bigint)",
            condition_source_value=_kept("dx.diagnosis_code"),
            condition_status_source_value=_kept("dx.diagnosis_type"),
        ),
        standard_and_source("dx", "diagnosis_code", "condition", style.vocabulary_id, "Condition"),
        _encounter_join("dx"),
        _fact_rules(style, "condition_occurrence_id", concept="condition_concept_id"),
        (CodeColumn("dx", "diagnosis_code", style.vocabulary_id),),
    )


def observation(style: Style = Style()) -> TableSpec:
    """The diagnoses whose standard concept belongs to the Observation domain."""
    return _spec(
        style,
        "observation",
        {"dx": "encounter_diagnosis", "enc": "encounter"},
        _columns(
            observation_id=natural_key(
                style.key, ("dx.encounter_id", "dx.line"), "dx.diagnosis_code", "observation_concept_id"
            ),
            person_id="cast(enc.patient_id as bigint)",
            observation_date="cast(dx.diagnosis_datetime as date)",
            observation_datetime="cast(dx.diagnosis_datetime as timestamp)",
            observation_type_concept_id=_provenance(),
            provider_id="cast(enc.provider_id as bigint)",
            visit_occurrence_id="cast(enc.encounter_id as bigint)",
            observation_source_value=_kept("dx.diagnosis_code"),
        ),
        standard_and_source("dx", "diagnosis_code", "observation", style.vocabulary_id, "Observation"),
        _encounter_join("dx"),
        _fact_rules(style, "observation_id", Rule("in_domain", "observation_concept_id != 0")),
        (CodeColumn("dx", "diagnosis_code", style.vocabulary_id),),
    )


def procedure_occurrence(style: Style = Style(vocabulary_id="CPT4")) -> TableSpec:
    return _spec(
        style,
        "procedure_occurrence",
        {"po": "procedure_order", "enc": "encounter"},
        _columns(
            procedure_occurrence_id=natural_key(
                style.key, ("po.encounter_id", "po.order_line"), "po.procedure_code", "procedure_concept_id"
            ),
            person_id="cast(enc.patient_id as bigint)",
            procedure_date="cast(po.order_datetime as date)",
            procedure_datetime="cast(po.order_datetime as timestamp)",
            procedure_type_concept_id=_provenance(),
            provider_id="cast(enc.provider_id as bigint)",
            visit_occurrence_id="cast(enc.encounter_id as bigint)",
            procedure_source_value=_kept("po.procedure_code"),
        ),
        standard_and_source("po", "procedure_code", "procedure", style.vocabulary_id, "Procedure"),
        _encounter_join("po"),
        _fact_rules(style, "procedure_occurrence_id", concept="procedure_concept_id"),
        (CodeColumn("po", "procedure_code", style.vocabulary_id),),
    )


def drug_exposure(style: Style = Style(vocabulary_id="NDC")) -> TableSpec:
    return _spec(
        style,
        "drug_exposure",
        {"mo": "medication_order", "enc": "encounter"},
        _columns(
            drug_exposure_id=natural_key(
                style.key, ("mo.encounter_id", "mo.order_line"), "mo.medication_code", "drug_concept_id"
            ),
            person_id="cast(enc.patient_id as bigint)",
            drug_exposure_start_date="cast(mo.order_datetime as date)",
            drug_exposure_start_datetime="cast(mo.order_datetime as timestamp)",
            drug_exposure_end_date="cast(mo.order_datetime as date)",
            drug_type_concept_id=_provenance(),
            quantity="cast(mo.quantity as float)",
            provider_id="cast(enc.provider_id as bigint)",
            visit_occurrence_id="cast(enc.encounter_id as bigint)",
            drug_source_value=_kept("mo.medication_code"),
        ),
        standard_and_source("mo", "medication_code", "drug", style.vocabulary_id, "Drug"),
        _encounter_join("mo"),
        _fact_rules(style, "drug_exposure_id", concept="drug_concept_id"),
        (CodeColumn("mo", "medication_code", style.vocabulary_id),),
    )


def measurement(style: Style = Style(vocabulary_id="LOINC")) -> TableSpec:
    standard, source = standard_and_source(
        "ms", "measurement_name", "measurement", style.vocabulary_id, "Measurement"
    )
    unit = Lookup(
        "ms", "measurement_name", "unit_concept_id", BY_RELATIONSHIP,
        vocabulary_id=style.vocabulary_id, domain_id="Unit", relationship_id="Maps to unit",
    )
    rules = _fact_rules(style, "measurement_id", concept="measurement_concept_id")
    return _spec(
        style,
        "measurement",
        {"ms": "clinical_measurement", "enc": "encounter"},
        _columns(
            measurement_id=natural_key(style.key, ("ms.measurement_id",), "measurement_concept_id", "unit_concept_id"),
            person_id="cast(enc.patient_id as bigint)",
            measurement_date="cast(ms.measurement_datetime as date)",
            measurement_datetime="cast(ms.measurement_datetime as timestamp)",
            measurement_type_concept_id=_provenance(),
            value_as_number="try_cast(ms.measurement_value as double)",
            provider_id="cast(enc.provider_id as bigint)",
            visit_occurrence_id="cast(enc.encounter_id as bigint)",
            measurement_source_value=_kept("ms.measurement_name"),
            value_source_value=_kept("ms.measurement_value"),
        ),
        (standard, unit, source),
        _encounter_join("ms"),
        Rules(rules.fail, rules.drop, (*rules.warn, Rule("has_value", "value_as_number IS NOT NULL"))),
        (CodeColumn("ms", "measurement_name", style.vocabulary_id),),
    )


def death(style: Style = Style()) -> TableSpec:
    return _spec(
        style,
        "death",
        {"pat": "patient"},
        _columns(
            person_id="cast(pat.patient_id as bigint)",
            death_date="cast(pat.death_date as date)",
            death_datetime="cast(pat.death_date as timestamp)",
            death_type_concept_id=_provenance(),
        ),
        rules=Rules(
            (Rule("valid_person", "person_id IS NOT NULL"),),
            (Rule("has_died", "death_date IS NOT NULL"),),
        ),
    )


def location(style: Style = Style()) -> TableSpec:
    """One row per zip code; give it :func:`distinct_locations` of the patients."""
    return _spec(
        style,
        "location",
        {"loc": "patient_zip"},
        _columns(
            location_id=natural_key(style.key, ("loc.zip_code",)),
            zip="cast(loc.zip_code as string)",
            location_source_value=_kept("loc.zip_code"),
        ),
        rules=Rules((Rule("valid_pk", "location_id IS NOT NULL"),)),
    )


def distinct_locations(patient: DataFrame) -> DataFrame:
    return patient.select("zip_code").filter(F.col("zip_code").isNotNull()).distinct()


def care_site(style: Style = Style()) -> TableSpec:
    return _spec(
        style,
        "care_site",
        {"fac": "facility"},
        _columns(
            care_site_id="cast(fac.facility_id as bigint)",
            care_site_name="cast(fac.facility_name as string)",
            location_id=_reference(style, "fac.zip_code"),
            care_site_source_value=_kept("fac.facility_id"),
            place_of_service_source_value=_kept("fac.service_code"),
        ),
        (
            Lookup(
                "fac", "service_code", "place_of_service_concept_id", BY_CONCEPT,
                vocabulary_id="Visit", domain_id="Visit",
            ),
        ),
        rules=Rules((Rule("valid_pk", "care_site_id IS NOT NULL"),)),
        codes=(CodeColumn("fac", "service_code", "Visit"),),
    )


def provider(style: Style = Style()) -> TableSpec:
    return _spec(
        style,
        "provider",
        {"doc": "clinician"},
        _columns(
            provider_id="cast(doc.clinician_id as bigint)",
            provider_name="cast(doc.clinician_name as string)",
            care_site_id="cast(doc.facility_id as bigint)",
            provider_source_value=_kept("doc.clinician_id"),
            specialty_source_value=_kept("doc.specialty_code"),
            gender_source_value=_kept("doc.gender_code"),
        ),
        (
            Lookup(
                "doc", "specialty_code", "specialty_concept_id", BY_CONCEPT,
                vocabulary_id="Specialty", domain_id="Provider",
            ),
            Lookup(
                "doc", "gender_code", "gender_concept_id", BY_CONCEPT,
                vocabulary_id="Gender", domain_id="Gender",
            ),
        ),
        rules=Rules((Rule("valid_pk", "provider_id IS NOT NULL"),)),
        codes=(
            CodeColumn("doc", "specialty_code", "Specialty"),
            CodeColumn("doc", "gender_code", "Gender"),
        ),
    )


RECIPES = {
    "person": person,
    "visit_occurrence": visit_occurrence,
    "condition_occurrence": condition_occurrence,
    "measurement": measurement,
    "procedure_occurrence": procedure_occurrence,
    "drug_exposure": drug_exposure,
    "observation": observation,
    "death": death,
    "location": location,
    "care_site": care_site,
    "provider": provider,
}
