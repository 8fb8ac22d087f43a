"""One Spark query per operator over the fixtures."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmloom.functions import values
from cdmloom.functions.keys import md5_key, row_number_key
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
from cdmloom.model.vocabulary import CONCEPT_MAP, VOCABULARY_TABLES, Vocabulary
from cdmloom.operators import codes, concepts, conformance, coverage, drafting, eras
from cdmloom.operators import expectations, ingredients, profiling, refresh, replacements
from cdmloom.operators.durable import scratch_path
from cdmloom.operators.joins import join_sources
from cdmloom.operators.lookups import apply_lookups, write_crosswalk
from cdmloom.operators.projection import append_lookup_targets, map_columns
from cdmloom.plans import tables
from cdmloom.plans.build import build_table, project_table, refresh_table, store_with_metrics
from cdmloom.sources import concept_map, vocabulary_files
from cdmloom.sources.tables import read_sources, write_target
from workload.fixtures import FACTS, Data

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STYLE = tables.Style(key=md5_key, orphans="drop", vocabulary_id="SRC")
WHOLE = tables.Style(key=md5_key, orphans="drop", vocabulary_id="SRC", complete=True)
KEEP_ORPHANS = tables.Style(key=md5_key, orphans="keep", vocabulary_id="SRC", complete=True)


def query(make: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
    """Register a query under its function name, less a trailing ``_query``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(Data(spark, sf_dir))

    QUERIES[make.__name__.removesuffix("_query")] = run
    return make


# Sources and sinks


def _stored_vocabulary(data: Data) -> str:
    """The fixture vocabulary written the way the bundle arrives: tab-separated files."""
    folder = scratch_path(data.spark, "vocabulary")
    for table in ("concept", "concept_relationship"):
        data[table].write.option("header", True).option("sep", "\t").option("quote", "").csv(
            f"{folder}/{table.upper()}.csv"
        )
    # Lines with fields missing, and with one too many, as a file that was cut or edited by hand has them.
    rows = data["concept"]
    last = [F.lit(x) for x in ("S", "D", "more")]
    short = rows.where("concept_id % 10 = 3").select(F.concat_ws("\t", "concept_id", "concept_name").alias("line"))
    names = ("concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id")
    more = rows.where("concept_id % 10 = 7").select(
        F.concat_ws("\t", *names, last[0], "concept_code", "valid_start_date", "valid_end_date", *last[1:]).alias("line")
    )
    lines = short.unionByName(more).toDF("\t".join(rows.columns))
    lines.write.mode("append").option("header", True).option("sep", "\x01").option("quote", "").csv(f"{folder}/CONCEPT.csv")
    return folder


@query
def load_vocabulary(data: Data) -> DataFrame:
    return vocabulary_files.load_vocabulary(data.spark, _stored_vocabulary(data))["concept"]


@query
def load_report(data: Data) -> DataFrame:
    return vocabulary_files.load_report(data.spark, _stored_vocabulary(data))


@query
def quarantined_lines(data: Data) -> DataFrame:
    return vocabulary_files.quarantined_lines(data.spark, _stored_vocabulary(data))


@query
def cast_to_schema(data: Data) -> DataFrame:
    text = data["clinical_measurement"].select(
        F.col("measurement_id").cast("string").alias("concept_id_1"),
        F.col("measurement_value").alias("concept_id_2"),
        F.col("measurement_name").alias("relationship_id"),
        F.lit("19700101").alias("valid_start_date"),
        F.lit("20991231").alias("valid_end_date"),
        F.lit(None).cast("string").alias("invalid_reason"),
    )
    return vocabulary_files.cast_to_schema(text, VOCABULARY_TABLES["concept_relationship"])


@query
def require_non_empty(data: Data) -> DataFrame:
    return vocabulary_files.require_non_empty(
        vocabulary_files.load_vocabulary(data.spark, _stored_vocabulary(data))
    )


@query
def table_row_counts(data: Data) -> DataFrame:
    names = ("patient", "encounter", "encounter_diagnosis", "clinical_measurement", "concept")
    return vocabulary_files.table_row_counts({n: data[n] for n in names})


@query
def normalize_seed_map(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "seed")
    data["seed_map"].write.option("header", True).csv(path)
    return concept_map.read_seed_map(data.spark, path)


@query
def union_license_gated(data: Data) -> DataFrame:
    return vocabulary_files.union_license_gated(data["concept"], data["concept_cpt4"])


@query
def upsert_concept_map(data: Data) -> DataFrame:
    seed = concept_map.normalize_seed_map(data["seed_map"])
    path = scratch_path(data.spark, "concept_map")
    write_target(data["source_to_concept_map"], path)
    return concept_map.store_upsert(data.spark, seed, path)


@query
def read_sources_query(data: Data) -> DataFrame:
    sources = (Source("o", "{folder}/orders.parquet"), Source("c", "{folder}/customer.parquet"))
    frames = read_sources(data.spark, sources, {"folder": data.sf_dir})
    joined = join_sources(frames, [Join("o", "c", "o.o_custkey = c.c_custkey")])
    return joined.groupBy("c.c_mktsegment").agg(F.count(F.lit(1)).alias("orders"))



@query
def write_target_query(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "visit_occurrence")
    return write_target(_build(data, "visit_occurrence"), path)



@query
def write_draft_map(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "draft")
    concept_map.write_draft_map(draft_concept_map(data), path)
    read = data.spark.read.option("header", True).csv(path)
    return read.na.fill("").select(*CONCEPT_MAP.names)


# Projections and filters


@query
def map_columns_query(data: Data) -> DataFrame:
    return map_columns(
        data["patient"].alias("pat"),
        [
            ColumnMap("person_id", "cast(pat.patient_id as bigint)"),
            ColumnMap("year_of_birth", "year(pat.birth_date)"),
            ColumnMap("zip", "pat.zip_code"),
        ],
    )


RACE = Lookup("pat", "race_code", "race_concept_id", BY_MAP, source_vocabulary_id="Race")
MAPPED = Lookup(
    "dx", "diagnosis_code", "condition_concept_id", BY_RELATIONSHIP,
    vocabulary_id="SRC", domain_id="Condition",
)
SOURCE_ID = Lookup(
    "dx", "diagnosis_code", "condition_source_concept_id", BY_CONCEPT,
    vocabulary_id="SRC", domain_id="Condition", standard_only=False,
)


@query
def append_lookup_targets_query(data: Data) -> DataFrame:
    resolved = apply_lookups(data["patient"].alias("pat"), [RACE], data.vocab)
    columns = (ColumnMap("person_id", "pat.patient_id"), ColumnMap("race", "pat.race_code"))
    return map_columns(resolved, append_lookup_targets(columns, [RACE]))



@query
def valid_concepts(data: Data) -> DataFrame:
    return concepts.valid_concepts(data["concept"]).select("concept_id", "concept_code")


@query
def standard_concepts(data: Data) -> DataFrame:
    return concepts.standard_concepts(data["concept"]).select("concept_id", "concept_code")


@query
def concepts_in(data: Data) -> DataFrame:
    return concepts.concepts_in(data["concept"], "SRC", "Drug").select("concept_id", "concept_code")


@query
def valid_edges(data: Data) -> DataFrame:
    return concepts.valid_edges(data["concept_relationship"]).select("concept_id_1", "concept_id_2")


# Joins


def _joined(data: Data, how: str) -> DataFrame:
    frames = {"e": data["encounter"], "d": data["encounter_diagnosis"]}
    joins = [Join("d", "e", "d.encounter_id = e.encounter_id", how)]
    return join_sources(frames, joins).selectExpr(
        "d.encounter_id as fact_encounter_id",
        "d.line",
        "d.diagnosis_code",
        "e.encounter_id",
        "e.patient_id",
    )


@query
def join_inner(data: Data) -> DataFrame:
    return _joined(data, "inner")


@query
def join_left(data: Data) -> DataFrame:
    return _joined(data, "left_outer")


@query
def join_right(data: Data) -> DataFrame:
    return _joined(data, "right")


@query
def join_full(data: Data) -> DataFrame:
    return _joined(data, "full_outer")


@query
def join_cross(data: Data) -> DataFrame:
    """Every visit against the one-row study period: the bounded use of a cross join."""
    period = data["encounter"].agg(
        F.min("admit_datetime").cast("date").alias("first_day"),
        F.max("admit_datetime").cast("date").alias("last_day"),
    )
    frames = {"e": data["encounter"], "p": period}
    return join_sources(frames, [Join("e", "p", type="cross")]).selectExpr(
        "e.encounter_id",
        "datediff(cast(e.admit_datetime as date), p.first_day) as days_in",
        "datediff(p.last_day, cast(e.admit_datetime as date)) as days_left",
    )


@query
def join_sources_query(data: Data) -> DataFrame:
    """Three sources, equal keys and an inequality on top."""
    frames = {"m": data["clinical_measurement"], "e": data["encounter"], "p": data["patient"]}
    joins = [
        Join(
            "m", "e", "m.measurement_datetime >= e.admit_datetime", "left",
            keys=(("m.encounter_id", "e.encounter_id"),),
        ),
        Join("e", "p", "e.patient_id = p.patient_id", "left"),
    ]
    return join_sources(frames, joins, broadcast_bytes=0, fraction=1.0).selectExpr(
        "m.measurement_id", "e.encounter_id", "p.patient_id", "p.race_code"
    )



@query
def join_between(data: Data) -> DataFrame:
    """Each measurement with the stays of any patient of its user's number that it falls into, by dates alone and by key."""
    stays = data["encounter"].selectExpr("encounter_id", "patient_id", "cast(admit_datetime as date) as first_day", "discharge_date as last_day")
    moved = data["clinical_measurement"].selectExpr(
        "measurement_id", "patient_id", "date_sub(cast(measurement_datetime as date), cast(measurement_id % 9000 as int)) as day"
    )
    span = ("m.day", "e.first_day", "e.last_day")
    frames = {"m": moved, "e": stays, "w": stays}
    joins = [
        Join("m", "e", type="left", keys=(("m.patient_id", "e.patient_id"),), between=span),
        Join("m", "w", "w.encounter_id % 97 = m.measurement_id % 97", between=("m.day", "w.first_day", "w.last_day")),
    ]
    return join_sources(frames, joins).selectExpr(
        "m.measurement_id", "m.day", "e.encounter_id as own_stay", "w.encounter_id as other_stay"
    )


@query
def lookup_source_map(data: Data) -> DataFrame:
    out = apply_lookups(data["patient"].alias("pat"), [RACE], data.vocab)
    return out.select("patient_id", "race_code", "race_concept_id")


@query
def lookup_concept(data: Data) -> DataFrame:
    out = apply_lookups(data["encounter_diagnosis"].alias("dx"), [SOURCE_ID], data.vocab)
    return out.select("encounter_id", "line", "diagnosis_code", "condition_source_concept_id")


def _mapped(data: Data, vocab: Vocabulary, **options) -> DataFrame:
    out = apply_lookups(data["encounter_diagnosis"].alias("dx"), [MAPPED], vocab, **options)
    return out.select("encounter_id", "line", "diagnosis_code", "condition_concept_id")


@query
def lookup_mapped(data: Data) -> DataFrame:
    return _mapped(data, data.vocab)


@query
def lookup_mapped_spread(data: Data) -> DataFrame:
    """The same lookup when the mapping is too large to broadcast."""
    return _mapped(data, data.vocab, broadcast_bytes=0, fraction=1.0)


@query
def lookup_mapped_crosswalk(data: Data) -> DataFrame:
    """The same lookup from the prepared crosswalk."""
    path = scratch_path(data.spark, "crosswalk")
    prepared = write_crosswalk(data.vocab, path)
    return _mapped(data, Vocabulary(data["concept"], crosswalk=prepared, sizes=vocabulary_files.stored_sizes(data.spark, {"crosswalk": path})))


@query
def lookup_mapped_by_codes(data: Data) -> DataFrame:
    """The same lookup from a vocabulary of unknown size: the codes that occur come first."""
    return _mapped(data, replace(data.vocab, sizes={}))


def _by_relationship(data: Data, relationship: str, domain: str, target: str) -> DataFrame:
    lookup = Lookup(
        "ms", "measurement_name", target, BY_RELATIONSHIP,
        vocabulary_id="SRC", domain_id=domain, relationship_id=relationship,
    )
    out = apply_lookups(data["clinical_measurement"].alias("ms"), [lookup], data.vocab)
    return out.select("measurement_id", "measurement_name", target)


@query
def lookup_unit(data: Data) -> DataFrame:
    return _by_relationship(data, "Maps to unit", "Unit", "unit_concept_id")


@query
def lookup_value(data: Data) -> DataFrame:
    return _by_relationship(data, "Maps to value", "Meas Value", "value_as_concept_id")


@query
def lookup_replacement(data: Data) -> DataFrame:
    lookup = Lookup(
        "f", "brand_code", "replacement_concept_id", BY_RELATIONSHIP,
        vocabulary_id="STD", domain_id="Procedure",
        relationship_id="Concept replaced by", source_invalid_reason="U",
    )
    out = apply_lookups(data["formulary"].alias("f"), [lookup], data.vocab)
    return out.select("item_id", "brand_code", "replacement_concept_id")


@query
def replacement_closure(data: Data) -> DataFrame:
    return replacements.replacement_closure(data["replacement_edges"])


@query
def lookup_standard_and_source(data: Data) -> DataFrame:
    out = apply_lookups(data["encounter_diagnosis"].alias("dx"), [MAPPED, SOURCE_ID], data.vocab)
    return out.select(
        "encounter_id", "line", "diagnosis_code", "condition_concept_id",
        "condition_source_concept_id",
    )


@query
def lookup_chain(data: Data) -> DataFrame:
    """Lookups of all three kinds on two columns; fan-outs multiply."""
    frames = {"dx": data["encounter_diagnosis"], "enc": data["encounter"]}
    joined = join_sources(frames, [Join("dx", "enc", "dx.encounter_id = enc.encounter_id", "left")])
    visit = Lookup("enc", "encounter_type", "visit_concept_id", BY_MAP, source_vocabulary_id="Visit")
    unit = Lookup(
        "dx", "diagnosis_code", "unit_concept_id", BY_RELATIONSHIP,
        vocabulary_id="SRC", domain_id="Unit", relationship_id="Maps to unit", fallback=-1,
    )
    out = apply_lookups(joined, [MAPPED, visit, SOURCE_ID, unit], data.vocab)
    return out.selectExpr(
        "dx.encounter_id", "dx.line", "dx.diagnosis_code", "condition_concept_id",
        "visit_concept_id", "condition_source_concept_id", "unit_concept_id",
    )


def _src_codes(data: Data) -> DataFrame:
    return codes.code_values(data["encounter_diagnosis"], "diagnosis_code").select(
        F.lit("SRC").alias("vocabulary_id"), "source_code"
    )


@query
def lookup_concept_by_code(data: Data) -> DataFrame:
    return codes.lookup_concept_by_code(_src_codes(data), data["concept"])


@query
def lookup_maps_to(data: Data) -> DataFrame:
    hits = codes.lookup_concept_by_code(_src_codes(data), data["concept"])
    plain = hits.filter("concept_id is not null and coalesce(standard_concept, '') <> 'S'")
    return codes.lookup_maps_to(plain, data["concept_relationship"], data["concept"])


def _map_by_hand(data: Data) -> DataFrame:
    """Patients with their mapped race, stale map targets included."""
    stcm = data["source_to_concept_map"].filter("source_vocabulary_id = 'Race'")
    return data["patient"].join(
        stcm.selectExpr("source_code as race_code", "target_concept_id as race_concept_id"),
        "race_code", "left",
    ).select("patient_id", "race_code", "race_concept_id")


@query
def anti_concept_fk(data: Data) -> DataFrame:
    return conformance.anti_concept_fk(_map_by_hand(data), "race_concept_id", data["concept"])


@query
def semi_code_exists(data: Data) -> DataFrame:
    return codes.code_exists(
        codes.code_values(data["encounter_diagnosis"], "diagnosis_code"), data["concept"], "SRC"
    )


# Codes and profiles


def _requests() -> list[codes.CodeRequest]:
    specs = [
        tables.person(STYLE),
        tables.visit_occurrence(STYLE),
        tables.condition_occurrence(STYLE),
        tables.measurement(STYLE),
        tables.care_site(STYLE),
        TableSpec(
            "drug_exposure",
            (Source("f", "formulary"),),
            (),
            source_vocabulary=(CodeColumn("f", "brand_code", "STD"),),
        ),
    ]
    return codes.mapping_requests(specs)


def _codes(data: Data) -> DataFrame:
    requests = _requests()
    return codes.distinct_codes({r.source_table: data[r.source_table] for r in requests}, requests)


def _stored_codes(data: Data) -> DataFrame:
    """The distinct codes written once, so that reports do not read the facts again."""
    return data.stored(
        "codes", lambda: write_target(_codes(data), scratch_path(data.spark, "codes"))
    )


def _classified(data: Data, after: bool = False, found: DataFrame | None = None) -> DataFrame:
    vocab = data.vocab_after if after else data.vocab
    return drafting.classify_codes(
        codes.codes_by_vocabulary(_stored_codes(data) if found is None else found),
        vocab.concept,
        vocab.concept_relationship,
    )


@query
def mapping_requests(data: Data) -> DataFrame:
    """The requested columns with the number of distinct codes each one holds."""
    keys = ["table_name", "source_alias", "source_column", "vocabulary_id"]
    return _codes(data).groupBy(*keys).agg(F.count(F.lit(1)).alias("distinct_codes"))


@query
def distinct_codes(data: Data) -> DataFrame:
    return _codes(data)


@query
def codes_by_vocabulary(data: Data) -> DataFrame:
    return codes.codes_by_vocabulary(_codes(data))


@query
def code_frequency(data: Data) -> DataFrame:
    return profiling.ranked_codes(data["encounter"], "provider_id")


@query
def top_codes(data: Data) -> DataFrame:
    return profiling.top_codes(data["encounter_diagnosis"], "diagnosis_code")


@query
def column_profile(data: Data) -> DataFrame:
    encounter = data["encounter"]
    return profiling.column_profile(encounter, profiling.dense_columns(encounter))


@query
def duplicate_keys(data: Data) -> DataFrame:
    return profiling.duplicate_keys(data["encounter_diagnosis"], ["encounter_id", "line"])


@query
def null_rates(data: Data) -> DataFrame:
    raw = project_table(
        tables.condition_occurrence(STYLE),
        {"dx": data["encounter_diagnosis"], "enc": data["encounter"]},
        data.vocab,
    )
    return profiling.null_rates(raw, ["person_id", "provider_id", "condition_concept_id"])


@query
def fanout_by_domain(data: Data) -> DataFrame:
    return coverage.fanout_by_domain(
        data["encounter_diagnosis"], "diagnosis_code", data.vocab, "SRC"
    )


@query
def resolution_rate(data: Data) -> DataFrame:
    return profiling.resolution_rate(
        _build(data, "condition_occurrence"),
        ["condition_concept_id", "condition_source_concept_id"],
    )


def _vocabulary_table(concept: DataFrame) -> DataFrame:
    loaded = F.count_if(F.col("invalid_reason").isNull()).cast("string")
    return concept.groupBy("vocabulary_id").agg(
        F.concat(F.lit("v"), loaded).alias("vocabulary_version")
    )


@query
def vocabulary_versions(data: Data) -> DataFrame:
    return profiling.vocabulary_versions(
        _vocabulary_table(data["concept"]), _vocabulary_table(data["concept_after"])
    )


@query
def concept_distribution_diff(data: Data) -> DataFrame:
    """From counts per code, so the facts are read once."""
    return profiling.code_distribution_diff(data["encounter_diagnosis"], MAPPED, data.vocab, data.vocab_after)


@query
def concept_distribution_diff_of_tables(data: Data) -> DataFrame:
    """The same report from two finished tables."""
    before = _mapped(data, data.vocab)
    after = _mapped(data, data.vocab_after)
    return profiling.concept_distribution_diff(before, after, "condition_concept_id")


@query
def join_fanout_check(data: Data) -> DataFrame:
    return profiling.join_fanout_check(
        data["encounter"], ["encounter_id"], data["encounter_diagnosis"], ["encounter_id"]
    )


# Drafting and coverage


@query
def classify_codes(data: Data) -> DataFrame:
    return _classified(data)


@query
def draft_concept_map(data: Data) -> DataFrame:
    """The whole way from the fact columns to the draft, in one plan."""
    return drafting.draft_concept_map(_classified(data, found=_codes(data)))


@query
def draft_single_vocabulary(data: Data) -> DataFrame:
    return drafting.draft_single_vocabulary(
        codes.code_values(data["encounter_diagnosis"], "diagnosis_code"), data["concept"], "SRC"
    )


@query
def coverage_by_vocabulary(data: Data) -> DataFrame:
    return coverage.coverage_by_vocabulary(_classified(data))


@query
def coverage_by_column(data: Data) -> DataFrame:
    return coverage.coverage_by_column(_stored_codes(data), _classified(data))


@query
def coverage_overview(data: Data) -> DataFrame:
    return coverage.coverage_overview(_classified(data), len(_requests()))


@query
def sample_unmapped(data: Data) -> DataFrame:
    return coverage.sample_unmapped(_classified(data))


@query
def coverage_diff(data: Data) -> DataFrame:
    return coverage.coverage_diff(
        coverage.coverage_by_vocabulary(_classified(data)),
        coverage.coverage_by_vocabulary(_classified(data, after=True)),
    )


@query
def vocabulary_diff(data: Data) -> DataFrame:
    return refresh.vocabulary_diff(
        data["concept"],
        data["concept_after"],
        data["concept_relationship"],
        data["concept_relationship_after"],
    )


@query
def regressed_codes(data: Data) -> DataFrame:
    return refresh.regressed_codes(
        _classified(data),
        _classified(data, after=True),
        data["concept_after"],
        data["concept_relationship_after"],
    )


@query
def collision_audit(data: Data) -> DataFrame:
    return coverage.collision_audit(
        data["source_to_concept_map"], data["concept"], data["patient"], "race_code", "Race"
    )


@query
def stale_map_targets(data: Data) -> DataFrame:
    return coverage.stale_map_targets(data["source_to_concept_map"], data["concept"])


@query
def format_mismatch(data: Data) -> DataFrame:
    return coverage.format_mismatch(_classified(data), data["concept"])


@query
def dropped_by_domain(data: Data) -> DataFrame:
    return coverage.dropped_by_domain(
        data["encounter_diagnosis"], "diagnosis_code", data.vocab, "SRC", "Condition"
    )


# Row expectations


def _raw_visits(data: Data) -> DataFrame:
    return project_table(tables.visit_occurrence(STYLE), {"enc": data["encounter"]}, data.vocab)


VISIT_RULES = Rules(
    fail=(Rule("valid_pk", "visit_occurrence_id IS NOT NULL"), Rule("has_provider", "provider_id >= 0")),
    drop=(Rule("valid_dates", "visit_start_date <= visit_end_date"),),
    warn=(Rule("known_visit", "visit_concept_id != 0"), Rule("short_stay", "provider_id < 5")),
)


@query
def expect_fail(data: Data) -> DataFrame:
    """The guarded rows of a table that holds, counted with the rules it was held to."""
    rules = (Rule("valid_pk", "visit_occurrence_id IS NOT NULL"), Rule("person", "person_id >= 0"))
    held = expectations.expect_fail(_raw_visits(data), rules)
    return expectations.expectation_metrics(held, Rules(fail=rules))


@query
def expect_drop(data: Data) -> DataFrame:
    kept = expectations.expect_drop(_raw_visits(data), [*VISIT_RULES.drop, VISIT_RULES.fail[1]])
    return kept.select("visit_occurrence_id", "visit_start_date", "visit_end_date", "provider_id")


@query
def expect_warn(data: Data) -> DataFrame:
    return expectations.expect_warn(_raw_visits(data), VISIT_RULES.warn)


@query
def expectation_metrics(data: Data) -> DataFrame:
    return expectations.expectation_metrics(_raw_visits(data), VISIT_RULES)


@query
def build_metrics(data: Data) -> DataFrame:
    """Counts of a build's rules, warn rules too, taken while its table is written."""
    rules = Rules(VISIT_RULES.fail[:1], VISIT_RULES.drop, VISIT_RULES.warn)
    return store_with_metrics(_raw_visits(data), rules, scratch_path(data.spark, "visits"))[1]


@query
def long_source_values(data: Data) -> DataFrame:
    return profiling.long_source_values(_build(data, "condition_occurrence"))


# Table builds

BRONZE = {
    "person": {"pat": "patient", "id": "patient_identifier"},
    "visit_occurrence": {"enc": "encounter"},
    "condition_occurrence": {"dx": "encounter_diagnosis", "enc": "encounter"},
    "measurement": {"ms": "clinical_measurement", "enc": "encounter"},
    "procedure_occurrence": {"po": "procedure_order", "enc": "encounter"},
    "drug_exposure": {"mo": "medication_order", "enc": "encounter"},
    "observation": {"dx": "encounter_diagnosis", "enc": "encounter"},
    "death": {"pat": "patient"},
    "care_site": {"fac": "facility"},
    "provider": {"doc": "clinician"},
}


def _build(data: Data, table: str, style: tables.Style = STYLE) -> DataFrame:
    if table == "observation_period":
        return eras.observation_period(_stored(data, "visit_occurrence"), md5_key)
    if table == "condition_era":
        return eras.condition_era(_stored(data, "condition_occurrence"), key=md5_key)
    if table == "drug_era":
        return eras.drug_era(_stored(data, "drug_exposure"), key=md5_key)
    if table == "location":
        frames = {"loc": tables.distinct_locations(data["patient"])}
    else:
        frames = {a: data.fact(n) if n in FACTS else data[n] for a, n in BRONZE[table].items()}
    return build_table(tables.RECIPES[table](style), frames, data.vocab)


BUILT = (
    "person", "visit_occurrence", "condition_occurrence", "measurement", "procedure_occurrence",
    "drug_exposure", "observation", "death", "location", "care_site", "provider",
    "observation_period", "condition_era", "drug_era",
)


def _register_build(table: str) -> None:
    QUERIES[f"build_{table}"] = lambda spark, sf_dir: _build(Data(spark, sf_dir), table)


for _table in BUILT:
    _register_build(_table)


@query
def build_dose_era(data: Data) -> DataFrame:
    """Doses come from the ordered quantity, units from the drug code's unit."""
    unit = Lookup(
        "mo", "medication_code", "unit_concept_id", BY_RELATIONSHIP,
        vocabulary_id="SRC", domain_id="Unit", relationship_id="Maps to unit",
    )
    spec = tables.drug_exposure(STYLE)
    dosed = TableSpec(
        spec.table_name,
        spec.sources,
        (*spec.column_mappings, ColumnMap("dose_value", "cast(mo.quantity as float)")),
        spec.joins,
        (*spec.vocabulary_lookups, unit),
        expectations=spec.expectations,
    )
    frames = {"mo": data.fact("medication_order"), "enc": data["encounter"]}
    return eras.dose_era(build_table(dosed, frames, data.vocab), key=_dose_key)


def _dose_key(*parts: str) -> str:
    """Key over the dose as a whole number, whose text is the same in every engine."""
    return md5_key(*["cast(dose_value as int)" if p == "dose_value" else p for p in parts])


@query
def drug_era_by_ingredient(data: Data) -> DataFrame:
    """Exposures followed to their ingredients through the closure; drugs without one stay as products."""
    found = ingredients.ingredients_of(data["ingredient_concept"], data["concept_ancestor"])
    return eras.drug_era(_stored(data, "drug_exposure"), key=md5_key, ingredients=found, keep_products=True)


def _dose_by_64(*parts: str) -> str:
    """Key over the dose in whole 64ths, whose text is the same in every engine."""
    return md5_key(*["cast(dose_value * 64 as bigint)" if p == "dose_value" else p for p in parts])


@query
def dose_era_by_strength(data: Data) -> DataFrame:
    """Daily doses of ingredients from quantity, strength and days of supply."""
    supplied = F.expr("case when provider_id is not null then 1 << (cast(quantity as int) % 3) end")
    exposures = _stored(data, "drug_exposure").withColumn("days_supply", supplied)
    return eras.dose_era(exposures, key=_dose_by_64, drug_strength=data["drug_strength"])


@query
def build_table_query(data: Data) -> DataFrame:
    """From stored source to stored target by a spec: local formulary codes to drug exposures."""
    spec = TableSpec(
        "drug_exposure",
        (Source("f", "{folder}/formulary"),),
        (
            ColumnMap("drug_exposure_id", md5_key("f.item_id", "drug_concept_id")),
            ColumnMap("drug_source_value", "f.brand_code"),
        ),
        vocabulary_lookups=(
            Lookup(
                "f", "brand_code", "drug_concept_id", BY_CONCEPT,
                vocabulary_id="STD", domain_id="Drug",
            ),
        ),
        expectations=Rules(
            fail=(Rule("valid_pk", "drug_exposure_id IS NOT NULL"),),
            drop=(Rule("known_drug", "drug_concept_id != 0"),),
        ),
    )
    folder = scratch_path(data.spark, "bronze")
    write_target(data["formulary"], f"{folder}/formulary")
    return refresh_table(data.spark, spec, data.vocab, f"{folder}/drug_exposure", {"folder": folder})



# Conformance


def _stored(data: Data, table: str) -> DataFrame:
    """A finished table, complete with its empty columns, written once per session."""
    return data.stored(
        table, lambda: write_target(_build(data, table, WHOLE), scratch_path(data.spark, table))
    )


def _faulty_person(data: Data) -> DataFrame:
    person = _stored(data, "person")
    return (
        person.drop("day_of_birth")
        .withColumnRenamed("race_source_value", "race_source_text")
        .withColumn("death_datetime", F.lit(None).cast("timestamp"))
        .withColumn("year_of_birth", F.col("year_of_birth").cast("string"))
    )


@query
def check_schema(data: Data) -> DataFrame:
    """Schema findings of a faulty, a sound and a missing table, with the rows they concern."""
    cases = {
        "person": _faulty_person(data),
        "visit_occurrence": _stored(data, "visit_occurrence"),
        "specimen": None,
    }
    findings = None
    for table, df in cases.items():
        one = conformance.check_schema(data.spark, table, df)
        findings = one if findings is None else findings.unionByName(one)
    counts = vocabulary_files.table_row_counts({t: df for t, df in cases.items() if df is not None})
    return findings.join(counts, "table_name", "left")


def _faulty_conditions(data: Data) -> DataFrame:
    """Conditions with columns missing, ids unknown, ids of the wrong domain and persons lost."""
    return data.stored("faulty condition_occurrence", lambda: _make_faulty_conditions(data))


def _make_faulty_conditions(data: Data) -> DataFrame:
    rows = build_table(
        tables.condition_occurrence(KEEP_ORPHANS),
        {"dx": data.fact("encounter_diagnosis"), "enc": data["encounter"]},
        data.vocab,
    )
    altered = (
        rows.drop("stop_reason", "condition_source_concept_id", "condition_start_date")
        .withColumn("condition_status_concept_id", F.col("provider_id").cast("int"))
        .withColumn("condition_type_concept_id", F.col("condition_concept_id"))
    )
    return write_target(altered, scratch_path(data.spark, "altered_conditions"))


@query
def check_primary_key(data: Data) -> DataFrame:
    return conformance.check_primary_key(
        data.spark, "condition_occurrence", _faulty_conditions(data)
    )


@query
def check_concept_fk(data: Data) -> DataFrame:
    return conformance.check_concept_fk(
        data.spark, "condition_occurrence", _faulty_conditions(data), data["concept"]
    )


@query
def check_domain(data: Data) -> DataFrame:
    return conformance.check_domain(
        data.spark, "condition_occurrence", _faulty_conditions(data), data["concept"]
    )


@query
def check_not_null(data: Data) -> DataFrame:
    return conformance.check_not_null(data.spark, "condition_occurrence", _faulty_conditions(data))


@query
def validate_table(data: Data) -> DataFrame:
    return conformance.validate_table(
        data.spark, "condition_occurrence", _faulty_conditions(data), data["concept"]
    )


@query
def layer_summary(data: Data) -> DataFrame:
    """Counts of columns and findings for a faulty, a sound and a missing table."""
    checked = {
        "condition_occurrence": _faulty_conditions(data),
        "visit_occurrence": _stored(data, "visit_occurrence"),
        "specimen": None,
    }
    found = conformance.findings(data.spark, checked, data["concept"])
    return conformance.layer_summary(found, checked)


def all_stored(data: Data) -> dict[str, DataFrame]:
    return {t: _stored(data, t) for t in BUILT}


@query
def validate_all(data: Data) -> DataFrame:
    return conformance.validate_all(data.spark, all_stored(data), data["concept"])


@query
def finding_counts(data: Data) -> DataFrame:
    return conformance.finding_counts(validate_all(data))


@query
def check_table_fk(data: Data) -> DataFrame:
    return conformance.check_table_fk(data.spark, all_stored(data))


@query
def check_date_order(data: Data) -> DataFrame:
    rules = Rules(drop=(Rule("valid_dates", "visit_start_date <= visit_end_date"),))
    return expectations.expectation_metrics(_raw_visits(data), rules)


@query
def standard_rate(data: Data) -> DataFrame:
    return conformance.standard_rate(
        _stored(data, "condition_occurrence"),
        ["condition_concept_id", "condition_source_concept_id", "condition_type_concept_id"],
        data["concept"],
    )


@query
def gate_on_findings(data: Data) -> DataFrame:
    """A table that passes the gate; its findings are stored and come back unchanged."""
    person = conformance.check_not_null(data.spark, "person", _stored(data, "person"))
    return conformance.gate_on_findings(person, scratch_path(data.spark, "findings"))


# Scalar expressions


@query
def hash_key(data: Data) -> DataFrame:
    parts = ("encounter_id", "line", "diagnosis_code", "diagnosis_type")
    return data["encounter_diagnosis"].select(*parts, F.expr(md5_key(*parts)).alias("row_key"))


@query
def row_number_key_query(data: Data) -> DataFrame:
    order = ["vocabulary_id", "concept_code", "concept_id"]
    return row_number_key(data["concept"].select(*order), order, "sequence")



@query
def case_map(data: Data) -> DataFrame:
    targets = {"M": 8507, "F": 8532}
    return data["patient"].select(
        "patient_id", values.case_map(F.col("gender_code"), targets).alias("gender_concept_id")
    )


@query
def birth_parts(data: Data) -> DataFrame:
    return data["patient"].select("patient_id", *values.birth_parts(F.col("birth_date")))


@query
def event_date(data: Data) -> DataFrame:
    day = values.event_date(F.col("measurement_datetime"))
    return data["clinical_measurement"].select("measurement_id", day.alias("measurement_date"))


@query
def safe_number(data: Data) -> DataFrame:
    number = values.safe_number(F.col("measurement_value"))
    return data["clinical_measurement"].select("measurement_id", number.alias("value_as_number"))


@query
def compact_date(data: Data) -> DataFrame:
    day = values.compact_date(F.col("valid_start_date"))
    return data["seed_map"].select("source_code", day.alias("valid_start_date"))


@query
def blank_to_null(data: Data) -> DataFrame:
    reason = values.blank_to_null(F.col("invalid_reason"))
    return data["seed_map"].select("source_code", reason.alias("invalid_reason"))


@query
def source_value(data: Data) -> DataFrame:
    long_text = F.repeat(F.concat_ws(" ", "source_code", "source_code_description"), 5)
    return data["seed_map"].select(
        "source_code", values.source_value(long_text).alias("code_source_value")
    )


@query
def literal_concept(data: Data) -> DataFrame:
    return data["patient"].select(
        "patient_id",
        values.literal_concept(values.EHR_RECORD).alias("type_concept_id"),
        values.literal_concept(values.UNKNOWN).alias("race_source_concept_id"),
    )
