"""The same queries as plain SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

import re

from cdmloom.model.cdm import CDM
from workload.fixtures import FIXTURES, fixture_sql

ORACLES: dict[str, str] = {}


def _with(body: str, extra: dict[str, str] | None = None) -> str:
    """Put the fixtures (and ``extra`` tables) that ``body`` mentions in front of it."""
    known = {name: fixture_sql(name) for name in FIXTURES} | (extra or {})
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed[name] = ""
                if name not in FIXTURES:
                    visit(known[name])
                needed.pop(name)
                needed[name] = known[name]

    visit(body)
    if not needed:
        return body
    tables = ",\n".join(f"{n} as materialized ({q})" for n, q in needed.items())
    return f"with {tables}\n{body}"


def oracle(name: str, body: str, **extra: str) -> None:
    ORACLES[name] = _with(body, extra)


def md5_key(*parts: str) -> str:
    slots = ", ".join(f"coalesce(cast(strlen(cast({p} as varchar)) as varchar) || ':' || cast({p} as varchar), '~')" for p in parts)
    return f"cast('0x' || substr(md5(concat_ws('|', {slots})), 1, 15) as bigint)"


def hop(
    domain: str | None,
    relationship: str = "Maps to",
    vocabulary: str = "SRC",
    suffix: str = "",
    origin: str = "a.invalid_reason is null",
) -> str:
    """(code, target, domain_id) over one relationship to valid standard concepts."""
    where = f"and b.domain_id = '{domain}'" if domain else ""
    return f"""(select a.concept_code as code, b.concept_id as target, b.domain_id
        from concept{suffix} a
        join concept_relationship{suffix} r on r.concept_id_1 = a.concept_id
        join concept{suffix} b on b.concept_id = r.concept_id_2
        where a.vocabulary_id = '{vocabulary}' and {origin}
          and r.relationship_id = '{relationship}' and r.invalid_reason is null
          and b.invalid_reason is null and b.standard_concept = 'S' {where})"""


def direct(vocabulary: str, domain: str, standard: bool) -> str:
    flag = "and standard_concept = 'S'" if standard else ""
    return f"""(select concept_code as code, concept_id as target from concept
        where vocabulary_id = '{vocabulary}' and domain_id = '{domain}'
          and invalid_reason is null {flag})"""


def mapped(vocabulary: str) -> str:
    return f"""(select m.source_code as code, m.target_concept_id as target
        from source_to_concept_map m
        where m.source_vocabulary_id = '{vocabulary}'
          and m.target_concept_id in (select concept_id from concept where invalid_reason is null))"""


# Sources and sinks

oracle("load_vocabulary", "select * from concept")
oracle(
    "load_report",
    """select 'concept' as table_name, 'OK' as status, count(*) as row_count,
        cast(0 as bigint) as bad_values, count(*) filter (concept_id % 10 = 3) as short_lines,
        count(*) filter (concept_id % 10 = 7) as long_lines from concept
    union all select 'concept_relationship', 'OK', count(*), 0, 0, 0 from concept_relationship
    union all select t, 'SKIP', 0, 0, 0, 0 from (values ('vocabulary'), ('domain'), ('concept_class'),
        ('relationship'), ('concept_synonym'), ('concept_ancestor'), ('drug_strength'),
        ('concept_cpt4')) as v(t)""",
)
oracle(
    "quarantined_lines",
    """select 'concept' as table_name, 'short' as kind, cast(concept_id as varchar) || chr(9) || concept_name as line
    from concept where concept_id % 10 = 3
    union all select 'concept', 'long', array_to_string([cast(concept_id as varchar), concept_name, domain_id, vocabulary_id,
        concept_class_id, 'S', concept_code, valid_start_date, valid_end_date, 'D', 'more'], chr(9))
    from concept where concept_id % 10 = 7""",
)
oracle(
    "cast_to_schema",
    """select cast(measurement_id as int) as concept_id_1,
        try_cast(measurement_value as int) as concept_id_2,
        measurement_name as relationship_id, '19700101' as valid_start_date,
        '20991231' as valid_end_date, cast(null as varchar) as invalid_reason
    from clinical_measurement""",
)
oracle(
    "require_non_empty",
    """select 'concept' as table_name, count(*) as row_count from concept
    union all select 'concept_relationship', count(*) from concept_relationship""",
)
oracle(
    "table_row_counts",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}"
        for t in ("patient", "encounter", "encounter_diagnosis", "clinical_measurement", "concept")
    ),
)
SEED = """select source_code, try_cast(source_concept_id as int) as source_concept_id,
    source_vocabulary_id, source_code_description,
    try_cast(target_concept_id as int) as target_concept_id, target_vocabulary_id,
    cast(try_strptime(valid_start_date, '%Y%m%d') as date) as valid_start_date,
    cast(try_strptime(valid_end_date, '%Y%m%d') as date) as valid_end_date,
    case when trim(invalid_reason) = '' then null else invalid_reason end as invalid_reason
    from seed_map"""
oracle("normalize_seed_map", SEED)
oracle(
    "union_license_gated",
    """select * from concept
    union all select * from concept_cpt4 g
    where not exists (select 1 from concept c where c.concept_id = g.concept_id)""",
)
oracle(
    "upsert_concept_map",
    """select * from seed
    union all select * from source_to_concept_map t
    where not exists (select 1 from seed s where s.source_code = t.source_code
                      and s.source_vocabulary_id = t.source_vocabulary_id)""",
    seed=SEED,
)
oracle(
    "read_sources",
    """select c_mktsegment, count(*) as orders from orders
    join customer on o_custkey = c_custkey group by c_mktsegment""",
)

# Projections and filters

oracle(
    "map_columns",
    "select patient_id as person_id, cast(year(birth_date) as int) as year_of_birth, zip_code as zip from patient",
)
oracle(
    "append_lookup_targets",
    f"""select patient_id as person_id, race_code as race, coalesce(m.target, 0) as race_concept_id
    from patient left join {mapped('Race')} m on m.code = race_code""",
)
oracle("valid_concepts", "select concept_id, concept_code from concept where invalid_reason is null")
oracle("standard_concepts", "select concept_id, concept_code from concept where standard_concept = 'S'")
oracle(
    "concepts_in",
    "select concept_id, concept_code from concept where vocabulary_id = 'SRC' and domain_id = 'Drug'",
)
oracle(
    "valid_edges",
    """select concept_id_1, concept_id_2 from concept_relationship
    where relationship_id = 'Maps to' and invalid_reason is null""",
)

# Joins

for _how in ("inner", "left", "right", "full"):
    oracle(
        f"join_{_how}",
        f"""select d.encounter_id as fact_encounter_id, d.line, d.diagnosis_code,
            e.encounter_id, e.patient_id
        from encounter_diagnosis d {_how} join encounter e on d.encounter_id = e.encounter_id""",
    )
oracle(
    "join_cross",
    """select e.encounter_id,
        cast(cast(e.admit_datetime as date) - p.first_day as int) as days_in,
        cast(p.last_day - cast(e.admit_datetime as date) as int) as days_left
    from encounter e cross join (select cast(min(admit_datetime) as date) as first_day,
        cast(max(admit_datetime) as date) as last_day from encounter) p""",
)
oracle(
    "join_sources",
    """select m.measurement_id, e.encounter_id, p.patient_id, p.race_code
    from clinical_measurement m
    left join encounter e on m.encounter_id = e.encounter_id
        and m.measurement_datetime >= e.admit_datetime
    left join patient p on e.patient_id = p.patient_id""",
)
oracle(
    "lookup_source_map",
    f"""select patient_id, race_code, coalesce(m.target, 0) as race_concept_id
    from patient left join {mapped('Race')} m on m.code = race_code""",
)
oracle(
    "lookup_concept",
    f"""select encounter_id, line, diagnosis_code,
        coalesce(m.target, 0) as condition_source_concept_id
    from encounter_diagnosis
    left join {direct('SRC', 'Condition', False)} m on m.code = diagnosis_code""",
)
for _name in ("lookup_mapped", "lookup_mapped_spread", "lookup_mapped_crosswalk", "lookup_mapped_by_codes"):
    oracle(
        _name,
        f"""select encounter_id, line, diagnosis_code, coalesce(m.target, 0) as condition_concept_id
        from encounter_diagnosis left join {hop('Condition')} m on m.code = diagnosis_code""",
    )
oracle(
    "replacement_closure",
    """select * from (with recursive step as (
        select concept_id_1 as a, min(concept_id_2) as b from replacement_edges
        where relationship_id = 'Concept replaced by' and invalid_reason is null group by 1),
    walk as (select a, b, 1 as hops from step
        union all select w.a, s.b, hops + 1 from walk w join step s on s.a = w.b where hops < 60),
    final as (select * from walk w where not exists (select 1 from step s where s.a = w.b))
    select s.a as concept_id, f.b as final_concept_id, cast(f.hops as int) as hops, f.a is null as cyclic
    from step s left join final f on f.a = s.a)""",
)
oracle(
    "lookup_unit",
    f"""select measurement_id, measurement_name, coalesce(m.target, 0) as unit_concept_id
    from clinical_measurement left join {hop('Unit', 'Maps to unit')} m on m.code = measurement_name""",
)
oracle(
    "lookup_value",
    f"""select measurement_id, measurement_name, coalesce(m.target, 0) as value_as_concept_id
    from clinical_measurement
    left join {hop('Meas Value', 'Maps to value')} m on m.code = measurement_name""",
)
oracle(
    "lookup_replacement",
    f"""select item_id, brand_code, coalesce(m.target, 0) as replacement_concept_id
    from formulary left join {hop('Procedure', 'Concept replaced by', 'STD',
    origin="a.invalid_reason = 'U'")} m on m.code = brand_code""",
)
oracle(
    "lookup_standard_and_source",
    f"""select encounter_id, line, diagnosis_code, coalesce(m.target, 0) as condition_concept_id,
        coalesce(s.target, 0) as condition_source_concept_id
    from encounter_diagnosis
    left join {hop('Condition')} m on m.code = diagnosis_code
    left join {direct('SRC', 'Condition', False)} s on s.code = diagnosis_code""",
)
oracle(
    "lookup_chain",
    f"""select d.encounter_id, d.line, d.diagnosis_code,
        coalesce(m.target, 0) as condition_concept_id, coalesce(v.target, 0) as visit_concept_id,
        coalesce(s.target, 0) as condition_source_concept_id,
        coalesce(u.target, -1) as unit_concept_id
    from encounter_diagnosis d
    left join encounter e on d.encounter_id = e.encounter_id
    left join {hop('Condition')} m on m.code = d.diagnosis_code
    left join {mapped('Visit')} v on v.code = e.encounter_type
    left join {direct('SRC', 'Condition', False)} s on s.code = d.diagnosis_code
    left join {hop('Unit', 'Maps to unit')} u on u.code = d.diagnosis_code""",
)
HITS = """select k.vocabulary_id, k.source_code, c.concept_id, c.concept_name,
    c.vocabulary_id as concept_vocabulary_id, c.standard_concept
    from src_codes k left join (
        select *, row_number() over (partition by vocabulary_id, concept_code order by concept_id) as rn
        from concept) c
    on c.rn = 1 and c.vocabulary_id = k.vocabulary_id and c.concept_code = k.source_code"""
SRC_CODES = "select distinct 'SRC' as vocabulary_id, diagnosis_code as source_code from encounter_diagnosis"
oracle("lookup_concept_by_code", HITS, src_codes=SRC_CODES)
oracle(
    "lookup_maps_to",
    """select r.concept_id_2 as target_concept_id, r.concept_id_1 as concept_id,
        t.vocabulary_id as target_vocabulary_id, t.standard_concept as target_standard_concept
    from concept_relationship r join concept t on t.concept_id = r.concept_id_2
    where r.relationship_id = 'Maps to' and r.invalid_reason is null
      and r.concept_id_1 in (select concept_id from hits where standard_concept is distinct from 'S')""",
    src_codes=SRC_CODES,
    hits=HITS,
)
oracle(
    "anti_concept_fk",
    """select patient_id, race_code, m.target_concept_id as race_concept_id
    from patient join source_to_concept_map m
        on m.source_vocabulary_id = 'Race' and m.source_code = race_code
    where m.target_concept_id <> 0 and m.target_concept_id not in (select concept_id from concept)""",
)
oracle(
    "semi_code_exists",
    """select concept_code, concept_id, concept_name, standard_concept from concept
    where vocabulary_id = 'SRC' and concept_code in (select diagnosis_code from encounter_diagnosis)""",
)

# Codes and profiles

_COLUMNS = (
    ("person", "pat", "patient", "race_code", "Race"),
    ("person", "pat", "patient", "ethnicity_code", "Ethnicity"),
    ("visit_occurrence", "enc", "encounter", "encounter_type", "Visit"),
    ("condition_occurrence", "dx", "encounter_diagnosis", "diagnosis_code", "SRC"),
    ("measurement", "ms", "clinical_measurement", "measurement_name", "SRC"),
    ("care_site", "fac", "facility", "service_code", "Visit"),
    ("drug_exposure", "f", "formulary", "brand_code", "STD"),
)
CODES = " union all ".join(
    f"select distinct '{t}' as table_name, '{a}' as source_alias, '{c}' as source_column, "
    f"'{v}' as vocabulary_id, {c} as source_code from {b} where {c} is not null"
    for t, a, b, c, v in _COLUMNS
)
_ALL = "select distinct vocabulary_id, source_code from codes"


def classified(suffix: str = "") -> str:
    return f"""select k.vocabulary_id, k.source_code,
        case when h.concept_id is null then 'unresolved_no_concept'
             when h.standard_concept = 'S' then 'resolved_direct'
             when coalesce(t.n, 0) = 0 then 'unresolved_no_maps_to'
             when t.s = 1 then 'resolved_via_maps_to'
             else 'unresolved_ambiguous' end as bucket,
        coalesce(h.concept_id, 0) as source_concept_id, h.concept_name as source_name,
        h.vocabulary_id as hit_vocabulary, h.standard_concept as hit_standard,
        t.target, t.target_vocabulary, coalesce(t.s, 0) as standard_targets
    from ({_ALL}) k
    left join concept{suffix} h
        on h.vocabulary_id = k.vocabulary_id and h.concept_code = k.source_code
    left join (
        select r.concept_id_1, count(*) as n, count(*) filter (c.standard_concept = 'S') as s,
            min(c.concept_id) filter (c.standard_concept = 'S') as target,
            arg_min(c.vocabulary_id, c.concept_id) filter (c.standard_concept = 'S')
                as target_vocabulary
        from concept_relationship{suffix} r join concept{suffix} c on c.concept_id = r.concept_id_2
        where r.relationship_id = 'Maps to' and r.invalid_reason is null
        group by r.concept_id_1) t on t.concept_id_1 = h.concept_id
    qualify row_number() over (partition by k.vocabulary_id, k.source_code order by h.concept_id) = 1"""


DRAFT = {"codes": CODES, "classified": classified()}
_TARGET = """case bucket when 'resolved_direct' then source_concept_id
    when 'resolved_via_maps_to' then target else 0 end"""
_TARGET_VOCABULARY = """case bucket when 'resolved_direct' then hit_vocabulary
    when 'resolved_via_maps_to' then target_vocabulary else '' end"""

oracle(
    "mapping_requests",
    """select table_name, source_alias, source_column, vocabulary_id, count(*) as distinct_codes
    from codes group by all""",
    codes=CODES,
)
oracle("distinct_codes", "select * from codes", codes=CODES)
oracle("codes_by_vocabulary", _ALL, codes=CODES)
oracle(
    "code_frequency",
    "select cast(provider_id as varchar) as code, count(*) as n from encounter group by provider_id",
)
oracle(
    "top_codes",
    """select diagnosis_code as code, count(*) as n from encounter_diagnosis
    group by diagnosis_code order by n desc, code limit 20""",
)
oracle(
    "column_profile",
    " union all ".join(
        f"select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count, "
        f"count(distinct {c}) as distinct_count from encounter"
        for c in (
            "encounter_id", "patient_id", "admit_datetime", "discharge_date", "encounter_type",
            "provider_id",
        )
    ),
)
oracle(
    "duplicate_keys",
    """select encounter_id, line, count(*) as n from encounter_diagnosis
    group by encounter_id, line having count(*) > 1 order by encounter_id, line limit 20""",
)
oracle(
    "null_rates",
    " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_count, "
        f"count(*) as row_count, round((count(*) - count({c})) / count(*), 6) as null_rate from raw"
        for c in ("person_id", "provider_id", "condition_concept_id")
    ),
    raw=f"""select e.patient_id as person_id, e.provider_id,
        coalesce(m.target, 0) as condition_concept_id
    from encounter_diagnosis d left join encounter e on e.encounter_id = d.encounter_id
    left join {hop('Condition')} m on m.code = d.diagnosis_code""",
)
oracle(
    "fanout_by_domain",
    f"""select code as source_code, domain_id, count(*) as targets
    from {hop(None)} where code in (select diagnosis_code from encounter_diagnosis)
    group by code, domain_id""",
)


def _versions(suffix: str) -> str:
    return f"""(select vocabulary_id,
        'v' || cast(count(*) filter (invalid_reason is null) as varchar) as version
        from concept{suffix} group by vocabulary_id)"""


oracle(
    "vocabulary_versions",
    f"""select vocabulary_id, b.version as version_before, a.version as version_after,
        b.version is distinct from a.version as changed
    from {_versions('')} b full join {_versions('_after')} a using (vocabulary_id)""",
)


def _distribution(suffix: str) -> str:
    return f"""(select coalesce(m.target, 0) as concept_id, count(*) as n from encounter_diagnosis
        left join {hop('Condition', suffix=suffix)} m on m.code = diagnosis_code group by 1)"""


for _name in ("concept_distribution_diff", "concept_distribution_diff_of_tables"):
    oracle(
        _name,
        f"""select concept_id, coalesce(b.n, 0) as rows_before, coalesce(a.n, 0) as rows_after,
            coalesce(a.n, 0) - coalesce(b.n, 0) as difference
        from {_distribution('')} b full join {_distribution('_after')} a using (concept_id)""",
    )
oracle(
    "join_fanout_check",
    """select case n when 0 then 'none' when 1 then 'one' else 'many' end as partners,
        count(*) as key_count, count(*) as left_rows,
        cast(sum(greatest(n, 1)) as bigint) as joined_rows
    from (select e.encounter_id, count(d.encounter_id) as n from encounter e
          left join encounter_diagnosis d on d.encounter_id = e.encounter_id
          group by e.encounter_id) group by 1""",
)

oracle(
    "join_between",
    """select * from (with stays as (select encounter_id, patient_id, cast(admit_datetime as date) as first_day, discharge_date as last_day from encounter),
    moved as (select measurement_id, patient_id,
        cast(measurement_datetime as date) - cast(measurement_id % 9000 as int) as day from clinical_measurement)
    select m.measurement_id, m.day, e.encounter_id as own_stay, w.encounter_id as other_stay
    from moved m
    left join stays e on e.patient_id = m.patient_id and m.day between e.first_day and e.last_day
    join stays w on w.encounter_id % 97 = m.measurement_id % 97 and m.day between w.first_day and w.last_day)""",
)

# Drafting and coverage

oracle(
    "classify_codes",
    f"""select vocabulary_id, source_code, bucket, source_concept_id, source_name,
        {_TARGET} as target_concept_id, {_TARGET_VOCABULARY} as target_vocabulary_id,
        standard_targets from classified""",
    **DRAFT,
)
_DRAFT_SQL = f"""select source_code, source_concept_id, vocabulary_id as source_vocabulary_id,
    case when bucket = 'unresolved_no_concept'
           then 'UNRESOLVED - no concept in OHDSI vocabulary; manual mapping required'
         when bucket = 'unresolved_no_maps_to'
           then source_name || ' - non-standard with no ''Maps to'' relationship; manual mapping required'
         when bucket = 'unresolved_ambiguous' and standard_targets = 0
           then source_name || ' - ''Maps to'' targets are non-standard (possible multi-hop); manual mapping required'
         when bucket = 'unresolved_ambiguous'
           then source_name || ' - multiple ''Maps to'' standard targets (' || standard_targets
                || '); chose lowest concept_id; manual review recommended'
         else source_name end as source_code_description,
    {_TARGET} as target_concept_id, {_TARGET_VOCABULARY} as target_vocabulary_id,
    '19700101' as valid_start_date, '20991231' as valid_end_date, '' as invalid_reason
    from classified"""
oracle("draft_concept_map", _DRAFT_SQL, **DRAFT)
oracle(
    "write_draft_map",
    """select * replace (cast(source_concept_id as varchar) as source_concept_id,
        cast(target_concept_id as varchar) as target_concept_id) from draft""",
    **DRAFT,
    draft=_DRAFT_SQL,
)
oracle(
    "draft_single_vocabulary",
    """select source_code, 0 as source_concept_id, 'SRC' as source_vocabulary_id,
        case when concept_id is null then 'UNRESOLVED — manual mapping required' else '' end
            as source_code_description,
        coalesce(concept_id, 0) as target_concept_id,
        coalesce(concept_vocabulary_id, '') as target_vocabulary_id,
        '19700101' as valid_start_date, '20991231' as valid_end_date, '' as invalid_reason
    from hits""",
    src_codes=SRC_CODES,
    hits=HITS,
)
_RESOLVED = "bucket like 'resolved%'"
_TOTALS = f"""count(*) filter ({_RESOLVED}) as resolved,
    count(*) filter (not {_RESOLVED}) as unresolved"""
_PCT = f"printf('%.1f%%', 100.0::double * count(*) filter ({_RESOLVED}) / count(*)) as resolution_pct"
oracle(
    "coverage_by_vocabulary",
    f"select vocabulary_id, count(*) as total, {_TOTALS}, "
    + ", ".join(
        f"count(*) filter (bucket = '{b}') as {b}"
        for b in (
            "resolved_direct", "resolved_via_maps_to", "unresolved_no_concept",
            "unresolved_no_maps_to", "unresolved_ambiguous",
        )
    )
    + f", {_PCT} from classified group by vocabulary_id",
    **DRAFT,
)
oracle(
    "coverage_by_column",
    f"""select k.table_name, k.source_alias, k.source_column, k.vocabulary_id,
        count(*) as distinct_codes, {_TOTALS}
    from codes k join classified using (vocabulary_id, source_code) group by 1, 2, 3, 4""",
    **DRAFT,
)
oracle(
    "coverage_overview",
    f"""select count(distinct vocabulary_id) as vocabularies, {len(_COLUMNS)} as columns_covered,
        count(*) as total, {_TOTALS}, {_PCT} from classified""",
    **DRAFT,
)
oracle(
    "sample_unmapped",
    f"""select vocabulary_id, source_code, cast(row_number() over
        (partition by vocabulary_id order by source_code) as int) as position
    from classified where not {_RESOLVED} qualify position <= 20""",
    **DRAFT,
)
_BOTH = {"codes": CODES, "was": classified(), "now": classified("_after")}
oracle(
    "coverage_diff",
    f"""select *, case when resolved_after / total_after > resolved_before / total_before
            then 'correction'
        when resolved_after / total_after < resolved_before / total_before then 'regression'
        else 'unchanged' end as change
    from (select vocabulary_id, count(*) as total_before,
              count(*) filter ({_RESOLVED}) as resolved_before,
              count(*) filter (not {_RESOLVED}) as unresolved_before from was group by 1)
    join (select vocabulary_id, count(*) as total_after,
              count(*) filter ({_RESOLVED}) as resolved_after,
              count(*) filter (not {_RESOLVED}) as unresolved_after from now group by 1)
    using (vocabulary_id)""",
    **_BOTH,
)
_MAPS = "relationship_id = 'Maps to' and invalid_reason is null"
oracle(
    "vocabulary_diff",
    f"""select 'new_code' as kind, concept_id, cast(null as int) as other_concept_id
        from concept_after where concept_id not in (select concept_id from concept)
    union all select 'de_standardised', a.concept_id, null from concept_after a
        join concept b using (concept_id)
        where b.standard_concept = 'S' and a.standard_concept is distinct from 'S'
    union all select 'promoted', a.concept_id, null from concept_after a
        join concept b using (concept_id)
        where a.standard_concept = 'S' and b.standard_concept is distinct from 'S'
    union all select 'deprecated', a.concept_id, null from concept_after a
        join concept b using (concept_id)
        where a.invalid_reason = 'D' and b.invalid_reason is distinct from 'D'
    union all select 'upgraded', a.concept_id, null from concept_after a
        join concept b using (concept_id)
        where a.invalid_reason = 'U' and b.invalid_reason is distinct from 'U'
    union all (select 'new_maps_to', concept_id_1, concept_id_2 from (
        select concept_id_1, concept_id_2 from concept_relationship_after where {_MAPS}
        except select concept_id_1, concept_id_2 from concept_relationship where {_MAPS}))
    union all (select 'removed_maps_to', concept_id_1, concept_id_2 from (
        select concept_id_1, concept_id_2 from concept_relationship where {_MAPS}
        except select concept_id_1, concept_id_2 from concept_relationship_after where {_MAPS}))""",
)
oracle(
    "regressed_codes",
    f"""select w.vocabulary_id, w.source_code, w.former_concept_id, n.bucket as bucket_after,
        case when c.concept_id is null then 'target_missing'
             when c.invalid_reason = 'U' then 'target_upgraded'
             when c.invalid_reason = 'D' then 'target_deprecated'
             when c.standard_concept is distinct from 'S' then 'target_de_standardised'
             else 'mapping_changed' end as reason,
        (select min(s.concept_id) from concept_relationship_after r
         join concept_after s on s.concept_id = r.concept_id_2
         where r.concept_id_1 = w.former_concept_id and r.relationship_id = 'Concept replaced by'
           and r.invalid_reason is null and s.invalid_reason is null and s.standard_concept = 'S')
            as replacement_concept_id
    from (select *, {_TARGET} as former_concept_id from was where {_RESOLVED}) w
    join (select * from now where not {_RESOLVED}) n using (vocabulary_id, source_code)
    left join concept_after c on c.concept_id = w.former_concept_id""",
    **_BOTH,
)
oracle(
    "collision_audit",
    """select m.source_code as code, m.target_concept_id as mapped_concept_id,
        c.concept_id as literal_concept_id,
        (select count(*) from patient where race_code = m.source_code) as rows_affected,
        round((select count(*) from patient where race_code = m.source_code)
              / (select count(*) from patient), 6) as row_share
    from source_to_concept_map m join concept c
        on c.vocabulary_id = 'Race' and c.concept_code = m.source_code
    where m.source_vocabulary_id = 'Race' and m.target_concept_id <> c.concept_id""",
)
oracle(
    "stale_map_targets",
    """select source_vocabulary_id, source_code, target_concept_id from source_to_concept_map
    where target_concept_id not in (select concept_id from concept where invalid_reason is null)""",
)
oracle(
    "format_mismatch",
    """select u.vocabulary_id, u.source_code, k.concept_code, k.concept_id from unknown_codes u
    join known_codes k on k.vocabulary_id = u.vocabulary_id and k.plain_code = u.plain_code
    where u.plain_code <> ''""",
    unknown_codes="""select vocabulary_id, source_code,
        regexp_replace(upper(source_code), '[^A-Z0-9]', '', 'g') as plain_code
        from classified where bucket = 'unresolved_no_concept'""",
    known_codes="""select vocabulary_id, concept_code, concept_id,
        regexp_replace(upper(concept_code), '[^A-Z0-9]', '', 'g') as plain_code from concept""",
    **DRAFT,
)
oracle(
    "dropped_by_domain",
    f"""select code, elsewhere, rows_lost from (
        select code, count(*) filter (domain_id = 'Condition') as wanted,
            count(*) filter (domain_id <> 'Condition') as elsewhere
        from {hop(None)} group by code)
    join (select diagnosis_code as code, count(*) as rows_lost from encounter_diagnosis group by 1)
        using (code)
    where wanted = 0 and elsewhere > 0""",
)

# Table builds. Each entry is the table's SELECT; the same text feeds the era and validation twins.

_ENC = "left join encounter e on e.encounter_id = f.encounter_id"
_TYPE = "cast(32817 as int)"


def _fact(table: str, bronze: str, stem: str, code: str, moment: str, domain: str, more: str) -> str:
    line = "line" if bronze == "encounter_diagnosis" else "order_line"
    key = md5_key("f.encounter_id", f"f.{line}", f"f.{code}", "coalesce(m.target, 0)")
    start = {
        "condition": "condition_start", "observation": "observation", "procedure": "procedure",
        "drug": "drug_exposure_start",
    }[stem]
    return f"""select {key} as {table}_id, e.patient_id as person_id,
        cast(f.{moment} as date) as {start}_date, cast(f.{moment} as timestamp) as {start}_datetime,
        {_TYPE} as {stem}_type_concept_id, e.provider_id, e.encounter_id as visit_occurrence_id,
        f.{code} as {stem}_source_value,
        coalesce(m.target, 0) as {stem}_concept_id,
        coalesce(s.target, 0) as {stem}_source_concept_id {more}
    from {bronze} f {_ENC}
    left join {hop(domain)} m on m.code = f.{code}
    left join {direct('SRC', domain, False)} s on s.code = f.{code}"""


CONDITIONS = _fact(
    "condition_occurrence", "encounter_diagnosis", "condition", "diagnosis_code",
    "diagnosis_datetime", "Condition", ", f.diagnosis_type as condition_status_source_value",
)
_HAS_PERSON = " where e.patient_id is not null"
BUILDS: dict[str, str] = {
    "person": f"""select patient_id as person_id,
        case gender_code when 'M' then 8507 when 'F' then 8532 else 0 end as gender_concept_id,
        cast(year(birth_date) as int) as year_of_birth,
        cast(month(birth_date) as int) as month_of_birth,
        cast(day(birth_date) as int) as day_of_birth, cast(birth_date as timestamp) as birth_datetime,
        {md5_key('zip_code')} as location_id, i.mrn as person_source_value,
        gender_code as gender_source_value, race_code as race_source_value,
        cast(0 as int) as race_source_concept_id, ethnicity_code as ethnicity_source_value,
        cast(0 as int) as ethnicity_source_concept_id, coalesce(r.target, 0) as race_concept_id,
        coalesce(x.target, 0) as ethnicity_concept_id
    from patient p
    left join (select patient_id as pid, mrn from patient_identifier where identity_type = 'MRN') i
        on i.pid = p.patient_id
    left join {mapped('Race')} r on r.code = race_code
    left join {mapped('Ethnicity')} x on x.code = ethnicity_code""",
    "visit_occurrence": f"""select encounter_id as visit_occurrence_id, patient_id as person_id,
        cast(admit_datetime as date) as visit_start_date,
        cast(admit_datetime as timestamp) as visit_start_datetime,
        discharge_date as visit_end_date, cast(discharge_date as timestamp) as visit_end_datetime,
        {_TYPE} as visit_type_concept_id, provider_id, encounter_type as visit_source_value,
        cast(0 as int) as visit_source_concept_id, coalesce(v.target, 0) as visit_concept_id
    from encounter left join {mapped('Visit')} v on v.code = encounter_type
    where cast(admit_datetime as date) <= discharge_date""",
    "condition_occurrence": CONDITIONS + _HAS_PERSON,
    "observation": _fact(
        "observation", "encounter_diagnosis", "observation", "diagnosis_code",
        "diagnosis_datetime", "Observation", "",
    ) + _HAS_PERSON + " and m.target is not null",
    "procedure_occurrence": _fact(
        "procedure_occurrence", "procedure_order", "procedure", "procedure_code",
        "order_datetime", "Procedure", "",
    ) + _HAS_PERSON,
    "drug_exposure": _fact(
        "drug_exposure", "medication_order", "drug", "medication_code", "order_datetime", "Drug",
        ", cast(f.order_datetime as date) as drug_exposure_end_date, cast(f.quantity as float) as quantity",
    ) + _HAS_PERSON,
    "measurement": f"""select
        {md5_key('f.measurement_id', 'coalesce(m.target, 0)', 'coalesce(u.target, 0)')} as measurement_id,
        e.patient_id as person_id, cast(f.measurement_datetime as date) as measurement_date,
        cast(f.measurement_datetime as timestamp) as measurement_datetime,
        {_TYPE} as measurement_type_concept_id,
        try_cast(f.measurement_value as double) as value_as_number, e.provider_id,
        e.encounter_id as visit_occurrence_id, f.measurement_name as measurement_source_value,
        f.measurement_value as value_source_value, coalesce(m.target, 0) as measurement_concept_id,
        coalesce(u.target, 0) as unit_concept_id,
        coalesce(s.target, 0) as measurement_source_concept_id
    from clinical_measurement f {_ENC}
    left join {hop('Measurement')} m on m.code = f.measurement_name
    left join {hop('Unit', 'Maps to unit')} u on u.code = f.measurement_name
    left join {direct('SRC', 'Measurement', False)} s on s.code = f.measurement_name""" + _HAS_PERSON,
    "death": f"""select patient_id as person_id, death_date,
        cast(death_date as timestamp) as death_datetime, {_TYPE} as death_type_concept_id
    from patient where death_date is not null""",
    "location": f"""select distinct {md5_key('zip_code')} as location_id, zip_code as zip,
        zip_code as location_source_value from patient""",
    "care_site": f"""select facility_id as care_site_id, facility_name as care_site_name,
        {md5_key('zip_code')} as location_id, cast(facility_id as varchar) as care_site_source_value,
        service_code as place_of_service_source_value,
        coalesce(m.target, 0) as place_of_service_concept_id
    from facility left join {direct('Visit', 'Visit', True)} m on m.code = service_code""",
    "provider": f"""select clinician_id as provider_id, clinician_name as provider_name,
        facility_id as care_site_id, cast(clinician_id as varchar) as provider_source_value,
        specialty_code as specialty_source_value, gender_code as gender_source_value,
        coalesce(m.target, 0) as specialty_concept_id, coalesce(g.target, 0) as gender_concept_id
    from clinician
    left join {direct('Specialty', 'Provider', True)} m on m.code = specialty_code
    left join {direct('Gender', 'Gender', True)} g on g.code = gender_code""",
}
BUILDS["observation_period"] = f"""select {md5_key('person_id')} as observation_period_id, person_id,
    min(visit_start_date) as observation_period_start_date,
    max(visit_end_date) as observation_period_end_date, {_TYPE} as period_type_concept_id
    from t_visit_occurrence group by person_id"""


def era(table: str, keys: list[str], start: str, end: str) -> str:
    """Islands found row by row, without reducing to days first."""
    by = ", ".join(keys)
    return f"""select {by}, min(s) as first_day, max(e) as last_day, count(*) as n,
        cast(sum(case when fresh = 0 and s > reach then s - reach else 0 end) as int) as gap
    from (select *, sum(fresh) over (partition by {by} order by s, e
                                     rows between unbounded preceding and current row) as island
        from (select *, case when reach is null or s - reach > 30 then 1 else 0 end as fresh
            from (select {by}, {start} as s, {end} as e,
                    max({end}) over (partition by {by} order by {start}, {end}
                        rows between unbounded preceding and 1 preceding) as reach
                from {table})))
    group by {by}, island"""


BUILDS["condition_era"] = f"""select
    {md5_key('person_id', 'condition_concept_id', 'first_day')} as condition_era_id, person_id,
    condition_concept_id, first_day as condition_era_start_date, last_day as condition_era_end_date,
    cast(n as int) as condition_occurrence_count
    from ({era('(select * from t_condition_occurrence where condition_concept_id <> 0)',
               ['person_id', 'condition_concept_id'], 'condition_start_date', 'condition_start_date')})"""
BUILDS["drug_era"] = f"""select
    {md5_key('person_id', 'drug_concept_id', 'first_day')} as drug_era_id, person_id,
    drug_concept_id, first_day as drug_era_start_date, last_day as drug_era_end_date,
    cast(n as int) as drug_exposure_count, gap as gap_days
    from ({era('(select * from t_drug_exposure where drug_concept_id <> 0)',
               ['person_id', 'drug_concept_id'], 'drug_exposure_start_date', 'drug_exposure_end_date')})"""

TABLES = {f"t_{t}": q for t, q in BUILDS.items()}
for _table, _select in BUILDS.items():
    oracle(f"build_{_table}", _select, **TABLES)
oracle("write_target", BUILDS["visit_occurrence"])
_DOSE_KEYS = ["person_id", "drug_concept_id", "unit_concept_id", "dose_value"]
oracle(
    "build_dose_era",
    f"""select {md5_key('person_id', 'drug_concept_id', 'unit_concept_id',
                        'cast(dose_value as int)', 'first_day')} as dose_era_id,
        {', '.join(_DOSE_KEYS)}, first_day as dose_era_start_date, last_day as dose_era_end_date
    from ({era(f'''(select t.*, t.quantity as dose_value, coalesce(u.target, 0) as unit_concept_id
        from t_drug_exposure t left join {hop('Unit', 'Maps to unit')} u on u.code = t.drug_source_value
        where t.drug_concept_id <> 0)''', _DOSE_KEYS, 'drug_exposure_start_date',
        'drug_exposure_end_date')})""",
    **TABLES,
)
_INGREDIENT = """(select a.descendant_concept_id as drug, a.ancestor_concept_id as ingredient
    from concept_ancestor a join ingredient_concept i on i.concept_id = a.ancestor_concept_id
    where i.concept_class_id = 'Ingredient' and i.standard_concept = 'S' and i.invalid_reason is null)"""
_BY_INGREDIENT = f"""(select x.* replace (cast(coalesce(m.ingredient, x.drug_concept_id) as int) as drug_concept_id)
    from t_drug_exposure x left join {_INGREDIENT} m on m.drug = x.drug_concept_id where x.drug_concept_id <> 0)"""
oracle(
    "drug_era_by_ingredient",
    f"""select {md5_key('person_id', 'drug_concept_id', 'first_day')} as drug_era_id, person_id,
        drug_concept_id, first_day as drug_era_start_date, last_day as drug_era_end_date,
        cast(n as int) as drug_exposure_count, gap as gap_days
    from ({era(_BY_INGREDIENT, ['person_id', 'drug_concept_id'], 'drug_exposure_start_date', 'drug_exposure_end_date')})""",
    **TABLES,
)
_STRENGTH = """(select *, row_number() over (partition by drug, ingredient order by unit, amount) as place from (
    select drug_concept_id as drug, ingredient_concept_id as ingredient,
        amount_value is null and coalesce(denominator_unit_concept_id = 8505, false) as hourly,
        coalesce(amount_value, numerator_value / coalesce(denominator_value, 1)) as amount,
        case when amount_value is null then numerator_unit_concept_id else amount_unit_concept_id end as unit
    from drug_strength where invalid_reason is null and coalesce(amount_value, numerator_value) is not null))"""
_DOSED = f"""(select x.person_id, m.ingredient as drug_concept_id, m.unit as unit_concept_id,
        x.drug_exposure_start_date, x.drug_exposure_end_date,
        case when m.hourly then 24 * m.amount else cast(x.quantity as double) * m.amount
            / (case when x.provider_id is null then 1 else 1 << (cast(x.quantity as int) % 3) end) end as dose_value
    from t_drug_exposure x join {_STRENGTH} m on m.drug = x.drug_concept_id and m.place = 1)"""
oracle(
    "dose_era_by_strength",
    f"""select {md5_key('person_id', 'drug_concept_id', 'unit_concept_id', 'cast(dose_value * 64 as bigint)', 'first_day')}
            as dose_era_id,
        {', '.join(_DOSE_KEYS)}, first_day as dose_era_start_date, last_day as dose_era_end_date
    from ({era(_DOSED, _DOSE_KEYS, 'drug_exposure_start_date', 'drug_exposure_end_date')})""",
    **TABLES,
)
oracle(
    "build_table",
    f"""select {md5_key('item_id', 'm.target')} as drug_exposure_id, brand_code as drug_source_value,
        m.target as drug_concept_id
    from formulary join {direct('STD', 'Drug', True)} m on m.code = brand_code""",
)
oracle(
    "resolution_rate",
    " union all ".join(
        f"select '{c}' as column_name, count(*) as row_count, count(*) filter ({c} <> 0) as resolved, "
        f"round(count(*) filter ({c} <> 0) / count(*), 6) as resolved_rate from t_condition_occurrence"
        for c in ("condition_concept_id", "condition_source_concept_id")
    ),
    **TABLES,
)

# Row expectations

RAW_VISITS = {"raw": BUILDS["visit_occurrence"].replace(
    "where cast(admit_datetime as date) <= discharge_date", "")}


def _metric(action: str, rule: str, predicate: str, scope: str = "true") -> str:
    ok = f"({scope}) and coalesce({predicate}, false)"
    return f"""select '{action}' as action, '{rule}' as rule, count(*) filter ({scope}) as checked,
        count(*) filter ({ok}) as passed,
        count(*) filter (({scope}) and not coalesce({predicate}, false)) as failed from raw"""


_DATES = "visit_start_date <= visit_end_date"
oracle(
    "expect_fail",
    _metric("fail", "valid_pk", "visit_occurrence_id is not null")
    + " union all " + _metric("fail", "person", "person_id >= 0"),
    **RAW_VISITS,
)
oracle(
    "expect_drop",
    f"""select visit_occurrence_id, visit_start_date, visit_end_date, provider_id
    from raw where {_DATES} and provider_id >= 0""",
    **RAW_VISITS,
)
oracle(
    "expect_warn",
    _metric("warn", "known_visit", "visit_concept_id <> 0")
    + " union all " + _metric("warn", "short_stay", "provider_id < 5"),
    **RAW_VISITS,
)
oracle(
    "expectation_metrics",
    " union all ".join([
        _metric("fail", "valid_pk", "visit_occurrence_id is not null"),
        _metric("fail", "has_provider", "provider_id >= 0"),
        _metric("drop", "valid_dates", _DATES),
        _metric("warn", "known_visit", "visit_concept_id <> 0", _DATES),
        _metric("warn", "short_stay", "provider_id < 5", _DATES),
    ]),
    **RAW_VISITS,
)
oracle(
    "long_source_values",
    " union all ".join(
        f"select '{c}' as column_name, count(*) filter (length({c}) > 50) as over_long, max(length({c})) as longest from built"
        for c in ("condition_source_value", "condition_status_source_value")
    ),
    built=BUILDS["condition_occurrence"],
)
oracle("build_metrics", " union all ".join([
    _metric("fail", "valid_pk", "visit_occurrence_id is not null"),
    _metric("drop", "valid_dates", _DATES),
    _metric("warn", "known_visit", "visit_concept_id <> 0", _DATES),
    _metric("warn", "short_stay", "provider_id < 5", _DATES),
]), **RAW_VISITS)
oracle("check_date_order", _metric("drop", "valid_dates", _DATES), **RAW_VISITS)

# Conformance: one query per table, layer and column


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _row(table: str, layer: int, status: str, check: str, message: str, where: str = "") -> str:
    return (
        f"select {_text(table)} as table_name, {layer} as layer, {_text(status)} as status, "
        f"{_text(check)} as \"check\", {message} as message {where}"
    )


def whole(table: str, source: str, without: frozenset[str] = frozenset()) -> str:
    """``source`` with every column of the target model, those it lacks being NULL."""
    nulls = ", ".join(
        f"cast(null as {c.type}) as \"{c.name}\"" for c in CDM[table] if c.name not in without
    )
    return f"select {nulls} where false union all by name select * from {source}"


def validation(table: str, source: str, without: frozenset[str] = frozenset()) -> str:
    """All findings of layers 2 to 5 on ``source``, which lacks the columns ``without``."""
    spec = CDM[table]
    present = {c.name for c in spec} - without
    parts = []
    pk = next(c.name for c in spec if c.pk)
    groups = f"(select {pk} as k, count(*) as n from {source} group by 1 having count(*) > 1)"
    parts.append(
        _row(table, 2, "PASS", f"pk_uniqueness:{pk}", "'no duplicate primary keys'",
             f"where not exists (select 1 from {groups})")
    )
    parts.append(
        _row(table, 2, "FAIL", f"pk_uniqueness:{pk}",
             f"""'duplicate PK groups (showing up to 20): ' || (select string_agg('[' || k || ', '
             || n || ']', ', ' order by k) from (select * from {groups} order by k limit 20))""",
             f"where exists (select 1 from {groups})")
    )

    def layer(number: int, name: str, columns, count, message, ok: str, all_skipped: str) -> None:
        gone = [c for c in columns if c.name not in present]
        kept = [c for c in columns if c.name in present]
        parts.extend(
            _row(table, number, "SKIP", f"{name}:{c.name}", "'column not in actual table (Layer 1)'")
            for c in gone
        )
        if gone and not kept:
            parts.append(_row(table, number, "SKIP", name, _text(all_skipped)))
            return
        for c in kept:
            parts.append(
                f"select * from ({_row(table, number, 'FAIL', f'{name}:{c.name}', message(c))} "
                f"from (select {count(c)} as bad, (select count(*) from {source}) as total)) "
                f"where message is not null"
            )
        suffix = " (some skipped per Layer 1)" if gone else ""
        total = " + ".join(count(c) for c in kept) or "0"
        parts.append(_row(table, number, "PASS", name, _text(ok + suffix), f"where ({total}) = 0"))

    concepts = [c for c in spec if c.name.endswith("_concept_id")]
    layer(
        3, "concept_fk", concepts,
        lambda c: f"(select count(*) from {source} where {c.name} <> 0 and {c.name} "
                  f"not in (select concept_id from concept))",
        lambda c: f"case when bad > 0 then printf('{c.name}: %d rows with concept_id not in "
                  f"reference.concept', bad) end",
        "all non-null non-zero concept_ids resolve to reference.concept",
        "all concept_id checks skipped (every concept column missing per Layer 1)",
    )
    layer(
        4, "domain", [c for c in concepts if c.domain],
        lambda c: f"(select count(*) from {source} s join concept k on k.concept_id = s.{c.name} "
                  f"where k.concept_id <> 0 and k.domain_id <> '{c.domain}')",
        lambda c: f"case when bad > 0 then printf('{c.name}: %d rows with domain_id <> {c.domain}', "
                  f"bad) end",
        "domain checks for annotated concept columns",
        "all domain checks skipped (every annotated concept column missing per Layer 1)",
    )
    required = [c for c in spec if c.required]
    if not present:
        parts.append(_row(table, 5, "SKIP", "not_null", "'table missing from actual catalog (Layer 1)'"))
    else:
        layer(
            5, "not_null", required,
            lambda c: f"(select count(*) from {source} where {c.name} is null)",
            lambda c: f"case when bad > 0 then printf('{c.name}: %d NULL rows (%.2f%% of %d)', bad, "
                      f"100.0::double * bad / total, total) end",
            "required (non-nullable) columns have no NULLs", "",
        )
    return " union all ".join(parts)


def missing_table(table: str) -> str:
    columns = [c.name for c in CDM[table]]
    concepts = [c for c in CDM[table] if c.name.endswith("_concept_id")]
    placed = [c for c in concepts if c.domain]
    skip = "'column not in actual table (Layer 1)'"
    parts = [_row(table, 1, "FAIL", "schema:table_missing", "'table does not exist'")]
    parts += [
        _row(table, 1, "FAIL", f"schema:missing:{c}", _text(f"missing column: {c}")) for c in columns
    ]
    pk = next(c.name for c in CDM[table] if c.pk)
    parts.append(
        _row(table, 2, "SKIP", f"pk_uniqueness:{pk}", "'PK columns missing from actual table (Layer 1)'")
    )
    parts += [_row(table, 3, "SKIP", f"concept_fk:{c.name}", skip) for c in concepts]
    if concepts:
        parts.append(
            _row(table, 3, "SKIP", "concept_fk",
                 "'all concept_id checks skipped (every concept column missing per Layer 1)'")
        )
    else:
        parts.append(_row(
            table, 3, "PASS", "concept_fk",
            "'all non-null non-zero concept_ids resolve to reference.concept'",
        ))
    parts += [_row(table, 4, "SKIP", f"domain:{c.name}", skip) for c in placed]
    if placed:
        parts.append(
            _row(table, 4, "SKIP", "domain",
                 "'all domain checks skipped (every annotated concept column missing per Layer 1)'")
        )
    else:
        parts.append(
            _row(table, 4, "PASS", "domain", "'domain checks for annotated concept columns'")
        )
    parts.append(_row(table, 5, "SKIP", "not_null", "'table missing from actual catalog (Layer 1)'"))
    return " union all ".join(parts)


_OK = "'column names and coarse types align with spec'"
_PERSON_FAULTS = " union all ".join([
    _row("person", 1, "FAIL", "schema:missing:day_of_birth", "'missing column: day_of_birth'"),
    _row("person", 1, "FAIL", "schema:missing:race_source_value", "'missing column: race_source_value'"),
    _row("person", 1, "WARN", "schema:extra:death_datetime", "'extra column not in spec: death_datetime'"),
    _row("person", 1, "WARN", "schema:extra:race_source_text", "'extra column not in spec: race_source_text'"),
    _row("person", 1, "FAIL", "schema:type:year_of_birth", "'year_of_birth: expected ~INT, got string'"),
    _row("visit_occurrence", 1, "PASS", "schema", _OK),
    _row("specimen", 1, "FAIL", "schema:table_missing", "'table does not exist'"),
    *(
        _row("specimen", 1, "FAIL", f"schema:missing:{c.name}", _text(f"missing column: {c.name}"))
        for c in CDM["specimen"]
    ),
])
oracle(
    "check_schema",
    f"""select f.*, case table_name when 'person' then (select count(*) from patient)
        when 'visit_occurrence' then (select count(*) from t_visit_occurrence) end as row_count
    from ({_PERSON_FAULTS}) f""",
    **TABLES,
)

_LOST = frozenset({"stop_reason", "condition_source_concept_id", "condition_start_date"})
_FAULTY = {
    "altered": f"""select * exclude (condition_source_concept_id, condition_start_date,
            condition_type_concept_id),
        cast(provider_id as int) as condition_status_concept_id,
        condition_concept_id as condition_type_concept_id from ({CONDITIONS})""",
    "faulty": whole("condition_occurrence", "altered", _LOST),
}
_FAULTY_ALL = " union all ".join(
    [
        *(
            _row("condition_occurrence", 1, "FAIL", f"schema:missing:{c}", f"'missing column: {c}'")
            for c in sorted(_LOST)
        ),
        validation("condition_occurrence", "faulty", _LOST),
    ]
)
oracle("validate_table", _FAULTY_ALL, **_FAULTY)
for _layer, _name in (
    (2, "check_primary_key"), (3, "check_concept_fk"), (4, "check_domain"), (5, "check_not_null"),
):
    oracle(_name, f"select * from ({_FAULTY_ALL}) where layer = {_layer}", **_FAULTY)
WHOLE = TABLES | {f"w_{t}": whole(t, f"t_{t}") for t in BUILDS}
# Columns of the standard per layer: all, key, concepts, concepts with a domain, required.
_EXPECTED = """(values ('condition_occurrence', 16, 1, 4, 3, 5), ('visit_occurrence', 17, 1, 5, 4, 6),
    ('specimen', 15, 1, 5, 4, 5)) t(table_name, n1, n2, n3, n4, n5)"""
_SOUND = _row("visit_occurrence", 1, "PASS", "schema", _OK) + " union all " + validation("visit_occurrence", "w_visit_occurrence")
oracle(
    "layer_summary",
    f"""select * from (with found as ({_FAULTY_ALL} union all {_SOUND} union all {missing_table("specimen")}),
    layers as (select table_name, layer, [n1, n2, n3, n4, n5][layer] as expected
        from {_EXPECTED}, (select unnest([1, 2, 3, 4, 5]) as layer)),
    counted as (select table_name, layer, count(*) filter (status = 'FAIL') as failed,
            count(*) filter (status = 'WARN') as warned, count(*) filter (status = 'SKIP') as skipped,
            count(*) filter (status = 'PASS') as passed,
            count(*) filter ("check" like 'schema:missing:%') as missing_columns,
            count(*) filter ("check" like 'schema:type:%') as mistyped_columns,
            count(*) filter ("check" like 'schema:extra:%') as extra_columns,
            count(*) filter (status = 'SKIP' and "check" like '%:%') as gone,
            bool_or("check" = 'not_null' and status = 'SKIP') as no_table,
            count(*) filter (status = 'FAIL' and "check" like '%:%' and "check" <> 'schema:table_missing') as failed_columns
        from found group by table_name, layer)
    select c.* exclude (gone, no_table), expected as expected_columns,
        case when no_table then expected when layer = 1 then missing_columns else gone end as skipped_columns,
        expected - skipped_columns as checked_columns,
        case when layer = 1 then expected - missing_columns - mistyped_columns end as aligned_columns,
        failed > 0 or (layer = 1 and warned > 0) as layer_failed,
        case table_name when 'condition_occurrence' then (select count(*) from faulty)
            when 'visit_occurrence' then (select count(*) from t_visit_occurrence) end as table_rows
    from counted c join layers using (table_name, layer))""",
    **_FAULTY,
    **WHOLE,
)
_EVERY = " union all ".join(
    _row(t, 1, "PASS", "schema", _OK) + " union all " + validation(t, f"w_{t}")
    if t in BUILDS
    else missing_table(t)
    for t in sorted(CDM)
)
oracle("validate_all", _EVERY, **WHOLE)
oracle("finding_counts", f"select status, count(*) as n from ({_EVERY}) group by status", **WHOLE)


def _table_fks() -> str:
    parts = []
    for table in sorted(BUILDS):
        for c in CDM[table]:
            parent = (c.fk or "concept.").split(".")[0]
            if parent == "concept" or parent not in BUILDS:
                continue
            key = c.fk.split(".")[1]
            lost = f"from w_{table} where {c.name} not in (select {key} from t_{parent})"
            parts.append(
                f"select '{table}' as table_name, '{c.name}' as column_name, '{parent}' as parent, "
                f"(select count(distinct {c.name}) {lost}) as dangling_ids, "
                f"(select count(*) {lost}) as dangling_rows"
            )
    return " union all ".join(parts)


oracle("check_table_fk", _table_fks(), **WHOLE)
oracle(
    "standard_rate",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as used_rows,
            count(*) filter (k.standard_concept = 'S') as standard_rows,
            round(count(*) filter (k.standard_concept = 'S') / count(*), 6) as standard_rate
        from t_condition_occurrence left join concept k on k.concept_id = {c} where {c} <> 0
        having count(*) > 0"""
        for c in ("condition_concept_id", "condition_source_concept_id", "condition_type_concept_id")
    ),
    **TABLES,
)
oracle(
    "gate_on_findings",
    _row("person", 5, "PASS", "not_null", "'required (non-nullable) columns have no NULLs'",
         "where (select count(*) from t_person where person_id is null) = 0"),
    **TABLES,
)

# Scalar expressions

oracle(
    "hash_key",
    f"""select encounter_id, line, diagnosis_code, diagnosis_type,
        {md5_key('encounter_id', 'line', 'diagnosis_code', 'diagnosis_type')} as row_key
    from encounter_diagnosis""",
)
oracle(
    "row_number_key",
    """select vocabulary_id, concept_code, concept_id,
        row_number() over (order by vocabulary_id, concept_code, concept_id) as sequence
    from concept""",
)
oracle(
    "case_map",
    """select patient_id, case gender_code when 'M' then 8507 when 'F' then 8532 else 0 end
        as gender_concept_id from patient""",
)
oracle(
    "birth_parts",
    """select patient_id, cast(year(birth_date) as int) as year_of_birth,
        cast(month(birth_date) as int) as month_of_birth, cast(day(birth_date) as int) as day_of_birth,
        cast(birth_date as timestamp) as birth_datetime from patient""",
)
oracle(
    "event_date",
    "select measurement_id, cast(measurement_datetime as date) as measurement_date from clinical_measurement",
)
oracle(
    "safe_number",
    """select measurement_id, try_cast(measurement_value as double) as value_as_number
    from clinical_measurement""",
)
oracle(
    "compact_date",
    """select source_code, cast(try_strptime(valid_start_date, '%Y%m%d') as date) as valid_start_date
    from seed_map""",
)
oracle(
    "blank_to_null",
    """select source_code, case when trim(invalid_reason) <> '' then invalid_reason end as invalid_reason
    from seed_map""",
)
oracle(
    "source_value",
    """select source_code,
        repeat(source_code || ' ' || source_code_description, 5) as code_source_value
    from seed_map""",
)
oracle(
    "literal_concept",
    "select patient_id, 32817 as type_concept_id, 0 as race_source_concept_id from patient",
)
