"""Bronze and vocabulary tables derived from the test tables.

Every fixture is a union of projections of whole test tables; faults are put in
by changing values, never by leaving rows out. The expressions are plain SQL
that Spark and DuckDB read alike, so both sides start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cdmloom.model.vocabulary import Vocabulary
from cdmloom.operators.durable import scratch_path
from cdmloom.operators.spread import configure
from cdmloom.sources.tables import file_bytes
from cdmloom.sources.vocabulary_files import store_vocabulary, stored_sizes

# Bronze tables large enough to be spread over all cores before a table is built from them.
FACTS = ("encounter_diagnosis", "procedure_order", "medication_order")


@dataclass(frozen=True)
class Part:
    """A projection of one test table, or of a few constant rows."""

    base: str
    columns: dict[str, str]
    distinct: bool = False
    rows: tuple[str, ...] = ()

    def sql(self) -> str:
        source = self.base
        if self.rows:
            source = f"(values {', '.join(self.rows)}) as {self.base}"
        exprs = ", ".join(f"{e} as {c}" for c, e in self.columns.items())
        return f"select {'distinct ' if self.distinct else ''}{exprs} from {source}"

    def frame(self, data: Data) -> DataFrame:
        if self.rows:
            return data.spark.sql(self.sql())
        picked = data.base(self.base).selectExpr(*[f"{e} as {c}" for c, e in self.columns.items()])
        return picked.distinct() if self.distinct else picked


PATIENT = Part(
    "customer",
    {
        "patient_id": "c_custkey",
        "birth_date": "cast('1940-01-01' as date) + cast((c_custkey * 37) % 25000 as int)",
        "gender_code": "case c_custkey % 3 when 0 then 'M' when 1 then 'F' else 'U' end",
        "race_code": "c_mktsegment",
        "ethnicity_code": "case c_nationkey % 3 when 0 then 'H' when 1 then 'NH' else 'X' end",
        "zip_code": "lpad(cast(c_nationkey as string), 5, '0')",
        "death_date": "case when c_custkey % 20 = 0 "
        "then cast('2005-01-01' as date) + cast(c_custkey % 1000 as int) end",
    },
)
PATIENT_IDENTIFIER = Part(
    "customer",
    {
        "patient_id": "c_custkey",
        "mrn": "c_name",
        "identity_type": "case when c_custkey % 10 = 9 then 'SSN' else 'MRN' end",
    },
)
ENCOUNTER = Part(
    "orders",
    {
        "encounter_id": "o_orderkey",
        "patient_id": "o_custkey",
        "admit_datetime": "o_orderdate",
        "discharge_date": "cast(o_orderdate as date) + cast(o_orderkey % 10 "
        "- case when o_orderkey % 50 = 0 then 3 else 0 end as int)",
        "encounter_type": "o_orderpriority",
        "provider_id": "case when o_orderkey % 4 <> 0 then o_orderkey % 10 end",
    },
)
# Some facts name an encounter that does not exist.
_LINE_ENCOUNTER = "case when l_orderkey % 40 = 39 then -l_orderkey else l_orderkey end"
ENCOUNTER_DIAGNOSIS = Part(
    "lineitem",
    {
        "encounter_id": _LINE_ENCOUNTER,
        "line": "l_linenumber",
        "diagnosis_code": "'P' || cast(l_partkey as string)",
        "diagnosis_type": "l_returnflag",
        "diagnosis_datetime": "l_shipdate",
    },
)
PROCEDURE_ORDER = Part(
    "lineitem",
    {
        "encounter_id": _LINE_ENCOUNTER,
        "order_line": "l_linenumber",
        "procedure_code": "'P' || cast(l_partkey as string)",
        "order_datetime": "l_shipdate",
    },
)
MEDICATION_ORDER = Part(
    "lineitem",
    {
        "encounter_id": _LINE_ENCOUNTER,
        "order_line": "l_linenumber",
        "medication_code": "'P' || cast(l_partkey as string)",
        "order_datetime": "l_shipdate",
        "quantity": "l_quantity",
    },
)
CLINICAL_MEASUREMENT = Part(
    "events",
    {
        "measurement_id": "event_id",
        "encounter_id": "case when event_id % 40 = 39 then -event_id else event_id end",
        "patient_id": "user_id",
        "measurement_name": "'P' || cast(event_id % 200 as string)",
        "measurement_value": "case when event_type = 'error' then 'n/a' "
        "else cast(cast(round(value * 100) as bigint) as string) end",
        "measurement_datetime": "ts",
    },
)
FACILITY = Part(
    "supplier",
    {
        "facility_id": "s_suppkey",
        "facility_name": "s_name",
        "zip_code": "lpad(cast(s_nationkey as string), 5, '0')",
        "service_code": "case s_nationkey % 3 when 0 then '1-URGENT' when 1 then '2-HIGH' else 'NONE' end",
    },
)
CLINICIAN = Part(
    "supplier",
    {
        "clinician_id": "s_suppkey",
        "clinician_name": "s_name",
        "facility_id": "s_suppkey",
        "specialty_code": "'NATION_' || cast(s_nationkey as string)",
        "gender_code": "case s_suppkey % 3 when 0 then 'M' when 1 then 'F' else 'U' end",
    },
)
FORMULARY = Part(
    "part",
    {"item_id": "p_partkey", "brand_code": "'B' || split_part(p_brand, '#', 2)"},
)

_BRAND = "cast(split_part(p_brand, '#', 2) as int)"
_SRC = "cast(10000000 + p_partkey as int)"


def _concept(
    base: str,
    concept_id: str,
    name: str,
    domain: str,
    vocabulary: str,
    code: str,
    kind: str = "'Fixture'",
    standard: str = "'S'",
    invalid: str = "cast(null as string)",
    distinct: bool = False,
    rows: tuple[str, ...] = (),
) -> Part:
    return Part(
        base,
        {
            "concept_id": f"cast({concept_id} as int)",
            "concept_name": name,
            "domain_id": domain,
            "vocabulary_id": vocabulary,
            "concept_class_id": kind,
            "standard_concept": standard,
            "concept_code": code,
            "valid_start_date": "'19700101'",
            "valid_end_date": "'20991231'",
            "invalid_reason": invalid,
        },
        distinct,
        rows,
    )


_DOMAINS = (
    "when 0 then 'Observation' when 1 then 'Procedure' when 2 then 'Drug' "
    "when 3 then 'Measurement' else 'Condition' end"
)


def concept(after: bool = False) -> tuple[Part, ...]:
    """Non-standard ``SRC``, standard ``STD`` and local code sets; ``after`` is a refreshed load."""
    src_code = "case when p_partkey % 23 = 0 then 'p-' else 'P' end || cast(p_partkey as string)"
    src_bad = "case when p_partkey % 17 = 0 then 'D' end"
    std = f"case when {_BRAND} % 6 = 5 then null else 'S' end"
    std_bad = f"case when {_BRAND} % 13 = 12 then 'U' end"
    new: tuple[Part, ...] = ()
    if after:
        src_code = "'P' || cast(p_partkey as string)"
        src_bad = "case when p_partkey % 17 = 0 or p_partkey % 31 = 0 then 'D' end"
        std = (
            f"case when {_BRAND} % 12 = 11 then 'S' "
            f"when {_BRAND} % 6 = 5 or {_BRAND} % 7 = 3 then null else 'S' end"
        )
        std_bad = f"case when {_BRAND} % 13 = 12 or {_BRAND} % 10 = 4 then 'U' end"
        new = (
            _concept(
                "supplier", "50000000 + s_suppkey", "s_name", "'Condition'", "'SRC'",
                "'N' || cast(s_suppkey as string)", standard="cast(null as string)",
            ),
        )
    return (
        _concept(
            "part", _SRC, "p_name", f"case p_partkey % 7 {_DOMAINS}", "'SRC'", src_code,
            kind="p_type", standard="cast(null as string)", invalid=src_bad,
        ),
        _concept(
            "part", f"2000000 + {_BRAND}", "p_brand", f"case {_BRAND} % 5 {_DOMAINS}", "'STD'",
            "'B' || split_part(p_brand, '#', 2)", standard=std, invalid=std_bad, distinct=True,
        ),
        _concept(
            "part", "3000000 + p_size", "'size ' || cast(p_size as string)", "'Condition'", "'STD'",
            "'S' || cast(p_size as string)", distinct=True,
        ),
        _concept(
            "part", "3500000 + p_size", "'unit ' || cast(p_size as string)", "'Unit'", "'STD'",
            "'U' || cast(p_size as string)", distinct=True,
        ),
        _concept(
            "part", "3700000 + p_size", "'value ' || cast(p_size as string)", "'Meas Value'", "'STD'",
            "'V' || cast(p_size as string)", distinct=True,
        ),
        _concept(
            "customer", "4000000 + ascii(c_mktsegment)", "c_mktsegment", "'Race'", "'Race'",
            "case when c_mktsegment = 'MACHINERY' then 'UNKNOWN' else c_mktsegment end",
            distinct=True,
        ),
        _concept(
            "orders", "5000000 + cast(substring(o_orderpriority, 1, 1) as int)", "o_orderpriority",
            "'Visit'", "'Visit'", "o_orderpriority", distinct=True,
        ),
        _concept("nation", "6000000 + n_nationkey", "n_name", "'Provider'", "'Specialty'", "n_name"),
        _concept(
            "fixed(i, n, d, c)", "i", "n", "d", "d", "c",
            rows=(
                "(32817, 'EHR', 'Type Concept', 'OMOP-EHR')",
                "(8507, 'MALE', 'Gender', 'M')",
                "(8532, 'FEMALE', 'Gender', 'F')",
                "(38003563, 'Hispanic or Latino', 'Ethnicity', 'Hispanic')",
                "(38003564, 'Not Hispanic or Latino', 'Ethnicity', 'Not Hispanic')",
            ),
        ),
        *new,
    )


def _edge(id_1: str, id_2: str, kind: str, bad: str = "cast(null as string)", distinct=False) -> Part:
    return Part(
        "part",
        {
            "concept_id_1": f"cast({id_1} as int)",
            "concept_id_2": f"cast({id_2} as int)",
            "relationship_id": kind,
            "valid_start_date": "'19700101'",
            "valid_end_date": "'20991231'",
            "invalid_reason": bad,
        },
        distinct,
    )


def concept_relationship(after: bool = False) -> tuple[Part, ...]:
    lost = "p_partkey % 37 = 0" if after else "p_partkey % 19 = 0"
    gone = f"{_BRAND} % 13 = 12" + (f" or {_BRAND} % 10 = 4" if after else "")
    return (
        _edge(
            _SRC, f"2000000 + {_BRAND}", f"case when {lost} then 'Is a' else 'Maps to' end",
            "case when p_partkey % 29 = 0 then 'D' end",
        ),
        _edge(
            _SRC, "3000000 + p_size",
            f"case when p_partkey % 5 = 0 and not ({lost}) then 'Maps to' else 'Subsumes' end",
        ),
        _edge(_SRC, "3500000 + p_size", "'Maps to unit'"),
        _edge(
            _SRC, "3700000 + p_size",
            "case when p_partkey % 4 = 0 then 'Maps to value' else 'Has answer' end",
        ),
        _edge(
            f"2000000 + {_BRAND}", "2000001",
            f"case when {gone} then 'Concept replaced by' else 'Concept same_as to' end",
            distinct=True,
        ),
    )


def _map(base: str, code: str, vocabulary: str, text: str, target: str, distinct=False, rows=()) -> Part:
    return Part(
        base,
        {
            "source_code": code,
            "source_concept_id": "0",
            "source_vocabulary_id": vocabulary,
            "source_code_description": text,
            "target_concept_id": f"cast({target} as int)",
            "target_vocabulary_id": vocabulary,
            "valid_start_date": "cast('1970-01-01' as date)",
            "valid_end_date": "cast('2099-12-31' as date)",
            "invalid_reason": "cast(null as string)",
        },
        distinct,
        rows,
    )


# One race points nowhere, one at the wrong concept, one is missing.
SOURCE_TO_CONCEPT_MAP = (
    _map(
        "customer",
        "case when c_mktsegment = 'MACHINERY' then 'UNKNOWN' else c_mktsegment end",
        "'Race'", "c_mktsegment",
        "case when c_mktsegment = 'BUILDING' then 4999999 when c_mktsegment = 'FURNITURE' "
        "then 4000065 else 4000000 + ascii(c_mktsegment) end",
        distinct=True,
    ),
    _map(
        "orders",
        "case when o_orderpriority = '5-LOW' then 'UNKNOWN' else o_orderpriority end",
        "'Visit'", "o_orderpriority",
        "5000000 + cast(substring(o_orderpriority, 1, 1) as int)", distinct=True,
    ),
    _map("part", "'L' || cast(p_partkey as string)", "'Local'", "p_name", f"2000000 + {_BRAND}"),
    _map(
        "fixed(c, n, i)", "c", "'Ethnicity'", "n", "i",
        rows=("('H', 'Hispanic', 38003563)", "('NH', 'Not Hispanic', 38003564)"),
    ),
)

# Seed rows as a hand-written file holds them: all text, some of it wrong.
SEED_MAP = Part(
    "part",
    {
        "source_code": "case when p_partkey % 3 = 0 then 'N' else 'L' end || cast(p_partkey as string)",
        "source_concept_id": "'0'",
        "source_vocabulary_id": "'Local'",
        "source_code_description": "p_type",
        "target_concept_id": "case when p_partkey % 11 = 0 then 'tbd' "
        "else cast(3000000 + p_size as string) end",
        "target_vocabulary_id": "'STD'",
        "valid_start_date": "case when p_partkey % 8 = 0 then '2020-13-45' else '20200229' end",
        "valid_end_date": "'20991231'",
        "invalid_reason": "case when p_partkey % 7 = 0 then 'D' when p_partkey % 2 = 0 then '' end",
    },
)
CONCEPT_CPT4 = _concept(
    "part", "case when p_partkey % 3 = 0 then 10000000 else 30000000 end + p_partkey",
    "'licensed ' || p_name", "'Procedure'", "'CPT4'", "'C' || cast(p_partkey as string)",
)

# Chains of up to five replacements, a cycle of three, and a chain that leads into the cycle.
REPLACEMENT_EDGES = _edge(
    "p_partkey",
    "case when p_partkey % 60 = 33 then p_partkey - 2 when p_partkey % 60 = 29 then p_partkey + 2 else p_partkey + 1 end",
    "case when p_partkey % 6 = 0 then 'Is a' else 'Concept replaced by' end",
    "case when p_partkey % 47 = 0 then 'D' end",
)

# Ingredients (one of them no longer standard, one invalid) and a drug class above them.
_STD = f"2000000 + {_BRAND}"
INGREDIENT_CONCEPT = _concept(
    "part", "8000000 + p_size % 8", "'ingredient ' || cast(p_size % 8 as string)", "'Drug'", "'RxNorm'",
    "'I' || cast(p_size % 8 as string)", kind="case when p_size % 8 = 7 then 'Drug Class' else 'Ingredient' end",
    standard="case when p_size % 8 <> 6 then 'S' end", invalid="case when p_size % 8 = 5 then 'D' end", distinct=True,
)


def _above(ancestor: str, descendant: str, levels: int) -> Part:
    columns = {
        "ancestor_concept_id": f"cast({ancestor} as int)",
        "descendant_concept_id": f"cast({descendant} as int)",
        "min_levels_of_separation": f"{levels}",
        "max_levels_of_separation": f"{levels}",
    }
    return Part("part", columns, distinct=True)


# Brands have one ingredient, every third of them two; some only ones that do not count, all are in the class.
CONCEPT_ANCESTOR = (
    _above(f"case when {_BRAND} = 52 then 8000005 else 8000000 + {_BRAND} % 2 end", _STD, 2),
    _above(f"case when {_BRAND} % 3 = 1 and {_BRAND} <> 52 then 8000002 else 8000006 end", _STD, 3),
    _above("8000007", _STD, 4),
    _above("8000000 + p_size % 8", "8000000 + p_size % 8", 0),
)


def _strength(ingredient: str, where: str, amount="null", unit="8576", numerator="null", below="null", below_unit="8587", invalid="cast(null as string)") -> Part:
    return Part(
        "part",
        {
            "drug_concept_id": f"cast(case when {where} then {_STD} end as int)",
            "ingredient_concept_id": f"cast({ingredient} as int)",
            "amount_value": f"cast({amount} as double)",
            "amount_unit_concept_id": f"cast({unit} as int)",
            "numerator_value": f"cast({numerator} as double)",
            "numerator_unit_concept_id": f"cast({unit} as int)",
            "denominator_value": f"cast({below} as double)",
            "denominator_unit_concept_id": f"cast({below_unit} as int)",
            "box_size": "cast(null as int)",
            "valid_start_date": "'19700101'",
            "valid_end_date": "'20991231'",
            "invalid_reason": invalid,
        },
        distinct=True,
    )


# Amounts, concentrations and hourly releases; also second and outdated strengths of the same pair.
DRUG_STRENGTH = (
    _strength(f"8000000 + {_BRAND} % 2", f"{_BRAND} not in (32, 52)", amount=f"{_BRAND} * 5"),
    _strength("8000000", f"{_BRAND} = 32", numerator="10", below="4"),
    _strength("8000002", f"{_BRAND} % 3 = 1", numerator="25", unit="9655", below="2", below_unit="8505"),
    _strength("8000002", f"{_BRAND} % 3 = 1", numerator="99", unit="9655", below_unit="8505"),
    _strength("8000002", f"{_BRAND} % 3 = 1", amount="1", unit="1", invalid="'D'"),
)

FIXTURES: dict[str, tuple[Part, ...]] = {
    "patient": (PATIENT,),
    "patient_identifier": (PATIENT_IDENTIFIER,),
    "encounter": (ENCOUNTER,),
    "encounter_diagnosis": (ENCOUNTER_DIAGNOSIS,),
    "procedure_order": (PROCEDURE_ORDER,),
    "medication_order": (MEDICATION_ORDER,),
    "clinical_measurement": (CLINICAL_MEASUREMENT,),
    "facility": (FACILITY,),
    "clinician": (CLINICIAN,),
    "formulary": (FORMULARY,),
    "concept": concept(),
    "concept_after": concept(after=True),
    "concept_relationship": concept_relationship(),
    "concept_relationship_after": concept_relationship(after=True),
    "replacement_edges": (REPLACEMENT_EDGES,),
    "ingredient_concept": (INGREDIENT_CONCEPT,),
    "concept_ancestor": CONCEPT_ANCESTOR,
    "drug_strength": DRUG_STRENGTH,
    "source_to_concept_map": SOURCE_TO_CONCEPT_MAP,
    "seed_map": (SEED_MAP,),
    "concept_cpt4": (CONCEPT_CPT4,),
}


def fixture_sql(name: str) -> str:
    """The fixture as one SELECT over the test tables."""
    return " union all ".join(p.sql() for p in FIXTURES[name])


# The vocabulary is loaded once and then read by every lookup, as in production.
LOADED = {
    "concept": "concept",
    "concept_after": "concept",
    "concept_relationship": "concept_relationship",
    "concept_relationship_after": "concept_relationship",
    "source_to_concept_map": "source_to_concept_map",
}
_STORED: dict[tuple[str, str, str], DataFrame] = {}
_PATHS: dict[tuple[str, str, str], str] = {}


# A file up to this size may be one row group, and so one task; larger ones are read by many tasks as they are.
SMALL_FILE = 32 * 1024 * 1024


def _balanced(df: DataFrame) -> DataFrame:
    """A small table over all cores; a large one is not moved."""
    if sum(file_bytes(df.sparkSession, f) for f in df.inputFiles()) > SMALL_FILE:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


class Data:
    """The fixtures of one data folder: bronze tables lazily, vocabulary tables as stored files."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def fact(self, name: str) -> DataFrame:
        return _balanced(self[name])

    def stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """What ``make`` gives, written out once per session and folder."""
        at = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if at not in _STORED:
            _STORED[at] = make()
        return _STORED[at]

    def derive(self, name: str) -> DataFrame:
        out = None
        for part in FIXTURES[name]:
            one = part.frame(self)
            out = one if out is None else out.unionByName(one)
        return out

    def __getitem__(self, name: str) -> DataFrame:
        if name not in LOADED:
            return self.derive(name)

        def load() -> DataFrame:
            table = LOADED[name]
            folder = scratch_path(self.spark, f"vocabulary-{name}")
            _PATHS[self.spark.sparkContext.applicationId, self.sf_dir, name] = f"{folder}/{table}"
            return store_vocabulary({table: self.derive(name)}, folder)[table]

        return self.stored(name, load)

    def _vocabulary(self, suffix: str) -> Vocabulary:
        names = (f"concept{suffix}", f"concept_relationship{suffix}", "source_to_concept_map")
        frames = [self[n] for n in names]
        here = (self.spark.sparkContext.applicationId, self.sf_dir)
        paths = {LOADED[n]: _PATHS[*here, n] for n in names}
        return Vocabulary(*frames, sizes=stored_sizes(self.spark, paths))

    @cached_property
    def vocab(self) -> Vocabulary:
        return self._vocabulary("")

    @cached_property
    def vocab_after(self) -> Vocabulary:
        return self._vocabulary("_after")
