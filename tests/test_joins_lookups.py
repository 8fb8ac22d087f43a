import re
import uuid
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdmloom.model.spec import BY_CONCEPT, BY_MAP, BY_RELATIONSHIP, ColumnMap, Join, Lookup
from cdmloom.model.vocabulary import Vocabulary
from cdmloom.operators.durable import scratch_path
from cdmloom.operators.joins import join_sources
from cdmloom.operators.lookups import MAPPING_ROW, apply_lookups, lookup_targets, mapping_bytes, write_crosswalk
from cdmloom.operators.projection import append_lookup_targets, map_columns
from cdmloom.operators.replacements import replacement_closure, with_final_replacements
from cdmloom.operators.spread import (
    TASK_BYTES,
    attach,
    configure,
    fits_broadcast,
    hot_keys,
    measured_bytes,
    spread_join,
)
from cdmloom.plans import tables
from cdmloom.plans.build import build_table
from cdmloom.sources.vocabulary_files import store_vocabulary, stored_vocabulary
from tests.conftest import rows


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [(1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, "E"), (6, "nope"), (7, None)], "id INT, code STRING"
    )


MAPPED = Lookup("f", "code", "std", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Condition")
EITHER_WAY = pytest.mark.parametrize("limit", [0, 1 << 20])


def ids(df, *columns):
    return rows(df.select("id", *columns))


@EITHER_WAY
def test_mapped_lookup_fans_out_and_keeps_all_rows(facts, vocab, limit):
    out = apply_lookups(facts.alias("f"), [MAPPED], vocab, limit, fraction=1.0)
    assert ids(out, "std") == [
        (1, 101), (2, 101), (2, 102), (3, 0), (4, 0), (5, 0), (6, 0), (7, 0),
    ]


def test_mapped_lookup_other_domain_and_any_standard(facts, vocab):
    other = Lookup(
        "f", "code", "std", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Observation", fallback=-5
    )
    loose = Lookup(
        "f", "code", "any", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Condition",
        standard_only=False,
    )
    out = apply_lookups(facts.alias("f"), [other], vocab)
    assert [r for r in ids(out, "std") if r[1] != -5] == [(2, 103)]
    out = apply_lookups(facts.alias("f"), [loose], vocab)
    assert (4, 104) in ids(out, "any")


def test_replacement_lookup(spark, vocab):
    old = spark.createDataFrame([(1, "U1"), (2, "A")], "id INT, code STRING")
    lookup = Lookup(
        "f", "code", "new", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Condition",
        relationship_id="Concept replaced by", source_invalid_reason="U",
    )
    assert ids(apply_lookups(old.alias("f"), [lookup], vocab), "new") == [(1, 102), (2, 0)]


def test_concept_lookup_respects_standard_flag(facts, vocab):
    strict = Lookup("f", "code", "c", BY_CONCEPT, vocabulary_id="LOC", domain_id="Condition")
    loose = Lookup(
        "f", "code", "c", BY_CONCEPT, vocabulary_id="LOC", domain_id="Condition", standard_only=False
    )
    assert {r[1] for r in ids(apply_lookups(facts.alias("f"), [strict], vocab), "c")} == {0}
    found = ids(apply_lookups(facts.alias("f"), [loose], vocab), "c")
    assert found == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 0), (6, 0), (7, 0)]


def test_map_lookup_drops_stale_targets_but_ignores_its_own_flag(spark, vocab):
    people = spark.createDataFrame(
        [(1, "w"), (2, "stale"), (3, "dead"), (4, "marked"), (5, "?")], "id INT, code STRING"
    )
    race = Lookup("f", "code", "race", BY_MAP, source_vocabulary_id="Race", fallback=9)
    assert ids(apply_lookups(people.alias("f"), [race], vocab), "race") == [
        (1, 101), (2, 9), (3, 9), (4, 102), (5, 9),
    ]


@EITHER_WAY
def test_chain_multiplies_fanouts(facts, vocab, limit):
    again = Lookup("f", "code", "std2", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Condition")
    source = Lookup(
        "f", "code", "src", BY_CONCEPT, vocabulary_id="LOC", domain_id="Condition", standard_only=False
    )
    out = apply_lookups(facts.alias("f"), [MAPPED, source, again], vocab, limit, fraction=1.0)
    b = [r[1:] for r in ids(out, "std", "src", "std2") if r[0] == 2]
    assert b == [(101, 2, 101), (101, 2, 102), (102, 2, 101), (102, 2, 102)]
    assert out.columns == ["id", "code", "std", "src", "std2"]


def test_numeric_source_codes_meet_text_codes(spark, vocab):
    coded = spark.createDataFrame([(1, 7)], "id INT, code INT")
    assert ids(apply_lookups(coded.alias("f"), [MAPPED], vocab), "std") == [(1, 0)]


def test_crosswalk_gives_the_same(spark, facts, vocab):
    prepared = write_crosswalk(vocab, scratch_path(spark, "crosswalk"))
    plain = apply_lookups(facts.alias("f"), [MAPPED], vocab)
    quick = apply_lookups(facts.alias("f"), [MAPPED], Vocabulary(vocab.concept, crosswalk=prepared))
    assert ids(plain, "std") == ids(quick, "std")
    # A relationship the crosswalk does not hold is read from the tables.
    both = Vocabulary(vocab.concept, vocab.concept_relationship, crosswalk=prepared.limit(0))
    other = Lookup(
        "f", "code", "std", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Observation",
        relationship_id="Is a",
    )
    assert (1, 103) in ids(apply_lookups(facts.alias("f"), [other], both), "std")
    assert {r[1] for r in ids(apply_lookups(facts.alias("f"), [MAPPED], both), "std")} == {0}


def test_projection_appends_targets_in_lookup_order(facts, vocab):
    source = Lookup(
        "f", "code", "src", BY_CONCEPT, vocabulary_id="LOC", domain_id="Condition", standard_only=False
    )
    columns = (ColumnMap("key", "concat_ws('|', f.id, std)"), ColumnMap("src", "src + 1"))
    out = map_columns(
        apply_lookups(facts.alias("f"), [MAPPED, source], vocab),
        append_lookup_targets(columns, [MAPPED, source]),
    )
    assert out.columns == ["key", "src", "std"]
    assert ("2|102", 3, 102) in rows(out)
    assert map_columns(facts, []) is facts


# Source joins


@pytest.fixture(scope="module")
def frames(spark):
    return {
        "a": spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k INT, v STRING"),
        "b": spark.createDataFrame([(1, 10), (1, 11), (3, 30)], "k INT, w INT"),
        "c": spark.createDataFrame([(10, "t")], "w INT, t STRING"),
    }


@pytest.mark.parametrize(
    ("how", "n"),
    [("inner", 2), ("left", 4), ("LEFT_OUTER", 4), ("right", 3), ("right_outer", 3),
     ("full", 5), ("full_outer", 5), ("outer", 5)],
)
@pytest.mark.parametrize("by_keys", [False, True])
def test_join_types(frames, how, n, by_keys):
    given = {"keys": (("a.k", "b.k"),)} if by_keys else {"condition": "a.k = b.k"}
    join = Join("a", "b", type=how, **given)
    both = {k: frames[k] for k in "ab"}
    assert join_sources(both, [join]).count() == n
    assert join_sources(both, [join], broadcast_bytes=0, fraction=1.0).count() == n


def test_cross_and_theta_joins(frames):
    both = {k: frames[k] for k in "ab"}
    assert join_sources(both, [Join("a", "b", type="cross")]).count() == 9
    assert join_sources(both, [Join("a", "b", type="cross")], broadcast_bytes=0).count() == 9
    with pytest.raises(ValueError):
        join_sources(both, [Join("a", "b")])
    theta = join_sources(both, [Join("a", "b", "a.k < b.k")])
    assert rows(theta.selectExpr("a.k", "b.k")) == [(1, 3), (2, 3)]


def test_left_fold_uses_later_right_aliases(frames):
    out = join_sources(
        frames, [Join("a", "b", "a.k = b.k", "left"), Join("b", "c", "b.w = c.w", "left")]
    )
    assert rows(out.selectExpr("a.v", "b.w", "c.t")) == [
        ("x", 10, "t"), ("x", 11, None), ("y", None, None), ("z", None, None),
    ]


def test_join_errors(frames):
    with pytest.raises(ValueError):
        join_sources(frames)
    with pytest.raises(KeyError):
        join_sources(frames, [Join("a", "zzz", "true")])
    with pytest.raises(ValueError):
        join_sources(frames, [Join("a", "b", "true", "sideways")])


def test_single_source_keeps_its_alias(frames):
    assert join_sources({"a": frames["a"]}).selectExpr("a.k").count() == 3


# Spread joins against the plain join


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(st.sampled_from(["hot", "hot", "a", "b", None]), st.integers(0, 3)), max_size=30),
    right=st.lists(st.tuples(st.sampled_from(["hot", "a", "c", None]), st.integers(0, 3)), max_size=12),
    how=st.sampled_from(["inner", "left"]),
)
def test_spread_join_equals_plain_join(spark, left, right, how):
    le = spark.createDataFrame(left, "k STRING, v INT").repartition(4)
    ri = spark.createDataFrame(right, "q STRING, w INT")
    plain = le.join(ri, F.col("k") == F.col("q"), how)
    pairs = [(F.col("k"), F.col("q"))]
    assert rows(spread_join(le, ri, pairs, how, fraction=1.0)) == rows(plain)
    assert rows(attach(le, ri, pairs, how)) == rows(plain)


def test_hot_key_is_found_and_spread(spark):
    many = spark.range(4000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id")
    many = many.repartition(16)
    assert len(hot_keys(many, [F.col("k")], 0.5)) <= 64
    one = spark.createDataFrame([("hot", 1), ("1", 2)], "q STRING, w INT")
    out = spread_join(many, one, [(F.col("k"), F.col("q"))], "left", fraction=1.0)
    assert out.count() == 4000
    assert out.filter("w = 1").count() == 1334
    # Rows of the hot key carry several salts, so several tasks share them.
    hot = hot_keys(many, [F.col("k")], 1.0)
    assert many.select(F.xxhash64(F.lit("hot")).isin(hot)).first()[0]


def test_spread_refuses_outer_joins(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        spread_join(df, df, [(F.col("id"), F.col("id"))], "outer")


def test_measured_bytes_counts_text(spark):
    small = spark.createDataFrame([("ab", 1)], "s STRING, n INT")
    assert measured_bytes(small) == 16 + 16 + 2
    assert measured_bytes(small.limit(0)) == 0
    assert fits_broadcast(small, 34) and fits_broadcast(small, 34, rows_first=True)
    assert not fits_broadcast(small, 33) and not fits_broadcast(small, 31, rows_first=True)
    assert not fits_broadcast(small, 0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(st.sampled_from(["hot", "hot", "a", "b", None]), st.integers(0, 3)), max_size=20),
    right=st.lists(st.tuples(st.sampled_from(["hot", "a", "c", None]), st.integers(0, 3)), max_size=8),
    how=st.sampled_from(["right", "full"]),
    limit=st.sampled_from([0, 1 << 20]),
)
def test_right_and_full_joins_by_keys_equal_plain_joins(spark, left, right, how, limit):
    frames = {
        "f": spark.createDataFrame(left, "k STRING, v INT").alias("f"),
        "d": spark.createDataFrame(right, "k STRING, w INT").alias("d"),
    }
    plain = join_sources(frames, [Join("f", "d", "f.k = d.k", how)])
    keyed = join_sources(frames, [Join("f", "d", type=how, keys=(("f.k", "d.k"),))], limit, 1.0)
    columns = ["f.k", "f.v", "d.k", "d.w"]
    assert rows(keyed.select(*columns)) == rows(plain.select(*columns))


SHUFFLED = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def shuffled(spark):
    """A session that joins by shuffles, as it would beyond the size for broadcasts."""
    before = {name: spark.conf.get(name, None) for name in SHUFFLED}
    for name, value in SHUFFLED.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_a_clustered_hot_key_is_shared_by_many_tasks(shuffled, how):
    facts = shuffled.range(0, 3000, 1, 1).selectExpr("if(id >= 0, 'hot', string(id)) as k", "id as v")
    side = shuffled.createDataFrame([("hot", 1), ("cold", 2)], "k STRING, w INT")
    frames = {"f": facts.alias("f"), "d": side.alias("d")}
    out = join_sources(frames, [Join("f", "d", type=how, keys=(("f.k", "d.k"),))], 0, 1.0)
    placed = out.filter("v is not null").select(F.spark_partition_id().alias("task"), "v").collect()
    assert sorted(r["v"] for r in placed) == list(range(3000))
    assert len({r["task"] for r in placed}) > 2


# Planning


class Jobs:
    """Jobs that Spark starts while the block runs."""

    def __init__(self, spark):
        self.sc = spark.sparkContext

    def __enter__(self):
        self.group = uuid.uuid4().hex
        self.sc.setJobGroup(self.group, "counted")
        return self

    def __exit__(self, *_):
        self.count = len(self.sc.statusTracker().getJobIdsForGroup(self.group))
        self.sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="module")
def stored(spark, vocab, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("vocabulary"))
    store_vocabulary({"concept": vocab.concept, "concept_relationship": vocab.concept_relationship, "source_to_concept_map": vocab.source_to_concept_map}, folder)
    return stored_vocabulary(spark, folder)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_job_runs_while_a_table_is_planned(spark, stored):
    spec = tables.measurement(tables.Style(vocabulary_id="LOC"))
    ms = spark.createDataFrame([(1, 1, 1, "A", "1.5", None)], "measurement_id INT, encounter_id INT, patient_id INT, measurement_name STRING, measurement_value STRING, measurement_datetime TIMESTAMP")
    enc = spark.createDataFrame([(1, 5, None, None, "x", 1)], "encounter_id INT, patient_id INT, admit_datetime TIMESTAMP, discharge_date DATE, encounter_type STRING, provider_id INT")
    for known in (stored, replace(stored, sizes={})):
        with Jobs(spark) as jobs:
            out = build_table(spec, {"ms": ms, "enc": enc}, known)
        assert jobs.count == 0
        assert out.count() == 1


def test_sizes_bound_the_mapping(stored):
    source = Lookup("f", "code", "s", BY_CONCEPT, vocabulary_id="LOC", domain_id="Condition")
    race = Lookup("f", "code", "r", source_vocabulary_id="Race")
    row = MAPPING_ROW
    assert mapping_bytes(stored, [source]) == 7 * (row + 2)
    assert mapping_bytes(stored, [race]) == 4 * (row + 6)
    assert mapping_bytes(stored, [MAPPED]) == 9 * (row + 2)
    assert mapping_bytes(stored, [source, race]) == 7 * (row + 2) + 4 * (row + 6)
    assert mapping_bytes(replace(stored, sizes={}), [source]) is None
    assert mapping_bytes(stored, [Lookup("f", "code", "s", BY_CONCEPT, vocabulary_id="none", domain_id="x")]) == 0


def test_a_mapping_of_known_size_is_broadcast_and_facts_are_read_once(spark, stored, tmp_path):
    spark.createDataFrame([("A", "w"), ("B", None), ("zz", "stale")], "code STRING, race STRING").write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts").alias("f")
    race = Lookup("f", "race", "race_id", source_vocabulary_id="Race")
    scans = {}
    for name, known in (("sizes", stored), ("codes", replace(stored, sizes={}))):
        out = apply_lookups(facts, [MAPPED, race], known)
        assert sorted(map(tuple, out.select("code", MAPPED.target_column, "race_id").collect())) == [("A", 101, 101), ("B", 101, 0), ("B", 102, 0), ("zz", 0, 0)]
        out.collect()
        plan = _plan(out).split("Initial Plan")[0]
        scans[name] = len(re.findall(r"Scan parquet[^\n]*race", plan))
        if name == "sizes":
            assert "SortMergeJoin" not in plan.split("BroadcastExchange")[0]
    assert scans == {"sizes": 1, "codes": 2}


def test_codes_first_looks_up_no_other_code(spark, vocab):
    facts = spark.createDataFrame([("A",), ("A",), ("zz",), (None,)], "code STRING").alias("f")
    codes = facts.select(F.concat(F.lit("0:"), "code").alias("__code")).where("__code is not null").distinct()
    found = lookup_targets(vocab, MAPPED, (codes, 0))
    assert {r["code"] for r in found.collect()} == {"A"}
    assert rows(apply_lookups(facts, [MAPPED], vocab)) == rows(apply_lookups(facts, [MAPPED], vocab, broadcast_bytes=1 << 20))


# Replacements


def test_replacements_are_followed_to_their_end(spark, vocab):
    pairs = [(i, i + 1) for i in range(1, 6)] + [(20, 21), (21, 22), (22, 20), (19, 20), (30, 30), (40, 42), (40, 41), (42, 43)]
    edges = spark.createDataFrame([(a, b, "Concept replaced by", None) for a, b in pairs] + [(6, 7, "Concept replaced by", "D")], vocab.concept_relationship.schema)
    got = {r["concept_id"]: tuple(r)[1:] for r in replacement_closure(edges).collect()}
    assert got == {
        **{i: (6, 6 - i, False) for i in range(1, 6)}, **{i: (None, None, True) for i in (19, 20, 21, 22, 30)}, 40: (41, 1, False), 42: (43, 1, False),
    }
    assert replacement_closure(edges.limit(0)).count() == 0


def test_a_lookup_takes_the_end_of_a_chain(spark, vocab):
    more = spark.createDataFrame([(7, 5, "Concept replaced by", None), (5, 103, "Concept replaced by", None)], vocab.concept_relationship.schema)
    rest = vocab.concept_relationship.where("concept_id_1 <> 7")
    chained = with_final_replacements(replace(vocab, concept_relationship=rest.unionByName(more)))
    lookup = Lookup(
        "f", "code", "new_id", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Observation",
        relationship_id="Concept replaced by", source_invalid_reason="U",
    )
    facts = spark.createDataFrame([("U1",), ("A",)], "code STRING").alias("f")
    assert rows(apply_lookups(facts, [lookup], chained)) == [("A", 0), ("U1", 103)]


def test_sizes_of_tasks_are_bounded_and_smaller_ones_stay(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for given, expected in (("64MB", None), ("1g", None), ("134217728b", None), ("100k", "100k"), ("8m", "8m")):
            for name in names:
                spark.conf.set(name, given)
            configure(spark)
            assert [spark.conf.get(n) for n in names] == [expected or str(TASK_BYTES[n]) for n in names]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
