import pytest
from pyspark.sql import functions as F

from cdmloom.model.spec import CodeColumn, ColumnMap, Source, TableSpec
from cdmloom.operators import codes, coverage, drafting
from cdmloom.operators.refresh import regressed_codes, vocabulary_diff
from tests.conftest import rows

REQUESTS = [
    codes.CodeRequest("condition_occurrence", "f", "code", "LOC", "facts"),
    codes.CodeRequest("observation", "g", "code", "LOC", "facts"),
    codes.CodeRequest("condition_occurrence", "f", "extra", "STD", "facts"),
]


@pytest.fixture(scope="module")
def tables(spark):
    data = [("A", "X"), ("A", "X"), ("B", "W"), ("C", None), ("D", "Q"), ("E", "V"), ("S1", "X"),
            ("a-", "X"), (None, "X")]
    return {"facts": spark.createDataFrame(data, "code STRING, extra STRING")}


@pytest.fixture(scope="module")
def found(tables):
    return codes.distinct_codes(tables, REQUESTS)


@pytest.fixture(scope="module")
def classified(found, vocab):
    return drafting.classify_codes(
        codes.codes_by_vocabulary(found), vocab.concept, vocab.concept_relationship
    )


def test_requests_come_from_the_specs():
    spec = TableSpec(
        "t", (Source("f", "{bronze}.facts"),), (ColumnMap("x", "1"),),
        source_vocabulary=(CodeColumn("f", "code", "LOC"),),
    )
    plain = TableSpec("u", (Source("f", "facts"),), (ColumnMap("x", "1"),))
    assert codes.mapping_requests([spec, plain, spec]) == [
        codes.CodeRequest("t", "f", "code", "LOC", "{bronze}.facts")
    ]


def test_codes_are_distinct_per_column_and_per_vocabulary(found):
    per_column = found.groupBy("table_name", "source_column").count()
    assert rows(per_column) == [
        ("condition_occurrence", "code", 7), ("condition_occurrence", "extra", 4),
        ("observation", "code", 7),
    ]
    assert codes.codes_by_vocabulary(found).count() == 11


def test_buckets(classified):
    got = {(r["vocabulary_id"], r["source_code"]): r["bucket"] for r in classified.collect()}
    assert got == {
        # A has one valid edge to a standard concept and one to an invalid standard concept:
        # validity of the target is not asked here, so two standard targets are ambiguous.
        ("LOC", "A"): drafting.AMBIGUOUS,
        ("LOC", "B"): drafting.AMBIGUOUS,
        ("LOC", "C"): drafting.NO_MAPS_TO,
        ("LOC", "D"): drafting.AMBIGUOUS,
        ("LOC", "E"): drafting.VIA_MAPS_TO,
        ("LOC", "S1"): drafting.DIRECT,
        ("LOC", "a-"): drafting.NO_CONCEPT,
        ("STD", "X"): drafting.DIRECT,
        ("STD", "W"): drafting.NO_MAPS_TO,
        ("STD", "Q"): drafting.NO_CONCEPT,
        ("STD", "V"): drafting.DIRECT,
    }


def test_draft_has_one_row_per_code_and_zero_for_unresolved(classified):
    draft = drafting.draft_concept_map(classified)
    assert draft.count() == draft.select("source_code", "source_vocabulary_id").distinct().count()
    by_code = {(r["source_vocabulary_id"], r["source_code"]): r for r in draft.collect()}
    several = by_code["LOC", "B"]
    assert several["target_concept_id"] == 0 and several["target_vocabulary_id"] == ""
    assert several["source_concept_id"] == 2
    assert "multiple 'Maps to' standard targets (3); chose lowest" in several["source_code_description"]
    assert "non-standard (possible multi-hop)" in by_code["LOC", "D"]["source_code_description"]
    assert by_code["LOC", "C"]["source_code_description"].startswith("c - non-standard with no")
    assert by_code["LOC", "a-"]["source_concept_id"] == 0
    mapped = by_code["LOC", "E"]
    assert (mapped["target_concept_id"], mapped["target_vocabulary_id"]) == (101, "STD")
    assert by_code["LOC", "S1"]["target_concept_id"] == 6


def test_lowest_concept_wins_for_a_repeated_code(spark, vocab):
    twin = vocab.concept.filter("concept_id = 6").withColumn("concept_id", F.lit(600))
    wanted = spark.createDataFrame([("LOC", "S1")], "vocabulary_id STRING, source_code STRING")
    hit = codes.lookup_concept_by_code(wanted, vocab.concept.unionByName(twin))
    assert [r["concept_id"] for r in hit.collect()] == [6]


def test_single_vocabulary_takes_any_concept(tables, vocab):
    draft = drafting.draft_single_vocabulary(
        codes.code_values(tables["facts"], "code"), vocab.concept, "LOC"
    )
    got = {r["source_code"]: (r["target_concept_id"], r["source_code_description"]) for r in draft.collect()}
    assert got["A"] == (1, "")
    assert got["a-"] == (0, drafting.TEXT_SINGLE_VOCABULARY)


def test_coverage_adds_up(found, classified):
    per_vocabulary = coverage.coverage_by_vocabulary(classified)
    for r in per_vocabulary.collect():
        assert r["total"] == sum(r[b] for b in drafting.BUCKETS) == r["resolved"] + r["unresolved"]
    got = {r["vocabulary_id"]: r["resolution_pct"] for r in per_vocabulary.collect()}
    assert got == {"LOC": "28.6%", "STD": "50.0%"}
    per_column = coverage.coverage_by_column(found, classified).collect()
    assert [(r["table_name"], r["distinct_codes"], r["resolved"]) for r in per_column] == [
        ("condition_occurrence", 7, 2), ("condition_occurrence", 4, 2), ("observation", 7, 2),
    ]
    overview = coverage.coverage_overview(classified, 3).first()
    assert (overview["vocabularies"], overview["total"], overview["resolved"]) == (2, 11, 4)


def test_empty_coverage_has_no_percentage(classified):
    assert coverage.coverage_overview(classified.limit(0), 0).first()["resolution_pct"] == "n/a"


def test_sample_is_first_codes_in_order(classified):
    got = rows(coverage.sample_unmapped(classified, 2))
    assert got == [("LOC", "A", 1), ("LOC", "B", 2), ("STD", "Q", 1), ("STD", "W", 2)]


def test_format_mismatch_ignores_case_and_punctuation(classified, vocab):
    assert rows(coverage.format_mismatch(classified, vocab.concept)) == [("LOC", "a-", "A", 1)]


def test_stale_targets(vocab):
    got = rows(coverage.stale_map_targets(vocab.source_to_concept_map, vocab.concept))
    assert got == [("Race", "dead", 105), ("Race", "stale", 555)]


def test_refresh_reports(spark, vocab, found, classified):
    after = vocab.concept.withColumn(
        "invalid_reason", F.when(F.col("concept_id") == 101, "U").otherwise(F.col("invalid_reason"))
    ).withColumn(
        "standard_concept", F.when(F.col("concept_id").isin(101, 6), None).otherwise(F.col("standard_concept"))
    )
    replaced = spark.createDataFrame(
        [(101, 102, "Concept replaced by", None)], vocab.concept_relationship.schema
    )
    edges = vocab.concept_relationship.filter("concept_id_1 <> 2").unionByName(replaced)
    changes = rows(vocabulary_diff(vocab.concept, after, vocab.concept_relationship, edges))
    assert changes == [
        ("de_standardised", 101, None), ("de_standardised", 6, None),
        ("removed_maps_to", 2, 101), ("removed_maps_to", 2, 102), ("removed_maps_to", 2, 103),
        ("upgraded", 101, None),
    ]
    now = drafting.classify_codes(codes.codes_by_vocabulary(found), after, edges)
    lost = rows(regressed_codes(classified, now, after, edges))
    assert lost == [
        ("LOC", "E", 101, drafting.AMBIGUOUS, "target_upgraded", 102),
        ("LOC", "S1", 6, drafting.NO_MAPS_TO, "target_de_standardised", None),
        ("STD", "X", 101, drafting.NO_MAPS_TO, "target_upgraded", 102),
    ]
