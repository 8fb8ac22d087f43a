import pytest

from cdmloom.model.cdm import CDM, struct_type
from cdmloom.operators import conformance
from cdmloom.sources.tables import read_target
from tests.conftest import rows


@pytest.fixture(scope="module")
def death(spark, vocab):
    """Deaths with a repeated person, an unknown cause and a misplaced type concept."""
    data = [(1, None, None, 101, 777, None, 0), (1, None, None, None, None, None, None),
            (2, None, None, 0, 101, None, 778)]
    columns = [c.name for c in CDM["death"]]
    shape = ", ".join(
        f"{c.name} {c.type}" for c in CDM["death"]
    )
    assert columns[0] == "person_id"
    return spark.createDataFrame(data, shape)


def found(df):
    return {(r["layer"], r["check"]): (r["status"], r["message"]) for r in df.collect()}


def test_all_layers(spark, death, vocab):
    got = found(conformance.validate_table(spark, "death", death, vocab.concept))
    assert got == {
        (1, "schema"): ("PASS", conformance.MSG_SCHEMA_OK),
        (2, "pk_uniqueness:person_id"): (
            "FAIL", "duplicate PK groups (showing up to 20): [1, 2]"),
        (3, "concept_fk:cause_concept_id"): (
            "FAIL", "cause_concept_id: 1 rows with concept_id not in reference.concept"),
        (3, "concept_fk:cause_source_concept_id"): (
            "FAIL", "cause_source_concept_id: 1 rows with concept_id not in reference.concept"),
        (4, "domain:death_type_concept_id"): (
            "FAIL", "death_type_concept_id: 1 rows with domain_id <> Type Concept"),
        (5, "not_null:death_date"): ("FAIL", "death_date: 3 NULL rows (100.00% of 3)"),
    }


def test_schema_faults(spark, death):
    bad = death.drop("death_datetime").withColumnRenamed("cause_source_value", "why")
    bad = bad.selectExpr("cast(person_id as string) as PERSON_ID", "* except (person_id)")
    got = found(conformance.check_schema(spark, "death", bad))
    assert got == {
        (1, "schema:missing:cause_source_value"): ("FAIL", "missing column: cause_source_value"),
        (1, "schema:missing:death_datetime"): ("FAIL", "missing column: death_datetime"),
        (1, "schema:extra:why"): ("WARN", "extra column not in spec: why"),
        (1, "schema:type:person_id"): ("FAIL", "person_id: expected ~BIGINT, got string"),
    }


def test_missing_columns_are_skipped_later(spark, death, vocab):
    bad = death.drop("person_id", "cause_concept_id", "death_type_concept_id")
    got = found(conformance.validate_table(spark, "death", bad, vocab.concept))
    assert got[2, "pk_uniqueness:person_id"][0] == "SKIP"
    assert got[3, "concept_fk:cause_concept_id"][0] == "SKIP"
    assert got[4, "domain:death_type_concept_id"][0] == "SKIP"
    assert got[4, "domain"] == ("SKIP", conformance.MSG_DOMAIN_ALL_SKIPPED)
    assert got[5, "not_null:person_id"][0] == "SKIP"
    assert got[5, "not_null:death_date"][0] == "FAIL"


def test_some_skipped_is_said_in_the_pass(spark, vocab):
    empty = spark.createDataFrame([], struct_type("location")).drop("country_concept_id", "location_id")
    got = found(conformance.validate_table(spark, "location", empty, vocab.concept))
    assert got[5, "not_null"][1].endswith("(some skipped per Layer 1)")
    assert got[3, "concept_fk"] == ("SKIP", conformance.MSG_FK_ALL_SKIPPED)


def test_unbuilt_table(spark, vocab):
    got = found(conformance.validate_table(spark, "specimen", None, vocab.concept))
    assert got[1, "schema:table_missing"][0] == "FAIL"
    assert sum(1 for layer, _ in got if layer == 1) == 1 + len(CDM["specimen"])
    assert got[5, "not_null"] == ("SKIP", conformance.MSG_TABLE_SKIP)
    assert {s for (layer, _), (s, _) in got.items() if layer > 1} == {"SKIP"}


def test_table_of_other_columns_only(spark, vocab):
    odd = spark.createDataFrame([(1,)], "nothing_we_know INT")
    got = found(conformance.validate_table(spark, "death", odd, vocab.concept))
    assert got[5, "not_null"] == ("SKIP", conformance.MSG_TABLE_SKIP)
    assert got[1, "schema:extra:nothing_we_know"][0] == "WARN"
    assert (1, "schema:table_missing") not in got


def test_validate_all_covers_the_spec_in_order(spark, death, vocab):
    out = conformance.validate_all(spark, {"death": death}, vocab.concept)
    order = [(r["table_name"], r["layer"], r["check"]) for r in out.collect()]
    assert order == sorted(order)
    assert {t for t, _, _ in order} == set(CDM)


def test_summary_gate_and_counts(spark, death, vocab):
    out = conformance.validate_table(spark, "death", death, vocab.concept)
    assert rows(conformance.finding_counts(out)) == [("FAIL", 5), ("PASS", 1)]
    failed = {r["layer"]: r["layer_failed"] for r in conformance.layer_summary(out).collect()}
    assert failed == {1: False, 2: True, 3: True, 4: True, 5: True}
    with pytest.raises(RuntimeError, match="5 conformance checks failed"):
        conformance.gate_on_findings(out)
    passing = out.filter("status <> 'FAIL'")
    assert conformance.gate_on_findings(passing) is passing


def test_gate_stores_its_findings(spark, death, vocab, tmp_path):
    out = conformance.validate_table(spark, "death", death, vocab.concept)
    path = str(tmp_path / "findings")
    with pytest.raises(RuntimeError, match="5 conformance checks failed"):
        conformance.gate_on_findings(out, path)
    assert rows(read_target(spark, path)) == rows(out)
    passing = out.filter("status <> 'FAIL'")
    assert rows(conformance.gate_on_findings(passing, path)) == rows(passing) == rows(read_target(spark, path))


def test_extra_columns_warn_but_fail_the_layer(spark, death):
    from pyspark.sql import functions as F

    extra = conformance.check_schema(spark, "death", death.withColumn("more", F.lit(1)))
    row = conformance.layer_summary(extra).first()
    assert (row["failed"], row["warned"], row["layer_failed"]) == (0, 1, True)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_rows_with_unknown_concepts(death, vocab, limit):
    bad = conformance.anti_concept_fk(death, "cause_concept_id", vocab.concept, limit)
    assert [r["cause_concept_id"] for r in bad.collect()] == [777]
    assert bad.columns == death.columns


def test_references_between_tables(spark, death):
    person = spark.createDataFrame([(1,)], "person_id BIGINT")
    got = rows(conformance.check_table_fk(spark, {"death": death, "person": person}))
    assert got == [("death", "person_id", "person", 1, 1)]
    people = spark.createDataFrame([(1, 5), (2, None)], "person_id BIGINT, provider_id BIGINT")
    doctors = spark.createDataFrame([(5, None)], "provider_id BIGINT, care_site_id BIGINT")
    tables = {"death": death, "person": people, "provider": doctors}
    assert rows(conformance.check_table_fk(spark, tables)) == [
        ("death", "person_id", "person", 0, 0), ("person", "provider_id", "provider", 0, 0),
    ]
    assert conformance.check_table_fk(spark, {"person": people}).count() == 0


def test_standard_rate(death, vocab):
    got = rows(conformance.standard_rate(death, ["cause_concept_id"], vocab.concept))
    assert got == [("cause_concept_id", 2, 1, 0.5)]


def test_layer_counts_of_columns(spark, death, vocab):
    out = conformance.findings(spark, {"death": death, "specimen": None}, vocab.concept)
    counts = conformance.layer_summary(out, {"death": death, "specimen": None})
    got = {(r["table_name"], r["layer"]): r for r in counts.collect()}
    for layer in conformance.LAYERS:
        none = got["specimen", layer]
        assert (none["checked_columns"], none["table_rows"]) == (0, None)
        some = got["death", layer]
        assert some["expected_columns"] == some["checked_columns"] + some["skipped_columns"]
        assert some["table_rows"] == death.count()
    assert got["specimen", 1]["missing_columns"] == got["specimen", 1]["expected_columns"] == 15
    assert got["specimen", 1]["aligned_columns"] == 0 and got["specimen", 5]["aligned_columns"] is None
    assert all(r["table_rows"] is None for r in conformance.layer_summary(out).collect())


def test_references_are_counted_without_text(spark, death):
    people = spark.createDataFrame([(1, 5)], "person_id BIGINT, provider_id BIGINT")
    got = conformance.check_table_fk(spark, {"death": death, "person": people})
    assert got.columns == ["table_name", "column_name", "parent", "dangling_ids", "dangling_rows"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [ref" in plan and "Aggregate [column_name" not in plan
