import pytest
from pyspark.sql import Observation

from cdmloom.functions.keys import md5_key
from cdmloom.model.spec import Rule, Rules
from cdmloom.operators.expectations import (
    apply_expectations,
    expect_drop,
    expect_fail,
    expect_warn,
    expectation_metrics,
    observe_rules,
    observed_metrics,
)
from cdmloom.plans import tables
from cdmloom.plans.build import build_table
from tests.conftest import rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id INT, v INT")


SMALL = Rule("small", "v < 10")
PRESENT = Rule("present", "id IS NOT NULL")


def test_null_predicate_is_a_violation(df):
    assert rows(expect_drop(df, [SMALL])) == [(1, 5)]


def test_fail_aborts_and_names_the_rule(df):
    assert expect_fail(df, [PRESENT]).count() == 3
    with pytest.raises(Exception, match="expectation failed: small"):
        expect_fail(df, [SMALL]).collect()


def test_fail_wins_over_drop(df):
    rules = Rules(fail=(SMALL,), drop=(Rule("first", "id = 1"),))
    with pytest.raises(Exception, match="expectation failed: small"):
        apply_expectations(df, rules).count()


def test_fail_guard_survives_pruning(df):
    with pytest.raises(Exception, match="expectation failed: small"):
        apply_expectations(df, Rules(fail=(SMALL,))).select("id").collect()


def test_metrics_count_warn_after_drop(df):
    rules = Rules(fail=(PRESENT,), drop=(Rule("few", "v < 100"),), warn=(SMALL,))
    assert rows(expectation_metrics(df, rules)) == [
        ("drop", "few", 3, 2, 1), ("fail", "present", 3, 3, 0), ("warn", "small", 2, 1, 1),
    ]
    assert rows(expect_warn(df, [SMALL])) == [("warn", "small", 3, 1, 2)]


def test_no_rules_change_nothing(df):
    assert apply_expectations(df, Rules()) is df


def test_observed_while_running(df):
    seen = Observation("rules")
    rules = Rules(drop=(SMALL,), warn=(PRESENT,))
    apply_expectations(observe_rules(df, rules, seen), rules).collect()
    assert rows(observed_metrics(df.sparkSession, rules, seen)) == rows(expectation_metrics(df, rules))


def test_a_rule_on_a_key_does_not_compute_it_again(spark, vocab):
    facts = spark.createDataFrame([(1, 1, "A", "x", None)], "encounter_id BIGINT, line INT, diagnosis_code STRING, diagnosis_type STRING, diagnosis_datetime TIMESTAMP")
    enc = spark.createDataFrame([(1, 2, 3)], "encounter_id BIGINT, patient_id BIGINT, provider_id BIGINT")
    spec = tables.condition_occurrence(tables.Style(key=md5_key, vocabulary_id="LOC"))
    out = build_table(spec, {"dx": facts, "enc": enc}, vocab)
    assert out.where("condition_occurrence_id is not null").count() == 1
    assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
