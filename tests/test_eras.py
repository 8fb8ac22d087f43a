import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdmloom.operators.eras import condition_era, dose_era, drug_era, islands, observation_period
from cdmloom.operators.ingredients import HOUR, at_ingredients, daily_doses, ingredients_of
from tests.conftest import rows

DAY0 = dt.date(2020, 1, 1)


def brute_force(spans, gap):
    groups = defaultdict(list)
    for key, start, end in spans:
        groups[key].append((start, max(start, end) if end is not None else start))
    out = []
    for key, items in groups.items():
        current = None
        for start, end in sorted(items):
            if current and (start - current[1]).days <= gap:
                current[3] += max((start - current[1]).days, 0)
                current[1] = max(current[1], end)
                current[2] += 1
            else:
                if current:
                    out.append((key, *current))
                current = [start, end, 1, 0]
        out.append((key, *current))
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 2), st.integers(0, 200), st.one_of(st.none(), st.integers(0, 60))),
        min_size=1,
        max_size=40,
    )
)
def test_islands_equal_brute_force(spark, drawn):
    spans = [
        (k, DAY0 + dt.timedelta(s), None if n is None else DAY0 + dt.timedelta(s + n))
        for k, s, n in drawn
    ]
    df = spark.createDataFrame(spans, "k INT, a DATE, b DATE")
    got = islands(df, ["k"], F.col("a"), F.col("b"), 30).select("k", "era_start", "era_end", "spans", "gap")
    assert sorted(tuple(r) for r in got.collect()) == brute_force(spans, 30)


def test_long_span_bridges_later_gaps(spark):
    spans = [(1, DAY0, DAY0 + dt.timedelta(100)), (1, DAY0 + dt.timedelta(1), DAY0 + dt.timedelta(2)),
             (1, DAY0 + dt.timedelta(120), None)]
    df = spark.createDataFrame(spans, "k INT, a DATE, b DATE")
    assert islands(df, ["k"], F.col("a"), F.col("b"), 30).count() == 1


def test_unmapped_and_ownerless_rows_form_no_era(spark):
    data = [(1, 0, DAY0), (None, 5, DAY0), (1, 5, DAY0), (1, 5, DAY0)]
    df = spark.createDataFrame(
        data, "person_id BIGINT, condition_concept_id INT, condition_start_date DATE"
    )
    got = condition_era(df).select("person_id", "condition_concept_id", "condition_occurrence_count")
    assert rows(got) == [(1, 5, 2)]
    assert condition_era(df, keep_unmapped=True).count() == 2


def test_observation_period(spark):
    later = DAY0 + dt.timedelta(9)
    visits = spark.createDataFrame(
        [(1, DAY0, DAY0), (1, later, later), (2, DAY0, later)],
        "person_id BIGINT, visit_start_date DATE, visit_end_date DATE",
    )
    got = observation_period(visits).drop("observation_period_id")
    assert rows(got) == [(1, DAY0, later, 32817), (2, DAY0, later, 32817)]


EXPOSURE = (
    "person_id BIGINT, drug_concept_id INT, drug_exposure_start_date DATE, drug_exposure_end_date DATE, quantity FLOAT, days_supply INT"
)
STRENGTH = (
    "drug_concept_id INT, ingredient_concept_id INT, amount_value DOUBLE, amount_unit_concept_id INT, numerator_value DOUBLE, "
    "numerator_unit_concept_id INT, denominator_value DOUBLE, denominator_unit_concept_id INT, invalid_reason STRING"
)


@pytest.fixture(scope="module")
def exposures(spark):
    two = DAY0 + dt.timedelta(1)
    data = [
        (1, 10, DAY0, two, 6.0, None),
        (1, 11, DAY0, two, 6.0, 3),
        (1, 12, DAY0, None, None, 0),
        (1, 13, DAY0, DAY0, 4.0, None),
        (1, 0, DAY0, DAY0, 1.0, 1),
        (1, None, DAY0, DAY0, 1.0, 1),
    ]
    return spark.createDataFrame(data, EXPOSURE)


def test_exposures_by_ingredient(spark, exposures):
    concept = spark.createDataFrame(
        [(1, "Ingredient", "S", None), (2, "Ingredient", "S", None), (3, "Ingredient", None, None), (4, "Ingredient", "S", "D"), (5, "Class", "S", None)],
        "concept_id INT, concept_class_id STRING, standard_concept STRING, invalid_reason STRING",
    )
    closure = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 11), (2, 11), (3, 12), (4, 12), (5, 12), (5, 10), (1, 1), (None, 13)],
        "ancestor_concept_id INT, descendant_concept_id INT",
    )
    found = ingredients_of(concept, closure)
    assert rows(found) == [(1, 1), (10, 1), (11, 1), (11, 2)]
    drugs = at_ingredients(exposures, found)
    assert rows(drugs.select("drug_concept_id")) == [(1,), (1,), (2,)]
    assert drugs.columns == exposures.columns
    kept = at_ingredients(exposures, found, keep_products=True)
    assert rows(kept.select("drug_concept_id")) == [(None,), (0,), (1,), (1,), (12,), (13,), (2,)]
    eras = drug_era(exposures, ingredients=found).select("drug_concept_id", "drug_exposure_count")
    assert rows(eras) == [(1, 2), (2, 1)]
    assert at_ingredients(exposures.limit(0), found).count() == at_ingredients(exposures, found.limit(0)).count() == 0


def test_daily_doses(spark, exposures):
    data = [
        (10, 1, 5.0, 7, None, None, None, None, None),  # 6 x 5 over two days, from the dates
        (11, 1, None, None, 9.0, 8, 3.0, 20, None),  # 6 x 9 / 3 over three days, as supplied
        (11, 2, None, None, 10.0, 9, None, HOUR, None),  # by the hour
        (11, 2, None, None, 2.0, 9, None, HOUR, None),  # of two strengths the smaller
        (11, 2, None, None, 1.0, 9, None, HOUR, "D"),
        (12, 1, 5.0, 7, None, None, None, None, None),  # no quantity, no dose
        (13, 1, None, None, 5.0, 7, 0.0, 20, None),  # no dose from a denominator of zero
        (13, 2, None, None, None, None, None, None, None),
        (99, 1, 5.0, 7, None, None, None, None, None),
    ]
    strength = spark.createDataFrame(data, STRENGTH)
    got = daily_doses(exposures, strength).select("drug_concept_id", "unit_concept_id", "dose_value")
    assert rows(got) == [(1, 7, None), (1, 7, 15.0), (1, 8, 6.0), (2, 9, 48.0)]
    eras = dose_era(exposures, drug_strength=strength).select("drug_concept_id", "unit_concept_id", "dose_value")
    assert rows(eras) == [(1, 7, 15.0), (1, 8, 6.0), (2, 9, 48.0)]
    assert dose_era(exposures, drug_strength=strength.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_a_drug_that_most_exposures_share_is_no_single_task(spark, limit):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in off}
    for name, value in off.items():
        spark.conf.set(name, value)
    try:
        many = spark.range(3000).selectExpr("id as person_id", "if(id < 2900, 0, cast(id % 5 as int)) as drug_concept_id")
        found = spark.createDataFrame([(d, 10 + d) for d in range(1, 4)], "drug_concept_id INT, ingredient_concept_id INT")
        out = at_ingredients(many, found, keep_products=True, broadcast_bytes=limit)
        placed = out.select("person_id", "drug_concept_id", F.spark_partition_id().alias("task")).collect()
        assert sorted(r[:2] for r in placed) == [(i, 0 if i < 2900 else i % 5 + 10 * (0 < i % 5 < 4)) for i in range(3000)]
        tasks = [r["task"] for r in placed if r["drug_concept_id"] == 0]
        assert max(tasks.count(t) for t in set(tasks)) < 1500
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
