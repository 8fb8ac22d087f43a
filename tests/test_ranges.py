import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdmloom.model.spec import Join
from cdmloom.operators.joins import join_sources
from cdmloom.operators.ranges import range_join
from tests.conftest import rows

DAY0 = dt.date(2020, 1, 1)
BETWEEN = ("p.at", "s.a", "s.b")
number = st.one_of(st.none(), st.integers(-100, 100))


@pytest.mark.parametrize("how", ["inner", "left"])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), number), max_size=12), st.lists(st.tuples(st.integers(0, 1), number, number), max_size=12))
def test_equals_the_plain_join(spark, how, drawn, given_spans):
    points = spark.createDataFrame(drawn, "k INT, at INT").alias("p")
    spans = spark.createDataFrame(given_spans, "k INT, a INT, b INT").alias("s")
    plain = points.join(spans, F.expr("p.k = s.k and p.at between s.a and s.b"), how)
    got = range_join(points, spans, BETWEEN, [(F.expr("p.k"), F.expr("s.k"))], how, width=7)
    assert rows(got) == rows(plain)


def test_dates_times_and_open_ends(spark):
    late = dt.datetime(2020, 1, 2, 23, 59)
    points = spark.createDataFrame([(1, late), (2, None), (3, late + dt.timedelta(400))], "i INT, at TIMESTAMP").alias("p")
    spans = spark.createDataFrame(
        [(1, DAY0, DAY0 + dt.timedelta(2)), (2, DAY0, dt.date(9999, 12, 31)), (3, dt.date(1, 1, 1), DAY0), (4, DAY0, None), (5, dt.date(2021, 1, 1), DAY0)],
        "j INT, a DATE, b DATE",
    ).alias("s")
    out = range_join(points, spans, BETWEEN, how="left").select("i", "j")
    assert rows(out) == [(1, 1), (1, 2), (2, None), (3, 2)]
    for some, all_spans in ((points.limit(0), spans), (points, spans.limit(0))):
        assert range_join(some.alias("p"), all_spans.alias("s"), BETWEEN).count() == 0


def test_no_nested_loop(spark):
    frames = {"p": spark.range(1000).selectExpr("id as at"), "s": spark.range(1000).selectExpr("id as a", "id + 3 as b")}
    out = join_sources(frames, [Join("p", "s", "s.a % 2 = 0", between=BETWEEN)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.columns == ["at", "a", "b"]
    assert out.count() == sum(1 for p in range(1000) for a in range(max(p - 3, 0), p + 1) if a % 2 == 0)


def test_one_bin_with_most_points(spark):
    points = spark.range(3000).selectExpr("id", "if(id % 10 < 9, 5, id) as at").alias("p")
    spans = spark.createDataFrame([(4, 6), (0, 100000)], "a BIGINT, b BIGINT").alias("s")
    assert range_join(points, spans, BETWEEN).count() == 3000 + 2700


def test_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x")], "a DOUBLE, b DOUBLE, at STRING")
    with pytest.raises(TypeError):
        range_join(df.alias("p"), df.alias("s"), BETWEEN)
    with pytest.raises(ValueError):
        range_join(df.alias("p"), df.alias("s"), BETWEEN, how="right")
    with pytest.raises(ValueError):
        Join("p", "s", between=("p.at", "s.a"))
