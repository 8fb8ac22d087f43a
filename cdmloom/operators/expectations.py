"""Row expectations: fail aborts the job, drop removes rows, warn only counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cdmloom.model.spec import Rule, Rules


def passes(rule: Rule) -> Column:
    """A row passes only where the predicate is TRUE; NULL is a violation."""
    return F.coalesce(F.expr(rule.expr), F.lit(False))


def _all_pass(rules: Sequence[Rule]) -> Column:
    out = F.lit(True)
    for r in rules:
        out = out & passes(r)
    return out


def apply_expectations(df: DataFrame, rules: Rules) -> DataFrame:
    """Abort on a fail violation, then remove drop violations.

    Both live in one predicate: separate filters could be pushed past each
    other, and a dropped row must still trip the fail rules first.
    """
    keep = _all_pass(rules.drop)
    for r in reversed(rules.fail):
        stop = F.raise_error(F.lit(f"expectation failed: {r.name}")).cast("boolean")
        keep = F.when(~passes(r), stop).otherwise(keep)
    return df.filter(keep) if rules.fail or rules.drop else df


def expect_fail(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return apply_expectations(df, Rules(fail=tuple(rules)))


def expect_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return apply_expectations(df, Rules(drop=tuple(rules)))


def _counts(rules: Rules) -> list[tuple[str, Rule, Column, Column]]:
    every, kept = F.lit(True), _all_pass(rules.drop)
    groups = (("fail", rules.fail, every), ("drop", rules.drop, every), ("warn", rules.warn, kept))
    return [
        (action, r, F.count_if(scope), F.count_if(scope & ~passes(r)))
        for action, group, scope in groups
        for r in group
    ]


def expectation_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """Per rule: action, rows checked, passed and failed, in one pass over ``df``.

    Fail and drop rules are counted on all rows, warn rules on rows that survive drop.
    """
    counts = _counts(rules)
    wide = df.agg(
        *[c.alias(f"checked_{i}") for i, (_, _, c, _) in enumerate(counts)],
        *[f.alias(f"failed_{i}") for i, (_, _, _, f) in enumerate(counts)],
    )
    rows = [
        F.struct(
            F.lit(action).alias("action"),
            F.lit(r.name).alias("rule"),
            F.col(f"checked_{i}").alias("checked"),
            (F.col(f"checked_{i}") - F.col(f"failed_{i}")).alias("passed"),
            F.col(f"failed_{i}").alias("failed"),
        )
        for i, (action, r, _, _) in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*rows)))


def expect_warn(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violation counts of warn rules; the rows themselves are untouched."""
    return expectation_metrics(df, Rules(warn=tuple(rules)))


def observe_rules(df: DataFrame, rules: Rules, observation: Observation) -> DataFrame:
    """Count violations while ``df`` is being written, at no extra pass.

    Put it before :func:`apply_expectations`, so dropped rows are counted too.
    """
    counts = _counts(rules)
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[checked.alias(f"checked_{i}") for i, (_, _, checked, _) in enumerate(counts)],
        *[failed.alias(f"failed_{i}") for i, (_, _, _, failed) in enumerate(counts)],
    )


METRICS = "action STRING, rule STRING, checked LONG, passed LONG, failed LONG"


def observed_metrics(spark: SparkSession, rules: Rules, observation: Observation) -> DataFrame:
    """What :func:`observe_rules` counted, in the shape of :func:`expectation_metrics`."""
    got = observation.get
    rows = []
    for i, (action, r, _, _) in enumerate(_counts(rules)):
        checked, failed = got[f"checked_{i}"], got[f"failed_{i}"]
        rows.append((action, r.name, checked, checked - failed, failed))
    return spark.createDataFrame(rows, METRICS)
