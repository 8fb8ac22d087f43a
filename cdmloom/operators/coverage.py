"""How much of the source codes resolves, per vocabulary, per column and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdmloom.model.spec import BY_RELATIONSHIP, Lookup
from cdmloom.model.vocabulary import Vocabulary
from cdmloom.operators.codes import code_values
from cdmloom.operators.concepts import valid_concepts
from cdmloom.operators.drafting import BUCKETS, is_resolved
from cdmloom.operators.lookups import lookup_targets, relationship_targets
from cdmloom.operators.profiling import code_frequency

# Fixed value: unresolved codes shown per vocabulary.
SAMPLE_SIZE = 20


def percentage(part: Column, whole: Column) -> Column:
    """Text with one decimal, ``n/a`` for an empty whole."""
    return F.when(whole == 0, "n/a").otherwise(F.format_string("%.1f%%", F.bround(part * 100.0 / whole, 1)))


def _totals() -> list[Column]:
    found = is_resolved(F.col("bucket"))
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(found).alias("resolved"),
        F.count_if(~found).alias("unresolved"),
    ]


def coverage_by_vocabulary(classified: DataFrame) -> DataFrame:
    per_bucket = [F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS]
    return (
        classified.groupBy("vocabulary_id")
        .agg(*_totals(), *per_bucket)
        .withColumn("resolution_pct", percentage(F.col("resolved"), F.col("total")))
    )


def coverage_by_column(codes: DataFrame, classified: DataFrame) -> DataFrame:
    """Distinct codes per requested column, not shared between columns."""
    keys = ["table_name", "source_alias", "source_column", "vocabulary_id"]
    outcome = classified.select("vocabulary_id", "source_code", "bucket")
    return (
        codes.join(outcome, ["vocabulary_id", "source_code"])
        .groupBy(*keys)
        .agg(*_totals())
        .withColumnRenamed("total", "distinct_codes")
        .orderBy(*keys)
    )


def coverage_overview(classified: DataFrame, columns: int) -> DataFrame:
    return classified.agg(
        F.count_distinct("vocabulary_id").alias("vocabularies"),
        F.lit(columns).alias("columns_covered"),
        *_totals(),
    ).withColumn("resolution_pct", percentage(F.col("resolved"), F.col("total")))


def sample_unmapped(classified: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """The first unresolved codes per vocabulary in code order.

    The rank filter lets every task keep only its first ``size`` codes before the shuffle.
    """
    by_code = W.partitionBy("vocabulary_id").orderBy("source_code")
    return (
        classified.filter(~is_resolved(F.col("bucket")))
        .select("vocabulary_id", "source_code", F.row_number().over(by_code).alias("position"))
        .filter(F.col("position") <= size)
    )


def coverage_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two runs of :func:`coverage_by_vocabulary`: more resolved is a correction, less a regression."""
    counts = ["total", "resolved", "unresolved"]
    b = before.select("vocabulary_id", *[F.col(c).alias(f"{c}_before") for c in counts])
    a = after.select("vocabulary_id", *[F.col(c).alias(f"{c}_after") for c in counts])
    both = b.join(a, "vocabulary_id", "full_outer").na.fill(
        0, [f"{c}_{side}" for c in counts for side in ("before", "after")]
    )
    share_before = F.col("resolved_before") / F.greatest("total_before", F.lit(1))
    share_after = F.col("resolved_after") / F.greatest("total_after", F.lit(1))
    return both.withColumn(
        "change",
        F.when(share_after > share_before, "correction")
        .when(share_after < share_before, "regression")
        .otherwise("unchanged"),
    )


def collision_audit(
    stcm: DataFrame, concept: DataFrame, facts: DataFrame, column: str, vocabulary_id: str
) -> DataFrame:
    """Local codes whose mapped target differs from the concept that happens to share the code."""
    frequency = code_frequency(facts, column).filter(F.col("code").isNotNull())
    total = facts.agg(F.lit(vocabulary_id).alias("source_vocabulary_id"), F.count(F.lit(1)).alias("all_rows"))
    mapped = stcm.filter(F.col("source_vocabulary_id") == vocabulary_id).select(
        "source_vocabulary_id",
        F.col("source_code").alias("code"), F.col("target_concept_id").alias("mapped_concept_id")
    )
    literal = concept.filter(F.col("vocabulary_id") == vocabulary_id).select(
        F.col("concept_code").alias("code"), F.col("concept_id").alias("literal_concept_id")
    )
    clash = mapped.join(literal, "code").filter(
        F.col("mapped_concept_id") != F.col("literal_concept_id")
    )
    return (
        clash.join(frequency, "code", "left")
        .join(F.broadcast(total), "source_vocabulary_id")
        .select(
            "code",
            "mapped_concept_id",
            "literal_concept_id",
            F.coalesce("n", F.lit(0)).alias("rows_affected"),
            F.round(F.coalesce("n", F.lit(0)) / F.greatest("all_rows", F.lit(1)), 6).alias(
                "row_share"
            ),
        )
    )


def stale_map_targets(stcm: DataFrame, concept: DataFrame) -> DataFrame:
    """Map rows a lookup silently ignores: their target is missing or no longer valid."""
    alive = valid_concepts(concept).select(F.col("concept_id").alias("target_concept_id"))
    return stcm.join(alive, "target_concept_id", "left_anti").select(
        "source_vocabulary_id", "source_code", "target_concept_id"
    )


def format_mismatch(classified: DataFrame, concept: DataFrame) -> DataFrame:
    """Unknown codes that match a concept once case and punctuation are ignored."""

    def plain(code: str) -> Column:
        return F.regexp_replace(F.upper(code), "[^A-Z0-9]", "")

    unknown = classified.filter(F.col("bucket") == "unresolved_no_concept").select(
        "vocabulary_id", "source_code", plain("source_code").alias("plain_code")
    )
    known = concept.select(
        "vocabulary_id", "concept_code", "concept_id", plain("concept_code").alias("plain_code")
    )
    return (
        unknown.filter(F.col("plain_code") != "")
        .join(known, ["vocabulary_id", "plain_code"])
        .select("vocabulary_id", "source_code", "concept_code", "concept_id")
    )


def fanout_by_domain(
    facts: DataFrame, column: str, vocab: Vocabulary, vocabulary_id: str
) -> DataFrame:
    """Number of standard targets per source code and domain, one row for each pair that occurs."""
    targets = relationship_targets(vocab, vocabulary_id).select(
        F.col("code").alias("source_code"), "domain_id"
    )
    return (
        code_values(facts, column)
        .join(targets, "source_code")
        .groupBy("source_code", "domain_id")
        .agg(F.count(F.lit(1)).alias("targets"))
    )


def dropped_by_domain(
    facts: DataFrame, column: str, vocab: Vocabulary, vocabulary_id: str, domain_id: str
) -> DataFrame:
    """Codes with standard targets, none of them in ``domain_id``, and the rows that lose them."""
    per_code = (
        relationship_targets(vocab, vocabulary_id)
        .groupBy("code")
        .agg(
            F.count_if(F.col("domain_id") == domain_id).alias("wanted"),
            F.count_if(F.col("domain_id") != domain_id).alias("elsewhere"),
        )
    )
    lost = per_code.filter((F.col("wanted") == 0) & (F.col("elsewhere") > 0))
    return lost.join(code_frequency(facts, column), "code").select(
        "code", "elsewhere", F.col("n").alias("rows_lost")
    )
