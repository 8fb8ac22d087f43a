"""A corpus pipeline: language, near duplicates, secrets, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns rows; all but the last keep the columns of
``documents``. Between stages the rows are written as Parquet in the shared folder and read again.

Defined results: further columns, whatever their names, are carried along unchanged (the last stage leaves all but
its own out); inside a stage they go by their position, so no name of theirs meets one of the stage's. A text that is null or
without letters has no language and goes; of rows alike in id and text one stays as their class's document; an id may be
null; a null ``source`` is a source of its own; texts of any length are masked, mixed and encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmloom.llm import jaccard_join, language_id, mixing, secret_scan, sentencepiece_codec
from cdmloom.llm.common import fold, stored, table, whole_text


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Spans of findings, over all documents, that are broadcast at most; about 40 bytes each.
BROADCAST_SPANS = 500_000


def by_position(stage: Stage) -> Stage:
    """The stage, with all columns that it does not know renamed while it works."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in COLUMNS else f"__kept_{i}" for i, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*names), sf_dir)
        return out.toDF(*docs.columns) if out.columns == names else out

    return run


@by_position
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go; the others get the language found in them."""
    dictionaries = language_id.learn(docs.where(fold("doc_id", 4) != 2))
    others = tuple(F.col(c) for c in docs.columns if c not in ("doc_id", "lang"))
    found = language_id.identify(docs, dictionaries, keep=others)
    return found.where(~F.col("rejected")).withColumnRenamed("lang_pred", "lang").select(docs.columns)


@by_position
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return jaccard_join.without_duplicates(docs)


@by_position
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts that have any; lengths follow."""
    found = secret_scan.scan(docs).where(F.size("found") > 0)
    found = stored(found.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.col("found").alias("__found")).dropDuplicates(["__id", "__h"]), "findings")
    rows, total = found.agg(F.count("*"), F.coalesce(F.sum(F.size("__found")), F.lit(0))).first()
    found = F.broadcast(found) if rows + total <= BROADCAST_SPANS else found
    here = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(whole_text()) == F.col("__h"))
    text = F.when(F.col("__found").isNull(), F.col("text")).otherwise(secret_scan.redacted(F.col("text"), F.col("__found")))
    masked = docs.join(found, here, "left").withColumn("__text", text)
    n_chars = F.when(F.col("__found").isNull(), F.col("n_chars")).otherwise(F.length("__text").cast("long"))
    return masked.withColumn("n_chars", n_chars).withColumn("text", F.col("__text")).select(docs.columns)


@by_position
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Documents alike in id and text share their copies."""
    plan = mixing.plan_mix(docs)
    copies = plan.where(F.col("copies") > 0).groupBy(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("source").alias("__source")).agg(F.sum("copies").alias("__copies"))
    rows = docs.withColumn("__text_hash", F.xxhash64(whole_text()))
    alike = stored(plan.groupBy("id", "h", "source").count().where("count > 1"), "alike")
    if not alike.isEmpty():
        rows = rows.dropDuplicates(["doc_id", "__text_hash", "source"])
    here = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__h")) & F.col("source").eqNullSafe(F.col("__source"))
    taken = rows.join(copies, here).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return taken.select(docs.columns)


@by_position
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mix", mix_stage),
    ("encoding", encoding_stage),
]

#: Compression, merging of pieces and random rounding have no SQL form; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
