"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmloom.llm import class_lm, hard_negatives, jaccard_join, language_id, mixing, periodic_runs, quality_rules, secret_scan, sentencepiece_codec, span_hashes, token_counts, vector_topk, warc_zip
from cdmloom.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, model)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = language_id.learn(docs.where(fold("doc_id", 4) != 2))
    return language_id.identify(docs, dictionaries, keep=((fold("doc_id", 4) == 2).alias("held_out"),))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_linked", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op7_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = class_lm.learn(docs, fold("doc_id", 7) != 2)
    return class_lm.score(docs, model, keep=((fold("doc_id", 7) == 2).alias("held_out"),))


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc_zip.write_packages(table(spark, sf_dir, "pages"))
    return warc_zip.read_packages(packages).drop("url")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op11_span_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_hashes.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_source_mix, op3_sentencepiece, op4_quality_rules, op5_language, op6_secrets, op7_vector_topk, op8_class_lm, op9_warc_zip,
        op10_jaccard_join, op11_span_fingerprints, op12_periodic_runs, op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op7_vector_topk": """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from whole q join whole c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)
)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
""",
    "op13_hard_negatives": """
with whole as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::bigint as score
  from whole a join whole c on a.vec_id % 100 = 0 and c.vec_id <> a.vec_id and len(a.v) = len(c.v)
),
positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.vec_id as positive_id,
       (row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id))::int as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n
  on n.anchor_id = p.anchor_id and not n.same and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
qualify row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) <= 5
""",
    "op9_warc_zip": """
with payloads as (select page_id, coalesce(html, '') as payload from pages),
sized as (select page_id, strlen(payload)::bigint as payload_bytes, sha1(payload) as payload_digest from payloads),
firsts as (select *, max(page_id) over (partition by payload_digest) as first_id from sized)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and first_id is distinct from page_id and first_id is not null then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and first_id is distinct from page_id then first_id end as refers_to
from firsts
""",
}
