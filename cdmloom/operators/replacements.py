"""Replacements of concepts followed to their end, by pointer jumping."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.model.vocabulary import Vocabulary
from cdmloom.operators.concepts import valid_edges
from cdmloom.operators.durable import durable

REPLACED_BY = "Concept replaced by"


def replacement_closure(edges: DataFrame, relationship_id: str = REPLACED_BY) -> DataFrame:
    """(concept_id, final_concept_id, hops, cyclic) of every replaced concept.

    A concept replaced by several goes to the least id. Each round lets every pointer that has not reached an end jump
    as far again, so a chain of n replacements takes log2(n) rounds, which are stored. While a chain is open, a round
    closes one pointer at least; when it closes none, what is left runs in circles: ``final_concept_id`` and ``hops`` are NULL there.
    """
    steps = valid_edges(edges, relationship_id).groupBy("concept_id_1").agg(F.min("concept_id_2").alias("b"))
    steps = steps.select(F.col("concept_id_1").alias("a"), "b")
    replaced = steps.select(F.col("a").alias("c"))
    at = durable(steps.join(replaced, F.col("b") == F.col("c"), "left").select("a", "b", F.lit(1).cast("long").alias("hops"), F.col("c").isNotNull().alias("open")))
    left, before = at.where("open").count(), -1
    while left and left != before:
        far = at.select(F.col("a").alias("c"), F.col("b").alias("far"), F.col("hops").alias("more"), F.col("open").alias("still"))
        jumped = at.join(far, F.col("open") & (F.col("b") == F.col("c")), "left")
        at = durable(
            jumped.select(
                "a",
                F.coalesce("far", "b").alias("b"),
                (F.col("hops").cast("long") + F.coalesce("more", F.lit(0))).alias("hops"),
                F.coalesce("still", F.lit(False)).alias("open"),
            )
        )
        left, before = at.where("open").count(), left
    ended = ~F.col("open")
    return at.select(
        F.col("a").alias("concept_id"),
        F.when(ended, F.col("b")).alias("final_concept_id"),
        F.when(ended, F.col("hops")).cast("int").alias("hops"),
        F.col("open").alias("cyclic"),
    )


def with_final_replacements(vocab: Vocabulary, relationship_id: str = REPLACED_BY) -> Vocabulary:
    """The vocabulary whose replacements lead straight to the end of their chains, for lookups over one hop.

    Concepts replaced in a circle have no replacement.
    """
    ends = replacement_closure(vocab.concept_relationship, relationship_id).where(~F.col("cyclic"))
    rest = vocab.concept_relationship.where(F.col("relationship_id") != relationship_id)
    ends = ends.select(
        F.col("concept_id").alias("concept_id_1"), F.col("final_concept_id").alias("concept_id_2"), F.lit(relationship_id).alias("relationship_id")
    )
    return replace(vocab, concept_relationship=rest.unionByName(ends, allowMissingColumns=True))
