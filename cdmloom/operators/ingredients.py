"""Drug exposures told by ingredient, with daily doses from the strengths of the vocabulary.

Both operators reduce the exposures to the drugs that occur before they meet the vocabulary, so the
mapping has no more drugs than the facts, whatever the size of the closure. It is written out and measured: a small
one is broadcast, for a larger one the rows of frequent drugs are spread, since most facts may share one drug, such as 0,
and the engine does not split that join. A drug with several ingredients gives a row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.operators.durable import durable
from cdmloom.operators.spread import BROADCAST_BYTES, attach

# The class of ingredient concepts, and the concept of the unit hour.
INGREDIENT = "Ingredient"
HOUR = 8505
#: Decimals a daily dose is rounded to, so that equal doses reached by different divisions are equal.
DOSE_DIGITS = 6


def ingredients_of(concept: DataFrame, concept_ancestor: DataFrame) -> DataFrame:
    """(drug_concept_id, ingredient_concept_id): valid standard ingredients above, or at, each drug."""
    kept = concept.filter(
        (F.col("concept_class_id") == INGREDIENT) & (F.col("standard_concept") == "S") & F.col("invalid_reason").isNull()
    ).select(F.col("concept_id").alias("ingredient_concept_id"))
    closure = concept_ancestor.select(
        F.col("ancestor_concept_id").alias("ingredient_concept_id"), F.col("descendant_concept_id").alias("drug_concept_id")
    )
    return closure.join(kept, "ingredient_concept_id", "left_semi").select("drug_concept_id", "ingredient_concept_id").distinct()


def _attach_drugs(exposures: DataFrame, mapping: DataFrame, how: str, broadcast_bytes: int) -> DataFrame:
    """The exposures with the rows of ``mapping`` for their drug, found for the drugs that occur."""
    used = exposures.select(F.col("drug_concept_id").cast("int").alias("__drug")).distinct()
    found = durable(used.join(mapping.withColumnRenamed("drug_concept_id", "__drug"), "__drug"))
    return attach(exposures, found, [(F.col("drug_concept_id"), F.col("__drug"))], how, broadcast_bytes)


def at_ingredients(
    exposures: DataFrame, ingredients: DataFrame, keep_products: bool = False, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The exposures with ``drug_concept_id`` replaced by each ingredient of the drug.

    Exposures without an ingredient (NULL, 0, or a drug that has none) go, unless ``keep_products``
    asks for them as they are.
    """
    found = ingredients.select("drug_concept_id", F.col("ingredient_concept_id").alias("__ingredient"))
    out = _attach_drugs(exposures, found, "left" if keep_products else "inner", broadcast_bytes)
    concept = F.coalesce("__ingredient", "drug_concept_id") if keep_products else F.col("__ingredient")
    return out.withColumn("drug_concept_id", concept.cast("int")).select(exposures.columns)


def _days(exposures: DataFrame) -> Column:
    """Days an exposure lasts: as supplied, or from its dates, one at least."""
    dated = F.datediff("drug_exposure_end_date", "drug_exposure_start_date") + 1
    dated = F.greatest(F.coalesce(dated, F.lit(1)), F.lit(1))
    if "days_supply" not in exposures.columns:
        return dated
    return F.coalesce(F.when(F.col("days_supply") > 0, F.col("days_supply").cast("int")), dated)


def strengths(drug_strength: DataFrame) -> DataFrame:
    """One valid strength per drug and ingredient: ``amount`` a unit of quantity, or an hour, and its unit.

    An amount stands for itself. A concentration counts per unit of its denominator, a missing
    denominator being one; ``hourly`` says that this unit is the hour. Of several rows the one with the
    smallest unit, then amount, is taken. Rows without amount or numerator, and denominators that are not positive, give none.
    """
    below = F.coalesce("denominator_value", F.lit(1.0))
    fixed = F.col("amount_value").isNotNull()
    amount = F.when(fixed, F.col("amount_value")).when(below > 0, F.col("numerator_value") / below)
    unit = F.when(fixed, F.col("amount_unit_concept_id")).otherwise(F.col("numerator_unit_concept_id"))
    hourly = ~fixed & F.coalesce(F.col("denominator_unit_concept_id") == HOUR, F.lit(False))
    return (
        drug_strength.filter(F.col("invalid_reason").isNull())
        .select(
            "drug_concept_id",
            "ingredient_concept_id",
            F.struct(F.coalesce(unit, F.lit(0)).alias("unit"), amount.alias("amount"), hourly.alias("hourly")).alias("s"),
        )
        .filter(F.col("s.amount").isNotNull())
        .groupBy("drug_concept_id", "ingredient_concept_id")
        .agg(F.min("s").alias("s"))
        .select("drug_concept_id", "ingredient_concept_id", "s.*")
    )


def daily_doses(exposures: DataFrame, drug_strength: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The exposures by ingredient with ``unit_concept_id`` and ``dose_value``, the dose of a day.

    The dose is quantity times strength over the days, or 24 times the strength where that is by the hour.
    Exposures of drugs without a strength go; without a quantity the dose is NULL, which forms no dose era.
    """
    per_drug = strengths(drug_strength).select(
        "drug_concept_id", *[F.col(c).alias(f"__{c}") for c in ("ingredient_concept_id", "unit", "amount", "hourly")]
    )
    spread = F.col("quantity").cast("double") * F.col("__amount") / _days(exposures)
    dose = F.when(F.col("__hourly"), F.col("__amount") * 24).otherwise(spread)
    kept = [c for c in exposures.columns if c not in ("drug_concept_id", "unit_concept_id", "dose_value")]
    return _attach_drugs(exposures, per_drug, "inner", broadcast_bytes).select(
        *kept,
        F.col("__ingredient_concept_id").cast("int").alias("drug_concept_id"),
        F.col("__unit").alias("unit_concept_id"),
        F.round(dose, DOSE_DIGITS).alias("dose_value"),
    )
