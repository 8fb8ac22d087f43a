"""Resolving source codes to concept ids.

A lookup becomes a two-column mapping (code, target). All lookups of a table are folded into a single mapping first,
with a row per source column and code that holds the targets of every lookup. The fact rows are joined with it
once per code column, however many ids are read from it, and the targets fan out behind the join.

No job runs while a plan is built. Whether the mapping is small enough to be broadcast follows from sizes that were
stored with the vocabulary. Beyond that, or without sizes, the codes that occur in the facts are reduced to a dictionary
first, and only these are looked up; how the rest is joined is left to adaptive execution, which splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.model.spec import BY_CONCEPT, BY_MAP, BY_RELATIONSHIP, Lookup
from cdmloom.model.vocabulary import CROSSWALK_RELATIONSHIPS, Vocabulary
from cdmloom.operators.concepts import concepts_in, standard_concepts, valid_concepts, valid_edges
from cdmloom.operators.spread import BROADCAST_BYTES, attach
from cdmloom.sources.tables import group_sizes, write_version

#: Bytes of a mapping's row besides its code.
MAPPING_ROW = 96

#: A dictionary of the codes that occur, as ``place:code``, and the place of the source column meant.
Occurring = tuple[DataFrame, int] | None


def _occurring(rows: DataFrame, code: str, only: Occurring) -> DataFrame:
    """The rows whose code occurs in the facts; all of them where no dictionary is given."""
    if only is None:
        return rows
    codes, place = only
    return rows.join(codes, F.concat(F.lit(f"{place}:"), F.col(code)) == F.col("__code"), "left_semi")


def _map_targets(vocab: Vocabulary, lookup: Lookup, only: Occurring = None) -> DataFrame:
    """Map rows of one vocabulary whose target is a valid concept."""
    alive = valid_concepts(vocab.concept).select("concept_id")
    rows = vocab.source_to_concept_map.filter(F.col("source_vocabulary_id") == lookup.vocabulary)
    rows = _occurring(rows, "source_code", only)
    return rows.join(alive, F.col("target_concept_id") == F.col("concept_id")).select(
        F.col("source_code").alias("code"), F.col("target_concept_id").alias("target")
    )


def _concept_targets(vocab: Vocabulary, lookup: Lookup, only: Occurring = None) -> DataFrame:
    found = concepts_in(valid_concepts(vocab.concept), lookup.vocabulary, lookup.domain_id)
    if lookup.standard_only:
        found = standard_concepts(found)
    return _occurring(found, "concept_code", only).select(F.col("concept_code").alias("code"), F.col("concept_id").alias("target"))


def relationship_targets(
    vocab: Vocabulary,
    vocabulary_id: str | None,
    relationship_id: str = "Maps to",
    domain_id: str | None = None,
    standard_only: bool = True,
    source_invalid_reason: str | None = None,
    only: Occurring = None,
) -> DataFrame:
    """Rows (vocabulary_id, code, source_concept_id, target, domain_id) over one hop."""
    origin = _occurring(concepts_in(vocab.concept, vocabulary_id), "concept_code", only)
    if source_invalid_reason is None:
        origin = valid_concepts(origin)
    else:
        origin = origin.filter(F.col("invalid_reason") == source_invalid_reason)
    goal = concepts_in(valid_concepts(vocab.concept), domain_id=domain_id)
    if standard_only:
        goal = standard_concepts(goal)
    hops = valid_edges(vocab.concept_relationship, relationship_id)
    return (
        origin.select(
            "vocabulary_id",
            F.col("concept_code").alias("code"),
            F.col("concept_id").alias("source_concept_id"),
        )
        .join(
            hops.select(F.col("concept_id_1").alias("source_concept_id"), "concept_id_2"),
            "source_concept_id",
        )
        .join(
            goal.select(F.col("concept_id").alias("concept_id_2"), "domain_id"),
            "concept_id_2",
        )
        .select(
            "vocabulary_id",
            "code",
            "source_concept_id",
            F.col("concept_id_2").alias("target"),
            "domain_id",
        )
    )


def _from_crosswalk(vocab: Vocabulary, lookup: Lookup) -> bool:
    stored = vocab.crosswalk is not None and lookup.source_invalid_reason is None
    return stored and lookup.relationship_id in vocab.crosswalk_relationships


def _relationship_targets(vocab: Vocabulary, lookup: Lookup, only: Occurring = None) -> DataFrame:
    if _from_crosswalk(vocab, lookup):
        rows = vocab.crosswalk.filter(
            (F.col("vocabulary_id") == lookup.vocabulary)
            & (F.col("relationship_id") == lookup.relationship_id)
            & (F.col("domain_id") == lookup.domain_id)
        )
        if lookup.standard_only:
            rows = rows.filter(F.col("standard"))
        return _occurring(rows, "code", only).select("code", "target")
    return relationship_targets(
        vocab,
        lookup.vocabulary,
        lookup.relationship_id,
        lookup.domain_id,
        lookup.standard_only,
        lookup.source_invalid_reason,
        only,
    ).select("code", "target")


def lookup_targets(vocab: Vocabulary, lookup: Lookup, only: Occurring = None) -> DataFrame:
    """The (code, target) mapping behind one lookup; a code may have several targets."""
    if lookup.resolution == BY_MAP:
        return _map_targets(vocab, lookup, only)
    if lookup.resolution == BY_CONCEPT:
        return _concept_targets(vocab, lookup, only)
    return _relationship_targets(vocab, lookup, only)


def mapping_bytes(vocab: Vocabulary, lookups: Sequence[Lookup]) -> int | None:
    """The most bytes that the mapping of these lookups can take, from stored sizes; None where one is not known.

    A lookup over a relationship has a row per edge at most, one by concept or map a row per code of its vocabulary.
    """
    total = 0
    for x in lookups:
        crossed = x.resolution == BY_RELATIONSHIP and _from_crosswalk(vocab, x)
        table = {BY_MAP: "source_to_concept_map", BY_CONCEPT: "concept"}.get(x.resolution, "crosswalk" if crossed else "concept_relationship")
        if table not in vocab.sizes or "concept" not in vocab.sizes and table == "concept_relationship":
            return None
        group = {"crosswalk": f"{x.relationship_id}|{x.vocabulary}", "concept_relationship": x.relationship_id}.get(table, x.vocabulary)
        rows, longest = vocab.sizes[table].get(group, (0, 0))
        if table == "concept_relationship":
            longest = vocab.sizes["concept"].get(x.vocabulary, (0, 0))[1]
        total += rows * (longest + MAPPING_ROW)
    return total


def crosswalk(
    vocab: Vocabulary, relationship_ids: Sequence[str] = CROSSWALK_RELATIONSHIPS
) -> DataFrame:
    """All one-hop mappings of valid concepts over the given relationships.

    Build it once per vocabulary load and write it with
    :func:`write_crosswalk`; lookups then read one pruned partition instead of
    joining the concept table with its edges each time.
    """
    origin = valid_concepts(vocab.concept).select(
        "vocabulary_id",
        F.col("concept_code").alias("code"),
        F.col("concept_id").alias("concept_id_1"),
    )
    hops = vocab.concept_relationship.filter(
        F.col("relationship_id").isin(*relationship_ids) & F.col("invalid_reason").isNull()
    ).select("concept_id_1", "concept_id_2", "relationship_id")
    goal = valid_concepts(vocab.concept).select(
        F.col("concept_id").alias("concept_id_2"),
        "domain_id",
        F.coalesce(F.col("standard_concept") == "S", F.lit(False)).alias("standard"),
    )
    return (
        origin.join(hops, "concept_id_1")
        .join(goal, "concept_id_2")
        .select(
            "vocabulary_id",
            "relationship_id",
            "domain_id",
            "standard",
            "code",
            F.col("concept_id_2").alias("target"),
        )
    )


def write_crosswalk(
    vocab: Vocabulary, path: str, relationship_ids: Sequence[str] = CROSSWALK_RELATIONSHIPS
) -> DataFrame:
    """The crosswalk stored by relationship and vocabulary.

    Ranges that include the code keep the number of files small and split a large vocabulary.
    """
    by = ("relationship_id", "vocabulary_id")
    rows = crosswalk(vocab, relationship_ids).repartitionByRange(*by, "code").sortWithinPartitions(*by, "code")
    both = F.concat_ws("|", *by).alias("both")
    sizes = lambda stored: group_sizes(stored.select(both, "code"), "both", "code")
    return write_version(vocab.concept.sparkSession, path, rows.write.partitionBy(*by).parquet, sizes)


def _mapping(vocab: Vocabulary, lookups: Sequence[Lookup], places: Mapping[tuple[str, str], int], codes: DataFrame | None) -> DataFrame:
    """(__code, __targets_0, ...): a row per source column and code, with a list of targets for each lookup.

    A target stays in a struct, so that one that is NULL is listed like any other.
    """
    every = None
    for i, x in enumerate(lookups):
        place = places[x.source_alias, x.source_column]
        found = lookup_targets(vocab, x, None if codes is None else (codes, place))
        one = found.select(F.concat(F.lit(f"{place}:"), "code").alias("__code"), F.lit(i).alias("lookup"), "target")
        every = one if every is None else every.unionByName(one)
    lists = [F.collect_list(F.when(F.col("lookup") == i, F.struct("target"))).alias(f"__targets_{i}") for i in range(len(lookups))]
    return every.groupBy("__code").agg(*lists)


def _dictionary(df: DataFrame, places: Mapping[tuple[str, str], int], sources: Mapping[str, DataFrame] | None) -> DataFrame:
    """(__code): the codes of every source column, from the sources as they are where given, else from ``df``.

    The sources may hold codes that ``df`` has lost to a join; these map to targets that no row asks for.
    """
    every = None
    for (alias, column), n in places.items():
        rows, name = (sources[alias], f"`{column}`") if sources and alias in sources else (df, f"`{alias}`.`{column}`")
        one = rows.select(F.concat(F.lit(f"{n}:"), F.col(name).cast("string")).alias("__code"))
        every = one if every is None else every.unionByName(one)
    return every.where(F.col("__code").isNotNull()).distinct()


def apply_lookups(
    df: DataFrame,
    lookups: Sequence[Lookup],
    vocab: Vocabulary,
    broadcast_bytes: int | None = None,
    fraction: float = 0.01,
    sources: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Add one concept id column per lookup; no match gives the lookup's fallback.

    Several targets for a code give several rows, for every combination of lookups. With ``broadcast_bytes`` the
    mapping is measured by a job, and joined with hot keys spread where it is larger. ``sources`` are the frames that
    ``df`` was joined from, by alias: a dictionary of codes is taken from them, so that the join is done once.
    """
    if not lookups:
        return df
    places: dict[tuple[str, str], int] = {}
    for x in lookups:
        places.setdefault((x.source_alias, x.source_column), len(places))
    raw = {n: F.concat(F.lit(f"{n}:"), F.col(f"`{alias}`.`{column}`").cast("string")) for (alias, column), n in places.items()}
    bound = mapping_bytes(vocab, lookups) if broadcast_bytes is None else 0
    codes = None
    if bound is None or bound > BROADCAST_BYTES:
        codes = _dictionary(df, places, sources)
    mapping = _mapping(vocab, lookups, places, codes)
    out = df
    for n, code in raw.items():
        here = [i for i, x in enumerate(lookups) if places[x.source_alias, x.source_column] == n]
        side = mapping.select(F.col("__code").alias(f"__code_{n}"), *[f"__targets_{i}" for i in here])
        if broadcast_bytes is not None:
            out = attach(out, side, [(code, F.col(f"__code_{n}"))], "left", broadcast_bytes, fraction=fraction)
        else:
            out = out.join(F.broadcast(side) if codes is None else side, code == F.col(f"__code_{n}"), "left")
        out = out.drop(f"__code_{n}")
    for i in range(len(lookups)):
        out = out.withColumn(f"__target_{i}", F.explode_outer(f"__targets_{i}")).drop(f"__targets_{i}")
    for i, x in enumerate(lookups):
        out = out.withColumn(x.target_column, F.coalesce(F.col(f"__target_{i}.target"), F.lit(x.fallback)))
    return out.drop(*[f"__target_{i}" for i in range(len(lookups))])
