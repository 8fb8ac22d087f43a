"""Numbers about source tables and finished tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.model.vocabulary import Vocabulary
from cdmloom.operators.lookups import Lookup, lookup_targets

# Fixed value: codes and key groups shown in a report.
TOP = 20


def code_frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per code; NULL is a group of its own."""
    return df.groupBy(F.col(column).cast("string").alias("code")).agg(
        F.count(F.lit(1)).alias("n")
    )


def ranked_codes(df: DataFrame, column: str) -> DataFrame:
    """Codes by falling frequency."""
    return code_frequency(df, column).orderBy(F.desc("n"), "code")


def top_codes(df: DataFrame, column: str, top: int = TOP) -> DataFrame:
    return ranked_codes(df, column).limit(top)


# Fixed value: positions of one bitmap of the engine.
BITMAP = 32768
#: A whole-number column is dense if its span is at most so many times its rows.
SPAN_PER_ROW = 16

_WHOLE = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "boolean")


def _as_long(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    if kind == "date":
        return F.unix_date(column).cast("long")
    if kind == "timestamp_ntz":
        return F.unix_micros(column.cast("timestamp"))
    if kind == "timestamp":
        return F.unix_micros(column)
    return column.cast("long")


def dense_columns(df: DataFrame, span_per_row: int = SPAN_PER_ROW) -> list[str]:
    """Columns of whole numbers that fill their span well enough for bitmaps; one job over these columns."""
    whole = [(n, k) for n, k in df.dtypes if k in _WHOLE and not k.startswith("timestamp")]
    if not whole:
        return []
    numbers = [_as_long(n, k).alias(str(i)) for i, (n, k) in enumerate(whole)]
    cells = [F.struct(F.count(str(i)).alias("n"), F.min(str(i)).alias("low"), F.max(str(i)).alias("high")).alias(str(i)) for i in range(len(whole))]
    ranges = df.select(*numbers).agg(*cells).first()
    return [n for (n, _), r in zip(whole, ranges) if r["n"] and r["high"] - r["low"] < max(BITMAP, span_per_row * r["n"])]


def column_profile(df: DataFrame, dense: Sequence[str] = ()) -> DataFrame:
    """Rows, NULLs and distinct values per column.

    Values are counted per (column, value) with partial aggregation first, so a frequent value costs nothing
    extra and no task sees all values of a column. Whole numbers, days and times are grouped as such, other
    values by 128 bits of hashes, so no text is shuffled. The columns named by ``dense`` (see
    :func:`dense_columns`) are counted in bitmaps, one for each 32,768 neighbouring numbers that occur.
    """
    kinds = dict(df.dtypes)
    if unfit := [c for c in dense if kinds.get(c) not in _WHOLE]:
        raise ValueError(f"no columns of whole numbers: {unfit}")
    sums = [F.sum("n").alias("row_count"), F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("null_count"), F.sum("found").alias("distinct_count")]
    parts = []
    number = {c: F.lit(i) for i, c in enumerate(df.columns)}
    if sparse := [c for c in df.columns if c not in dense]:
        cells = []
        for c in sparse:
            column = F.col(f"`{c}`")
            whole = kinds[c] in _WHOLE
            a = _as_long(c, kinds[c]) if whole else F.when(column.isNotNull(), F.xxhash64(column))
            b = F.lit(None).cast("long") if whole else F.when(column.isNotNull(), F.xxhash64(F.lit("second"), column))
            cells.append(F.struct(number[c].alias("c"), a.alias("a"), b.alias("b")))
        per_value = df.select(F.inline(F.array(*cells))).groupBy("c", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_value.select("c", "n", F.col("a").isNull().alias("missing"), F.when(F.col("a").isNull(), 0).otherwise(1).cast("long").alias("found")))
    if dense:
        cells = F.array(*[F.struct(number[c].alias("c"), _as_long(c, kinds[c]).alias("a")) for c in dense])
        bits = (
            df.select(F.inline(cells))
            .groupBy("c", F.bitmap_bucket_number("a").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position("a")).alias("bits"))
        )
        missing = F.col("bucket").isNull()
        parts.append(bits.select("c", "n", missing.alias("missing"), F.when(missing, 0).otherwise(F.bitmap_count("bits")).cast("long").alias("found")))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    names = F.array(*[F.lit(c) for c in df.columns])
    return every.groupBy("c").agg(*sums).select(F.get(names, F.col("c")).alias("column_name"), "row_count", "null_count", "distinct_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str], top: int = TOP) -> DataFrame:
    """The first key groups that occur more than once; NULL keys group together."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .orderBy(*keys)
        .limit(top)
    )


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL rows, total rows and NULL share of several columns in one pass."""
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns],
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count"))
            for c in columns
        ]
    )
    return wide.select("__rows", F.inline(cells)).select(
        "column_name",
        "null_count",
        F.col("__rows").alias("row_count"),
        F.round(F.col("null_count") / F.greatest("__rows", F.lit(1)), 6).alias("null_rate"),
    )


def resolution_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a known (non-zero) concept per column, in one pass."""
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{c}`") != 0).alias(c) for c in columns],
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("resolved"))
            for c in columns
        ]
    )
    return wide.select("__rows", F.inline(cells)).select(
        "column_name",
        F.col("__rows").alias("row_count"),
        "resolved",
        F.round(F.col("resolved") / F.greatest("__rows", F.lit(1)), 6).alias("resolved_rate"),
    )


def vocabulary_versions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Loaded version per vocabulary, two loads side by side."""
    b = before.select("vocabulary_id", F.col("vocabulary_version").alias("version_before"))
    a = after.select("vocabulary_id", F.col("vocabulary_version").alias("version_after"))
    return b.join(a, "vocabulary_id", "full_outer").withColumn(
        "changed", ~F.col("version_before").eqNullSafe(F.col("version_after"))
    )


def concept_distribution_diff(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Rows per concept before and after a refresh, where they differ or not."""
    b = before.groupBy(F.col(column).alias("concept_id")).agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.groupBy(F.col(column).alias("concept_id")).agg(F.count(F.lit(1)).alias("rows_after"))
    same = F.col("b.concept_id").eqNullSafe(F.col("a.concept_id"))
    return (
        b.alias("b")
        .join(a.alias("a"), same, "full_outer")
        .select(
            F.coalesce("b.concept_id", "a.concept_id").alias("concept_id"),
            F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
            F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        )
        .withColumn("difference", F.col("rows_after") - F.col("rows_before"))
    )


def code_distribution_diff(df: DataFrame, lookup: Lookup, before: Vocabulary, after: Vocabulary) -> DataFrame:
    """The same report for one lookup over a source column, from counts per code: facts are read once.

    Both vocabularies map the codes that occur, side by side, so neither facts nor results of a lookup are joined.
    """
    counted = df.groupBy(F.col(f"`{lookup.source_column}`").cast("string").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    sides, fallback = (("before", before), ("after", after)), F.array(F.lit(lookup.fallback).cast("int"))
    for name, vocab in sides:
        found = lookup_targets(vocab, lookup).groupBy("code").agg(F.collect_list(F.col("target").cast("int")).alias(name))
        counted = counted.join(found, "code", "left").withColumn(name, F.coalesce(F.when(F.size(name) > 0, F.col(name)), fallback))
    zero = F.lit(0).cast("long")

    def rows_of(side: str) -> Column:
        counts = [(F.col("n") if side == name else zero).alias(f"rows_{name}") for name, _ in sides]
        return F.transform(side, lambda t: F.struct(t.alias("concept_id"), *counts))

    cells = [rows_of(name) for name, _ in sides]
    return (
        counted.select(F.inline(F.concat(*cells)))
        .groupBy("concept_id")
        .agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))
        .withColumn("difference", F.col("rows_after") - F.col("rows_before"))
    )


def join_fanout_check(
    left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str]
) -> DataFrame:
    """Left rows by number of partners: ``none``, ``one`` or ``many``.

    Both sides are counted per key before they meet, so the join itself never multiplies rows.
    """
    names = [f"k{i}" for i in range(len(left_keys))]
    lk = [F.col(c).alias(n) for c, n in zip(left_keys, names)]
    rk = [F.col(c).alias(n) for c, n in zip(right_keys, names)]
    l_counts = left.groupBy(*lk).agg(F.count(F.lit(1)).alias("left_rows"))
    r_counts = right.groupBy(*rk).agg(F.count(F.lit(1)).alias("partners"))
    partners = F.coalesce("partners", F.lit(0))
    return (
        l_counts.join(r_counts, names, "left")
        .groupBy(
            F.when(partners == 0, "none").when(partners == 1, "one").otherwise("many").alias(
                "partners"
            )
        )
        .agg(
            F.count(F.lit(1)).alias("key_count"),
            F.sum("left_rows").alias("left_rows"),
            F.sum(F.col("left_rows") * F.greatest(partners, F.lit(1))).alias("joined_rows"),
        )
    )


# Fixed value: width that the standard gives the *_source_value columns.
SOURCE_VALUE_CHARS = 50


def long_source_values(df: DataFrame, width: int = SOURCE_VALUE_CHARS) -> DataFrame:
    """Per ``*_source_value`` column: values longer than the standard's width, which are kept whole, and the longest."""
    columns = [c for c in df.columns if c.endswith("_source_value")]
    wide = df.agg(
        *[F.count_if(F.length(c) > width).alias(f"n_{c}") for c in columns], *[F.max(F.length(c)).alias(f"m_{c}") for c in columns]
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("over_long"), F.col(f"m_{c}").alias("longest")) for c in columns]
    return wide.select(F.inline(F.array(*rows)))
