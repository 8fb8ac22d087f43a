"""Loading the vocabulary bundle: ten tab-separated files with a header."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdmloom.functions.values import blank_to_null
from cdmloom.model.vocabulary import VOCABULARY_TABLES, Vocabulary
from cdmloom.sources.tables import commits, group_sizes, read_target, table_sizes, write_target, write_version

# Fixed value: tables a load must not leave empty.
REQUIRED_TABLES = ("concept", "concept_relationship")


def cast_to_schema(df: DataFrame, shape: StructType) -> DataFrame:
    """The columns of ``shape`` by name; a value that is no such type becomes NULL."""
    return df.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in shape.fields]
    )


#: Where a line goes that has not as many fields as the header names.
BAD_LINE = "__bad_line"


def read_raw(spark: SparkSession, path: str) -> DataFrame | None:
    """One file as text columns, or None where it is missing.

    Lines are cut at tabs, as quotes are ordinary characters here: concept names contain unbalanced ones. Every part of
    the file begins with the header; a blank field is NULL and a blank line nothing. A line with too few or too
    many fields is kept whole in a further column, ``BAD_LINE``, which is NULL for all others.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    header = (lines.first() or [""])[0]
    names = header.split("\t")
    fields = F.split("value", "\t", -1)
    given = lines.where((F.trim("value") != "") & (F.col("value") != header)).select("value", fields.alias("fields"))
    columns = [F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    return given.select(*columns, F.when(F.size("fields") != len(names), F.col("value")).alias(BAD_LINE))


def _checked(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """The raw file, or None where it is missing. A file that lacks columns is an error."""
    raw = read_raw(spark, path)
    lacking = [] if raw is None else [c for c in VOCABULARY_TABLES[table].names if c not in raw.columns]
    if lacking:
        raise ValueError(f"{path}: the file for {table} lacks {', '.join(lacking)}")
    return raw


def read_vocabulary_file(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """One file as its typed table, or None where it is missing. A file that lacks columns is an error.

    A blank ``invalid_reason`` or ``standard_concept`` means NULL. Lines that do not fit the header are left out
    and found by :func:`quarantined_lines`.
    """
    shape = VOCABULARY_TABLES[table]
    raw = _checked(spark, path, table)
    if raw is None:
        return None
    typed = cast_to_schema(raw.where(F.col(BAD_LINE).isNull()), shape)
    for flag in ("invalid_reason", "standard_concept"):
        if flag in typed.columns:
            typed = typed.withColumn(flag, blank_to_null(F.col(flag)))
    return typed


def _line_kind(raw: DataFrame) -> Column:
    """``short`` or ``long`` for a line that does not fit, NULL for others."""
    fields = F.length(F.col(BAD_LINE)) - F.length(F.replace(F.col(BAD_LINE), F.lit("\t"), F.lit(""))) + 1
    return F.when(F.col(BAD_LINE).isNotNull(), F.when(fields < len(raw.columns) - 1, "short").otherwise("long"))


def quarantined_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, kind, line): the lines of all vocabulary files that have too few or too many fields, as they are.

    Store it beside the tables to keep what a load left out.
    """
    out = spark.createDataFrame([], "table_name STRING, kind STRING, line STRING")
    for table in VOCABULARY_TABLES:
        raw = _checked(spark, f"{folder.rstrip('/')}/{table.upper()}.csv", table)
        if raw is not None:
            bad = raw.select(F.lit(table).alias("table_name"), _line_kind(raw).alias("kind"), F.col(BAD_LINE).alias("line"))
            out = out.unionByName(bad.where(F.col("line").isNotNull()))
    return out


def load_vocabulary(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All vocabulary tables under ``folder``; a missing file gives an empty table."""
    out = {}
    for table, shape in VOCABULARY_TABLES.items():
        read = read_vocabulary_file(spark, f"{folder.rstrip('/')}/{table.upper()}.csv", table)
        out[table] = spark.createDataFrame([], shape) if read is None else read
    return out


def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Every vocabulary table with its status, OK or SKIP for a missing file, and its rows.

    ``bad_values`` counts texts that are no value of their column's type and became NULL, ``short_lines`` and ``long_lines``
    the lines with too few and too many fields, which are no rows of the table.
    """
    out = None
    for table, shape in VOCABULARY_TABLES.items():
        raw = _checked(spark, f"{folder.rstrip('/')}/{table.upper()}.csv", table)
        counts = ("row_count", "bad_values", "short_lines", "long_lines")
        if raw is None:
            one = spark.range(1).select(*[F.lit(0).cast("long").alias(c) for c in counts])
        else:
            fits, kind = F.col(BAD_LINE).isNull(), _line_kind(raw)
            bad = [
                F.count_if(fits & F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
                for f in shape.fields
            ]
            total = bad[0]
            for b in bad[1:]:
                total = total + b
            one = raw.agg(F.count_if(fits), total, F.count_if(kind == "short"), F.count_if(kind == "long")).toDF(*counts)
        one = one.select(F.lit(table).alias("table_name"), F.lit("SKIP" if raw is None else "OK").alias("status"), *counts)
        out = one if out is None else out.unionByName(one)
    return out


# Columns the stored tables are laid out by, so lookups skip most row groups.
STORED_ORDER = {
    "concept": ("vocabulary_id", "concept_code"),
    "concept_relationship": ("relationship_id", "concept_id_1"),
    "source_to_concept_map": ("source_vocabulary_id", "source_code"),
}


# Text whose length bounds a mapping made from the table.
CODE_TEXT = {"concept": "concept_code", "concept_relationship": None, "source_to_concept_map": "source_code"}


def store_vocabulary(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Replace the tables under ``folder`` by a new load and read them back."""
    out = {}
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        order = STORED_ORDER.get(name)
        if not order:
            out[name] = write_target(df, path)
            continue
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        sizes = partial(group_sizes, by=order[0], text=CODE_TEXT[name])
        out[name] = write_version(df.sparkSession, path, df.write.parquet, sizes)
    return out


def stored_sizes(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, dict[str, list[int]]]:
    """The sizes in the logs of stored tables, for :class:`Vocabulary`; tables stored without sizes are left out."""
    found = {name: table_sizes(spark, path) for name, path in paths.items()}
    return {name: sizes for name, sizes in found.items() if sizes is not None}


def stored_vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    """The vocabulary that :func:`store_vocabulary` left under ``folder``, with its sizes, and the crosswalk if there is one."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in (*STORED_ORDER, "crosswalk")}
    frames = {name: read_target(spark, path) for name, path in paths.items() if commits(spark, path)}
    return Vocabulary(**frames, sizes=stored_sizes(spark, paths))


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out


def require_non_empty(
    tables: Mapping[str, DataFrame], required: Iterable[str] = REQUIRED_TABLES
) -> DataFrame:
    """Row counts of the required tables; raises naming those that are empty."""
    counts = table_row_counts({t: tables[t] for t in required})
    empty = sorted(r["table_name"] for r in counts.filter("row_count = 0").collect())
    if empty:
        raise RuntimeError(f"vocabulary load failed, no rows in: {', '.join(empty)}")
    return counts


def union_license_gated(concept: DataFrame, gated: DataFrame) -> DataFrame:
    """Concepts plus the separately licensed ones, one row per id, ``concept`` first.

    An aggregate with partial results on the map side, so no id gathers its copies in one task.
    """
    fields = [F.col(c) for c in concept.columns]
    both = concept.select(F.lit(0).alias("__rank"), *fields).unionByName(
        gated.select(F.lit(1).alias("__rank"), *fields)
    )
    rest = [c for c in concept.columns if c != "concept_id"]
    best = F.min(F.struct("__rank", *rest)).alias("__best")
    return (
        both.groupBy("concept_id")
        .agg(best)
        .select("concept_id", *[F.col(f"__best.{c}").alias(c) for c in rest])
        .select(*concept.columns)
    )
