"""Five layers of checks on finished tables; every result is a findings DataFrame.

Findings are rows (table_name, layer, status, check, message). What a schema alone
tells is decided on the driver. The rest comes from three scans per table: one
aggregate for NULLs, one group count of the key, and one count per distinct
concept id that serves layers 3 and 4. The concept counts of all tables meet the
concept table in a single join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdmloom.model.cdm import CDM, Column
from cdmloom.operators.profiling import TOP, duplicate_keys
from cdmloom.operators.spread import BROADCAST_BYTES, attach
from cdmloom.sources.tables import write_target

FINDING = "table_name STRING, layer INT, status STRING, check STRING, message STRING"

# Spark types accepted for each declared type.
ACCEPTED_TYPES = {
    "INT": ("int", "bigint", "smallint", "tinyint", "decimal"),
    "BIGINT": ("bigint",),
    "STRING": ("string", "varchar", "char"),
    "DATE": ("date",),
    "TIMESTAMP": ("timestamp", "timestamp_ntz"),
    "FLOAT": ("float", "double"),
}

# Messages of the checks.
MSG_TABLE_MISSING = "table does not exist"
MSG_MISSING = "missing column: {0}"
MSG_EXTRA = "extra column not in spec: {0}"
MSG_TYPE = "{0}: expected ~{1}, got {2}"
MSG_SCHEMA_OK = "column names and coarse types align with spec"
MSG_PK_SKIP = "PK columns missing from actual table (Layer 1)"
MSG_PK_OK = "no duplicate primary keys"
MSG_PK_BAD = "duplicate PK groups (showing up to 20): "
MSG_COLUMN_SKIP = "column not in actual table (Layer 1)"
MSG_TABLE_SKIP = "table missing from actual catalog (Layer 1)"
MSG_FK_BAD = "%s: %d rows with concept_id not in reference.concept"
MSG_FK_OK = "all non-null non-zero concept_ids resolve to reference.concept"
MSG_FK_ALL_SKIPPED = "all concept_id checks skipped (every concept column missing per Layer 1)"
MSG_DOMAIN_BAD = "%s: %d rows with domain_id <> %s"
MSG_DOMAIN_OK = "domain checks for annotated concept columns"
MSG_DOMAIN_ALL_SKIPPED = (
    "all domain checks skipped (every annotated concept column missing per Layer 1)"
)
MSG_NULL_BAD = "%s: %d NULL rows (%.2f%% of %d)"
MSG_NULL_OK = "required (non-nullable) columns have no NULLs"
SOME_SKIPPED = " (some skipped per Layer 1)"

LAYERS = (1, 2, 3, 4, 5)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _names(df: DataFrame | None) -> set[str]:
    return set() if df is None else {c.lower() for c in df.columns}


def _split(found: set[str], wanted: Sequence[Column]) -> tuple[list[Column], list[Column]]:
    present = [c for c in wanted if c.name.lower() in found]
    return present, [c for c in wanted if c.name.lower() not in found]


def _text(value: str | None) -> str:
    return "cast(null as string)" if value is None else "'" + value.replace("'", "\\'") + "'"


def _cells(rows: Sequence[Mapping[str, str]]) -> str:
    """SQL turning one row into several: one struct of expressions per entry."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in r.items()) + ")" for r in rows
    )
    return f"inline(array({structs}))"


def schema_findings(
    table: str, actual: StructType | None, spec: Mapping[str, Sequence[Column]] = CDM
) -> list[tuple]:
    """Layer 1 from the schema alone, as finding tuples."""
    columns = spec[table]
    found = {f.name.lower(): f.dataType.simpleString() for f in actual.fields} if actual else {}
    out = []
    if not found:
        out.append((table, 1, "FAIL", "schema:table_missing", MSG_TABLE_MISSING))
    names = {c.name.lower() for c in columns}
    for c in sorted(names - set(found)):
        out.append((table, 1, "FAIL", f"schema:missing:{c}", MSG_MISSING.format(c)))
    for c in sorted(set(found) - names):
        out.append((table, 1, "WARN", f"schema:extra:{c}", MSG_EXTRA.format(c)))
    for c in columns:
        got = found.get(c.name.lower())
        if got and got.split("(")[0] not in ACCEPTED_TYPES[c.type]:
            out.append(
                (table, 1, "FAIL", f"schema:type:{c.name}", MSG_TYPE.format(c.name, c.type, got))
            )
    return out or [(table, 1, "PASS", "schema", MSG_SCHEMA_OK)]


def _column_layer(
    table: str, layer: int, name: str, present: Sequence, absent: Sequence, ok: str, all_skipped: str
) -> list[tuple]:
    """SKIP rows of a layer, and its PASS row, which stands unless a column fails."""
    rows = [(table, layer, "SKIP", f"{name}:{c.name}", MSG_COLUMN_SKIP) for c in absent]
    if absent and not present:
        return [*rows, (table, layer, "SKIP", name, all_skipped)]
    return [*rows, (table, layer, "PASS", name, ok + (SOME_SKIPPED if absent else ""))]


def _key_failures(table: str, df: DataFrame, keys: Sequence[str], check: str) -> DataFrame:
    """One row when key groups repeat, showing the first of them."""
    parts = ", ".join(f"coalesce(cast(`{k}` as string), 'NULL')" for k in keys)
    at = ", ".join(f"`{k}`" for k in keys)
    return (
        duplicate_keys(df, keys, TOP)
        .selectExpr(f"struct({at}) as at", f"concat('[', concat_ws(', ', {parts}, n), ']') as shown")
        .selectExpr("array_sort(collect_list(struct(at, shown))).shown as shown")
        .filter("size(shown) > 0")
        .selectExpr(
            f"{_text(table)} as table_name",
            "2 as layer",
            f"{_text(check)} as check",
            f"concat({_text(MSG_PK_BAD)}, array_join(shown, ', ')) as message",
        )
    )


def _null_failures(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = [f"count_if(`{c}` is null) as `null_{c}`" for c in columns]
    cells = [{"name": _text(c), "n": f"`null_{c}`"} for c in columns]
    return (
        df.selectExpr("count(1) as total", *counts)
        .selectExpr("total", _cells(cells))
        .filter("n > 0")
        .selectExpr(
            f"{_text(table)} as table_name",
            "5 as layer",
            "concat('not_null:', name) as check",
            f"format_string({_text(MSG_NULL_BAD)}, name, n, bround(n * 100.0D / total, 2), total) as message",
        )
    )


def concept_usage(table: str, df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Rows per (column, concept id) over several columns in one scan; NULL and 0 left out."""
    cells = [
        {
            "column_name": _text(c.name),
            "domain": _text(c.domain),
            "concept_id": f"cast(`{c.name}` as bigint)",
        }
        for c in columns
    ]
    return (
        df.selectExpr(_cells(cells))
        .filter("concept_id <> 0")
        .groupBy("column_name", "domain", "concept_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("table_name", F.lit(table))
    )


def _concept_failures(
    usages: Sequence[DataFrame], concept: DataFrame, layers: Sequence[int]
) -> DataFrame:
    """Failing columns of layers 3 and 4 for all tables together."""
    known = concept.selectExpr("cast(concept_id as bigint) as concept_id", "domain_id", "true as known")
    checks = {
        3: {"check": "concat('concept_fk:', column_name)", "n": "unknown",
            "message": f"format_string({_text(MSG_FK_BAD)}, column_name, unknown)"},
        4: {"check": "concat('domain:', column_name)", "n": "misplaced",
            "message": f"format_string({_text(MSG_DOMAIN_BAD)}, column_name, misplaced, domain)"},
    }
    cells = [{"layer": str(n), **checks[n]} for n in layers]
    return (
        _union(usages)
        .join(known, "concept_id", "left")
        .groupBy("table_name", "column_name", "domain")
        .agg(
            F.expr("sum(if(known is null, n, 0)) as unknown"),
            F.expr("sum(if(domain_id <> domain, n, 0)) as misplaced"),
        )
        .selectExpr("table_name", _cells(cells))
        .filter("n > 0")
        .drop("n")
    )


def findings(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    concept: DataFrame | None = None,
    spec: Mapping[str, Sequence[Column]] = CDM,
    layers: Sequence[int] = LAYERS,
) -> DataFrame:
    """Findings of the wanted layers; a table given as ``None`` was not built.

    Columns that layer 1 finds missing are skipped by the others.
    """
    told: list[tuple] = []
    failures: list[DataFrame] = []
    usages: list[DataFrame] = []
    for table, df in sorted(tables.items()):
        found, columns = _names(df), spec[table]
        if 1 in layers:
            told += schema_findings(table, df.schema if df is not None else None, spec)
        if 2 in layers:
            keys = [c for c in columns if c.pk]
            check = f"pk_uniqueness:{', '.join(c.name for c in keys)}"
            present, _ = _split(found, keys)
            if present:
                told.append((table, 2, "PASS", check, MSG_PK_OK))
                failures.append(_key_failures(table, df, [c.name for c in present], check))
            else:
                told.append((table, 2, "SKIP", check, MSG_PK_SKIP))
        if 3 in layers or 4 in layers:
            concepts = [c for c in columns if c.name.endswith("_concept_id")]
            if 3 in layers:
                told += _column_layer(
                    table, 3, "concept_fk", *_split(found, concepts), MSG_FK_OK, MSG_FK_ALL_SKIPPED
                )
            if 4 in layers:
                placed = [c for c in concepts if c.domain]
                told += _column_layer(
                    table, 4, "domain", *_split(found, placed), MSG_DOMAIN_OK, MSG_DOMAIN_ALL_SKIPPED
                )
                concepts = concepts if 3 in layers else placed
            present, _ = _split(found, concepts)
            if present:
                usages.append(concept_usage(table, df, present))
        if 5 in layers and not _split(found, columns)[0]:
            told.append((table, 5, "SKIP", "not_null", MSG_TABLE_SKIP))
        elif 5 in layers:
            present, absent = _split(found, [c for c in columns if c.required])
            told += [(table, 5, "SKIP", f"not_null:{c.name}", MSG_COLUMN_SKIP) for c in absent]
            told.append((table, 5, "PASS", "not_null", MSG_NULL_OK + (SOME_SKIPPED if absent else "")))
            if present:
                failures.append(_null_failures(table, df, [c.name for c in present]))
    if usages:
        failures.append(_concept_failures(usages, concept, [n for n in (3, 4) if n in layers]))

    rows = spark.createDataFrame(told, FINDING)
    if not failures:
        return rows
    failed = _union(failures).withColumn("status", F.lit("FAIL"))
    # A PASS row gives way to the failures of its layer; a layer has at most one row per column.
    return (
        rows.unionByName(failed)
        .groupBy("table_name", "layer")
        .agg(
            F.expr("collect_list(struct(status, check, message)) as found"),
            F.expr("count_if(status = 'FAIL') > 0 as bad"),
        )
        .selectExpr(
            "table_name", "layer", "inline(filter(found, f -> not (bad and f.status = 'PASS')))"
        )
    )


def check_schema(
    spark: SparkSession, table: str, df: DataFrame | None, spec: Mapping[str, Sequence[Column]] = CDM
) -> DataFrame:
    """Layer 1: missing, extra and mistyped columns."""
    return findings(spark, {table: df}, None, spec, (1,))


def check_primary_key(
    spark: SparkSession, table: str, df: DataFrame | None, spec: Mapping[str, Sequence[Column]] = CDM
) -> DataFrame:
    """Layer 2: duplicate key groups, at most 20 of them as examples; NULL keys group together."""
    return findings(spark, {table: df}, None, spec, (2,))


def check_concept_fk(
    spark: SparkSession,
    table: str,
    df: DataFrame | None,
    concept: DataFrame,
    spec: Mapping[str, Sequence[Column]] = CDM,
) -> DataFrame:
    """Layer 3: concept ids the concept table does not know; NULL and 0 are exempt."""
    return findings(spark, {table: df}, concept, spec, (3,))


def check_domain(
    spark: SparkSession,
    table: str,
    df: DataFrame | None,
    concept: DataFrame,
    spec: Mapping[str, Sequence[Column]] = CDM,
) -> DataFrame:
    """Layer 4: known concepts of another domain than the column declares."""
    return findings(spark, {table: df}, concept, spec, (4,))


def check_not_null(
    spark: SparkSession, table: str, df: DataFrame | None, spec: Mapping[str, Sequence[Column]] = CDM
) -> DataFrame:
    """Layer 5: NULLs in required columns."""
    return findings(spark, {table: df}, None, spec, (5,))


def validate_table(
    spark: SparkSession,
    table: str,
    df: DataFrame | None,
    concept: DataFrame,
    spec: Mapping[str, Sequence[Column]] = CDM,
) -> DataFrame:
    """All five layers on one table."""
    return findings(spark, {table: df}, concept, spec)


def validate_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    concept: DataFrame,
    spec: Mapping[str, Sequence[Column]] = CDM,
) -> DataFrame:
    """Every table of the spec, ordered by table, layer and check."""
    every = {t: tables.get(t) for t in spec}
    return findings(spark, every, concept, spec).orderBy("table_name", "layer", "check")


def finding_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _expected_columns(spec: Mapping[str, Sequence[Column]]) -> list[tuple[str, int, int]]:
    """How many columns each layer is to look at."""
    out = []
    for table, columns in spec.items():
        concepts = [c for c in columns if c.name.endswith("_concept_id")]
        wanted = (columns, [c for c in columns if c.pk], concepts, [c for c in concepts if c.domain], [c for c in columns if c.required])
        out += [(table, layer, len(some)) for layer, some in zip(LAYERS, wanted)]
    return out


def layer_summary(
    found: DataFrame,
    tables: Mapping[str, DataFrame | None] | None = None,
    spec: Mapping[str, Sequence[Column]] = CDM,
) -> DataFrame:
    """Per table and layer: findings by status, columns by what became of them, and whether the layer failed.

    Of the columns the spec expects of a layer some are checked, the others skipped because layer 1 misses them;
    ``failed_columns`` counts columns with a failure, for layer 2 the key as one. ``missing_columns``, ``mistyped_columns``,
    ``extra_columns`` and ``aligned_columns`` belong to layer 1. ``table_rows`` needs the ``tables``
    and is NULL for one that was not given. Layer 1 fails on extra columns too, although those are only warnings.
    """
    spark = found.sparkSession
    status, check = F.col("status"), F.col("check")
    counts = {n: status == s for s, n in {"FAIL": "failed", "WARN": "warned", "SKIP": "skipped", "PASS": "passed"}.items()}
    counts |= {f"{n}_columns": check.startswith(f"schema:{k}:") for n, k in {"missing": "missing", "mistyped": "type", "extra": "extra"}.items()}
    of_column = check.contains(":")
    counts["failed_columns"] = (status == "FAIL") & of_column & (check != "schema:table_missing")
    counts["__gone"] = (status == "SKIP") & of_column
    counts["__no_table"] = (status == "SKIP") & (check == "not_null")
    expected = spark.createDataFrame(_expected_columns(spec), "table_name STRING, layer INT, expected_columns INT")
    n, missing, mistyped = (F.col(f"{c}_columns") for c in ("expected", "missing", "mistyped"))
    first = F.col("layer") == 1
    out = (
        found.groupBy("table_name", "layer")
        .agg(*[F.count_if(when).alias(name) for name, when in counts.items()])
        .join(F.broadcast(expected), ["table_name", "layer"])
        .withColumn("skipped_columns", F.when(F.col("__no_table") > 0, n).when(first, missing).otherwise(F.col("__gone")))
        .withColumn("checked_columns", n - F.col("skipped_columns"))
        .withColumn("aligned_columns", F.when(first, n - missing - mistyped))
        .withColumn("layer_failed", (F.col("failed") > 0) | (first & (F.col("warned") > 0)))
        .drop("__gone", "__no_table")
    )
    given = {t: df for t, df in (tables or {}).items() if df is not None}
    if not given:
        return out.withColumn("table_rows", F.lit(None).cast("bigint"))
    rows = _union([df.agg(F.count(F.lit(1)).alias("table_rows")).withColumn("table_name", F.lit(t)) for t, df in given.items()])
    return out.join(F.broadcast(rows), "table_name", "left")


def gate_on_findings(found: DataFrame, path: str | None = None) -> DataFrame:
    """The findings again; raises when any of them is a failure.

    With a ``path`` they are stored there first, as the next version: the gate reads the stored
    rows, so the checks run once, and a failed gate leaves its findings to be read.
    """
    if path is not None:
        found = write_target(found, path)
    failed = found.filter(F.col("status") == "FAIL").count()
    if failed:
        raise RuntimeError(f"{failed} conformance checks failed")
    return found


def anti_concept_fk(
    df: DataFrame, column: str, concept: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows whose concept id is neither NULL, 0 nor known.

    Distinct ids are looked up first; only the unknown ones are joined back to the rows.
    """
    used = df.select(F.col(column).cast("bigint").alias("__bad")).filter("__bad != 0").distinct()
    known = concept.select(F.col("concept_id").cast("bigint").alias("__bad"))
    unknown = used.join(known, "__bad", "left_anti")
    pairs = [(F.col(column).cast("bigint"), F.col("__bad"))]
    return attach(df, unknown, pairs, "inner", broadcast_bytes).drop("__bad")


def check_table_fk(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    spec: Mapping[str, Sequence[Column]] = CDM,
) -> DataFrame:
    """Rows whose reference to another target table dangles, per reference.

    One scan per table counts all its references per distinct id; the counts of
    all tables then meet the keys of all parents in a single join. References and
    parents go by number until the end, so what is grouped and moved holds no text.
    """
    checks: list[tuple] = []
    usages: list[DataFrame] = []
    parents: dict[str, tuple[int, str]] = {}
    for table, df in sorted(tables.items()):
        cells = []
        for c in _split(_names(df), spec[table])[0]:
            parent, _, key = (c.fk or "concept.").partition(".")
            if parent in tables:
                at = parents.get(parent, (len(parents), key))[0]
                parents[parent] = (at, key)
                cells.append({"ref": str(len(checks)), "parent": str(at), "id": f"cast(`{c.name}` as bigint)"})
                checks.append((len(checks), table, c.name, parent))
        if cells:
            usages.append(
                df.selectExpr(_cells(cells))
                .filter("id is not null")
                .groupBy("ref", "parent", "id")
                .agg(F.count(F.lit(1)).alias("n"))
            )
    wanted = spark.createDataFrame(checks, "ref INT, table_name STRING, column_name STRING, parent STRING")
    none = {"dangling_ids": 0, "dangling_rows": 0}
    if not usages:
        return wanted.drop("ref").withColumns({c: F.lit(n).cast("bigint") for c, n in none.items()})
    keys = _union(
        [tables[p].selectExpr(f"{at} as parent", f"cast(`{k}` as bigint) as id") for p, (at, k) in parents.items()]
    )
    lost = (
        _union(usages)
        .join(keys, ["parent", "id"], "left_anti")
        .groupBy("ref")
        .agg(F.count(F.lit(1)).alias("dangling_ids"), F.sum("n").alias("dangling_rows"))
    )
    return wanted.join(lost, "ref", "left").drop("ref").na.fill(none)


def standard_rate(df: DataFrame, columns: Sequence[str], concept: DataFrame) -> DataFrame:
    """Share of non-zero concept ids that are standard concepts, per column."""
    flags = concept.select(
        F.col("concept_id").cast("bigint").alias("concept_id"),
        (F.col("standard_concept") == "S").alias("standard"),
    )
    standard = F.sum(F.when(F.col("standard"), F.col("n")).otherwise(0))
    return (
        concept_usage("", df, [Column(c, "INT") for c in columns])
        .join(flags, "concept_id", "left")
        .groupBy("column_name")
        .agg(F.sum("n").alias("used_rows"), standard.alias("standard_rows"))
        .withColumn("standard_rate", F.round(F.col("standard_rows") / F.col("used_rows"), 6))
    )
