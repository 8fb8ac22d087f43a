"""Run queries on Spark and their SQL twins on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.queries import QUERIES

VIEWS = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"create view {v} as select * from '{sf_dir}/{v}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, decimal.Decimal)):
        return str(int(value)) if value == int(value) else str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value) if value != int(value) else str(int(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def normal(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    if ours == theirs:
        return True, f"{len(ours[1])} rows"
    if ours[0] != theirs[0]:
        return False, f"columns {ours[0]} against {theirs[0]}"
    a, b = set(ours[1]), set(theirs[1])
    return False, (
        f"{len(ours[1])} against {len(theirs[1])} rows; only here {sorted(a - b)[:2]}; "
        f"only there {sorted(b - a)[:2]}"
    )


if __name__ == "__main__":
    folder, wanted = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = session(), duck(folder)
    bad = 0
    for q in wanted:
        start = time.time()
        try:
            same, note = compare(spark, con, folder, q) if q in ORACLES else (True, "no twin")
        except Exception as e:  # noqa: BLE001
            same, note = False, f"{type(e).__name__}: {str(e)[:500]}"
        bad += not same
        print(f"{'ok ' if same else 'BAD'} {q:30s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")
