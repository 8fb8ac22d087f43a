"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmloom.operators.durable import scratch_path, shared_folder

#: Rows of text that one Arrow batch holds, so that a batch of very long texts stays small.
TEXT_ROWS = 256

#: Words of a text: maximal runs of anything but ASCII white space. ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    What follows is computed once, whatever reads it, and outlives executors.
    """
    spark = df.sparkSession
    shared_folder(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """``crc32(id as text) mod folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[Any]]]:
    """Each batch as Python lists, one for each column."""
    for batch in batches:
        yield [column.to_pylist() for column in batch.columns]


@cache
def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file of that name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
