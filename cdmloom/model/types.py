"""Column types by the names the table layouts use."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

SPARK_TYPES = {
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "STRING": StringType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
    "FLOAT": FloatType(),
    "DOUBLE": DoubleType(),
}


def layout(text: str) -> StructType:
    """``"a INT, b STRING"`` as a schema, without needing a session."""
    pairs = [column.split() for column in text.split(", ")]
    return StructType([StructField(name, SPARK_TYPES[kind]) for name, kind in pairs])
