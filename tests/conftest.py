"""A local session and small helpers."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cdmloom.operators.spread import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def rows(df) -> list[tuple]:
    """Rows as sorted tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.fixture(scope="session")
def vocab(spark):
    """A few hand-made concepts: A maps once, B twice, C nowhere, D to a non-standard one."""
    from cdmloom.model.vocabulary import Vocabulary

    concept = spark.createDataFrame(
        [
            (1, "a", "Condition", "LOC", None, "A", None),
            (2, "b", "Condition", "LOC", None, "B", None),
            (3, "c", "Condition", "LOC", None, "C", None),
            (4, "d", "Condition", "LOC", None, "D", None),
            (5, "e", "Condition", "LOC", None, "E", "D"),
            (6, "std", "Condition", "LOC", "S", "S1", None),
            (7, "old", "Condition", "LOC", None, "U1", "U"),
            (101, "x", "Condition", "STD", "S", "X", None),
            (102, "y", "Condition", "STD", "S", "Y", None),
            (103, "z", "Observation", "STD", "S", "Z", None),
            (104, "w", "Condition", "STD", None, "W", None),
            (105, "v", "Condition", "STD", "S", "V", "D"),
        ],
        "concept_id INT, concept_name STRING, domain_id STRING, vocabulary_id STRING, "
        "standard_concept STRING, concept_code STRING, invalid_reason STRING",
    )
    edges = spark.createDataFrame(
        [
            (1, 101, "Maps to", None),
            (2, 101, "Maps to", None),
            (2, 102, "Maps to", None),
            (2, 103, "Maps to", None),
            (4, 104, "Maps to", None),
            (5, 101, "Maps to", None),
            (1, 102, "Maps to", "D"),
            (1, 105, "Maps to", None),
            (1, 103, "Is a", None),
            (3, 999, "Maps to", None),
            (7, 102, "Concept replaced by", None),
        ],
        "concept_id_1 INT, concept_id_2 INT, relationship_id STRING, invalid_reason STRING",
    )
    stcm = spark.createDataFrame(
        [
            ("w", "Race", 101, None),
            ("stale", "Race", 555, None),
            ("dead", "Race", 105, None),
            ("w", "Other", 102, None),
            ("marked", "Race", 102, "D"),
        ],
        "source_code STRING, source_vocabulary_id STRING, target_concept_id INT, invalid_reason STRING",
    )
    return Vocabulary(concept, edges, stcm)
