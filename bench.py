"""Headline queries, timed; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores.
Each query is written to the no-op sink, so all its rows and columns are computed.
The vocabulary load is timed on its own, as lookups read the loaded tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from workload.fixtures import LOADED, Data
from workload.queries import QUERIES, all_stored

HEADLINE = (
    "lookup_mapped",
    "lookup_mapped_spread",
    "lookup_mapped_crosswalk",
    "lookup_chain",
    "distinct_codes",
    "draft_concept_map",
    "coverage_by_column",
    "vocabulary_diff",
    "upsert_concept_map",
    "column_profile",
    "expectation_metrics",
    "build_person",
    "build_visit_occurrence",
    "build_condition_occurrence",
    "build_measurement",
    "build_procedure_occurrence",
    "build_drug_exposure",
    "build_observation",
    "build_condition_era",
    "build_drug_era",
    "validate_table",
    "check_table_fk",
    "validate_all",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    data = Data(spark, folder)
    data.base("lineitem").limit(1).collect()
    times: dict[str, float] = {}
    start = time.perf_counter()
    for name in LOADED:
        data[name]
    times["vocabulary_load"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    all_stored(data)
    times["build_and_write_14_tables"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "clinical_etl_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
