"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from rootwise.plans.queries import QUERIES

HEADLINE = [
    "expression_values",
    "formula_edges",
    "formula_depth",
    "formula_values",
    "formula_values_lines",
    "reachable_subgraph_edges",
    "region_hops",
    "shortest_paths",
    "cycle_members",
    "cycle_affected_edges",
    "sales_hierarchy",
    "part_hierarchy",
    "propagated_depth",
    "log_normal_distances",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rootwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{tempfile.gettempdir()}/rootwise-shared")
        # Loops bring back the same few plans: keep their compiled code.
        .config("spark.sql.codegen.cache.maxEntries", "5000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    # The first job of a session pays for starting it.
    spark.read.parquet(f"{folder}/region.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
