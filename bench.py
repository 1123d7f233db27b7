"""Headline timings; prints one JSON line.

BENCH_SF_DIR  test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, of which the median counts (default 3)
BENCH_COPIES  copies of the counts for the scale-up runs (default "10,100"; "" skips them); they are
              written to Parquet first and read by the timed runs
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallytide.operators.layout import rebalance
from tallytide.operators.sets import replicate_rows
from tallytide.plans import normalize
from tallytide.sources import read_table, write_table
from workload import fixtures
from workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
COPIES = [int(c) for c in os.environ.get("BENCH_COPIES", "10,100").split(",") if c]

HEADLINE = [
    "ingest",
    "normalize",
    "normalize_unfiltered",
    "top_variable",
    "fold_change",
    "changed_entities",
    "fold_change_for",
    "heat_matrix",
    "dynamics",
    "process_trajectory",
    "standardize",
    "sample_pca",
    "time_cluster_profiles",
    "cluster_profiles",
    "silhouette",
]


def drain(df: DataFrame) -> None:
    """Evaluate every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run: Callable[[], None], runs: int = RUNS) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tallytide-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stages() -> None:
        fixtures.forget_stages()
        fixtures.normalized(spark, SF_DIR)

    stages()  # warms the JVM up
    seconds = {"stage_tables": median_seconds(stages)}
    for name in HEADLINE:
        drain(QUERIES[name](spark, SF_DIR))
        seconds[name] = median_seconds(lambda name=name: drain(QUERIES[name](spark, SF_DIR)))

    scale = {}
    spread = fixtures.scratch_path(spark, "spread")
    write_table(rebalance(fixtures.counts(spark, SF_DIR), int(CPUS)), spread)
    counts = read_table(spark, spread)
    base = counts.count()
    for copies in COPIES:
        copied = fixtures.scratch_path(spark, f"x{copies}")
        write_table(replicate_rows(counts, copies), copied)
        many = read_table(spark, copied)
        key = ["sample_id", "replica"]

        def run(many: DataFrame = many, key: list[str] = key) -> None:
            drain(normalize(many, None, sample=key, count="n"))

        run()
        took = median_seconds(run)
        scale[f"normalize_x{copies}"] = {
            "rows": base * copies,
            "sec": took,
            "rows_per_sec": round(base * copies / took),
        }

    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "scale": scale,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
