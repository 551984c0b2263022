"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores. The tables come as one file of one
row group each, which one task would read; the queries run over a copy split into as many files as there are cores, made
once before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millpulse import fixtures, registry  # noqa: E402
from millpulse.session import build_session  # noqa: E402

HEADLINE = (
    "machine_health_hourly", "machine_risk_hourly", "machine_risk_hourly_dense", "work_orders_status", "latest_status",
    "hourly_features_filled", "eda_rolling_features", "sustained_breaches", "sustained_breaches_dense", "risk_ranking",
    "correlation_matrix", "key_coverage", "upsert_by_key", "with_dim_hour", "run_checks", "validate_payload",
    "stream_health_hourly", "land_stream", "incremental_load", "refresh_marts",
)
TABLES = ("events", "lineitem", "part")
STREAMED = ("stream_health_hourly", "land_stream")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    memory = os.environ.get("BENCH_MEMORY", "16g")
    spark = build_session(
        "millpulse-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": memory,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    split_dir = tempfile.mkdtemp(prefix="millpulse-bench-")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(int(cpus)).write.parquet(f"{split_dir}/{name}.parquet")

    def run(name: str) -> float:
        start = time.perf_counter()
        registry.QUERIES[name](spark, split_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("machine_risk_hourly")  # start the session's threads and compile once
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    events = fixtures.table(spark, split_dir, "events").count()
    print(json.dumps({
        "metric": "total seconds over the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "rows_per_second": {name: round(events / seconds[name]) for name in STREAMED},
        "spark": spark.version,
        "cpus": int(cpus),
        "driver_memory": memory,
        "shuffle_partitions": int(cpus),
        "input_files_per_table": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
