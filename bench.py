"""Time the headline queries: one cold run, then warm runs whose median counts. Prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline set
BENCH_WARM     warm runs (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegate.plans import QUERIES  # noqa: E402
from tidegate.session import build_session  # noqa: E402

HEADLINE = (
    "apply_latest",
    "apply_latest_composite",
    "hourly_rollup",
    "top10_revenue",
    "decode_json",
    "decode_debezium",
    "cdc_postgres_apply",
    "kafka_upsert_latest",
    "tx_complete_only",
    "typemap_mysql",
    "select_tables_glob",
    "candidate_keys",
    "sink_parquet_roundtrip",
    "lake_upsert",
    "compact_preserves_rows",
    "es_bulk_docs",
    "es_batches",
    "es_request_packing",
    "stream_cdc_to_lake",
)


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    warm_runs = int(os.environ.get("BENCH_WARM", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(timed(spark, name, sf_dir), 3)
        warm[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(warm_runs)), 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of warm medians",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": sf_dir.rstrip("/").rpartition("sf")[2],
                "cores": int(cpus),
                "shuffle_partitions": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
