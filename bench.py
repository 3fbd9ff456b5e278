"""Time the headline queries; print one JSON line.

The small tables lie in one row group each, which is one task; `setup_spread` writes them
again as one file a core, as a large table would lie. The serving table is written once and
timed as `setup_serving`. Each query then runs twice and its second run counts, with the
result fully computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallystream.registry import fixture, load  # noqa: E402
from tallystream.session import build_session, prepare, scratch_path  # noqa: E402

HEADLINES = [
    "table_overview", "list_event_names", "discover_json_keys", "sample_events", "calculate_dau",
    "calculate_funnel", "calculate_funnel_long_window", "readonly_sql",
    "serving_projection", "distinct_rows", "dedupe_latest", "base_model", "promote_fields",
    "flatten_raw", "dedupe_window", "validate_envelope", "batch_limits", "geo_enrich", "collect_to_raw",
    "actor_sessions", "retention_day_n", "event_value_daily", "sample_newest_days",
    # Paths that write.
    "load_hour", "reload_corrected_hour", "land_raw", "dedupe_stream", "compact_serving",
]
# Also over the tables as they lie, in one row group each: these read `events` themselves.
AS_THEY_LIE = ["serving_projection", "distinct_rows", "dedupe_latest", "flatten_raw", "dedupe_window", "validate_envelope"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = cpus if cpus.isdigit() else "8"
    spark = prepare(
        build_session(
            "bench",
            f"local[{cpus}]",
            **{
                "spark.sql.shuffle.partitions": partitions,
                # The tables are so small that one task would write them all.
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
                # Folders are listed by a job with one task each otherwise.
                "spark.sql.sources.parallelPartitionDiscovery.parallelism": partitions,
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
                "spark.driver.memory": "12g",
            },
        )
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load()
    timings: dict[str, float] = {}

    def timed(name: str, job) -> None:
        started = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - started, 3)
        print(name, timings[name], file=sys.stderr, flush=True)

    tables = scratch_path(spark, "tables")

    def spread() -> None:
        for name in ("events", "supplier", "nation"):
            rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(int(partitions))
            rows.write.parquet(f"{tables}/{name}.parquet")

    timed("setup_spread", spread)
    timed("setup_serving", lambda: fixture.serving_store(spark, tables))
    for name in HEADLINES:
        for _ in range(2):
            timed(name, lambda n=name: queries[n](spark, tables).write.format("noop").mode("overwrite").save())
    for name in AS_THEY_LIE:
        for _ in range(2):
            timed(f"{name}_one_file", lambda n=name: queries[n](spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = sum(timings[name] for name in HEADLINES)
    print(
        json.dumps(
            {
                "metric": "headline query seconds, warm",
                "value": round(total, 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
