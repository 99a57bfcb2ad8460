"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and threads. Each query
runs to completion into the no-op sink after one small warm-up query, so the numbers contain planning,
intermediate tables and execution. BENCH_QUERIES, a comma-separated list, runs others than the default.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "ladder_2level", "ladder_3level", "ladder_two_phase", "ladder_mixed", "flat_report", "line_filter", "read_files",
    "sheet_cells", "sheet_table", "period_complete", "cast_int", "cast_float", "cast_dates", "identifier",
    "byte_truncate", "infer_types_wide", "contract_generation", "period_replace", "period_replace_text",
    "batch_period_replace", "schema_difference", "unique_audit", "surrogate_id", "new_file_versions", "recency",
    "stale_guard", "file_status", "error_classification", "cast_quarantine", "reconciliation", "stream_ingest",
)


def main() -> None:
    from ladderline.session import build_session
    from workload import queries

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = queries()
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    run["cast_int"](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        try:
            run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
        except Exception as error:  # noqa: BLE001
            seconds[name] = None
            print(f"{name}: {error}", file=sys.stderr)
    total = round(sum(s for s in seconds.values() if s is not None), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
