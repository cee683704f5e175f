"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is timed from building the plan to having collected its result
(eager checkpoints and the stream's availableNow run are inside the timing).
A warm-up pass runs every headline query once at the same scale factor first
(results discarded), so JVM class loading and JIT compilation are not charged
to the timed pass: the numbers are warm, steady-state times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plaudit.plans.queries import QUERIES  # noqa: E402
from plaudit.sources.tables import load_table  # noqa: E402
from plaudit.session import build_session, ensure_checkpoint_dir  # noqa: E402

# headline query -> the driver table whose rows it consumes
HEADLINE = {
    "scorecard_by_points_events": "events",  # Q1 on A1 (the batch program)
    "scorecard_by_points_brands": "lineitem",  # Q1 on A2 (aggregate before the join)
    "scorecard_by_avg_events": "events",  # Q4
    "scorecard_per_day": "events",  # per-batch scope
    "scorecard_tumbling": "events",  # windowed scope
    "scorecard_sliding": "events",  # sliding windows from panes
    "scorecard_from_json": "events",  # JSON-lines source, strict (incl. writing it)
    "scorecard_from_json_lenient": "events",  # JSON-lines source, lenient
    "scorecard_sampling": "events",  # the first day of every second day
    "scorecard_brands_per_month": "lineitem",  # many scopes, aggregate before the join
    "stream_per_day": "events",  # Structured Streaming backfill, per batch
    "stream_tumbling": "events",  # Structured Streaming backfill, tumbling windows
    "stream_sliding": "events",  # Structured Streaming backfill, sliding windows
    "stream_sliding_panes": "events",  # the same from pane state
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    ensure_checkpoint_dir(spark)
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).collect()
    input_rows = {t: load_table(spark, sf_dir, t).count() for t in set(HEADLINE.values())}
    times, rows, rate = {}, {}, {}
    for name, table in HEADLINE.items():
        start = time.perf_counter()
        rows[name] = len(QUERIES[name](spark, sf_dir).collect())
        secs = time.perf_counter() - start
        times[name] = round(secs, 3)
        rate[name] = round(input_rows[table] / secs)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows": rows,
                "input_rows_per_sec": rate,
                "sf": float(match.group(1)) if match else sf_dir,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
