"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (no collect to the driver),
``$BENCH_RUNS`` times (default 2); the faster run counts, which removes most of the
VM's timing noise and the one-off JIT/class-loading cost of a plan's first execution.
Prints one JSON line: {"metric", "value" (sum of query seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import catalog  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "latest_per_key",
    "upsert",
    "snapshot_as_of",
    "check_foreign_keys",
    "rows_affected",
    "append_conflicts",
    "net_changes",
    "reconcile",
    "pair_updates",
    "decode_rows",
    "poll_changes",
    "safe_high_water",
    "assign_sequence",
    "assign_batches",
    "batch_boundaries",
    "build_acks",
    "route_changes",
    "fold_cursors",
    "pending_batches",
    "stream_apply",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * cpus))))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=parts)
    # warm-up on the smallest data set (JIT, class loading); not timed
    catalog.REGISTRY["latest_per_key"].run(spark, "/root/testdata/sf0.001").write.format("noop").mode(
        "overwrite"
    ).save()
    times = {}
    failed = {}
    for name in names:
        best = None
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                catalog.REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
                took = time.perf_counter() - t0
                best = took if best is None else min(best, took)
            times[name] = round(best, 3)
        except Exception as e:  # report and go on: one failure must not hide the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": f"headline_queries_total_best_of_{runs}",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
