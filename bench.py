"""Times the headline queries and prints one JSON line.

Each query is built and fully materialized (noop sink): one warm-up, then the
median of the measured runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakeops.catalog.queries import queries  # noqa: E402
from lakeops.session import build_session  # noqa: E402

HEADLINE = (
    "latest_by_key",
    "upsert_single_key",
    "scd2_apply",
    "snapshot_diff_feed",
    "publish_with_deletes",
    "reconcile_counts",
    # storage path: three commits arrive, each followed by a run that writes its changes
    "resume_with_late_commit",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(
        "lakeops-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = queries()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
