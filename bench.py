"""Time the catalog queries and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads of the local session (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 1)
BENCH_KEYS     space-separated query keys (default: all but those that repeat the
               fits of another key only to show more of them)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallymark.plans import catalog  # noqa: E402
from tallymark.session import local_session  # noqa: E402


# The same cross validation as cv_grid, seen from its folds and its rows.
_REPEATS = ("cv_folds", "cv_held_out")


def timed(spark, key: str, folder: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    keys = os.environ.get("BENCH_KEYS", "").split() or [key for key in catalog.QUERIES if key not in _REPEATS]
    spark = local_session("tallymark-bench", os.environ.get("BENCH_CPUS", "8"), "16g")
    seconds = {}
    for key in keys:
        timed(spark, key, folder)
        seconds[key] = round(statistics.median(timed(spark, key, folder) for _ in range(runs)), 3)
        print(f"{key} {seconds[key]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all catalog queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
