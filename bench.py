"""Time the registered queries; prints one JSON line.

Everything runs BENCH_REPEATS times and the median counts. `write_raw` and
`build_warehouse` are the jobs that write what the queries read; they come first and
write anew each time. The time of a query includes all jobs it starts while it is built.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from finmart.plans import roles
from finmart.plans.registry import QUERIES
from finmart.sources.session import get_spark_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = get_spark_session(
        "finmart-bench",
        {
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
        master=f"local[{CPUS}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)

    writes = {"write_raw": [], "build_warehouse": []}
    for _ in range(REPEATS):
        roles.forget(spark, SF_DIR)
        writes["write_raw"].append(timed(lambda: roles.transactions(spark, SF_DIR)))
        writes["build_warehouse"].append(timed(lambda: roles.warehouse(spark, SF_DIR)))
    times = {name: statistics.median(seconds) for name, seconds in writes.items()}
    for name in names:

        def run() -> None:
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

        times[name] = statistics.median(timed(run) for _ in range(REPEATS))
    print(
        json.dumps(
            {
                "metric": "sum of median times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": float(Path(SF_DIR).name.removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
