"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of
local cores, ``BENCH_RUNS`` the number of warm runs (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame

import quern.plans.queries  # noqa: F401
from quern.plans.registry import REGISTRY
from quern.session import build_session, clear_shared

HEADLINE = (
    "join_star3",
    "join_star5",
    "product_qty",
    "history_rollup",
    "selectivity",
    "latest_per_key",
    "topk_other_rank",
    "order_lines",
    "dense_id",
    "total_loss",
    "workload_rollup",
    "xe_shred",
    "agg_view_delta",
)


def consume(df: DataFrame) -> None:
    """Compute every column of every row, without moving rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "quern-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name in names:
        plan = REGISTRY[name]
        seconds = []
        for run in range(runs + 1):
            started = time.perf_counter()
            consume(plan.run(spark, folder))
            if run:  # the first run warms up
                seconds.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(seconds), 4)
    clear_shared(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
