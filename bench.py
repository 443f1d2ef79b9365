"""Times the headline queries; prints one JSON line.

Each query runs once to warm up and is then timed; the time is the best of REPEAT runs and covers the
making of the plan and all rows of the result. ``replay_log_<n>x`` replays the change log repeated n
times, to show that time follows the data and the plan does not grow with the log; in ``_hot`` a third
of the changes has one key.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from tidewell.catalog import inputs
from tidewell.catalog.queries import QUERIES
from tidewell.operators.changes import replay
from tidewell.session import build_session, workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
HEADLINE = [
    "cdc_update",
    "cdc_delete",
    "cdc_insert",
    "cdc_replay",
    "cdc_replay_orders",
    "cdc_rejects",
    "cdc_incremental",
    "duplicate_keys",
    "lookup_state",
    "rank_by_city",
    "login_rate_by_city",
    "users_by_city",
    "city_features",
    "summary_by_city",
    "summary_by_state",
    "features_sorted",
    "features_top10",
    "replay_files",
    "stream_apply",
]


def repeated_log(spark, times: int, hot: bool = False) -> str:
    """The change log ``times`` over, one copy after the other, as a table."""
    path = workspace(spark, f"log-{times}x")
    log = inputs.change_log(spark, SF_DIR)
    copies = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    step = log.agg(F.max("seq")).first()[0] + 1
    longer = log.withColumn("copy", copies).withColumn("seq", F.col("copy") * step + F.col("seq")).drop("copy")
    if hot:
        key = F.when(F.col("seq") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
        longer = longer.withColumn("user_id", key)
    longer.repartition(int(CPUS)).write.parquet(path)
    return path


def main() -> None:
    spark = build_session(
        "tidewell-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tasks = {name: (lambda query=QUERIES[name]: query(spark, SF_DIR)) for name in HEADLINE}
    for times, hot in ((1, False), (10, False), (100, False), (100, True)):
        path = repeated_log(spark, times, hot)
        name = f"replay_log_{times}x" + ("_hot" if hot else "")
        tasks[name] = lambda path=path: replay(inputs.users(spark, SF_DIR), spark.read.parquet(path))

    seconds = {}
    for name, task in tasks.items():
        best = float("inf")
        for run in range(REPEAT + 1):
            start = time.perf_counter()
            task().write.format("noop").mode("overwrite").save()
            if run:
                best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of best times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
