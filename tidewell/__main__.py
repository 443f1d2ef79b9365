"""Batch and incremental jobs.

    python -m tidewell LANDING DIMENSION --state PATH --features PATH [--as-of DATE]

replays the landing folder, writes the state and the features as CSV, counts the rejected changes and shows
the first rows. ``DIMENSION`` is a CSV of city and state. The output paths must lie outside ``LANDING``.

    python -m tidewell sync LANDING TABLE --checkpoint PATH [--compact RATIO] [--dimension CSV --as-of DATE]

takes up the files that came since the last call into the synced table at ``TABLE``, which the newest
snapshot file starts; compacts it if its log is larger than RATIO times its snapshot, and publishes
features if a dimension is given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from tidewell.plans.features import FEATURES, city_features, first_features, sort_features
from tidewell.plans.replay_files import rejected_changes, replay_files
from tidewell.plans.synced_table import SyncedTable
from tidewell.schemas import USERS_DDL
from tidewell.session import build_session, settle
from tidewell.sources.files import read_dimension
from tidewell.sources.sinks import write_features_csv, write_state_csv
from tidewell.streaming.sync import sync_stream


def sync(arguments: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="tidewell sync")
    parser.add_argument("landing")
    parser.add_argument("table")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--compact", type=float, metavar="RATIO")
    parser.add_argument("--dimension")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--days", type=int, default=90)
    parser.add_argument("--key-type", default="INT", help="type of the user id")
    options = parser.parse_args(arguments)
    spark = build_session("tidewell-sync")
    table = SyncedTable(spark, options.table, ddl=USERS_DDL.replace("INT", options.key_type, 1))
    sync_stream(table, options.landing, options.checkpoint).awaitTermination()
    if not table.is_loaded():
        raise SystemExit("no snapshot file has come yet")
    if options.compact is not None:
        table.compact(options.compact)
    if options.dimension:
        print(table.publish_features(read_dimension(spark, options.dimension), options.as_of, days=options.days))
    print(f"version {table.current().version}, rejected {table.rejects().count()}, late {table.late().count()}")


def main(arguments: list[str] | None = None) -> None:
    arguments = sys.argv[1:] if arguments is None else arguments
    if arguments[:1] == ["sync"]:
        sync(arguments[1:])
        return
    parser = argparse.ArgumentParser(prog="tidewell", description="Replay a landing folder")
    parser.add_argument("landing")
    parser.add_argument("dimension")
    parser.add_argument("--state", required=True, help="overwritten")
    parser.add_argument("--features", required=True, help="must not exist")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--days", type=int, default=90)
    parser.add_argument("--key-type", default="INT", help="type of the user id")
    options = parser.parse_args(arguments)
    for path in (options.state, options.features):
        if f"{path.rstrip('/')}/".startswith(f"{options.landing.rstrip('/')}/"):
            parser.error(f"{path} lies in the landing folder and would be read as a change file")

    spark = build_session("tidewell")
    dimension = read_dimension(spark, options.dimension)
    ddl = USERS_DDL.replace("INT", options.key_type, 1)
    state = settle(replay_files(spark, options.landing, ddl=ddl), "state")
    write_state_csv(state, options.state)
    features = city_features(state, dimension, options.as_of, days=options.days)
    write_features_csv(sort_features(features).select(*state.columns, *FEATURES), options.features)
    first_features(state, dimension, options.as_of, days=options.days).show(10, False)
    rejected_changes(spark, options.landing, ddl=ddl).groupBy("action", "reason").agg(F.count("*").alias("n")).show()


if __name__ == "__main__":
    main()
