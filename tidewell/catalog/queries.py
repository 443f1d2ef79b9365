"""The registered queries: name -> function of (spark, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.catalog import inputs
from tidewell.catalog.inputs import ALIASES, AS_OF, USERS_DDL
from tidewell.operators import changes, ranking, windows
from tidewell.operators.joins import denormalize
from tidewell.plans import churn, features
from tidewell.plans import replay_files as batch
from tidewell.plans.city_counts import CityCounts
from tidewell.plans.synced_table import SyncedTable
from tidewell.session import settle, workspace
from tidewell.sources import files, sinks
from tidewell.streaming.sync import sync_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Sources


@query
def scan_snapshot(spark, sf_dir):
    path = workspace(spark, "snapshot")
    sinks.write_state_csv(inputs.users(spark, sf_dir), path)
    return files.read_snapshot(spark, path, ddl=USERS_DDL)


@query
def scan_log(spark, sf_dir):
    log = files.read_changes(spark, inputs.landing_folder(spark, sf_dir), ddl=USERS_DDL)
    return log.withColumn("delivery", F.col("seq.file")).drop("seq")


@query
def route_files(spark, sf_dir):
    listing = files.list_files(spark, inputs.landing_folder(spark, sf_dir))
    return listing.select("name", "is_snapshot", "version").distinct()


@query
def latest_snapshot(spark, sf_dir):
    landing = workspace(spark, "landing")
    inputs.deliver_snapshots(inputs.snapshots(spark, sf_dir), landing)
    return files.read_latest_snapshot(spark, landing, ddl=USERS_DDL)


@query
def unreadable_lines(spark, sf_dir):
    """Lines of a landing folder that do not fit their layout, by reason; the others are none."""
    found = batch.unreadable_lines(spark, inputs.broken_landing(spark, sf_dir), ddl=USERS_DDL)
    return found.groupBy("name", "reason").agg(F.count("*").alias("n"))


@query
def replay_broken_files(spark, sf_dir):
    """What can be read of broken lines is applied, with NULL for the rest."""
    return batch.replay_files(spark, inputs.broken_landing(spark, sf_dir), ddl=USERS_DDL)


@query
def union_logs(spark, sf_dir):
    log = inputs.delivered_log(spark, sf_dir)
    first, second = workspace(spark, "landing"), workspace(spark, "landing")
    inputs.deliver(log.filter(F.col("delivery") < "20240116"), first, "seq")
    inputs.deliver(log.filter(F.col("delivery") >= "20240116"), second, "seq")
    return files.read_changes(spark, [first, second], ddl=USERS_DDL).drop("seq")


@query
def union_logs_same_names(spark, sf_dir):
    """Two folders with files of the same names; all their changes, replayed."""
    log, landing = inputs.delivered_log(spark, sf_dir), workspace(spark, "landing")
    log = log.withColumn("delivery", F.lit("changes"))
    inputs.deliver(log.filter(F.col("seq") % 2 == 0), f"{landing}/first", "seq")
    inputs.deliver(log.filter(F.col("seq") % 2 != 0), f"{landing}/second", "seq")
    changed = files.settle_changes(files.read_changes(spark, landing, ddl=USERS_DDL))
    return changes.replay(inputs.users(spark, sf_dir), changed)


# Change replay


def _replayed(spark, sf_dir):
    return changes.replay(inputs.users(spark, sf_dir), inputs.change_log(spark, sf_dir))


def _saved_state(spark, sf_dir):
    """The state, written once: features read it several times."""
    return settle(_replayed(spark, sf_dir), "state")


@query
def cdc_update(spark, sf_dir):
    log = inputs.change_log(spark, sf_dir)
    return changes.apply_updates(inputs.users(spark, sf_dir), log.filter(F.col("action") == "U"))


@query
def cdc_delete(spark, sf_dir):
    log = inputs.change_log(spark, sf_dir)
    return changes.apply_deletes(inputs.users(spark, sf_dir), log.filter(F.col("action") == "D"))


@query
def cdc_insert(spark, sf_dir):
    log = inputs.change_log(spark, sf_dir)
    return changes.apply_inserts(inputs.users(spark, sf_dir), log.filter(F.col("action") == "I"))


@query
def cdc_replay(spark, sf_dir):
    return _replayed(spark, sf_dir)


@query
def cdc_replay_orders(spark, sf_dir):
    return changes.replay(inputs.orders(spark, sf_dir), inputs.order_log(spark, sf_dir), key="o_orderkey")


@query
def cdc_rejects(spark, sf_dir):
    rejected = changes.rejects(inputs.change_log(spark, sf_dir))
    return rejected.groupBy("action", "reason").agg(F.count("*").alias("n"))


@query
def cdc_incremental(spark, sf_dir):
    log = inputs.delivered_log(spark, sf_dir)
    first = log.filter(F.col("delivery") < "20240116")
    second = log.filter(F.col("delivery") >= "20240116")
    saved = settle(changes.replay(inputs.users(spark, sf_dir), first), "state")
    return changes.replay(saved, second)


@query
def cdc_initial_load(spark, sf_dir):
    landing = workspace(spark, "landing")
    inputs.deliver_snapshots(inputs.snapshots(spark, sf_dir), landing)
    table = SyncedTable(spark, workspace(spark, "table"), ddl=USERS_DDL)
    table.load(files.read_latest_snapshot(spark, landing, ddl=USERS_DDL))
    return table.state()


@query
def replay_files(spark, sf_dir):
    return batch.replay_files(spark, inputs.landing_folder(spark, sf_dir), ddl=USERS_DDL)


@query
def duplicate_keys(spark, sf_dir):
    return changes.duplicate_keys(_replayed(spark, sf_dir))


# Projections, filters, joins


@query
def normalize_city(spark, sf_dir):
    return features.normalize_city(inputs.users_with_gaps(spark, sf_dir), ALIASES)


@query
def lookup_state(spark, sf_dir):
    return denormalize(inputs.users_with_gaps(spark, sf_dir), inputs.dimension(spark, sf_dir), "city")


@query
def filter_not_equal(spark, sf_dir):
    return changes.not_equal(inputs.users_with_gaps(spark, sf_dir), "city", "NATION_7")


# Windows and aggregates


@query
def rank_by_city(spark, sf_dir):
    return windows.rank_by_group(inputs.users_with_gaps(spark, sf_dir))


@query
def login_rate_by_city(spark, sf_dir):
    return windows.login_rate_by_group(inputs.users_with_gaps(spark, sf_dir), AS_OF)


@query
def users_by_city(spark, sf_dir):
    return windows.users_by_group(inputs.users_with_gaps(spark, sf_dir))


@query
def city_features(spark, sf_dir):
    return features.city_features(_saved_state(spark, sf_dir), inputs.dimension(spark, sf_dir), AS_OF)


@query
def city_features_gaps(spark, sf_dir):
    rows, dimension = inputs.users_with_gaps(spark, sf_dir), inputs.dimension(spark, sf_dir)
    return features.city_features(rows, dimension, AS_OF, aliases=ALIASES)


@query
def summary_by_city(spark, sf_dir):
    return features.summary_by_city(_replayed(spark, sf_dir), inputs.dimension(spark, sf_dir), AS_OF)


@query
def summary_by_state(spark, sf_dir):
    return features.summary_by_state(_replayed(spark, sf_dir), inputs.dimension(spark, sf_dir), AS_OF)


@query
def rank_by_city_seconds(spark, sf_dir):
    """Events of a kind by their time: nearly as many times as rows, ranked in parts."""
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return windows.rank_by_group(events, group="event_type", day="ts")


def _two_versions(spark, sf_dir):
    """The table before and after the changes of the second half of the month."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    early, late = log.filter(F.col("delivery") < "20240116"), log.filter(F.col("delivery") >= "20240116")
    versions = []
    _stream_in_two_runs(spark, table, early, late, after_batch=lambda t: versions.append(t.current().version))
    return table.state(versions[0]), table.state(versions[-1])


@query
def churn_by_city(spark, sf_dir):
    before, after = _two_versions(spark, sf_dir)
    return churn.churn_by_city(before, after, inputs.FIRST_HALF, inputs.LATER)


@query
def churn_by_state(spark, sf_dir):
    before, after = _two_versions(spark, sf_dir)
    return churn.churn_by_state(before, after, inputs.dimension(spark, sf_dir), inputs.FIRST_HALF, inputs.LATER)


# Sort, limit, sinks


@query
def features_sorted(spark, sf_dir):
    rows, dimension = inputs.users_with_gaps(spark, sf_dir), inputs.dimension(spark, sf_dir)
    return features.sort_features(features.city_features(rows, dimension, AS_OF, aliases=ALIASES))


@query
def features_positions(spark, sf_dir):
    """The sorted features with the place at which each row lies in the sorted output."""
    rows, dimension = inputs.users_with_gaps(spark, sf_dir), inputs.dimension(spark, sf_dir)
    sorted_rows = features.sort_features(features.city_features(rows, dimension, AS_OF, aliases=ALIASES))
    return ranking.positions(sorted_rows)


@query
def features_top10(spark, sf_dir):
    return features.first_features(_saved_state(spark, sf_dir), inputs.dimension(spark, sf_dir), AS_OF)


@query
def sink_roundtrip_state(spark, sf_dir):
    path = workspace(spark, "state")
    sinks.write_state_csv(inputs.users_with_gaps(spark, sf_dir), path)
    sinks.write_state_csv(_replayed(spark, sf_dir), path)
    return files.read_snapshot(spark, path, ddl=USERS_DDL)


@query
def sink_roundtrip_features(spark, sf_dir):
    rows, dimension = inputs.users_with_gaps(spark, sf_dir), inputs.dimension(spark, sf_dir)
    result = features.city_features(rows, dimension, AS_OF, aliases=ALIASES)
    path = workspace(spark, "features")
    sinks.write_features_csv(result, path)
    return spark.read.schema(result.schema).csv(path)


# Streaming


def _loaded_table(spark, sf_dir):
    table = SyncedTable(spark, workspace(spark, "table"), ddl=USERS_DDL)
    table.load(inputs.users(spark, sf_dir))
    return table


def _stream_in_two_runs(spark, table, early, late, snapshots=None, **options):
    """Deliver and take up ``early``, then ``late``, as two runs of one stream."""
    landing, checkpoint = workspace(spark, "landing"), workspace(spark, "checkpoint")
    if snapshots is not None:
        inputs.deliver_snapshots(snapshots, landing)
    for log in (early, late):
        inputs.deliver(log, landing, "seq")
        sync_stream(table, landing, checkpoint, **options).awaitTermination()
    return landing


@query
def stream_apply(spark, sf_dir):
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    early, late = log.filter(F.col("delivery") < "20240116"), log.filter(F.col("delivery") >= "20240116")
    _stream_in_two_runs(spark, table, early, late)
    return table.state()


@query
def stream_features(spark, sf_dir):
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    early, late = log.filter(F.col("delivery") < "20240116"), log.filter(F.col("delivery") >= "20240116")
    dimension, published = inputs.dimension(spark, sf_dir), []
    _stream_in_two_runs(
        spark, table, early, late, after_batch=lambda t: published.append(t.publish_features(dimension, AS_OF))
    )
    return spark.read.parquet(published[-1])


@query
def stream_city_stats(spark, sf_dir):
    """City statistics that follow the changes of each batch, after deletes and moves from city to city."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    early, late = log.filter(F.col("delivery") < "20240116"), log.filter(F.col("delivery") >= "20240116")
    counts = CityCounts(table)
    counts.refresh()
    _stream_in_two_runs(spark, table, early, late, after_batch=lambda _: counts.refresh())
    return counts.stats(inputs.dimension(spark, sf_dir), AS_OF)


@query
def stream_late_files(spark, sf_dir):
    """Deliveries of one day arrive after the later days were compacted: they are kept apart."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    one_day = F.col("delivery").startswith("20240110")
    _stream_in_two_runs(spark, table, log.filter(~one_day), log.filter(one_day), after_batch=SyncedTable.compact)
    return table.late().drop("seq", "_append")


@query
def stream_late_repair(spark, sf_dir):
    """As above, then repaired by a full replay of the landing folder."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    one_day = F.col("delivery").startswith("20240110")
    landing = _stream_in_two_runs(
        spark,
        table,
        log.filter(~one_day),
        log.filter(one_day),
        snapshots=inputs.snapshots(spark, sf_dir),
        after_batch=SyncedTable.compact,
    )
    table.rebuild(landing)
    return table.state()


@query
def stream_late_repair_by_key(spark, sf_dir):
    """Two days come late, each after a compaction, and are repaired for the keys that they address."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    one, other = (F.col("delivery").startswith(day) for day in ("20240110", "20240112"))
    landing, checkpoint = workspace(spark, "landing"), workspace(spark, "checkpoint")
    for part in (log.filter(~one & ~other & (F.col("delivery") < "20240120")), log.filter(one), log.filter(other), log.filter(F.col("delivery") >= "20240120")):
        inputs.deliver(part, landing, "seq")
        sync_stream(table, landing, checkpoint).awaitTermination()
        table.repair()
        table.compact()
    return table.state()


@query
def stream_late_after_repair(spark, sf_dir):
    """A late day is repaired; the deliveries of another late day come after that."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    repaired, after = (F.col("delivery").startswith(day) for day in ("20240110", "20240112"))
    landing, checkpoint = workspace(spark, "landing"), workspace(spark, "checkpoint")
    inputs.deliver_snapshots(inputs.snapshots(spark, sf_dir), landing)
    for part in (log.filter(~repaired & ~after), log.filter(repaired), log.filter(after)):
        if table.history().count() > 1 and table.late().count():
            table.rebuild(landing)
        inputs.deliver(part, landing, "seq")
        sync_stream(table, landing, checkpoint, after_batch=SyncedTable.compact).awaitTermination()
    return table.late().drop("seq", "_append")


@query
def stream_reload(spark, sf_dir):
    """A newer snapshot file replaces the state; the changes that come with it or later apply to it."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    landing, checkpoint = workspace(spark, "landing"), workspace(spark, "checkpoint")
    early, late = log.filter(F.col("delivery") < "20240116"), log.filter(F.col("delivery") >= "20240116")
    for number, part in ((None, early), (20, late), (19, None)):
        if number is not None:
            users = inputs.users(spark, sf_dir).withColumn("last_login", F.lit(None).cast("date"))
            inputs.deliver(users.withColumn("delivery", F.lit(f"LOAD{number}")), landing, "user_id")
            files.mark_complete(spark, landing, f"LOAD{number}")
        if part is not None:
            inputs.deliver(part, landing, "seq")
        sync_stream(table, landing, checkpoint).awaitTermination()
    return table.state()


@query
def stream_rejects(spark, sf_dir):
    """The rejects of a synced table, across a compaction."""
    table, log = _loaded_table(spark, sf_dir), inputs.delivered_log(spark, sf_dir)
    early, late = log.filter(F.col("delivery") < "20240116"), log.filter(F.col("delivery") >= "20240116")
    _stream_in_two_runs(spark, table, early, late, after_batch=SyncedTable.compact)
    return table.rejects().groupBy("action", "reason").agg(F.count("*").alias("n"))
