"""One key holds a third of all rows: results stay whole, and no task takes the whole key."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.rows import executed_plan
from tidewell import city_features, replay
from tidewell.operators import joins
from tidewell.operators.joins import HOT_LIMIT, hot_keys, join_unique, sized_lookup
from tidewell.plans.features import city_stats, normalize_city
from tidewell.session import (
    BROADCAST_CONF,
    SPLIT_FLOOR_CONF,
    estimated_bytes,
    memory_bytes,
    scratch,
    shared_folder,
    workspace,
)

N = 30_000


@pytest.fixture
def tables(spark):
    """Base with one hot key and many NULL keys, and a log with the same hot key."""
    base, log = workspace(spark, "base"), workspace(spark, "log")
    key = "CAST(CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id END AS INT) AS user_id"
    spark.range(N).selectExpr(
        key, "'base' AS name", "CASE WHEN id % 3 = 0 THEN 'Hot' ELSE concat('C', id % 50) END AS city",
        "CASE WHEN id % 6 = 0 THEN NULL ELSE date_add(DATE'2021-01-01', CAST(id % 40 AS INT)) END AS last_login",
    ).write.parquet(base)
    spark.range(N // 3).selectExpr(
        "id AS seq", "CASE WHEN id % 5 = 0 THEN 'I' WHEN id % 97 = 0 THEN 'D' ELSE 'U' END AS action",
        "CAST(CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS INT) AS user_id", "concat('u', id) AS name",
        "'Hot' AS city", "DATE'2021-03-01' AS last_login",
    ).write.parquet(log)
    return spark.read.parquet(base), spark.read.parquet(log)


def checksum(df):
    return df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38)"))).first()


def test_hot_keys_are_found(at_scale, tables):
    base, _ = tables
    found = hot_keys(base, ["user_id"])
    assert found[0] == (7,) and (None,) in found and len(found) <= HOT_LIMIT


def test_replay_with_a_hot_key(spark, tables, at_scale):
    base, log = tables
    split = replay(base, log)
    assert checksum(split) == checksum(replay(base, log, hot=()))
    # The hot branch joins by broadcast although the threshold forbids it for all other joins.
    plan = executed_plan(split)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_shuffled_rows_of_the_hot_key(tables, at_scale):
    """After the split, no shuffle partition of the join holds the hot key's rows."""
    base, log = tables
    lookup = log.groupBy("user_id").agg(F.max("seq").alias("last"))
    joined = join_unique(base, lookup, ["user_id"], hot=hot_keys(base, ["user_id"]))
    biggest = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert joined.count() == N
    assert biggest < N / 3


def test_features_with_a_hot_city_and_day(spark, tables, at_scale):
    base, _ = tables
    dimension = spark.createDataFrame([("Hot", "S")], "city STRING, state STRING")
    as_of = dt.date(2021, 2, 9)
    split = city_features(base, dimension, as_of)
    assert checksum(split) == checksum(city_features(base, dimension, as_of, hot=()))
    stats = city_stats(normalize_city(base), dimension, as_of)
    assert stats.count() == base.select("city", "last_login").distinct().count()


def test_a_written_lookup_of_known_size_is_broadcast(spark, tables, at_scale):
    """Up to the limit for written lookups, large rows are not shuffled at all."""
    base, log = tables
    expected = checksum(replay(base, log))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    spark.conf.set(BROADCAST_CONF, str(64 << 20))
    result = replay(base, log)
    assert checksum(result) == expected
    plan = executed_plan(result)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_a_lookup_is_broadcast_by_its_size_in_memory(spark, tables):
    """Few bytes of Parquet, many rows: not broadcast. Nor is anything if the user has forbidden it."""
    base, _ = tables
    path = workspace(spark, "lookup")
    spark.range(300_000).selectExpr("CAST(id AS INT) AS user_id", "1L AS last").write.parquet(path)
    lookup = spark.read.parquet(path)
    assert memory_bytes(lookup) > 10 * estimated_bytes(lookup)
    settings = {
        SPLIT_FLOOR_CONF: "0",
        "spark.sql.autoBroadcastJoinThreshold": "1000",
        BROADCAST_CONF: str(memory_bytes(lookup) - 1),
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        assert sized_lookup(lookup, base)[1]
        spark.conf.set(BROADCAST_CONF, str(memory_bytes(lookup)))
        assert not sized_lookup(lookup, base)[1]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert sized_lookup(lookup, base)[1]
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_a_long_list_of_hot_keys_is_cut(tables):
    base, log = tables
    lookup = log.groupBy("user_id").agg(F.max("seq").alias("last"))
    keys = [(7,), *((i,) for i in range(100, 100 + 2 * HOT_LIMIT))]
    assert checksum(join_unique(base, lookup, ["user_id"], hot=keys)) == checksum(
        join_unique(base, lookup, ["user_id"], hot=())
    )


def test_a_key_is_hot_by_its_bytes(at_scale, tables, monkeypatch):
    base, _ = tables
    monkeypatch.setattr(joins, "HOT_BYTES", 1 << 40)
    assert hot_keys(base, ["user_id"]) == []


def test_the_shared_folder_is_needed_on_clusters():
    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda name, default=None: folder or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", "/shared/")) == "/shared"
    assert shared_folder(session("local[4]")) == shared_folder(session("local"))
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))


def test_scratch_tables_are_removed(spark):
    with scratch(spark):
        path = workspace(spark, "table")
        spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
