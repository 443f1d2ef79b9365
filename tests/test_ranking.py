"""Ranks in parts and positions, against plain Python; the balance of the parts."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from tidewell.operators import ranking
from tidewell.operators.windows import RANK, rank_by_group

NOON = dt.datetime(2021, 1, 1, 12)


def test_ranks_of_times_in_parts(spark):
    """Ties, nulls, a NULL group, and one group with a third of all rows, which lies in several parts."""
    draw = random.Random(6)
    rows = [(i, draw.choice([None, "a", "b", "c"]), NOON + dt.timedelta(seconds=draw.randrange(300)) if draw.random() < 0.9 else None) for i in range(400)]
    rows += [(1000 + i, "hot", NOON + dt.timedelta(seconds=i)) for i in range(300)]
    frame = spark.createDataFrame(rows, "id INT, city STRING, last_login TIMESTAMP_NTZ")
    expected = []
    for key, city, login in rows:
        above = {other for _, same, other in rows if same == city and other is not None and (login is None or other > login)}
        expected.append((key, city, login, len(above) + 1))
    got = [tuple(row) for row in rank_by_group(frame).select("id", "city", "last_login", RANK).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert rank_by_group(frame.limit(0)).count() == 0


def test_no_part_holds_much_more_than_the_median(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("city"),
        F.timestamp_seconds(F.col("id")).alias("last_login"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ranked = ranking.dense_rank_by_group(rows, "city", "last_login", "rank")
        plan = ranked._jdf.queryExecution().optimizedPlan().toString()
        assert ranked.filter("city = 'hot'").agg(F.max("rank")).first()[0] == 10_000
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "_part" in plan
    parted = rows.repartitionByRange(16, "city", F.desc("last_login")).groupBy(F.spark_partition_id().alias("p"), "city").count()
    tasks = [row["count"] for row in parted.groupBy("p").agg(F.sum("count").alias("count")).collect()]
    assert max(tasks) <= 3 * statistics.median(tasks)


def test_positions_and_breaks_of_an_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(7)
    found = ranking.positions(rows.orderBy("x")).collect()
    assert sorted((row.x, row.position) for row in found) == [(i, i + 1) for i in range(5000)]
    assert ranking.positions(rows.limit(0).orderBy("x")).count() == 0
    assert ranking.order_breaks(ranking.placed(rows.orderBy("x")), F.struct("x")) == 0
    assert ranking.order_breaks(ranking.placed(rows.orderBy(F.desc("x"))), F.struct("x")) == 4999
    one = rows.orderBy("x").withColumn("x", F.when(F.col("x") == 2500, -1).otherwise(F.col("x")))
    assert ranking.order_breaks(ranking.placed(one), F.struct("x")) == 1


def test_sorted_features_have_no_breaks(spark):
    from tidewell.catalog import inputs
    from tidewell.catalog.inputs import ALIASES, AS_OF
    from tidewell.plans import features

    sf_dir = "/root/testdata/sf0.001"
    rows, dimension = inputs.users_with_gaps(spark, sf_dir), inputs.dimension(spark, sf_dir)
    placed = ranking.placed(features.sort_features(features.city_features(rows, dimension, AS_OF, aliases=ALIASES)))
    assert ranking.order_breaks(placed, features.sort_key()) == 0
