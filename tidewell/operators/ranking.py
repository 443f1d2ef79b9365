"""Ranks and positions over data that no single task holds.

Rows are put in order by a range partitioning, which splits a large group over as many tasks as its rows need.
What is in a partition is numbered there, and the counts of the partitions before it, which are few, are added.
The order is written first, so that numbers and counts are taken from the same partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import settle

PART, ROW = "_part", "_row"


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` of an ordered plan, written with the partition they are in and their place there."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return settle(rows.withColumns({PART: F.spark_partition_id(), ROW: place}), "placed")


def positions(ordered: DataFrame, name: str = "position") -> DataFrame:
    """``ordered`` (sorted by ``orderBy``) with the position of each row in it, from 1."""
    rows = placed(ordered)
    return _positioned(rows, name)


def _positioned(rows: DataFrame, name: str) -> DataFrame:
    # A row for each partition: a single task sums them up, and they are small enough to be sent to all.
    counts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(PART, F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = rows.join(F.broadcast(counts), PART)
    return numbered.withColumn(name, F.col("_before") + F.col(ROW) + 1).drop(PART, ROW, "_before")


def order_breaks(rows: DataFrame, key: Column) -> int:
    """Places at which ``rows`` (from ``placed``) are not in the order of ``key``: neighbours in a partition, and
    the last row of a partition against the first of the next one that has rows."""
    rows = rows.select(PART, ROW, key.alias("_key"))
    earlier = F.lag("_key").over(Window.partitionBy(PART).orderBy(ROW))
    inside = rows.withColumn("_earlier", earlier).filter(F.col("_earlier") > F.col("_key")).count()
    bounds = rows.groupBy(PART).agg(F.min_by("_key", ROW).alias("_first"), F.max_by("_key", ROW).alias("_last"))
    last = F.lag("_last").over(Window.orderBy(PART))
    return inside + bounds.withColumn("_earlier", last).filter(F.col("_earlier") > F.col("_first")).count()


def dense_rank_by_group(pairs: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``pairs``, distinct rows of ``group`` and ``value``, with the dense rank of the value in its group, the
    largest first and NULL last."""
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first(group), F.desc_nulls_last(value)]
    rows = settle(pairs.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), "ranges")
    counts = rows.groupBy(group, PART).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # Only groups that lie in more than one partition: at most one for each partition boundary.
    counts = counts.withColumn("_before", F.sum("_n").over(earlier)).filter("_before IS NOT NULL")
    counts = counts.select(F.col(group).alias("_group"), F.col(PART).alias("_at"), "_before")
    local = F.row_number().over(Window.partitionBy(group, PART).orderBy(F.desc_nulls_last(value)))
    ranked = rows.withColumn(name, local)
    same = ranked[group].eqNullSafe(F.col("_group")) & (F.col(PART) == F.col("_at"))
    ranked = ranked.join(F.broadcast(counts), same, "left")
    rank = (F.col(name) + F.coalesce("_before", F.lit(0))).cast("int")
    return ranked.select(group, value, rank.alias(name))
