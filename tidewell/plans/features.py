"""City features of the synced table: state, recency rank, login rate, distinct users; summaries.

All features of a row follow from its city and login day, so they are computed once per (city, day)
pair and joined to the rows in a single join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import is_recent, rewrite
from tidewell.operators.joins import HotKeys, denormalize, join_unique, lookup_table
from tidewell.operators.windows import RANK, RATE, USERS, distinct_users, recency_rank
from tidewell.session import settle

# City names that are written in more than one way in the source.
CITY_ALIASES = {"Nashville-Davidson": "Nashville"}

BROADCAST_ROWS = 10_000

FEATURES = ["state", RANK, RATE, USERS]


def normalize_city(rows: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    aliases = CITY_ALIASES if aliases is None else aliases
    return rows.withColumn("city", rewrite(F.col("city"), aliases))


def city_stats(rows: DataFrame, dimension: DataFrame, as_of: dt.date, *, days: int = 90) -> DataFrame:
    """All features, one row per (city, last_login) of ``rows`` with normalized cities."""
    pairs = rows.groupBy("city", "last_login").agg(F.count("*").alias("_n"))
    return stats_of_counts(pairs, distinct_users(rows, "city", "user_id"), dimension, as_of, days=days)


def stats_of_counts(
    pairs: DataFrame, users: DataFrame, dimension: DataFrame, as_of: dt.date, *, days: int = 90
) -> DataFrame:
    """``city_stats`` from ``pairs``, the number of rows ``_n`` of each (city, last_login), and the users per city."""
    whole_city = Window.partitionBy("city")
    recent = F.when(is_recent(F.col("last_login"), as_of, days), F.col("_n")).otherwise(0)
    ranked = pairs.select(
        "city",
        "last_login",
        recency_rank("city", "last_login").alias(RANK),
        (F.sum(recent).over(whole_city) / F.sum("_n").over(whole_city)).alias(RATE),
    )
    # A left join whose other side has one row per city: the few rows need no care for hot cities.
    per_city = users.join(lookup_table(dimension, "city"), "city", "left").withColumnRenamed("city", "_city")
    return ranked.join(per_city, F.col("city").eqNullSafe(F.col("_city")), "left").select(
        "city", "last_login", *FEATURES
    )


def city_features(
    rows: DataFrame,
    dimension: DataFrame,
    as_of: dt.date,
    *,
    days: int = 90,
    aliases: dict[str, str] | None = None,
    stats: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``rows`` with the four features. ``stats`` may be a written ``city_stats`` of the same rows.

    ``rows`` are read three times, so a state that takes a replay to compute should be written first.
    """
    rows = normalize_city(rows, aliases)
    if stats is None:
        stats = city_stats(rows, dimension, as_of, days=days)
    return join_unique(rows, stats, ["city", "last_login"], null_safe=True, hot=hot).select(*rows.columns, *FEATURES)


def sort_features(features: DataFrame) -> DataFrame:
    """Cities in order, oldest login first within a city, ties by user.

    Copies of one row are told apart by the partition they come from, so that a range sort can spread
    them; they are equal, so their order does not show.
    """
    return (
        features.withColumn("_from", F.spark_partition_id())
        .orderBy(F.asc_nulls_first("city"), F.desc(RANK), "user_id", "name", "_from")
        .drop("_from")
    )


def sort_key() -> Column:
    """The order of ``sort_features`` as one value."""
    return F.struct("city", -F.col(RANK), "user_id", "name")


def first_features(
    rows: DataFrame,
    dimension: DataFrame,
    as_of: dt.date,
    *,
    n: int = 10,
    days: int = 90,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """The first ``n`` rows of the sorted features, without computing the features of all rows.

    A high rank is an old login, so the first rows are known before any feature is; only their cities,
    at most ``n``, are then read for the features.
    """
    rows = normalize_city(rows, aliases)
    first = rows.orderBy(
        F.asc_nulls_first("city"), F.asc_nulls_first("last_login"), F.asc("user_id"), F.asc("name")
    ).limit(n)
    first = settle(first, "first")  # n rows, which are read twice
    cities = first.select(F.col("city").alias("_city")).distinct()
    if n <= BROADCAST_ROWS:
        cities = F.broadcast(cities)
    same_city = F.col("city").eqNullSafe(F.col("_city"))
    stats = city_stats(rows.join(cities, same_city, "left_semi"), dimension, as_of, days=days)
    features = city_features(first, dimension, as_of, days=days, aliases={}, stats=stats, hot=())
    return features.orderBy(F.asc_nulls_first("city"), F.desc(RANK), "user_id", "name").limit(n)


def summary_by_city(
    rows: DataFrame,
    dimension: DataFrame,
    as_of: dt.date,
    *,
    days: int = 90,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    return _summary(normalize_city(rows, aliases), "city", as_of, days).join(
        lookup_table(dimension, "city"), "city", "left"
    )


def summary_by_state(
    rows: DataFrame,
    dimension: DataFrame,
    as_of: dt.date,
    *,
    days: int = 90,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """One row per state; cities without a state are summed up under NULL."""
    return _summary(denormalize(normalize_city(rows, aliases), dimension, "city"), "state", as_of, days)


def _summary(rows: DataFrame, group: str, as_of: dt.date, days: int) -> DataFrame:
    recent = is_recent(F.col("last_login"), as_of, days).cast("double")
    return rows.groupBy(group).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("user_id").cast("int").alias("users"),
        F.avg(recent).alias("login_rate"),
        F.max("last_login").alias("latest_login"),
    )
