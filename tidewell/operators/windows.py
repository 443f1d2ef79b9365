"""Per-group window features computed from pre-aggregated groups instead of whole partitions.

``dense_rank`` over a group depends only on the group's distinct order values, and a whole-partition
average or distinct count has one value per group. So each is computed on aggregated rows, which Spark
combines before the shuffle, and joined back; no task ever holds all rows of one group.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidewell.functions import is_recent
from tidewell.operators.joins import HotKeys, join_unique
from tidewell.operators.ranking import dense_rank_by_group

RANK = "last_login_rank_by_city"
RATE = "login_rate_last_3_months_by_city"
USERS = "users_by_city"


def recency_rank(group: str, day: str) -> Column:
    """Dense rank, newest day first, NULL last. The rows must be distinct (group, day) pairs."""
    return F.dense_rank().over(Window.partitionBy(group).orderBy(F.desc_nulls_last(day)))


def distinct_users(rows: DataFrame, group: str, user: str) -> DataFrame:
    """Distinct non-NULL users per group; Spark deduplicates on (group, user) before it counts."""
    return rows.groupBy(group).agg(F.countDistinct(user).cast("int").alias(USERS))


def rank_by_group(
    rows: DataFrame, *, group: str = "city", day: str = "last_login", hot: HotKeys | None = None
) -> DataFrame:
    """``rows`` with the dense rank of ``day`` in its group, newest first.

    A group has no more dates than there are days, so its distinct ones are ranked by one task; of any other
    type a group may have as many values as rows, and is ranked in parts.
    """
    pairs = rows.select(group, day).distinct()
    if isinstance(rows.schema[day].dataType, DateType):
        ranks = pairs.select(group, day, recency_rank(group, day).alias(RANK))
    else:
        ranks = dense_rank_by_group(pairs, group, day, RANK)
    return join_unique(rows, ranks, [group, day], null_safe=True, hot=hot)


def login_rate_by_group(
    rows: DataFrame,
    as_of: dt.date,
    *,
    days: int = 90,
    group: str = "city",
    day: str = "last_login",
    hot: HotKeys | None = None,
) -> DataFrame:
    recent = is_recent(F.col(day), as_of, days).cast("double")
    rates = rows.groupBy(group).agg(F.avg(recent).alias(RATE))
    return join_unique(rows, rates, [group], null_safe=True, hot=hot)


def users_by_group(
    rows: DataFrame, *, group: str = "city", user: str = "user_id", hot: HotKeys | None = None
) -> DataFrame:
    return join_unique(rows, distinct_users(rows, group, user), [group], null_safe=True, hot=hot)
