"""Batch job: newest snapshot of a landing folder with all its change files replayed on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.changes import rejects, replay, valid_changes
from tidewell.schemas import USERS_DDL, changes_ddl
from tidewell.sources.files import (
    is_snapshot_name,
    latest_snapshot_name,
    read_changes,
    read_latest_snapshot,
    settle_changes,
    unreadable_rows,
)


def replay_files(
    spark: SparkSession, landing: str, *, ddl: str = USERS_DDL, key: str | Sequence[str] = "user_id"
) -> DataFrame:
    """State after all changes; without change files, the snapshot as it is."""
    base = read_latest_snapshot(spark, landing, ddl=ddl)
    # Rejects are left out once the order is fixed, so they are not written.
    log = settle_changes(valid_changes(read_changes(spark, landing, ddl=ddl), key=key))
    return replay(base, log, key=key)


def rejected_changes(
    spark: SparkSession, landing: str, *, ddl: str = USERS_DDL, key: str | Sequence[str] = "user_id"
) -> DataFrame:
    """The changes of the landing folder that ``replay_files`` ignores, with the reason."""
    return rejects(read_changes(spark, landing, ddl=ddl), key=key)


def unreadable_lines(spark: SparkSession, landing: str, *, ddl: str = USERS_DDL) -> DataFrame:
    """Lines of the newest snapshot and of all change files that do not fit their layout, with the reason.

    ``replay_files`` takes what can be read of them, and NULL for the rest.
    """
    newest = latest_snapshot_name(spark, landing)
    base = unreadable_rows(spark, landing, ddl=ddl).filter(F.col("name") == newest)
    log = unreadable_rows(spark, landing, ddl=changes_ddl(ddl)).filter(~is_snapshot_name(F.col("name")))
    return base.unionByName(log)
