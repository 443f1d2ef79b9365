"""Replay of an ordered change log on a keyed table, as one plan of fixed size.

A change row carries an action (insert, update or delete), the key, and the full row image. Changes
apply in ``seq`` order, with these rules:

* an insert appends a row and does not check for the key, so copies survive;
* an update overwrites every row that has the key at that point, also with NULL; it never inserts;
* a delete drops every row that has the key at that point.

A row therefore survives if no delete of its key comes after its birth (base rows are born before all
changes), and shows the image of the key's last update if that comes after its birth. So it is enough
to know, per key, when the last delete came and what the last update was: one aggregation of the log,
combined map-side, and one join. ``seq`` may have any type with an order and must be unique per key; the
row's columns need an order as well, so no maps.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.joins import HotKeys, hot_keys, join_unique, sized_lookup
from tidewell.session import is_large

INSERT, UPDATE, DELETE = "I", "U", "D"


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(name).isNotNull() for name in keys))


def valid_changes(
    log: DataFrame,
    *codes: str,
    key: str | Sequence[str] = "user_id",
    action: str = "action",
) -> DataFrame:
    """Changes that replay applies, or only those with the given codes. The filter reaches the scan."""
    return log.filter(F.col(action).isin(*(codes or (INSERT, UPDATE, DELETE))) & _has_key(_names(key)))


def rejects(log: DataFrame, *, key: str | Sequence[str] = "user_id", action: str = "action") -> DataFrame:
    """Changes that replay ignores, with the reason."""
    known = F.coalesce(F.col(action).isin(INSERT, UPDATE, DELETE), F.lit(False))
    keyed = _has_key(_names(key))
    reason = F.when(~known, F.lit("unknown action")).otherwise(F.lit("null key"))
    return log.filter(~(known & keyed)).withColumn("reason", reason)


def net_changes(
    log: DataFrame,
    columns: Sequence[str],
    *,
    key: str | Sequence[str] = "user_id",
    seq: str = "seq",
    action: str = "action",
) -> DataFrame:
    """One row per changed key: when its last delete came, and its last update."""
    code = F.col(action)
    image = F.struct(F.col(seq).alias("_at"), *columns)
    return (
        valid_changes(log, UPDATE, DELETE, key=key, action=action)
        .groupBy(*_names(key))
        .agg(
            F.max(F.when(code == DELETE, F.col(seq))).alias("_deleted_at"),
            F.max(F.when(code == UPDATE, image)).alias("_update"),
        )
    )


def _net_applied(rows: DataFrame, net: DataFrame, keys: list[str], columns: list[str], hot: HotKeys) -> DataFrame:
    """Drop and overwrite ``rows`` by the net changes. Rows without ``_born`` are base rows."""
    joined = join_unique(rows, net, keys, hot=hot)
    if "_born" in rows.columns:
        survives = F.coalesce(F.col("_born") > F.col("_deleted_at"), F.lit(True))
        updated = F.coalesce(F.col("_update._at") > F.col("_born"), F.lit(False))
    else:
        survives = F.col("_deleted_at").isNull()
        updated = F.col("_update").isNotNull()
    return joined.filter(survives).select(
        *keys,
        *(F.when(updated, F.col("_update")[name]).otherwise(F.col(name)).alias(name) for name in columns),
    )


def replay(
    base: DataFrame,
    log: DataFrame,
    *,
    key: str | Sequence[str] = "user_id",
    seq: str = "seq",
    action: str = "action",
    hot: HotKeys | None = None,
) -> DataFrame:
    """State of ``base`` after all changes of ``log``. Columns are those of ``base``.

    Base rows with a NULL key are kept: no change can address them. ``hot`` as in ``join_unique``.
    """
    keys = _names(key)
    columns = [name for name in base.columns if name not in keys]
    inserted = valid_changes(log, INSERT, key=keys, action=action).select(*keys, *columns, F.col(seq).alias("_born"))
    net, shuffled = sized_lookup(net_changes(log, columns, key=keys, seq=seq, action=action), base, inserted)

    def applied(rows: DataFrame) -> DataFrame:
        found = hot_keys(rows, keys) if hot is None and shuffled and is_large(rows) else hot or ()
        return _net_applied(rows, net, keys, columns, found)

    # Two joins rather than one over the union: base rows need no birth, and inserts, which come with
    # the log, do not change how the base is joined. Both read the same exchange of the net changes.
    return applied(base).unionByName(applied(inserted)).select(*base.columns)


def apply_updates(
    base: DataFrame,
    updates: DataFrame,
    *,
    key: str | Sequence[str] = "user_id",
    seq: str = "seq",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Overwrite each row by the last update of its key; keys without a row have no effect."""
    keys = _names(key)
    columns = [name for name in base.columns if name not in keys]
    last = (
        updates.filter(_has_key(keys))
        .groupBy(*keys)
        .agg(F.max(F.struct(F.col(seq).alias("_at"), *columns)).alias("_update"))
    )
    updated = F.col("_update").isNotNull()
    return join_unique(base, last, keys, hot=hot).select(
        *(
            F.col(name) if name in keys else F.when(updated, F.col("_update")[name]).otherwise(F.col(name)).alias(name)
            for name in base.columns
        )
    )


def apply_deletes(
    base: DataFrame, deletes: DataFrame, *, key: str | Sequence[str] = "user_id", hot: HotKeys | None = None
) -> DataFrame:
    """Drop every row whose key is deleted; rows with a NULL key stay."""
    keys = _names(key)
    gone = deletes.filter(_has_key(keys)).groupBy(*keys).agg(F.lit(True).alias("_gone"))
    return join_unique(base, gone, keys, hot=hot).filter(F.col("_gone").isNull()).select(*base.columns)


def apply_inserts(base: DataFrame, inserts: DataFrame, *, key: str | Sequence[str] = "user_id") -> DataFrame:
    """Append the inserted rows; copies of a key survive."""
    return base.unionByName(inserts.filter(_has_key(_names(key))).select(*base.columns))


def duplicate_keys(rows: DataFrame, *, key: str | Sequence[str] = "user_id") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*_names(key)).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def not_equal(rows: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` differs from ``value``; NULL is not different, so it is dropped."""
    return rows.filter(F.col(column) != F.lit(value))
