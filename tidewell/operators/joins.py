"""Left join of many rows to a lookup that has one row per key, safe for hot keys.

Small lookups are broadcast by Catalyst, which checks their size. If the rows are many and the lookup's
size is only guessed (it is the result of an aggregation), the lookup is written first: now its rows and
texts can be counted, and up to a limit of their size in memory it is broadcast, so that the rows need no shuffle. If it is larger, the
heaviest keys of the rows are found in a sample and taken out of the shuffle: their lookup rows, at most
HOT_LIMIT, are broadcast, and all other rows take the shuffle join. The sample only decides which way a
row goes, never whether it is kept.

AQE's skew-join rule alone is not enough here: it splits only sides that come straight from a shuffle,
not from an aggregation after one, and above 2,000 partitions Spark reports only the average size of all
blocks under 100 MB, which hides a hot partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import (
    broadcast_limit,
    estimated_bytes,
    input_bytes,
    is_large,
    memory_bytes,
    settle,
    shared_folder,
    written_broadcast_limit,
)

HOT_LIMIT = 1000  # at most this many keys are kept out of the shuffle
HOT_FLOOR = 30  # sampled rows a key must have, so that chance does not make it hot
HOT_BYTES = 1 << 26  # about this much of the rows a key must have to be called hot
SAMPLE_BYTES = 1 << 30  # about this much of the rows is sampled, keys only

HotKeys = Sequence[tuple]


def sized_lookup(lookup: DataFrame, *rows: DataFrame) -> tuple[DataFrame, bool]:
    """``lookup``, and whether joining it to some of ``rows`` means to shuffle many of them."""
    spark = lookup.sparkSession
    shared_folder(spark)
    if not any(map(is_large, rows)) or estimated_bytes(lookup) <= broadcast_limit(spark):
        return lookup, False
    lookup = settle(lookup, "lookup")
    if broadcast_limit(spark) >= 0 and memory_bytes(lookup) <= written_broadcast_limit(spark):
        return F.broadcast(lookup), False
    return lookup, True


def hot_keys(rows: DataFrame, on: Sequence[str]) -> HotKeys:
    """The heaviest keys in a sample of ``rows``, at most HOT_LIMIT of them."""
    fraction = min(1.0, max(SAMPLE_BYTES / max(input_bytes(rows), 1), 1e-7))
    floor = max(HOT_FLOOR, HOT_BYTES * fraction / rows._jdf.schema().defaultSize())
    heavy = (
        rows.select(*on)
        .sample(fraction=fraction, seed=7)
        .groupBy(*on)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") >= floor)
        .orderBy(F.desc("_n"), *on)
        .limit(HOT_LIMIT)
    )
    return [tuple(row[name] for name in on) for row in heavy.collect()]


def _join(rows: DataFrame, other: DataFrame, on: Sequence[str], null_safe: bool, how: str) -> DataFrame:
    right = {name: f"_lookup_{name}" for name in on}
    same = (
        F.col(name).eqNullSafe(F.col(alias)) if null_safe else F.col(name) == F.col(alias)
        for name, alias in right.items()
    )
    joined = rows.join(other.withColumnsRenamed(right), reduce(Column.__and__, same), how)
    return joined.drop(*right.values())


def join_unique(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    *,
    null_safe: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``rows`` LEFT JOIN ``lookup``, which must have one row per ``on`` key.

    ``hot`` names the keys to keep out of the shuffle, the heaviest first, as only HOT_LIMIT of them can be;
    by default they are looked for when needed.
    """
    if hot is None:
        lookup, shuffled = sized_lookup(lookup, rows)
        hot = hot_keys(rows, on) if shuffled else ()
    if not hot:
        return _join(rows, lookup, on, null_safe, "left")

    # The first of a longer list; the others take the shuffle join like all keys.
    keys = list(dict.fromkeys(map(tuple, hot)))[:HOT_LIMIT]
    few = F.broadcast(rows.sparkSession.createDataFrame(keys, rows.select(*on).schema))
    has_null = any(value is None for key in keys for value in key)  # else the faster plain equality will do
    # One row per hot key, with its attributes if the lookup has the key. Joining it picks the hot rows.
    known = F.broadcast(_join(lookup, few, on, null_safe, "left_semi"))
    hot_rows = _join(rows, F.broadcast(_join(few, known, on, null_safe, "left")), on, has_null, "inner")
    other_rows = _join(_join(rows, few, on, has_null, "left_anti"), lookup, on, null_safe, "left")
    return hot_rows.unionByName(other_rows)


def lookup_table(dimension: DataFrame, key: str) -> DataFrame:
    """``dimension`` with one row per non-NULL ``key``; a repeated key fails when the plan runs."""
    values = [name for name in dimension.columns if name != key]
    message = F.concat(F.lit(f"dimension key {key} is not unique: "), F.col(key).cast("string"))
    return (
        dimension.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_copies"), *(F.max(name).alias(name) for name in values))
        .select(
            key,
            *(
                F.when(F.col("_copies") == 1, F.col(name)).otherwise(F.raise_error(message)).alias(name)
                for name in values
            ),
        )
    )


def denormalize(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Add the dimension's attributes to every row; no match or a NULL key gives NULL."""
    return join_unique(rows, lookup_table(dimension, key), [key])
