"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots, once and for all. What moves is the map from slots to
shards: a small table with a version number. Balancing edits a few entries of the newest version and
stores the result as the next one, so that only the records of those slots move.

Sharding by bytes hashes the key with the size and checksum of the text, and for rows that agree in all of
these which of them it is, so that neither null keys nor repeated rows pile up in a slot.

Defined results: a null key is hashed like any other value; a null text has no bytes; equal rows are told
apart by where they lie in the input, and get slots and places of their own; an empty table gives an empty result (and a map all the same). Columns
that are not named in the call are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.operators.joins import join_unique
from tidewell.session import settle, workspace

SLOTS = 8192
SHARDS = 40
ROW_BYTES = 16

MAP_DDL = "version INT, slot INT, shard INT"


def virtual_slot(key: str | list[str], slots: int = SLOTS) -> Column:
    names = [key] if isinstance(key, str) else key
    return F.pmod(F.xxhash64(*[F.col(name) for name in names]), F.lit(slots)).cast("int")


def record_size(text: str = "text") -> Column:
    """Bytes that a record takes in a shard."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + ROW_BYTES).cast("long")


def first_map(shards: int = SHARDS, slots: int = SLOTS) -> list[int]:
    return [slot % shards for slot in range(slots)]


def balanced(owner: list[int], loads: dict[int, int], shards: int) -> list[int]:
    """``owner`` with entries edited until no move or swap of slots between the fullest and the
    emptiest shard makes them more equal. ``loads`` has the bytes of each slot that is in use.

    Works on one number per slot, so its size is that of the map, not of the data.
    """
    owner = list(owner)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    total = [0] * shards
    for slot, load in loads.items():
        held[owner[slot]].append((load, slot))
        total[owner[slot]] += load
    for slots in held:
        slots.sort()
    full = [(-load, shard) for shard, load in enumerate(total)]
    empty = [(load, shard) for shard, load in enumerate(total)]
    heapq.heapify(full)
    heapq.heapify(empty)
    while True:
        high, low = _top(full, total, -1), _top(empty, total, 1)
        give, take = _exchange(held[high], held[low], total[high] - total[low])
        if give is None:
            return owner
        for moved, source, target in ((give, high, low), (take, low, high)):
            if moved is not None:
                held[source].pop(bisect_left(held[source], moved))
                insort(held[target], moved)
                owner[moved[1]] = target
                total[source] -= moved[0]
                total[target] += moved[0]
        for shard in (high, low):
            heapq.heappush(full, (-total[shard], shard))
            heapq.heappush(empty, (total[shard], shard))


def _top(heap: list[tuple[int, int]], total: list[int], sign: int) -> int:
    while heap[0][0] != sign * total[heap[0][1]]:
        heapq.heappop(heap)
    return heap[0][1]


def _nearest(slots: list[tuple[int, int]], wanted: float, gap: int) -> tuple[int, int] | None:
    """The slot whose load is nearest to ``wanted``, among loads between 0 and ``gap``."""
    place = bisect_left(slots, (wanted, -1))
    near = [slot for slot in slots[max(place - 1, 0) : place + 1] if 0 < slot[0] < gap]
    return min(near, key=lambda slot: (abs(slot[0] - wanted), slot[1]), default=None)


def _exchange(high, low, gap: int):
    """A slot to give from the fuller shard, and one to take back or None, that make both more equal."""
    give, take, best = _nearest(high, gap / 2, gap), None, float("inf")
    if give is not None:
        best = abs(give[0] - gap / 2)
    if give is None or best > gap / 4:
        for candidate in high:
            back = _nearest(low, candidate[0] - gap / 2, candidate[0])
            if back is not None and 0 < candidate[0] - back[0] < gap:
                off = abs(candidate[0] - back[0] - gap / 2)
                if off < best:
                    give, take, best = candidate, back, off
    return give, take


def grown(owner: list[int], shards: int) -> list[int]:
    """The map for one more shard, which takes every ``shards + 1``-th slot of each old shard only."""
    seen = [0] * shards
    result = list(owner)
    for slot, shard in enumerate(owner):
        seen[shard] += 1
        if (seen[shard] + shard) % (shards + 1) == 0:
            result[slot] = shards
    return result


def store_map(spark: SparkSession, path: str, version: int, owner: list[int]) -> None:
    """Add a version of the map; older versions stay readable."""
    rows = [(version, slot, shard) for slot, shard in enumerate(owner)]
    spark.createDataFrame(rows, MAP_DDL).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map, by default the newest: one row per slot."""
    versions = spark.read.schema(MAP_DDL).parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == version)


#: What a record is hashed by: ``copy`` is 0 but for repeated rows.
RECORD = ["key", "size", "text_crc32", "copy"]


def told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: 0 for the first of equal rows, a hash of part and number for the others. No task
    sees more of them than one part holds."""
    same = RECORD[:-1]
    number = F.row_number().over(Window.partitionBy(*same, "part").orderBy(F.lit(0)))
    first = rows.groupBy(*same).agg(F.min("part").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    each = join_unique(rows.withColumn("number", number), first, same, null_safe=True)
    own = F.when(F.col("n").isNull() | ((F.col("part") == F.col("first")) & (F.col("number") == 1)), F.lit(0).cast("long"))
    return each.withColumn("copy", own.otherwise(F.xxhash64("part", "number"))).drop("number", "first", "n")


def shard_records(
    docs: DataFrame, map_path: str, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """Every record with its virtual slot, its shard and its place there (``place``, gapless from 0).

    The map is created (version 1) and balanced by the bytes of each slot (version 2); both are kept
    under ``map_path``. Places count the records of a shard by slot, then by the part of the input they
    come from, then by key, so that no task sees more than one part of one slot.
    """
    spark = docs.sparkSession
    text = F.col("text")
    read = settle(
        docs.select(
            F.col(key).alias("key"),
            record_size("text").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.spark_partition_id().alias("part"),
        ),
        "sizes",
    )
    rows = settle(told_apart(read).withColumn("virtual_slot", virtual_slot(RECORD, slots)), "slots")
    parts = settle(
        rows.groupBy("virtual_slot", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "parts"
    )
    # One row per slot: bounded by the number of slots.
    loads = {
        row["virtual_slot"]: (row["bytes"], row["n"])
        for row in parts.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    }
    owner = first_map(shards, slots)
    store_map(spark, map_path, 1, owner)
    owner = balanced(owner, {slot: load for slot, (load, _) in loads.items()}, shards)
    store_map(spark, map_path, 2, owner)

    used = [0] * shards
    before = []
    for slot in sorted(loads):
        before.append((slot, owner[slot], used[owner[slot]]))
        used[owner[slot]] += loads[slot][1]
    places = F.broadcast(spark.createDataFrame(before, "virtual_slot INT, shard INT, slot_start LONG"))
    earlier = Window.partitionBy("virtual_slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part_starts = parts.withColumn("part_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    part_starts = part_starts.join(places, "virtual_slot").select(
        "virtual_slot", "part", "shard", (F.col("slot_start") + F.col("part_start")).alias("start")
    )
    within = Window.partitionBy("virtual_slot", "part").orderBy(*RECORD)
    return (
        rows.withColumn("number", F.row_number().over(within) - 1)
        .join(part_starts, ["virtual_slot", "part"])
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            "shard",
            (F.col("start") + F.col("number")).cast("long").alias("place"),
            "virtual_slot",
            F.lit(2).alias("map_version"),
        )
    )


def map_folder(spark: SparkSession) -> str:
    return workspace(spark, "slot-map")
