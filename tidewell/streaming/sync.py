"""Each new file of a landing folder is added once to a synced table.

A snapshot file (``LOAD<number>``) that is newer than the one loaded replaces the table. The change files
of the same batch and of later ones apply to it, whatever their names; those of earlier batches are gone
with the state that they changed. ``SyncedTable.rebuild`` replays all change files on it instead.

A snapshot may be delivered in many files. It is loaded once its delivery is complete, which the mark of its
writer says (``is_complete``); until then the old state stays and is kept in sync, and the changes that come in
the meantime are changes of the new state as well. A mark that comes alone is seen with the next batch or when a
stream is started. Files that come into the delivery's folder after that are added as inserts that come before
all changes; once changes were compacted they are late, as changes would be, until a ``rebuild``. Rows without
a key in such files are rejects, as inserts without a key are.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions import drop_name, first_number, folder_of
from tidewell.plans.synced_table import SyncedTable
from tidewell.schemas import changes_ddl
from tidewell.sources.files import (
    delivered_files,
    file_ids,
    is_complete,
    is_snapshot_row,
    read_delivery,
    read_snapshot,
    snapshot_order,
    with_order,
    with_position,
)
from tidewell.storage import read_text


def arrived(batch: DataFrame, loaded: str | None) -> Row:
    """Of a batch, ``newest``: its newest snapshot; ``parts``: whether it has parts of the one loaded."""
    name = drop_name(F.col("_path"))
    version = first_number(name)
    is_part = (version == loaded) & (F.substring_index("_path", "/", -1) != name)
    return (
        batch.filter(is_snapshot_row())
        .agg(
            F.max(F.when(version.isNotNull(), snapshot_order(version, name))).alias("newest"),
            F.max(is_part).alias("parts"),
        )
        .first()
    )


def _number(table: SyncedTable, name: str) -> str:
    return table.spark.range(1).select(first_number(F.lit(name))).first()[0]


def load_if_complete(table: SyncedTable, landing: str, name: str) -> bool:
    """Replace the table by the delivery ``name``, if all of it is there.

    The load itself is no batch's commit: if what follows fails, the batch is repeated on the new state.
    """
    if not is_complete(table.spark, landing, name):
        return False
    current = table.current()
    waited = current is not None and current.awaited == name
    table.load(
        read_delivery(table.spark, landing, name, ddl=table.ddl),
        number=_number(table, name),
        files=file_ids(delivered_files(table.spark, landing, name)),
        changes_after=current.awaited_from if waited else None,
    )
    return True


def later_parts(table: SyncedTable, batch: DataFrame, number: str) -> DataFrame | None:
    """Rows of the batch's files of the loaded snapshot, as inserts before all changes; None if it has none."""
    name = drop_name(F.col("_path"))
    found = batch.filter(is_snapshot_row()).select("_path", name.alias("name"), first_number(name).alias("version"))
    found = found.distinct().filter((F.col("version") == number) & (F.substring_index("_path", "/", -1) != F.col("name")))
    # A copy of the delivery in another folder is no part of it.
    known = table.taken().select(F.col("folder").alias("known")).distinct()
    found = found.join(known, folder_of(F.col("_path")) == F.col("known"), "left_semi")
    paths = [row[0] for row in found.select("_path").collect()]
    if not paths:
        return None
    rows = with_position(read_snapshot(table.spark, paths, ddl=table.ddl))
    rows = with_order(rows.select(F.lit("I").alias("action"), "*"))
    return rows.withColumn("seq", F.col("seq").withField("file", F.lit("")))


def sync_stream(
    table: SyncedTable,
    landing: str,
    checkpoint: str,
    *,
    max_files: int | None = None,
    max_age: str = "36500d",
    after_batch: Callable[[SyncedTable], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Start the sync; by default it takes up all files that are there and stops.

    The checkpoint keeps which files were taken, the table's manifest which batches of which checkpoint
    were committed, so a batch that is repeated after a failure has no effect. ``after_batch`` can
    publish features or compact.

    ``max_age``: files whose time stamp is older than the newest one's by more than this are never seen;
    the default lets none out, also copies that keep their time stamps. The stream then remembers all
    files it has seen; lower it only if files never come with old time stamps.
    """
    raw = table.spark.readStream.schema(changes_ddl(table.ddl)).option("recursiveFileLookup", "true")
    raw = raw.option("maxFileAge", max_age)
    if max_files is not None:
        raw = raw.option("maxFilesPerTrigger", max_files)

    def add(batch: DataFrame, batch_id: int) -> None:
        # The id of the query, which stays with its checkpoint and begins anew with a new one.
        stream = json.loads(read_text(table.spark, f"{checkpoint}/metadata"))["id"]
        if table.committed(stream, batch_id) is None:
            current = table.current()
            loaded = None if current is None else current.number
            found = arrived(batch, loaded)
            order = lambda number: (len(number), number)
            newer = found.newest is not None and (
                loaded is None or (found.newest.digits, found.newest.version) > order(loaded)
            )
            name, reloaded = found.newest["name"] if newer else None, False
            awaited = None if current is None else current.awaited
            if awaited is not None and (name is None or (found.newest.digits, found.newest.version) <= order(_number(table, awaited))):
                name = awaited
            if name is not None:
                reloaded = load_if_complete(table, landing, name)
                if not reloaded and name != awaited:
                    table.wait_for(name)
            # Changes of a table that nothing has started yet wait for a rebuild.
            if name is not None or current is not None:
                changes = with_order(batch.filter(~is_snapshot_row()))
                # Files that a load has taken are known to the table and have no effect.
                parts = later_parts(table, batch, loaded) if found.parts and not reloaded else None
                if parts is not None:
                    changes = changes.unionByName(parts)
                table.append(changes, stream=stream, batch_id=batch_id)
        if after_batch is not None and table.is_loaded():
            after_batch(table)

    current = table.current()
    if current is not None and current.awaited is not None:
        load_if_complete(table, landing, current.awaited)
    return (
        with_position(raw.csv(landing))
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
