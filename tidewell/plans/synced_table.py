"""A synced table on storage: a snapshot, the changes since, and a manifest that commits versions.

Folder layout under ``root``::

    snapshots/<version>/                  full state, Parquet
    log/_snapshot=<version>/_append=<n>/  changes of the n-th append, with ``seq``, since that snapshot
    late/_snapshot=<version>/_append=<n>/ those of them that came too late to be put in order
    files/_ledger=<version>/_append=<n>/  one row per change file of an append, since that ledger
    ledgers/<version>/                    all files up to then, sorted by name
    features/<version>-<id>/              published features, with the table of city statistics
    manifest/<epoch>/<version>.json       one line per committed version

Appends are numbered without gaps, so that a line of the manifest needs only the first and the last number
to say what belongs to the table: the log is read as one folder with a range of its partitions, and neither
plans nor the lines that are read grow with the number of versions. Every FOLD appends the lists of files are
folded into one ledger, of which a later append reads the names between those of its own files.

A new change file costs its own size and one row in the list of files: its rows are added to the log, and
readers replay the log since the last snapshot, which is one aggregation of the log and one join.
``compact`` writes the state as a new snapshot when the log has grown. No path that is being read is ever
overwritten, and only what the manifest names is read, so a failed run leaves nothing visible and can be
repeated. There must be one writer at a time.

Changes are ordered by file name, whatever the order of arrival. Once compacted, the order is settled:
a file whose name sorts at or before the newest compacted file is kept apart as late; a replay of the keys
it addresses (``repair``), or of the whole landing folder (``rebuild``), puts it right. A file that came once, in time or late, is not taken
again, also after a compaction.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import first_number
from tidewell.operators import changes as ops
from tidewell.operators.changes import replay
from tidewell.plans.features import city_features, city_stats, normalize_city, sort_features
from tidewell.schemas import FILE_ID, SEQ_DDL, USERS_DDL, changes_ddl
from tidewell.session import estimated_bytes, settle
from tidewell.sources.files import (
    delivered_files,
    file_ids,
    latest_snapshot_name,
    read_changes,
    read_delivery,
    settle_changes,
)
from tidewell.storage import make_folder, names, read_text, write_once

# snapshot: version of the snapshot to start from; its log is that of the appends after ``first``.
# mark: newest file whose changes are part of the snapshot.
# loaded: version that replaced the table; its files are those of appends after ``since``, its late changes
# those after ``late_since``.
# last: number of the newest append. ledger: version of the newest ledger; folded: the last append in it.
# number: of the snapshot file that was loaded, as text; path: of published features.
# awaited: delivery of a newer snapshot that is not complete; awaited_from: the last append before it.
# streams: newest batch of every stream, with the version that has it.
MANIFEST_DDL = (
    "version BIGINT, kind STRING, snapshot BIGINT, first BIGINT, last BIGINT, mark STRING, loaded BIGINT,"
    " since BIGINT, late_since BIGINT, ledger BIGINT, folded BIGINT, number STRING, awaited STRING, awaited_from BIGINT, path STRING,"
    " stream STRING, batch_id BIGINT, streams MAP<STRING, ARRAY<BIGINT>>"
)
_FIELDS = [part.split()[0] for part in MANIFEST_DDL.replace("MAP<STRING, ARRAY<BIGINT>>", "MAP").split(", ")]
# What one version alone says.
_OWN = ("path", "stream", "batch_id")

FOLD = 16
EPOCH = 1000


class SyncedTable:
    """``ddl`` gives the columns of the table, ``key`` those that changes address rows by."""

    def __init__(
        self, spark: SparkSession, root: str, *, ddl: str = USERS_DDL, key: str | Sequence[str] = "user_id"
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ddl = ddl
        self.key = key

    # Manifest

    def history(self) -> DataFrame:
        """One row per version."""
        if not names(self.spark, f"{self.root}/manifest"):
            return self.spark.createDataFrame([], MANIFEST_DDL)
        reader = self.spark.read.schema(MANIFEST_DDL).option("recursiveFileLookup", "true")
        return reader.json(f"{self.root}/manifest")

    def current(self) -> Row | None:
        """The newest version: one listing, and one line read."""
        epochs = names(self.spark, f"{self.root}/manifest")
        if not epochs:
            return None
        newest = max(names(self.spark, f"{self.root}/manifest/{max(epochs)}"))
        return self.version(int(newest.split(".")[0]))

    def _line(self, version: int) -> str:
        return f"{self.root}/manifest/{version // EPOCH:09d}/{version:012d}.json"

    def version(self, version: int) -> Row:
        """The line of a version."""
        known = json.loads(read_text(self.spark, self._line(version)))
        return Row(**{name: known.get(name) for name in _FIELDS})

    def _require_current(self) -> Row:
        current = self.current()
        if current is None:
            raise ValueError(f"nothing loaded into {self.root} yet")
        return current

    def _commit(self, version: int, current: Row | None = None, **fields) -> int:
        """Make a version visible; what ``fields`` does not name stays as in ``current``."""
        kept = {} if current is None else {k: v for k, v in current.asDict().items() if k not in _OWN}
        fields = {**kept, **fields, "version": version}
        if fields.get("stream") is not None:
            fields["streams"] = {**(fields.get("streams") or {}), fields["stream"]: [fields["batch_id"], version]}
        write_once(self.spark, self._line(version), json.dumps(fields))
        return version

    def committed(self, stream: str, batch_id: int) -> int | None:
        """Version that has the stream's batch, or a later batch of it."""
        return self._committed(self.current(), stream, batch_id)

    @staticmethod
    def _committed(current: Row | None, stream: str | None, batch_id: int | None) -> int | None:
        known = ((current and current.streams) or {}).get(stream)
        return known[1] if known and batch_id <= known[0] else None

    # Changes of the table

    def load(
        self,
        state: DataFrame,
        *,
        mark: str | None = None,
        number: str | None = None,
        files: DataFrame | None = None,
        changes_after: int | None = None,
        stream: str | None = None,
        batch_id: int | None = None,
    ) -> int:
        """Replace the table. ``mark`` names the newest change file that ``state`` contains, ``number`` the
        snapshot file it is, and ``files`` the files it contains (columns ``FILE_ID``). Appends with numbers
        above ``changes_after`` are changes of ``state``; by default there are none."""
        current = self.current()
        version = 0 if current is None else current.version + 1
        last = 0 if current is None else current.last
        first = last if changes_after is None else changes_after
        state.write.mode("overwrite").parquet(self._snapshot(version))
        self._start(version)
        known = self._no_files() if files is None else files.select(*FILE_ID)
        if first < last:
            log = self._kept_apart("log", first).filter(_is_delivered())
            log = log.unionByName(self._kept_apart("late", first))
            path = f"{self.root}/log/_snapshot={version}"
            log.write.mode("overwrite").partitionBy("_append").parquet(path)
            known = known.union(log.select(*(F.col("seq")[name].alias(name) for name in FILE_ID)))
        self._write_ledger(version, known)
        return self._commit(
            version,
            current,
            kind="load",
            snapshot=version,
            first=first,
            last=last,
            mark=mark,
            loaded=version,
            since=first,
            late_since=first,
            ledger=version,
            folded=last,
            number=number,
            awaited=None,
            awaited_from=None,
            stream=stream,
            batch_id=batch_id,
        )

    def wait_for(self, name: str) -> int:
        """Note that a newer snapshot has begun to come; the changes from now on are also changes of it.

        In a table that nothing was loaded into, changes are kept for it; there is no state until it is loaded.
        """
        current = self.current()
        if current is not None:
            fields = {"awaited": name, "awaited_from": current.last}
            return self._commit(current.version + 1, current, kind="wait", **fields)
        self._start(0)
        self._write_ledger(0, self._no_files())
        zero = dict.fromkeys(("snapshot", "first", "last", "since", "late_since", "ledger", "folded", "awaited_from"), 0)
        return self._commit(0, kind="wait", awaited=name, **zero)

    def rebuild(self, landing: str) -> int:
        """Replace the table by the newest complete snapshot of ``landing`` with all change files replayed."""
        current = self.current()
        name = latest_snapshot_name(self.spark, landing, without=current and current.awaited)
        log = settle_changes(read_changes(self.spark, landing, ddl=self.ddl))
        newest = log.agg(F.max("seq.file")).first()[0]
        base = read_delivery(self.spark, landing, name, ddl=self.ddl)
        files = _files(log).union(file_ids(delivered_files(self.spark, landing, name)))
        number = self.spark.range(1).select(first_number(F.lit(name))).first()[0]
        return self.load(replay(base, log, key=self.key), mark=newest, number=number, files=files)

    def append(self, changes: DataFrame, *, stream: str | None = None, batch_id: int | None = None) -> int:
        """Add changes, as given by ``read_changes``.

        A stream's batch that is there already has no effect, nor have files that came before.
        """
        current = self._require_current()
        if stream is not None and (done := self._committed(current, stream, batch_id)) is not None:
            return done
        version, number = current.version + 1, current.last + 1
        path = f"{self.root}/files/_ledger={current.ledger}/_append={number}"
        _files(changes).write.mode("overwrite").parquet(path)
        files = self.spark.read.schema(_FILES_DDL).parquet(path)
        repeated = self._repeated(current, files)
        if not repeated.isEmpty():
            files = settle(files.join(repeated, FILE_ID, "left_anti"), "new-files")
            files.write.mode("overwrite").parquet(path)
            new = [F.col("seq")[name] == F.col(f"_new_{name}") for name in FILE_ID]
            renamed = files.select(*(F.col(name).alias(f"_new_{name}") for name in FILE_ID))
            changes = changes.join(renamed, new, "left_semi")
        place = f"_snapshot={current.snapshot}/_append={number}"
        if current.mark is not None:
            is_late = F.col("seq.file") <= current.mark
            changes.filter(is_late).write.mode("overwrite").parquet(f"{self.root}/late/{place}")
            changes = changes.filter(~is_late)
        changes.write.mode("overwrite").parquet(f"{self.root}/log/{place}")
        ledger = {}
        if number - current.folded >= FOLD:
            known = self._since_ledger(current, number).select(*FILE_ID).union(self._ledger(current))
            self._write_ledger(version, known)
            ledger = {"ledger": version, "folded": number}
        return self._commit(
            version, current, kind="append", last=number, stream=stream, batch_id=batch_id, **ledger
        )

    def compact(self, ratio: float = 0.0) -> int:
        """Write the state as a snapshot, so that readers need no replay, if the files of the log are larger
        than ``ratio`` times those of the snapshot."""
        current = self._require_current()
        if current.first == current.last or current.loaded is None:
            return current.version
        log = self._log(current)
        if ratio and estimated_bytes(log) <= ratio * estimated_bytes(self._base(current)):
            return current.version
        version = current.version + 1
        newest = log.agg(F.max("seq.file")).first()[0]
        mark = max((name for name in (newest, current.mark) if name is not None), default=None)
        self._state(current).write.mode("overwrite").parquet(self._snapshot(version))
        self._start(version)
        return self._commit(version, current, kind="compact", snapshot=version, first=current.last, mark=mark)

    def repair(self) -> int:
        """Put late changes in their place, for the keys that they address and no others.

        The rows of these keys are replayed from the state that was loaded and all changes up to the mark, late
        ones among them. What comes out is added to the log as changes that come right after the mark: the
        old rows are deleted and the new ones inserted; the changes since the mark apply to them. If the load
        itself had a mark, as a ``rebuild`` has, its state can't be taken apart, and only a rebuild will do.
        """
        current = self._require_current()
        late = ops.valid_changes(self.late(), key=self.key) if current.mark is not None else None
        if late is None or late.isEmpty():
            return current.version
        if self.version(current.loaded).mark is not None:
            raise ValueError("the table was loaded with changes in it: rebuild it")
        names_of_key = [self.key] if isinstance(self.key, str) else list(self.key)
        keys = settle(late.select(*names_of_key).distinct(), "late-keys")
        past = self._kept_apart("log").unionByName(self._kept_apart("late"))
        past = past.filter((F.col("seq.file") <= current.mark) & _is_delivered()).drop("_append")
        loaded = self.spark.read.schema(self.ddl).parquet(self._snapshot(current.loaded))
        rows = replay(
            loaded.join(keys, names_of_key, "left_semi"), past.join(keys, names_of_key, "left_semi"), key=self.key
        )
        version, number = current.version + 1, current.last + 1

        def changes(rows: DataFrame, action: str, block: int) -> DataFrame:
            places = {"file": current.mark, "folder": _REPAIRED, "part": number, "base": "", "block": block}
            parts = [F.lit(value).alias(name) for name, value in places.items()]
            seq = F.struct(*parts, F.monotonically_increasing_id().alias("row")).cast(SEQ_DDL)
            return rows.withColumns({"action": F.lit(action), "seq": seq})

        gone = changes(keys, "D", 0).unionByName(changes(rows, "I", 1), allowMissingColumns=True)
        columns = [field.name for field in self._base(current).schema]
        path = f"{self.root}/log/_snapshot={current.snapshot}/_append={number}"
        gone.select("action", *columns, "seq").write.mode("overwrite").parquet(path)
        return self._commit(version, current, kind="repair", last=number, late_since=number)

    # Reading

    def is_loaded(self) -> bool:
        """Whether there is a state."""
        current = self.current()
        return current is not None and current.loaded is not None

    def state(self, version: int | None = None) -> DataFrame:
        """The table as of ``version``, by default the newest."""
        row = self._require_current()
        if version is not None:
            if not 0 <= version <= row.version:
                raise ValueError(f"{self.root} has no version {version}")
            row = self.version(version)
        return self._state(row)

    def late(self) -> DataFrame:
        """Changes that were kept apart and are not in the state, with the append they came with."""
        return self._kept_apart("late", self._require_current().late_since)

    def rejects(self) -> DataFrame:
        """Changes since the table was loaded that replay ignores, with the reason and their append."""
        return ops.rejects(self._kept_apart("log"), key=self.key)

    def taken(self) -> DataFrame:
        """The files (``FILE_ID``) that are part of the table since it was loaded."""
        current = self._require_current()
        return self._since_ledger(current).select(*FILE_ID).union(self._ledger(current))

    def changed_keys(self, since: Row) -> DataFrame:
        """Keys of the changes that were added after ``since``, a version of the table as it is loaded now."""
        keys = [self.key] if isinstance(self.key, str) else list(self.key)
        return ops.valid_changes(self._kept_apart("log", since.last), key=keys).select(*keys).distinct()

    def published(self) -> list[str]:
        """Paths of published features, oldest first."""
        rows = self.history().filter("kind = 'publish'").orderBy("version").collect()
        return [row.path for row in rows]

    def _kept_apart(self, folder: str, first: int | None = None) -> DataFrame:
        """Rows of all appends since the table was loaded, or after ``first``, over its compactions."""
        current = self._require_current()
        rows = self._log_folder(folder, None, current.since if first is None else first, current.last)
        return rows.filter(F.col("_snapshot") >= (current.loaded or 0)).drop("_snapshot")

    def _snapshot(self, version: int) -> str:
        return f"{self.root}/snapshots/{version}"

    def _start(self, version: int) -> None:
        """Folders for what comes after a snapshot, so that reading them before anything has come is no error."""
        for folder in ("log", "late"):
            make_folder(self.spark, f"{self.root}/{folder}/_snapshot={version}")

    def _base(self, row: Row) -> DataFrame:
        return self.spark.read.schema(self.ddl).parquet(self._snapshot(row.snapshot))

    def _partitions(self, folder: str, below: str, ddl: str, kept: Column) -> DataFrame:
        reader = self.spark.read.schema(ddl).option("basePath", f"{self.root}/{folder}")
        return reader.parquet(f"{self.root}/{folder}{below}").filter(kept)

    def _log_folder(self, folder: str, snapshot: int | None, first: int, last: int) -> DataFrame:
        ddl = f"{changes_ddl(self.ddl)}, seq {SEQ_DDL}, _snapshot BIGINT, _append BIGINT"
        below = "" if snapshot is None else f"/_snapshot={snapshot}"
        return self._partitions(folder, below, ddl, (F.col("_append") > first) & (F.col("_append") <= last))

    def _log(self, row: Row) -> DataFrame:
        return self._log_folder("log", row.snapshot, row.first, row.last).drop("_snapshot", "_append")

    def _state(self, row: Row) -> DataFrame:
        if row.loaded is None:
            raise ValueError(f"nothing loaded into {self.root} yet")
        base = self._base(row)
        return base if row.first == row.last else replay(base, self._log(row), key=self.key)

    # Files

    def _no_files(self) -> DataFrame:
        return self.spark.createDataFrame([], _FILES_DDL)

    def _write_ledger(self, version: int, files: DataFrame) -> None:
        sorted_files = files.distinct().sort("base", "folder")
        sorted_files.write.mode("overwrite").parquet(f"{self.root}/ledgers/{version}")
        make_folder(self.spark, f"{self.root}/files/_ledger={version}")

    def _ledger(self, row: Row) -> DataFrame:
        return self.spark.read.schema(_FILES_DDL).parquet(f"{self.root}/ledgers/{row.ledger}")

    def _since_ledger(self, row: Row, last: int | None = None) -> DataFrame:
        kept = F.col("_append") <= (row.last if last is None else last)
        ddl = f"{_FILES_DDL}, _ledger BIGINT, _append BIGINT"
        return self._partitions("files", f"/_ledger={row.ledger}", ddl, kept)

    def _repeated(self, row: Row, files: DataFrame) -> DataFrame:
        """Those of ``files`` that came before. Of the ledger, only names between theirs are read."""
        known = self._ledger(row)
        if row.folded > row.since:
            low, high = files.agg(F.min("base"), F.max("base")).first()
            known = known.filter(F.col("base").between(low, high))
        known = known.union(self._since_ledger(row).select(*FILE_ID))
        return files.join(known, FILE_ID, "left_semi")

    # Features

    def publish_features(
        self, dimension: DataFrame, as_of: dt.date, *, days: int = 90, stats: DataFrame | None = None
    ) -> str:
        """Write the sorted features of the newest state to a path of their own; returns it.

        The table itself stays as it is: nothing is compacted, and the mark does not move. State and city
        statistics are written before they are joined: the state is read several times, and the join needs
        to know the size of the statistics. ``stats`` may be those of ``CityCounts`` at the newest state.
        """
        current = self._require_current()
        version = current.version + 1
        path = f"{self.root}/features/{version}-{uuid.uuid4().hex}"
        state = self.state()
        if current.first != current.last:
            state = settle(state, "state")
        if stats is None:
            stats = city_stats(normalize_city(state), dimension, as_of, days=days)
        stats.write.parquet(f"{path}/stats")
        stats = self.spark.read.parquet(f"{path}/stats")
        features = city_features(state, dimension, as_of, days=days, stats=stats)
        sort_features(features).write.parquet(f"{path}/rows")
        self._commit(version, current, kind="publish", path=f"{path}/rows")
        return f"{path}/rows"


# In place of a folder, of changes that a repair has made.
_REPAIRED = "repaired"


def _is_delivered() -> Column:
    return F.col("seq.folder") != _REPAIRED


_FILES_DDL = ", ".join(f"{name} STRING" for name in FILE_ID)


def _files(changes: DataFrame) -> DataFrame:
    return changes.select(*(F.col("seq")[name].alias(name) for name in FILE_ID)).distinct()
