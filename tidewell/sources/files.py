"""Landing folder: snapshot files (``LOAD<number>``) and change files (named by their time).

Files are headerless CSV, read with a fixed layout; an unreadable number or date becomes NULL. A file
may lie in the folder itself, in any folder below it, or, as one of many parts, in a folder
``delivery=<name>`` as Spark writes it. A file is known by its whole path. Changes are ordered by the name
their file was delivered under, whatever form it has, then by folder, by the number of the part, and by
position.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.functions import DELIVERY, drop_name, first_number, folder_of, is_snapshot_name, part_number, plain_path
from tidewell.schemas import USERS_DDL, changes_ddl
from tidewell.session import settle
from tidewell.storage import exists, write_once

_PATH = "_metadata.file_path"
#: Beside the parts of a delivery: all of them are there.
MARK = "_SUCCESS"


@contextmanager
def _few_tasks(spark: SparkSession):
    """Scans that open no file: as many tasks as cores at most, however large the files are."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(1 << 50))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _listing(spark: SparkSession, landing: str) -> DataFrame:
    """One row per file: path, delivery name, whether it is a snapshot, its number (as text). No file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.load(landing).select(plain_path(F.col(_PATH)).alias("path"))
    name = drop_name(F.col("path"))
    return files.select(
        "path",
        name.alias("name"),
        is_snapshot_name(name).alias("is_snapshot"),
        F.when(is_snapshot_name(name), first_number(name)).alias("version"),
    )


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """One row per file: path, delivery name, whether it is a snapshot, and its number (as text).

    Names are taken from file metadata by a scan that opens no file, and written to the shared folder; none
    comes to Python.
    """
    with _few_tasks(spark):
        return settle(_listing(spark, landing), "listing")


def snapshot_order(version: str | Column = "version", name: str | Column = "name") -> Column:
    """Snapshots by their number, however long it is; equal numbers by name."""
    version = F.col(version) if isinstance(version, str) else version
    name = F.col(name) if isinstance(name, str) else name
    return F.struct(F.length(version).alias("digits"), version.alias("version"), name.alias("name"))


def latest_snapshot_name(spark: SparkSession, landing: str, *, without: str | None = None) -> str:
    """Name of the snapshot with the highest number; a snapshot file without a number is an error.

    ``without`` names a delivery that does not count, as it is not complete.
    """
    found = _listing(spark, landing).filter("is_snapshot")
    if without is not None:
        found = found.filter(F.col("name") != without)
    newest = F.max(F.when(F.col("version").isNotNull(), snapshot_order())).alias("newest")
    unnumbered = F.min(F.when(F.col("version").isNull(), F.col("path"))).alias("unnumbered")
    with _few_tasks(spark):
        found = found.agg(newest, unnumbered).first()
    if found.unnumbered is not None:
        raise ValueError(f"snapshot file without a number: {found.unnumbered}")
    if found.newest is None:
        raise ValueError(f"no snapshot file in {landing}")
    return found.newest["name"]


def delivered_files(spark: SparkSession, landing: str, name: str) -> DataFrame:
    """``_path`` of each file that was delivered under ``name``; none is opened."""
    return _listing(spark, landing).filter(F.col("name") == name).select(F.col("path").alias("_path"))


def is_complete(spark: SparkSession, landing: str, name: str) -> bool:
    """Whether all of a delivery lies in the landing folder.

    A file that is delivered under its own name is complete by itself. One of many parts, in a folder
    ``delivery=<name>``, needs the mark that its writer puts beside the parts when all are there.
    """
    folder = F.when(F.substring_index("_path", "/", -1) != name, folder_of(F.col("_path")))
    with _few_tasks(spark):
        folders = delivered_files(spark, landing, name).select(folder.alias("folder")).distinct().collect()
    return bool(folders) and all(row.folder is None or exists(spark, row.folder + MARK) for row in folders)


def mark_complete(spark: SparkSession, landing: str, name: str) -> None:
    """Put the mark beside the parts of a delivery that has been written into ``landing``."""
    write_once(spark, f"{landing}/{DELIVERY}={name}/{MARK}", "")


def file_ids(files: DataFrame) -> DataFrame:
    """``FILE_ID`` of files given by ``_path``."""
    path = F.col("_path")
    return files.select(folder_of(path).alias("folder"), F.substring_index(path, "/", -1).alias("base"))


def read_snapshot(spark: SparkSession, path: str | list[str], *, ddl: str = USERS_DDL) -> DataFrame:
    return spark.read.schema(ddl).option("recursiveFileLookup", "true").csv(path)


def read_delivery(spark: SparkSession, landing: str, name: str, *, ddl: str = USERS_DDL) -> DataFrame:
    """The rows of all files that were delivered under ``name``."""
    # A filter on file metadata is applied to the file listing: other files are not opened.
    return read_snapshot(spark, landing, ddl=ddl).filter(drop_name(plain_path(F.col(_PATH))) == name)


def read_latest_snapshot(spark: SparkSession, landing: str, *, ddl: str = USERS_DDL) -> DataFrame:
    return read_delivery(spark, landing, latest_snapshot_name(spark, landing), ddl=ddl)


def with_order(changes: DataFrame) -> DataFrame:
    """Put ``seq`` in place of the columns ``_path`` and ``_block``.

    Rows of a block are read in order by one task, so their ids grow; ids of different blocks are not
    comparable, as tasks take blocks by size, which is why file and block come first.
    """
    path = F.col("_path")
    seq = F.struct(
        drop_name(path).alias("file"),
        folder_of(path).alias("folder"),
        part_number(path).alias("part"),
        F.substring_index(path, "/", -1).alias("base"),
        F.col("_block").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return changes.withColumn("seq", seq).drop("_path", "_block")


def with_position(rows: DataFrame) -> DataFrame:
    """Each row with the path of its file and its block."""
    return rows.select(
        "*", plain_path(F.col(_PATH)).alias("_path"), F.col("_metadata.file_block_start").alias("_block")
    )


def is_snapshot_row() -> Column:
    return is_snapshot_name(drop_name(F.col("_path")))


def read_changes(spark: SparkSession, landing: str | list[str], *, ddl: str = USERS_DDL) -> DataFrame:
    """All change files as one log, with ``seq``: by delivered name, file, and position."""
    raw = spark.read.schema(changes_ddl(ddl)).option("recursiveFileLookup", "true").csv(landing)
    return with_order(with_position(raw).filter(~is_snapshot_row()))


def unreadable_rows(spark: SparkSession, path: str | list[str], *, ddl: str) -> DataFrame:
    """Lines that do not fit the layout ``ddl``: their file, the line, and the reason.

    They are read all the same, with NULL for what can't be read: a number of columns that differs (the line
    is cut or filled up), or a value that is none of its column's type, of which the first column is named.
    """
    line = "_line"
    reader = spark.read.schema(f"{ddl}, {line} STRING").option("columnNameOfCorruptRecord", line)
    rows = with_position(reader.option("recursiveFileLookup", "true").csv(path)).filter(F.col(line).isNotNull())
    fields = [field for field in StructType.fromDDL(ddl)]
    texts = ", ".join(f"`{field.name}` STRING" for field in fields) + f", {line} STRING"
    raw = F.from_csv(line, F.lit(texts), {"columnNameOfCorruptRecord": line})
    lost = (
        F.when(F.col(f"`{field.name}`").isNull() & F.col("_raw")[field.name].isNotNull(), F.lit(f"unreadable {field.name}"))
        for field in fields
    )
    reason = F.when(F.col("_raw")[line].isNotNull(), F.lit("number of columns")).otherwise(F.coalesce(*lost))
    return rows.withColumn("_raw", raw).select(
        F.col("_path").alias("path"),
        drop_name(F.col("_path")).alias("name"),
        F.col(line).alias("line"),
        F.coalesce(reason, F.lit("unreadable")).alias("reason"),
    )


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """City dimension, CSV without header: city, state."""
    return spark.read.schema("city STRING, state STRING").csv(path)


def settle_changes(changes: DataFrame) -> DataFrame:
    """Write the log as Parquet, which fixes ``seq`` however often the log is read afterwards."""
    return settle(changes, "changes")
