"""Small files and folders on any file system that Spark reaches: names, marks, and lines of a manifest."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    path, system = _at(spark, path)
    return system.exists(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, hidden names left out; nothing if it is not there."""
    path, system = _at(spark, folder)
    if not system.exists(path):
        return []
    found = (status.getPath().getName() for status in system.listStatus(path))
    return [name for name in found if name[:1] not in "._"]


def make_folder(spark: SparkSession, path: str) -> None:
    path, system = _at(spark, path)
    system.mkdirs(path)


def read_text(spark: SparkSession, path: str) -> str:
    path, system = _at(spark, path)
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there as a whole or not at all; one that is there already is an error."""
    final, system = _at(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(final) or not system.rename(hidden, final):
        system.delete(hidden, False)
        raise FileExistsError(f"{path} is there already")
