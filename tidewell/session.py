"""Session defaults, size estimates, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Below this input size a hot key cannot hurt, so no extra job is spent on it.
SPLIT_FLOOR_CONF = "spark.tidewell.splitFloorBytes"
SPLIT_FLOOR_DEFAULT = 1 << 30
# A written lookup of at most this many bytes in memory is broadcast.
BROADCAST_CONF = "spark.tidewell.broadcastBytes"
BROADCAST_DEFAULT = 64 << 20
# Pointer, header and padding of a row in a hash table.
ROW_OVERHEAD = 48


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Hash the smaller side of a shuffle join, instead of sorting both, if its partitions are small.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128MB",
        # With more than 2,000 shuffle partitions Spark reports only the average size of blocks under
        # 100 MB, which hides a hot partition from AQE; this keeps the sizes of outlying blocks.
        "spark.shuffle.accurateBlockSkewedFactor": "5",
    }
    for name, value in {**defaults, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    path = tempfile.mkdtemp(prefix="tidewell-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which only a session of one process may leave unset.

    Operators that write intermediate tables for large inputs ask for it at every size, so that a call does
    not begin to fail when its input grows.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_scratch()
    return root.rstrip("/")


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables that are written inside are removed at the end: use results inside only."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _scopes[-1:]:
        paths.append(path)
    return path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage and a known size."""
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate, the one it uses to choose a broadcast join."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Size of the tables and files that ``df`` reads; unlike an estimate, joins do not inflate it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def broadcast_limit(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def written_broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_CONF, str(BROADCAST_DEFAULT)))


def memory_bytes(df: DataFrame) -> int:
    """Bytes that the rows of a written table take in a hash table: each with its fixed parts and texts.

    One scan of the table; the size of its files says little, as they are compressed.
    """
    texts = [F.octet_length(F.col(name)) for name in _text_columns(df.schema)]
    text = sum((F.coalesce(size, F.lit(0)) for size in texts), F.lit(0).cast("long"))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(text).alias("text")).first()
    fixed = df._jdf.schema().defaultSize() - 20 * len(texts) + ROW_OVERHEAD
    return found["rows"] * fixed + (found["text"] or 0)


def _text_columns(schema: StructType, prefix: str = "") -> list[str]:
    names = []
    for field in schema:
        if isinstance(field.dataType, StringType):
            names.append(f"{prefix}`{field.name}`")
        elif isinstance(field.dataType, StructType):
            names += _text_columns(field.dataType, f"{prefix}`{field.name}`.")
    return names


def is_large(df: DataFrame) -> bool:
    """Whether the input of ``df`` is worth an extra job that saves a shuffle or a hot task."""
    return input_bytes(df) >= int(df.sparkSession.conf.get(SPLIT_FLOOR_CONF, str(SPLIT_FLOOR_DEFAULT)))
