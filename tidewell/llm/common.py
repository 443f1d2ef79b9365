"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


LONG_WORD = 64


class Recent:
    """A table of words that forgets those not asked for during ``size`` new ones, and never keeps long
    ones. A matter of speed only."""

    def __init__(self, size: int):
        self.size = size
        self.now: dict = {}
        self.old: dict = {}

    def get(self, word: str):
        value = self.now.get(word)
        if value is None:
            value = self.old.get(word)
            if value is not None:
                self.put(word, value)
        return value

    def put(self, word: str, value) -> None:
        if len(word) > LONG_WORD:
            return
        if len(self.now) >= self.size:
            self.now, self.old = {}, self.now
        self.now[word] = value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """The texts of an Arrow column; null counts as empty."""
    return ["" if text is None else text for text in column.to_pylist()]


def runs_of(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """First column and texts (second column; null counts as empty) of runs of rows with about so many
    characters; a longer text is a run of its own."""
    start, held, texts = 0, 0, []
    for row, text in enumerate(batch.column(1)):
        text = text.as_py() or ""
        if texts and held + len(text) > chars:
            yield batch.column(0).slice(start, row - start), texts
            start, held, texts = row, 0, []
        texts.append(text)
        held += len(text)
    if texts:
        yield batch.column(0).slice(start), texts


def lower_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 with A-Z lower-cased.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is just these characters.
    """
    return text.encode().lower().split()


def words(text: str) -> list[bytes]:
    return text.encode().split()


def crc_bucket(column: str, buckets: int):
    """crc32 of the value as text, modulo ``buckets``; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(buckets))


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` tuples."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield _batch(block, schema)
            block = []
    if block:
        yield _batch(block, schema)


def _batch(block: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*block, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema
    )


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each run begins, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
