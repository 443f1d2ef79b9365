"""Approximate nearest neighbours by cosine: p-stable hashing with several probes per table.

A table hashes unit vectors by ``m`` Gaussian projections, each cut into cells of one width. A query
probes a table's buckets in the order of their estimated chance of holding a neighbour: given the
query's projections and a neighbour at the usual cosine, each projection of the neighbour is normal, and
a bucket's chance is the product over its cells. Probing ends when the chances add up to the table's
share of ``TARGET``. That is done twice: first for the usual cosine, then, for each query whose own ``k``-th
neighbour so far is farther off than that, for the cosine of this neighbour, which is no nearer than the true one; only
buckets that the first round left out are then looked at. The candidates of all tables are compared with the query exactly, on the original
vectors, where they lie: each bucket is joined with the queries that probe it in one task, which gives
out the best ``k`` of each query only. Queries that find fewer than ``k`` candidates are compared with
all vectors, in blocks.

The usual cosine and the number of projections come from a sample of ``SAMPLE`` expected vectors and from
the number of vectors; every vector is indexed. Equal vectors are one entry of the index, which keeps
the ``k + 1`` smallest ids: no search can return more of them. Buckets of more than ``BLOCK`` entries are
cut into blocks, and so are the queries that probe a bucket, so neither a frequent vector nor a dense bucket nor
a bucket that all queries probe lands in one task.

Defined results: vectors that are null, empty, zero, or have a null or non-finite component, rows with a
null id, and vectors of another length than most take no part; ties go to the smaller id; repeated ids
are ranked like any other rows; of several queries with one id, the one with the least vector (component by
component) is asked; an empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.joins import join_unique
from tidewell.session import settle

TABLES = 2
#: Share of neighbours that all tables together should find.
TARGET = 0.95
#: Width of cells, in standard deviations of a projection; cells beyond the farthest are joined to it.
CELL = 2.0
FARTHEST = 9
BUCKET = 600
SAMPLE = 2000
BLOCK = 2048
QUERY_BLOCK = 1024
SEED = 11


@dataclass
class Tables:
    """Projections, offsets and cell width of all tables, and what is known about neighbours."""

    axes: np.ndarray  # tables x m x d
    offsets: np.ndarray  # tables x m
    width: float
    near: float

    def project(self, unit: np.ndarray) -> np.ndarray:
        """Per vector, table and projection: place on the axis, in cells."""
        return np.einsum("tmd,nd->ntm", self.axes, unit) / self.width + self.offsets

    def buckets(self, unit: np.ndarray) -> list[bytes]:
        """Of each vector, its bucket in every table: number of the table, then the cells."""
        cells = np.clip(np.floor(self.project(unit)), -FARTHEST, FARTHEST).astype(np.int8)
        return [bytes([table]) + row.tobytes() for vector in cells for table, row in enumerate(vector)]

    def probes(self, unit: np.ndarray, near: np.ndarray) -> Iterator[list[bytes]]:
        """Per vector, its buckets in each table: those most likely to hold a neighbour at its cosine first."""
        share = 1 - (1 - TARGET) ** (1 / len(self.axes))
        near = near[:, None, None]
        spread = np.sqrt(1 - near**2) / math.sqrt(unit.shape[1]) / self.width
        mean = (self.project(unit) - self.offsets) * near + self.offsets
        edges = np.arange(1 - FARTHEST, FARTHEST + 1)
        below = _normal((edges[:, None, None, None] - mean) / spread)
        chance = np.diff(below, axis=0, prepend=0.0, append=1.0)  # the outer cells are open
        for vector in range(len(unit)):
            yield [
                bytes([table]) + cells
                for table in range(len(self.axes))
                for cells in best_first(chance[:, vector, table, :].T, share)
            ]

    def first_probes(self, unit: np.ndarray) -> Iterator[list[bytes]]:
        return self.probes(unit, np.full(len(unit), self.near))

    def further_probes(self, unit: np.ndarray, cosine: np.ndarray) -> Iterator[list[bytes]]:
        """Buckets to look at for neighbours at each query's ``cosine`` that ``first_probes`` leaves out."""
        both = zip(self.probes(unit, np.clip(cosine, 0.0, self.near)), self.first_probes(unit), strict=True)
        for wanted, seen in both:
            known = set(seen)
            yield [bucket for bucket in wanted if bucket not in known]


def _normal(x: np.ndarray) -> np.ndarray:
    """Standard normal distribution, to about 1e-7."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = 0.3989422804 * np.exp(-x * x / 2)
    tail *= t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(x > 0, 1 - tail, tail)


def best_first(chance: np.ndarray, share: float) -> list[bytes]:
    """Cell combinations in descending chance until their chances add up to ``share``.

    ``chance`` is projections x cells, the first cell being -FARTHEST. A combination is a rank per projection;
    each is reached once, by raising the last raised rank or a later one.
    """
    order = np.argsort(-chance, axis=1, kind="stable")
    ranked = np.take_along_axis(chance, order, axis=1).tolist()
    cells = (order - FARTHEST).astype(np.int8).tolist()
    m = len(ranked)
    first = math.prod(row[0] for row in ranked)
    heap = [(-first, (0,) * m, 0)]
    found, total = [], 0.0
    while heap and total < share:
        value, ranks, last = heapq.heappop(heap)
        total -= value
        found.append(bytes(cells[i][r] & 255 for i, r in enumerate(ranks)))
        for i in range(last, m):
            rank = ranks[i] + 1
            if rank < len(ranked[i]) and ranked[i][rank] > 1e-12:
                rest = math.prod(ranked[j][r] for j, r in enumerate(ranks) if j != i) * ranked[i][rank]
                if rest > 1e-9:
                    heapq.heappush(heap, (-rest, (*ranks[:i], rank, *ranks[i + 1 :]), i))
    return found


def cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each query with each row, in double precision, every pair by the same sums."""
    dots = np.stack([(rows * query).sum(axis=1) for query in queries])
    return dots / (np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None, :])


def stack(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def unit_of(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v``: finite, non-zero double vectors of the most frequent length."""
    v = F.col("v")
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull()).filter(fine)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def fit(entries: DataFrame, count: int, k: int) -> Tables:
    """Tables for ``count`` vectors, from a bounded sample of them."""
    sample = entries.select("v").filter(F.rand(SEED) < SAMPLE / max(1, count)).toPandas()["v"]
    unit = unit_of(stack(sample)) if len(sample) else np.zeros((0, 1))
    near = usual_cosine(unit, min(0.5, k / max(1, count)))
    d = unit.shape[1]
    # About three cells of an axis are in use, so buckets hold about BUCKET vectors.
    m = max(1, min(d, round(math.log(max(2.0, count / BUCKET), 3))))
    rng = np.random.default_rng(SEED)
    axes = rng.standard_normal((TABLES, m, d))
    axes /= np.linalg.norm(axes, axis=2, keepdims=True)
    width = CELL / math.sqrt(d)
    return Tables(axes, rng.uniform(0, 1, (TABLES, m)), width, near)


def usual_cosine(unit: np.ndarray, share: float) -> float:
    """The cosine that ``share`` of all vectors exceed, for a vector of the sample's lower quarter.

    A share that the sample is too small to show is carried on from one it shows, by the normal tail.
    """
    if len(unit) < 3:
        return 0.5
    each = unit @ unit.T
    np.fill_diagonal(each, np.nan)
    shown = max(share, min(0.5, 10 / len(unit)))
    middle, upper, seen = np.nanquantile(each, [0.5, 0.84, 1 - shown], axis=1)
    estimate = seen + (upper - middle) * (_quantile(1 - share) - _quantile(1 - shown))
    return float(np.clip(np.quantile(estimate, 0.25), 0.1, 0.95))


def _quantile(p: float) -> float:
    low, high = -9.0, 9.0
    for _ in range(60):
        middle = (low + high) / 2
        if float(_normal(np.array(middle))) < p:
            low = middle
        else:
            high = middle
    return low


def best_of(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Of ``rows`` (``v``, ``ids``), the best ``k`` for each query (``id``, ``v``), and those that tie with
    the last of them."""
    if not len(queries) or not len(rows):
        return pd.DataFrame({"query_id": [], "ids": [], "score": []}, dtype=object)
    ids, places, scores = [], [], []
    score = cosines(stack(queries["v"]), stack(rows["v"]))
    alone = np.array([len(x) == 1 for x in rows["ids"]])
    first = np.array([x[0] for x in rows["ids"]])
    for query, row in zip(queries["id"], score, strict=True):
        row = np.where(alone & (first == query), -np.inf, row)  # the query itself and nothing else
        if len(row) > k:
            limit = np.partition(row, len(row) - k)[len(row) - k]
            take = np.nonzero((row >= limit) & np.isfinite(row))[0]
            if len(take) > k:  # ties: the smallest ids
                take = take[np.lexsort((first[take], -row[take]))][:k]
        else:
            take = np.nonzero(np.isfinite(row))[0]
        ids.append(np.full(len(take), query))
        places.append(take)
        scores.append(row[take])
    found = pd.Series([rows["ids"].iloc[i] for i in np.concatenate(places)], dtype=object)
    return pd.DataFrame({"query_id": np.concatenate(ids), "ids": found, "score": np.concatenate(scores)})


FOUND = "query_id LONG, ids ARRAY<LONG>, score DOUBLE"


def entries_of(rows: DataFrame, keep: int) -> DataFrame:
    """``v, ids``: distinct vectors with their ``keep`` smallest ids. The rank is limited before the shuffle,
    so a frequent vector is a few rows per task."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("place", rank).filter(F.col("place") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score`` of the ``k`` nearest rows found for each query.

    ``queries`` has the same columns as ``rows``; a row with the query's own id is not its neighbour.
    """
    rows = usable(rows, key, vector)
    entries = settle(entries_of(rows, k + 1), "vectors")
    asked = settle(usable(queries, key, vector).groupBy("id").agg(F.min("v").alias("v")), "queries")
    count = entries.count()
    tables = fit(entries, count, k)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bucket = tables.buckets(unit_of(stack(batch.column(0).to_pylist())))
                each = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), TABLES)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.binary()), *each.columns], names=["bucket", "v", "ids"]
                )

    def compared(probes: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        return best_of(probes, bucket, k)

    index = settle(entries.mapInArrow(hashed, "bucket BINARY, v ARRAY<DOUBLE>, ids ARRAY<LONG>"), "buckets")
    large = index.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    large = settle(large.filter("blocks > 1"), "large-buckets")
    index = join_unique(index, large, ["bucket"]).withColumn(
        "block", F.pmod(F.xxhash64(F.col("ids")[0]), F.coalesce("blocks", F.lit(1)))
    )
    many = asked.count() > QUERY_BLOCK

    def searched(queries: DataFrame, label: str) -> DataFrame:
        """What the buckets hold that ``queries`` (``id, v, near``, the last null in the first round) probe."""

        def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    unit = unit_of(stack(part.column(1).to_pylist()))
                    near = part.column(2)
                    if near.null_count:
                        found = list(tables.first_probes(unit))
                    else:
                        found = list(tables.further_probes(unit, near.to_numpy()))
                    each = part.take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))
                    bucket = [bucket for x in found for bucket in x]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket, pa.binary()), each.column(0), each.column(1)], names=["bucket", "id", "v"]
                    )

        probes = queries.select("id", "v", "near").mapInArrow(probed, "bucket BINARY, id LONG, v ARRAY<DOUBLE>")
        # Where more than QUERY_BLOCK queries probe a bucket, they are cut into parts, and each block goes to each part.
        crowded = probes.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("long").alias("parts"))
        crowded = settle(crowded.filter("parts > 1") if many else crowded.limit(0), "crowded-buckets")
        parts, blocks = F.coalesce("parts", F.lit(1)), F.coalesce("blocks", F.lit(1))
        zero = F.lit(0).cast("long")
        probes = join_unique(join_unique(probes, large, ["bucket"]), crowded, ["bucket"])
        probes = probes.withColumn("part", F.pmod(F.xxhash64("id"), parts))
        probes = probes.withColumn("block", F.explode(F.sequence(zero, blocks - 1)))
        rows = join_unique(index, crowded, ["bucket"]).withColumn("part", F.explode(F.sequence(zero, parts - 1)))
        found = (
            probes.select("bucket", "block", "part", "id", "v")
            .groupBy("bucket", "block", "part")
            .cogroup(rows.select("bucket", "block", "part", "v", "ids").groupBy("bucket", "block", "part"))
            .applyInPandas(compared, FOUND)
        )
        return settle(ranked(found, k), label)

    first = searched(asked.withColumn("near", F.lit(None).cast("double")), "found")
    # The k-th neighbour found is no nearer than the true one, so its cosine is safe to probe for.
    last = first.filter((F.col("rank") == k) & (F.col("score") < tables.near))
    far = asked.join(last.select(F.col("query_id").alias("id"), F.col("score").alias("near")), "id")
    far = settle(far, "far-queries")
    found = first
    if not far.isEmpty():
        both = first.unionByName(searched(far, "found-further"))
        found = settle(ranked(both.select("query_id", F.array("id").alias("ids"), "score"), k), "found-in-all")
    return exactly_filled(found, entries, asked, k).withColumnRenamed("id", key)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what several tasks found for each query."""
    each = found.select("query_id", F.explode("ids").alias("id"), "score").filter("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    best = each.dropDuplicates(["query_id", "id"]).withColumn("rank", F.row_number().over(order))
    return best.filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def exactly_filled(found: DataFrame, entries: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``found``, with the queries that have fewer than ``k`` results compared with all entries instead."""
    full = found.filter(F.col("rank") == k).select("query_id")
    short = settle(asked.select("id", "v").join(full, F.col("id") == F.col("query_id"), "left_anti"), "short-queries")
    parts = -(-short.count() // QUERY_BLOCK)
    results = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
    for part in range(parts):
        # About QUERY_BLOCK vectors at a time.
        block = short.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).toPandas()

        def compared(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch) and len(block):
                    yield best_of(block, batch, k)

        results = results.unionByName(ranked(entries.select("v", "ids").mapInPandas(compared, FOUND), k))
    return results
