"""Near-duplicate documents by SimHash fingerprints, linked exactly with vantage-point trees.

A document's fingerprint has bit i set if over half of the XXH64 values (seed 42) of its 4-word shingles
have it; repeated shingles count each time. Fingerprints that differ in at most ``reach`` bits are
linked, and documents are grouped by the connected components of the links.

Copies meet as one fingerprint before any search, so a group of copies costs its number of distinct
fingerprints. Distinct fingerprints are dealt out to the leaves of a vantage-point tree; a leaf returns
one edge per point that has a neighbour there, never all pairs. A leaf that is large is cut into blocks
and searched block against block; the depth of the tree is the one that needs few visits times blocks.

Defined results: a null text is empty; a text without words has fingerprint zero and is linked like any
other; rows with a null id are grouped too, and a component with null ids only has a null id; repeated
rows are all returned; an empty table gives an empty result. ``near_duplicates`` reads the two named columns
only; ``keep_one`` returns all columns of its input, whatever their names, and no others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import lower_words, texts_of
from tidewell.llm.components import components
from tidewell.llm.vantage import Search, Tree
from tidewell.operators.joins import join_unique
from tidewell.session import settle

SHINGLE = 4
SEED = 42
REACH = 4
#: Fingerprints from which the tree is fitted: this many are expected, whatever the input. All are indexed.
TREE_SAMPLE = 1 << 15
#: Rows of a leaf in one block; a task compares two (some 130 MB), and a row is sent once for each block of its leaf.
LEAF_BLOCK = 3 << 19
SPAN = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    tokens = lower_words(text)
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum([len(token) + 1 for token in tokens])
    starts = np.concatenate(([0], ends[:-1]))
    if len(tokens) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for begin in range(0, len(starts), SPAN):
        span = zip(starts[begin : begin + SPAN].tolist(), (ends[begin : begin + SPAN] - 1).tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in span], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def _printed(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``fingerprint`` (its 64 bits as a signed number) in place of ``text``."""
    place = rows.columns.index(text)
    schema = rows.drop(text).schema.add("fingerprint", "long")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x) for x in texts_of(batch.column(place))], np.uint64)
            others = [column for i, column in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays([*others, pa.array(prints.view(np.int64))], names=schema.names)

    return rows.mapInArrow(mapped, schema)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` of every row."""
    return _printed(docs.select(key, text), text)


def near_edges(prints: DataFrame, reach: int = REACH) -> DataFrame:
    """Edges ``a, b`` that connect all distinct fingerprints at most ``reach`` bits apart.

    ``prints`` has one row per fingerprint, in column ``fingerprint``, and is read more than once.
    """
    spark = prints.sparkSession
    count = prints.count()
    leaf_size = max(2048, int(32 * math.sqrt(count)))
    depth = max(0, math.ceil(math.log2(max(1, count) / leaf_size)))
    keep = min(1.0, TREE_SAMPLE / max(1, count))
    chosen = F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 40)) < int(keep * (1 << 40))
    sample = np.array([row[0] for row in prints.filter(chosen).select("fingerprint").collect()], np.int64)
    tree = Tree.fit(np.sort(sample).view(np.uint64), depth, reach, 1 / keep, LEAF_BLOCK)
    tree = spark.sparkContext.broadcast(tree)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at, leaf, home = tree.value.route(points)
            blocks = tree.value.blocks[leaf]
            own = (points[at] % blocks.astype(np.uint64)).astype(np.int64)
            copies = np.repeat(np.arange(len(at)), blocks)
            other = np.arange(len(copies)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(leaf[copies]),
                    pa.array(np.minimum(own[copies], other)),
                    pa.array(np.maximum(own[copies], other)),
                    pa.array(own[copies]),
                    pa.array(points[at][copies].view(np.int64)),
                    pa.array(home[copies]),
                ],
                names=["leaf", "low", "high", "block", "fingerprint", "home"],
            )

    def searched(group: pa.Table) -> pa.Table:
        points = group["fingerprint"].to_numpy().view(np.uint64)
        home = group["home"].to_numpy(zero_copy_only=False)
        low = group["block"].to_numpy() == group["low"].to_numpy()
        search = Search(points, reach)
        own, visiting = np.nonzero(home & low)[0], np.nonzero(~home & low)[0]
        if low.all():
            search.within(own)
            search.between(own, visiting)
        else:
            own_high, visiting_high = np.nonzero(home & ~low)[0], np.nonzero(~home & ~low)[0]
            search.between(own, own_high)
            search.between(own, visiting_high)
            search.between(own_high, visiting)
        root = search.groups.roots(np.arange(len(points)))
        hangs = root != np.arange(len(points))
        return pa.table({"a": points[hangs].view(np.int64), "b": points[root[hangs]].view(np.int64)})

    schema = "leaf LONG, low LONG, high LONG, block LONG, fingerprint LONG, home BOOLEAN"
    return (
        prints.select("fingerprint")
        .mapInArrow(routed, schema)
        .groupBy("leaf", "low", "high")
        .applyInArrow(searched, "a LONG, b LONG")
    )


def rooted(prints: DataFrame, least: Column, reach: int) -> DataFrame:
    """``fingerprint``, ``least`` (an aggregate of its rows) and ``root`` of every distinct fingerprint."""
    distinct = settle(prints.groupBy("fingerprint").agg(least.alias("least")), "distinct-fingerprints")
    linked = components(near_edges(distinct, reach)).withColumnRenamed("node", "fingerprint")
    roots = join_unique(distinct, linked, ["fingerprint"])
    return settle(roots.withColumn("root", F.coalesce("root", "fingerprint")), "rooted")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id`` (smallest key reachable) of every row."""
    prints = settle(fingerprints(docs, key, text), "fingerprints")
    roots = rooted(prints, F.min(key), reach)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = join_unique(roots, least, ["root"]).select("fingerprint", "component_id")
    return join_unique(prints, named, ["fingerprint"]).select(key, "fingerprint", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with the smallest key (a null key
    comes last), and of rows that share it, the one with the smallest fingerprint and digest of the text.

    Rows are known by their key and a digest (SHA-256) of their text, so that texts are fingerprinted once.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    read = docs.select(F.col(key).alias("key"), digest.alias("digest"), F.col(text).alias("text"))
    prints = settle(_printed(read, "text"), "fingerprints")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "fingerprint", "digest")
    first = rooted(prints, F.min(order), reach).groupBy("root").agg(F.min("least").alias("first"))
    # The names of the other side are no names of ``docs``, whatever those are.
    own = next(name for i in range(len(docs.columns) + 1) if (name := f"digest_{i}") not in docs.columns)
    first = first.select(F.col("first.key").alias(f"{own}_key"), F.col("first.digest").alias(f"{own}_of"))
    same = F.col(own).eqNullSafe(F.col(f"{own}_of")) & F.col(f"`{key}`").eqNullSafe(F.col(f"{own}_key"))
    kept = docs.withColumn(own, digest).join(first, same, "left_semi")
    # Rows that are equal in key and text can't be told apart by the join.
    if not prints.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        kept = kept.dropDuplicates([key, own])
    return kept.drop(own)


def hex_digits(bits: str = "fingerprint"):
    return F.lower(F.lpad(F.hex(F.col(bits)), 16, "0"))
