"""Conversations that begin alike, as a trie of their turns, built by bursting containers.

A turn is a block of 24 bytes: 16 of a SHA-256 over role and text, and the bytes of its text. A conversation
is the blocks of its turns one after the other, so that texts are read once and never shuffled, and the
order of bytes is an order of sequences.

A shard begins as one container of all sequences. A container with more than ``CONTAINER`` turns bursts: the
turns that all its members share become a run of nodes, and its members move into one container for each
next turn. This goes on for the containers that are still too large, each round only over their members. The
containers that remain are dealt to tasks, sorted by Spark and swept in that order into nodes; a task holds
one container at a time. Totals of the containers then go up the runs, a round for each round of bursting.

No row and no group grows with a hot conversation or a hot prefix: equal sequences are one row with a count,
combined before the shuffle; positions are counted in stretches of ``STRETCH`` turn numbers, which are summed
up; and a conversation longer than ``SEGMENT`` turns is cut there, its next segment being in the trie below
the node of what comes before. Segments of the same place are layers, done from the last one up. One thing
is a stream through one task by its definition, in constant memory: the digest over all members that end in
one node.

Defined results: rows without a conversation's id have no part; turns are ordered by their number, a null
first, and those of one number by the bytes of their block; repeated rows are turns of their own; a null role
or text is empty; a conversation without turns is a member of the root; an empty table has no nodes. Ids and
turn numbers are whole numbers. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewell.llm.common import batches_of
from tidewell.operators.joins import join_unique
from tidewell.session import settle

#: Bytes of a block, and of the digest it begins with.
BLOCK, DIGEST = 24, 16
#: Turns of a row at most; more than a conversation is lent.
SEGMENT = 1 << 16
#: Turns of a container that one task sweeps, unless it is one sequence.
CONTAINER = 1 << 14
#: Turn numbers whose positions are counted together.
STRETCH = 1 << 16

NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id LONG, depth LONG, parent_conv_id LONG, n_convs LONG, n_children LONG, n_leaves LONG, "
    "saved_tokens LONG, ends_sha256 STRING"
)
SWEPT = f"{NODE}, up BINARY, head BINARY"


def _packed(place: str) -> Column:
    """The blocks of a group of rows in the order of ``place``."""
    rows = F.array_sort(F.collect_list(F.struct(place, F.hex("block").alias("block"))))
    return F.unhex(F.array_join(F.transform(rows, lambda row: row["block"]), ""))


def _turns(ids: str = "ids") -> Column:
    return F.call_function("div", F.octet_length(ids), F.lit(BLOCK))


def rebuilt(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    family: int = 5,
    most: int = 9,
) -> DataFrame:
    """``conv``, ``layer``, ``ids`` (its blocks in that layer) and ``ends`` (no later layer) of rebuilt conversations.

    Conversation c begins with the first h turns of conversation c - c % family, h = crc32(c) % most; its own
    turns after its first h follow. With ``most`` = 1 every conversation is left as it is.
    """
    said = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in (role, text)]
    digest = F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256)
    block = F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(F.octet_length(said[1]).cast("long")), 16, "0"))
    number = F.col(turn).cast("long")
    rows = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"),
        number.alias("turn"),
        F.coalesce(F.call_function("div", number, F.lit(STRETCH)), F.lit(-(1 << 62))).alias("stretch"),
        F.unhex(block).alias("block"),
    )

    counts = rows.groupBy("conv", "stretch").agg(F.count(F.lit(1)).alias("n"))
    own_length = counts.groupBy("conv").agg(F.sum("n").alias("own"))
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    convs = own_length.select("conv", "own", taken.alias("taken"), (F.col("conv") - F.col("conv") % family).alias("base"))
    bases = own_length.select(F.col("conv").alias("base"), F.col("own").alias("base_length"))
    convs = convs.join(bases, "base", "left").withColumn(
        "lent", F.least("taken", F.coalesce("base_length", F.lit(0).cast("long")))
    )
    total = F.col("lent") + F.greatest(F.col("own") - F.col("taken"), F.lit(0))
    convs = settle(convs.select("conv", "base", "taken", "lent", total.alias("total")), "conversations")

    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.join(convs.select("conv", (F.col("taken") - F.col("lent")).alias("shift")), "conv").select(
        "conv", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), "shift"
    )
    order = Window.partitionBy("conv", "stretch").orderBy(F.asc_nulls_first("turn"), "block")
    placed = rows.withColumn("place", F.row_number().over(order).cast("long"))
    placed = placed.join(moved.filter("before > 0 OR shift > 0"), ["conv", "stretch"], "left")
    placed = placed.select(
        "conv",
        "block",
        (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"),
        F.coalesce("shift", F.lit(0)).alias("shift"),
    )
    placed = settle(placed, "placed-turns")

    firsts = placed.filter(F.col("conv") % family == 0).filter(F.col("place") < most)
    firsts = firsts.groupBy(F.col("conv").alias("base")).agg(_packed("place").alias("first"))
    lent = F.coalesce(F.expr(f"substring(first, 1, cast({BLOCK} * lent AS int))"), F.lit(b""))
    convs = convs.join(firsts, "base", "left").select("conv", "total", lent.alias("lent"))

    kept = placed.filter(F.col("place") > taken).withColumn("place", F.col("place") - F.col("shift"))
    layer = F.call_function("div", F.col("place") - 1, F.lit(SEGMENT))
    kept = kept.groupBy("conv", layer.alias("layer")).agg(_packed("place").alias("ids"))
    start = convs.join(kept.filter("layer = 0").drop("layer"), "conv", "left").select(
        "conv", F.lit(0).cast("long").alias("layer"), F.concat("lent", F.coalesce("ids", F.lit(b""))).alias("ids"), "total"
    )
    later = kept.filter("layer > 0").join(convs.select("conv", "total"), "conv").select(start.columns)
    ends = F.col("total") <= (F.col("layer") + 1) * SEGMENT
    return start.unionByName(later).select("conv", "layer", "ids", ends.alias("ends"))


def _ends(layer: DataFrame) -> DataFrame:
    """``tail`` and ``ends_sha256``: the digest over the ids, in their order, of conversations that end there."""

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            now, digest = None, None
            for batch in batches:
                for tail, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if tail == now:
                        digest.update(b",%d" % conv)
                        continue
                    if digest:
                        yield now, digest.hexdigest()
                    now, digest = tail, hashlib.sha256(b"%d" % conv)
            if digest:
                yield now, digest.hexdigest()

        yield from batches_of(found(), pa.schema([("tail", pa.binary()), ("ends_sha256", pa.string())]))

    dealt = layer.filter("ends").select("tail", "conv").repartition("tail").sortWithinPartitions("tail", "conv")
    return dealt.mapInArrow(streamed, "tail BINARY, ends_sha256 STRING")


def _layers(sequences: DataFrame) -> list[DataFrame]:
    """Distinct segments of each layer: ``head`` (what comes before), ``ids``, ``tail``, the conversations ``n``
    and the least of them, the digest of those that end, and the least one at the head."""
    spark = sequences.sparkSession
    sequences = settle(sequences, "sequences")
    last = sequences.agg(F.max("layer")).first()[0]
    heads = sequences.filter("layer = 0").select("conv", F.lit(b"").alias("head"), F.lit(None).cast("long").alias("above"))
    layers = []
    for number in range(-1 if last is None else last + 1):
        now = sequences.filter(F.col("layer") == number).drop("layer")
        now = now.withColumns({"head": F.lit(b""), "above": F.lit(None).cast("long")}) if not number else now.join(heads, "conv")
        tail = F.unhex(F.sha2(F.concat("head", "ids"), 256))
        now = settle(now.withColumn("tail", tail), "layer") if number < last else now.withColumn("tail", tail)
        merged = now.groupBy("head", "ids", "tail").agg(
            F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"), F.first("above").alias("above")
        )
        merged = settle(merged.join(_ends(now), "tail", "left"), "segments")
        layers.append(merged)
        if number < last:
            heads = now.filter("NOT ends").select("conv", "tail")
            heads = join_unique(heads, merged.select("tail", "least"), ["tail"])
            heads = heads.select("conv", F.col("tail").alias("head"), F.col("least").alias("above"))
    return layers


def _shared(low: bytes, high: bytes, start: int = 0) -> int:
    """Blocks that both begin with; they agree in the first ``start``."""
    end = min(len(low), len(high)) // BLOCK
    while start < end and low[start * BLOCK : (start + 1) * BLOCK] == high[start * BLOCK : (start + 1) * BLOCK]:
        start += 1
    return start


def _size(ids: bytes, depth: int) -> int:
    """Bytes of the text of the turn at ``depth``; the root has none."""
    return int.from_bytes(ids[depth * BLOCK - BLOCK + DIGEST : depth * BLOCK], "big") if depth else 0


def _with_runs(containers: DataFrame) -> DataFrame:
    """Adds ``shared``: the depth down to which all members of a container agree."""
    schema = StructType([*containers.schema.fields, StructField("shared", LongType())])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in ("low", "high", "cut")), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_shared(*row) for row in rows], pa.int64())], names=schema.names
            )

    return containers.mapInArrow(measured, schema)


def _burst(segments: DataFrame) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Rounds of burst containers; the members that end in their runs; all other members, by container."""
    at = F.unhex(F.sha2(F.concat("head", F.expr(f"substring(ids, 1, cast({BLOCK} * cut AS int))")), 256))
    none = {"up": F.lit(None).cast("binary"), "cut": F.lit(0).cast("long")}
    pending = segments.withColumns(none).withColumn("at", at)
    rounds, enders, members = [], [], []
    while True:
        found = pending.groupBy("at").agg(
            F.first("up").alias("up"),
            F.first("head").alias("head"),
            F.first("above").alias("above"),
            F.first("cut").alias("cut"),
            F.sum(_turns() - F.col("cut")).alias("turns"),
            F.min("ids").alias("low"),
            F.max("ids").alias("high"),
            F.sum("n").alias("n"),
            F.min("least").alias("least"),
        )
        large = settle(_with_runs(found.filter(F.col("turns") > CONTAINER).filter("low <> high")), "burst")
        if large.isEmpty():
            return rounds, enders, [*members, pending]
        # At the head of a later layer the parent is the node above, with those that end there.
        parent = F.when(F.col("shared") == 0, F.coalesce("above", "least")).otherwise(F.col("least"))
        to = large.select("at", "shared", parent.alias("parent"))
        marked = settle(join_unique(pending, to, ["at"]), "members")
        members.append(marked.filter("shared IS NULL").drop("shared", "parent"))
        marked = marked.filter("shared IS NOT NULL")
        rounds.append(large)
        enders.append(marked.filter(_turns() == F.col("shared")))
        moved = marked.filter(_turns() > F.col("shared"))
        moved = moved.withColumns({"up": F.col("at"), "cut": F.col("shared") + 1, "above": F.col("parent")})
        pending = moved.drop("shared", "parent").withColumn("at", at)


def _sweep(members: DataFrame) -> DataFrame:
    """Nodes of every container; its topmost one has the container above it, or the head of its layer."""
    names = ["at", "up", "head", "above", "cut", "ids", "n", "least", "ends_sha256", "kids", "leaves", "saved"]

    def nodes_of(rows: list[tuple]) -> Iterator[tuple]:
        _, up, head, above, cut, ids, *_ = rows[0]
        depth, parent, size = [cut], [0], [_size(ids, cut)]
        count, least, ends, kids, leaves, saved = [0], [None], [None], [0], [0], [0]
        path, before = [0], ids[: cut * BLOCK]
        for _, _, _, _, _, ids, n, first, digest, below, below_leaves, below_saved in rows:
            common = _shared(before, ids, cut)
            del path[common - cut + 1 :]
            for d in range(common + 1, len(ids) // BLOCK + 1):
                path_end = path[-1]
                path.append(len(depth))
                depth.append(d)
                parent.append(path_end)
                size.append(_size(ids, d))
                count.append(0)
                least.append(None)
                ends.append(None)
                kids.append(0)
                leaves.append(0)
                saved.append(0)
            tip, before = path[-1], ids
            count[tip] += n
            least[tip] = first
            ends[tip] = digest
            kids[tip] += below
            leaves[tip] += below_leaves
            saved[tip] += below_saved
        for i in range(len(depth) - 1, -1, -1):
            leaves[i] = leaves[i] if kids[i] else 1
            saved[i] += (count[i] - 1) * size[i]
            if i:
                p = parent[i]
                count[p] += count[i]
                least[p] = least[i] if least[p] is None else min(least[p], least[i])
                kids[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
        yield least[0], depth[0], above, count[0], kids[0], leaves[0], saved[0], ends[0], up, None if cut else head
        for i in range(1, len(depth)):
            # Below the head of a later layer the parent is the node above, with those that end there.
            p = above if not parent[i] and not cut and above is not None else least[parent[i]]
            yield least[i], depth[i], p, count[i], kids[i], leaves[i], saved[i], ends[i], None, None

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            group: list[tuple] = []
            for batch in batches:
                for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    if group and group[0][0] != row[0]:
                        yield from nodes_of(group)
                        group = []
                    group.append(row)
            if group:
                yield from nodes_of(group)

        yield from batches_of(found(), schema)

    fields = [*[(name.split()[0], pa.int64()) for name in NODE.split(", ")[:-1]], ("ends_sha256", pa.string())]
    schema = pa.schema([*fields, ("up", pa.binary()), ("head", pa.binary())])
    dealt = members.select(names).repartition("at").sortWithinPartitions("at", "ids")
    return dealt.mapInArrow(swept, SWEPT)


def _runs(containers: DataFrame) -> DataFrame:
    """Nodes of the runs of burst containers, from the totals below each."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for x in batch.to_pylist():
                    saved, kids, ends, n = x["saved"], x["kids"], x["ends_sha256"], x["n"]
                    for depth in range(x["shared"], x["cut"] - 1, -1):
                        saved += (n - 1) * _size(x["low"], depth)
                        top = depth == x["cut"]
                        parent = x["above"] if top or depth == 1 and x["above"] is not None else x["least"]
                        up, head = (x["up"], None if x["cut"] else x["head"]) if top else (None, None)
                        yield x["least"], depth, parent, n, kids, x["leaves"], saved, ends, up, head
                        kids, ends = 1, None

        yield from batches_of(found(), schema)

    fields = [*[(name.split()[0], pa.int64()) for name in NODE.split(", ")[:-1]], ("ends_sha256", pa.string())]
    schema = pa.schema([*fields, ("up", pa.binary()), ("head", pa.binary())])
    return containers.mapInArrow(nodes, SWEPT)


def _layer_nodes(segments: DataFrame) -> DataFrame:
    """Nodes of a layer, as swept."""
    rounds, enders, members = _burst(segments)
    found = settle(_sweep(reduce(DataFrame.unionByName, members)), "swept")
    parts = [found]
    children = found.filter("up IS NOT NULL")
    for large, ending in zip(reversed(rounds), reversed(enders), strict=True):
        below = children.groupBy(F.col("up").alias("at")).agg(
            F.count(F.lit(1)).alias("kids"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"),
            F.lit(None).cast("string").alias("ends_sha256"),
        )
        own = ending.select("at", "kids", "leaves", "saved", "ends_sha256")
        total = below.unionByName(own).groupBy("at").agg(
            *(F.sum(name).alias(name) for name in ("kids", "leaves", "saved")), F.max("ends_sha256").alias("ends_sha256")
        )
        runs = settle(_runs(large.join(total, "at")), "runs")
        parts.append(runs)
        children = children.unionByName(runs.filter("up IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts)


def nodes(sequences: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``sequences``, the rows of ``rebuilt``."""
    layers = _layers(sequences)
    if not layers:
        return sequences.sparkSession.createDataFrame([], NODE)
    parts, below = [], None
    for number in range(len(layers) - 1, -1, -1):
        segments = layers[number]
        if below is None:
            segments = segments.withColumns({name: F.lit(0).cast("long") for name in ("kids", "leaves", "saved")})
        else:
            segments = join_unique(segments, below, ["tail"]).fillna(0, ["kids", "leaves", "saved"])
        found = _layer_nodes(segments)
        below = found.filter("head IS NOT NULL").select(
            F.col("head").alias("tail"),
            F.col("n_children").alias("kids"),
            F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("saved"),
        )
        own = found if not number else found.filter("depth > 0").withColumn("depth", F.col("depth") + number * SEGMENT)
        parts.append(own)
    names = [field.split()[0] for field in NODE.split(", ")]
    return reduce(DataFrame.unionByName, parts).select(names).fillna(NO_ENDS, ["ends_sha256"])
