"""Scoring of whole texts with a recurrent language model learnt from the corpus itself.

Word counts are taken over all training documents. The ``COMMON`` most frequent words at most are sent to
every task with their counts; counts of all other words stay a table, and texts meet it by a join on the
word. Frequent words therefore never take part in a shuffle of texts, and rare ones can't be hot.

The model (``gru.py``) predicts the next item: the end of a text, one of the most frequent words, or one
of ``BUCKETS`` groups of all other words, by their last letters. A word of a group has its smoothed share
of the group's count, with the same share for one word never seen, so every text has a proper chance.

Training is local and then averaged: in each round, every task starts from the model of the round before,
passes over its own documents and returns its model, weighted by its tokens; models are summed in two
steps in pieces, and only one model reaches the driver. The training documents are dealt to the rounds by
hash of the id, so every one of them trains the model once, and the counts cover all of them too.

Defined results: a null text is empty and has its end only; a null id is a training document; repeated
rows are scored each and count each; words are those of the lower-cased (A-Z) text between white space
(space and \\x09-\\x0D); without training documents every word is unknown; an empty table gives an empty
result. Only the two named columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidewell.llm.common import crc_bucket
from tidewell.llm.gru import Model
from tidewell.session import settle

#: Words whose counts every task gets; the bound of what is broadcast.
COMMON = 200_000
CLASSES = 64
BUCKETS = 64
ROUNDS = 3
SMOOTH = 0.1
#: Tokens that a task trains on at least, if there are so many: models of fewer are not worth sending.
TRAINER_TOKENS = 1_000_000
#: Bytes of text that are counted, trained on or scored at a time.
RUN_BYTES = 1 << 23
#: Rows given out at a time.
ROWS = 50_000
PIECES = 8
LANES = 64

END = b""


def bucket_of(word: bytes) -> int:
    """The group of a word that is not an item of its own."""
    return zlib.crc32(word[-3:]) % BUCKETS


def held_out(key: str):
    return F.coalesce(crc_bucket(key, 10) == 0, F.lit(False))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and of each the number of its text.

    Arrow's lower case and white space of ASCII are just those of ``common.lower_words``.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words, text = lists.flatten().cast(pa.binary()), pc.list_parent_indices(lists).to_numpy()
    # White space at an end of a text leaves an empty word there.
    some = pc.greater(pc.binary_length(words), 0)
    return words.filter(some), text[some.to_numpy(zero_copy_only=False)]


def runs(batches: Iterator[pa.RecordBatch], size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches with about so many bytes of text (last column)."""
    size = size or RUN_BYTES
    held, full = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = before = 0
        # A run ends with the text that fills it.
        while (cut := int(np.searchsorted(ends, before + size - full)) + 1) <= batch.num_rows:
            yield pa.concat_batches([*held, batch.slice(start, cut - start)])
            held, full, start, before = [], 0, cut, int(ends[cut - 1])
        if start < batch.num_rows:
            held.append(batch.slice(start))
            full += int(ends[-1]) - before
    if held:
        yield pa.concat_batches(held)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over the texts (the only column); each text also has one ``END``."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            counts = words_of(run.column(0))[0].value_counts()
            words = pa.concat_arrays([counts.field(0), pa.array([END], pa.binary())])
            n = pa.concat_arrays([counts.field(1), pa.array([run.num_rows], pa.int64())])
            yield from sliced(pa.RecordBatch.from_arrays([words, n], names=["word", "n"]))

    return texts.mapInArrow(mapped, "word BINARY, n LONG").groupBy("word").agg(F.sum("n").alias("n"))


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, ROWS):
        yield batch.slice(start, ROWS)


class Read(NamedTuple):
    """Of each text its items, what is known of its base score and of its words' shares of their groups, and its
    known tokens; and the words whose counts are still to be looked up, each with its text and its times there."""

    items: list[np.ndarray]
    base: np.ndarray
    share: np.ndarray
    n_known: np.ndarray
    rare: pa.Array
    rare_text: np.ndarray
    rare_n: np.ndarray


class Vocabulary:
    """Counts of the common words, items of the model, and totals; sent to every task."""

    def __init__(self, common: list[tuple[bytes, int]], total: int, distinct: int, buckets: dict[int, tuple[int, int]]):
        """``common`` in descending count; ``buckets``: count and distinct words of each group, of the words
        that are not common."""
        self.counts = dict(common)
        self.total, self.distinct = total, distinct
        words = [word for word, _ in common if word != END]
        self.items = {END: BUCKETS} | {word: BUCKETS + 1 + i for i, word in enumerate(words[: (CLASSES - 1) * BUCKETS - 1])}
        mass, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for number, (n, words_there) in buckets.items():
            mass[number], kinds[number] = n, words_there
        for word, n in common:
            if word not in self.items:
                mass[bucket_of(word)] += n
                kinds[bucket_of(word)] += 1
        table = np.zeros((CLASSES, BUCKETS))
        table[0] = mass
        for word, item in self.items.items():
            table.flat[item] = self.counts.get(word, 0)
        self.table = table
        self.base_rest = math.log10(total + SMOOTH * (distinct + 1)) if total else math.log10(SMOOTH)
        self.bucket_rest = np.log10(mass + SMOOTH * (kinds + 1))
        #: The common words; by number: item, log10 of the smoothed count, and log10 of the share of its group.
        #: The last row stands for words that are not common.
        self.words = pa.array([word for word, _ in common], pa.binary())
        self.item = np.array([self.items.get(word, bucket_of(word)) for word, _ in common] + [0], np.int32)
        self.log = np.log10(np.array([n + SMOOTH for _, n in common] + [1.0]))
        alone = np.array([word in self.items for word, _ in common] + [True])
        self.share = np.where(alone, 0.0, self.log - self.bucket_rest[np.minimum(self.item, BUCKETS - 1)])

    def _distinct(self, words: pa.Array):
        """Of each word its number among the distinct ones; these, and their numbers (-1: not common) and items."""
        coded = words.dictionary_encode()
        number = pc.fill_null(pc.index_in(coded.dictionary, self.words), -1).to_numpy()
        item = self.item[number]
        rare = coded.dictionary.filter(pa.array(number < 0))
        item[number < 0] = np.fromiter(map(bucket_of, rare.to_pylist()), np.int32, len(rare))
        return coded.indices.to_numpy(), coded.dictionary, number, item

    def _by_text(self, items: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
        """The items of each text, with its end."""
        with_end = np.insert(items, np.cumsum(length), self.items[END])
        return np.split(with_end, np.cumsum(length + 1)[:-1])

    def items_of(self, texts: pa.Array) -> list[np.ndarray]:
        words, text = words_of(texts)
        code, _, _, item = self._distinct(words)
        return self._by_text(item[code], np.bincount(text, minlength=len(texts)))

    def read(self, texts: pa.Array) -> Read:
        words, text = words_of(texts)
        code, distinct, number, item = self._distinct(words)
        length = np.bincount(text, minlength=len(texts))
        share = np.where(number < 0, -self.bucket_rest[np.minimum(item, BUCKETS - 1)], self.share[number])
        base = np.bincount(text, self.log[number][code], len(texts)) - (length + 1) * self.base_rest
        is_rare = (number < 0)[code]
        pair, n = np.unique(text[is_rare] * len(distinct) + code[is_rare], return_counts=True)
        rare_text, rare = np.divmod(pair, max(1, len(distinct)))
        return Read(
            self._by_text(item[code], length),
            base + math.log10(self.counts.get(END, 0) + SMOOTH),
            np.bincount(text, share[code], len(texts)),
            length - np.bincount(text[is_rare], minlength=len(texts)) + (END in self.counts),
            distinct.take(pa.array(rare)),
            rare_text,
            n,
        )


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """The vocabulary, and the count below which words stay in the table.

    Counts are sorted into bins of a sixteenth octave; the common words are those of the highest bins that
    hold at most ``COMMON`` words together, and the end of a text.
    """
    fine = F.floor(F.log2("n") * 16)
    bins = counts.groupBy(fine.alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.min("n").alias("least"))
    total = distinct = taken = 0
    cut = 1 << 62
    for row in sorted(bins.collect(), key=lambda row: -row["bin"]):
        total += row["n"]
        distinct += row["words"]
        if taken is not None and taken + row["words"] <= COMMON:
            taken += row["words"]
            cut = row["least"]
        else:
            taken = None
    # The end of a text is an item of its own and always known with its count, however rare.
    ending = F.octet_length("word") == 0
    common = [(bytes(row["word"]), row["n"]) for row in counts.filter((F.col("n") >= cut) | ending).collect()]
    common.sort(key=lambda x: (-x[1], x[0]))
    last = F.substring("word", F.greatest(F.octet_length("word") - 2, F.lit(1)), F.lit(3))
    grouped = counts.filter((F.col("n") < cut) & ~ending).groupBy(
        F.pmod(F.crc32(last), F.lit(BUCKETS)).alias("bucket")
    )
    rest = grouped.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    return Vocabulary(common, total, distinct, {int(r["bucket"]): (r["n"], r["words"]) for r in rest}), cut


def trained(texts: DataFrame, model: Model, shared) -> Model:
    """The average of the models that the tasks learn from their texts (the only column)."""
    vector = model.vector()
    start = texts.sparkSession.sparkContext.broadcast(vector)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        own, tokens = Model(known.table), 0
        own.load(start.value)
        for run in runs(batches):
            items = known.items_of(run.column(0))
            own.train(items, BUCKETS)
            tokens += sum(map(len, items))
        pieces = np.array_split(own.vector() * np.float32(tokens), PIECES)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(PIECES), pa.int32()),
                pa.array([TaskContext.get().partitionId() % LANES] * PIECES, pa.int32()),
                pa.array([tokens] * PIECES, pa.int64()),
                pa.array([piece.tobytes() for piece in pieces], pa.binary()),
            ],
            names=["piece", "lane", "tokens", "sums"],
        )

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(sums, np.float32) for sums in group["sums"])
        return pd.DataFrame(
            {"piece": [group["piece"].iloc[0]], "lane": [0], "tokens": [group["tokens"].sum()], "sums": [total.tobytes()]}
        )

    schema = "piece INT, lane INT, tokens LONG, sums BINARY"
    lanes = texts.mapInArrow(mapped, schema).filter("tokens > 0").groupBy("piece", "lane").applyInPandas(summed, schema)
    rows = sorted(lanes.groupBy("piece").applyInPandas(summed, schema).collect(), key=lambda row: row["piece"])
    start.destroy()
    if rows:
        model.load(np.concatenate([np.frombuffer(row["sums"], np.float32) / row["tokens"] for row in rows]))
    return model


def learnt(docs: DataFrame, key: str = "doc_id", text: str = "text"):
    """Counts (``word``, ``n``) of the training documents, the vocabulary, its cut, and the model."""
    training = docs.filter(~held_out(key))
    counts = settle(word_counts(training.select(text)), "word-counts")
    known, cut = vocabulary(counts)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    model = Model(known.table)
    lot = F.pmod(F.xxhash64(F.col(key)), F.lit(ROUNDS))
    trainers = max(1, known.total // (ROUNDS * TRAINER_TOKENS))
    for number in range(ROUNDS):
        texts = training.filter(lot == number).select(text)
        model = trained(texts.coalesce(trainers), model, shared)
    return counts, cut, shared, model


PARTS = "row LONG, held_out BOOLEAN, n_tokens LONG, n_known LONG, base DOUBLE, model DOUBLE, word BINARY, n LONG"


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark: SparkSession = docs.sparkSession
    counts, cut, shared, model = learnt(docs, key, text)
    final = spark.sparkContext.broadcast(model.vector())
    schema = docs.select(key).schema
    for field in spark.createDataFrame([], PARTS).schema:
        schema = schema.add(field)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per document, with a word that no text has, and one per word still to be looked up."""
        known = shared.value
        own = Model(known.table)
        own.load(final.value)
        row = TaskContext.get().partitionId() << 40
        for run in runs(batches):
            read = known.read(run.column(2))
            logs = own.score(read.items, BUCKETS) / math.log(10) + read.share
            rows = np.arange(row, row + run.num_rows)
            row += run.num_rows
            n, rare = run.num_rows, len(read.rare)
            of_texts = (
                run.column(0), rows, run.column(1), [len(x) for x in read.items], read.n_known, read.base, logs,
                [b" %d" % number for number in rows.tolist()], np.zeros(n, np.int64),
            )
            zeros = np.zeros(rare, np.int64)
            of_words = (
                pa.nulls(rare, arrow[0].type), rows[read.rare_text], pa.nulls(rare), zeros, zeros, zeros, zeros, read.rare, read.rare_n,
            )
            for columns in (of_texts, of_words):
                arrays = [
                    (column if isinstance(column, pa.Array) else pa.array(column)).cast(field.type)
                    for column, field in zip(columns, arrow, strict=True)
                ]
                yield from sliced(pa.RecordBatch.from_arrays(arrays, schema=arrow))

    arrow = to_arrow_schema(schema)
    parts = docs.select(key, held_out(key).alias("held_out"), text).mapInArrow(mapped, schema)
    rare = counts.filter(F.col("n") < cut).select(F.col("word").alias("rare_word"), F.col("n").alias("c"))
    joined = parts.join(rare, F.col("word") == F.col("rare_word"), "left")
    log = F.when(F.col("n") > 0, F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).otherwise(0.0)
    total = shared.value.total
    return (
        joined.groupBy("row")
        .agg(
            F.max(key).alias(key),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            F.sum(F.col("base") + log).alias("base_score"),
            F.sum(F.col("model") + log).alias("score"),
        )
        .drop("row")
    )
