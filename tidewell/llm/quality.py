"""Quality rules, and an isolation forest over their statistics.

Fixed rules reject very short and very repetitive documents. For the rest, an isolation forest measures
how easily random splits of five rule statistics separate a document from others. As in any isolation
forest, the places of the splits are drawn at random, each tree's within the range of 256 documents drawn from the
whole table; every document is then counted in every tree, and path lengths come from these counts. The threshold
above which a document is rejected is calibrated on all labelled rows, exactly. Every document is measured
and judged over its whole text; counts of texts are written once, so that texts are not read for each step.

Defined results: a null text has no words, so the rules reject it; without labelled rows, or without both
kinds of them, only the fixed rules decide; labels with null quality are ignored and repeated labels of
a document count each; repeated documents are judged alike; an empty table gives an empty result.
``judged`` returns the key and its own columns only; ``keep_good`` returns all columns of its input,
whatever their names, and no others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import texts_of, words
from tidewell.session import settle

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
TREES = 128
TREE_ROWS = 256
DEPTH = 8
NODES = (1 << (DEPTH + 1)) - 1
SEED = 17
#: Stretches of scores in which cuts are counted side by side.
BINS = 1 << 14
#: Share of the labelled good documents that pass the rules and that the threshold may cost.
GOOD_LOST = 0.005

SYMBOLS = re.compile(r"[#*$%&|<>]")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
#: Statistics of a text: those of the contract, then what the forest needs besides.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper"]


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """Words in windows that occur twice or more, and distinct words.

    Windows are numbered exactly by doubling: equal pairs of equal halves have one number.
    """
    if len(tokens) < 2:
        return 0, len(tokens)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(token, len(number)) for token in tokens], np.int64)
    if len(number) == len(tokens) or len(tokens) <= window:
        return 0, len(number)
    width = 1
    while width < window:
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        _, ids = np.unique(pairs, return_inverse=True)
        width *= 2
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(tokens) + 1, np.int64)
    edges[:-window][again] += 1
    edges[window:][again] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1]))), len(number)


def statistics(text: str) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text."""
    tokens = words(text)
    repeat, distinct = repeated_words(tokens)
    lines = [line for line in text.split("\n") if line.strip(" \t\n\r\x0b\f")]
    # Every byte that does not continue a character, less the white space.
    chars = len(text) - sum(map(text.count, " \t\n\r\x0b\f"))
    return (
        len(tokens),
        chars,
        len(SYMBOLS.findall(text)),
        len(lines) - len(set(lines)),
        repeat,
        distinct,
        len(UPPER.findall(text)),
    )


def measured(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch with the statistics of its texts, a row per text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        counts = np.array([statistics(x) for x in texts_of(column)], np.int64).reshape(-1, len(COUNTS))
        yield batch, counts


def rules_fail(counts: np.ndarray) -> np.ndarray:
    n, repeat = counts[:, 0], counts[:, 4]
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


def features(counts: np.ndarray) -> np.ndarray:
    """Word length, and shares of symbols, repeated passages, capitals and repeated words."""
    n, chars, symbols, _, repeat, distinct, upper = counts.T[: len(COUNTS)].astype(float)
    n, chars = np.maximum(n, 1), np.maximum(chars, 1)
    return np.stack([chars / n, symbols / n, repeat / n, upper / chars, (n - distinct) / n], axis=1)


class Forest:
    """Isolation trees as arrays in heap order; score near 1 for rows that few splits isolate."""

    def __init__(self, rows: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.column = np.zeros((TREES, NODES), np.int64)
        self.split = np.full((TREES, NODES), np.nan)
        self.path = np.zeros((TREES, NODES))
        self.size = min(TREE_ROWS, len(rows))
        self.usual = self._rest(self.size)
        for tree in range(TREES):
            held = {0: rows[rng.permutation(len(rows))[:TREE_ROWS]]}
            for node in range(NODES):
                here = held.pop(node, None)
                if here is None:
                    continue
                depth = (node + 1).bit_length() - 1
                self.path[tree, node] = depth + self._rest(len(here))
                low, high = here.min(axis=0), here.max(axis=0)
                open_columns = np.nonzero(high > low)[0]
                if depth == DEPTH or not len(open_columns):
                    continue
                column = rng.choice(open_columns)
                split = rng.uniform(low[column], high[column])
                left = here[:, column] < split
                if left.all() or not left.any():
                    continue
                self.column[tree, node], self.split[tree, node] = column, split
                held[2 * node + 1], held[2 * node + 2] = here[left], here[~left]

    @staticmethod
    def _rest(n: int) -> float:
        """Mean depth of a random search tree over n rows."""
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def leaves(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Of each tree the node in which each row ends."""
        every = np.arange(len(rows))
        for column, split in zip(self.column, self.split, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                cut = split[node]
                right = rows[every, column[node]] >= cut
                node = np.where(np.isnan(cut), node, 2 * node + 1 + right)
            yield node

    def weigh(self, counts: np.ndarray) -> None:
        """Path lengths from how many of all rows end in each node (trees x nodes)."""
        share = counts / counts.sum(axis=1, keepdims=True)
        for tree, node in np.argwhere(counts > 0).tolist():
            depth = (node + 1).bit_length() - 1
            self.path[tree, node] = depth + self._rest(self.size * share[tree, node])

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for node, path in zip(self.leaves(rows), self.path, strict=True):
            total += path[node]
        return 2.0 ** (-total / (TREES * self.usual)) if self.usual else np.zeros(len(rows))


def threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """The score above which documents are rejected.

    Of the cuts that lose at most ``GOOD_LOST`` of the good rows, the one with the largest share of bad
    rows caught less share of good rows lost; infinity if there are not both kinds.
    """
    if good.all() or not good.any():
        return float("inf")
    cuts = np.unique(scores)
    lost = 1 - np.searchsorted(np.sort(scores[good]), cuts, side="right") / good.sum()
    caught = 1 - np.searchsorted(np.sort(scores[~good]), cuts, side="right") / (~good).sum()
    gain = np.where(lost <= GOOD_LOST, caught - lost, -1.0)
    best = int(np.argmax(gain))
    above = cuts[best + 1] if best + 1 < len(cuts) else cuts[best]
    return float((cuts[best] + above) / 2)


def threshold_of(scored: DataFrame) -> float:
    """``threshold`` of all rows of ``score`` and how many ``good`` and ``bad`` rows have it, by the same rule.

    Rows below a stretch of scores are known from the sums of the stretches; within one they are a running sum. Only
    stretches that end with few enough good rows lost are looked at more closely.
    """
    scored = settle(scored.groupBy("score").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "label-scores")
    place = F.floor(F.col("score") * BINS)
    bins = scored.groupBy(place.alias("bin")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    bins = sorted(tuple(row) for row in bins.collect())
    all_good, all_bad = sum(row[1] for row in bins), sum(row[2] for row in bins)
    if not all_good or not all_bad:
        return float("inf")
    below, good, bad = [], 0, 0
    for number, more_good, more_bad in bins:
        if 1 - (good + more_good) / all_good <= GOOD_LOST:
            below.append((number, good, bad))
        good, bad = good + more_good, bad + more_bad
    below = F.broadcast(scored.sparkSession.createDataFrame(below, "bin LONG, good_below LONG, bad_below LONG"))
    here = Window.partitionBy("bin").orderBy("score")
    cuts = scored.withColumn("bin", place).join(below, "bin").select(
        "score",
        (1 - (F.col("good_below") + F.sum("good").over(here)) / all_good).alias("lost"),
        (1 - (F.col("bad_below") + F.sum("bad").over(here)) / all_bad).alias("caught"),
    )
    cuts = cuts.filter(F.col("lost") <= GOOD_LOST)
    best = cuts.agg(F.max_by("score", F.struct(F.col("caught") - F.col("lost"), -F.col("score")))).first()[0]
    above = scored.filter(F.col("score") > best).agg(F.min("score")).first()[0]
    return best if above is None else (best + above) / 2


class Judge:
    """A forest and its threshold; small, and sent to every task."""

    def __init__(self, forest: Forest | None, limit: float):
        self.forest, self.limit = forest, limit

    @classmethod
    def fit(cls, counts: DataFrame, labels: DataFrame, key: str = "doc_id") -> Judge:
        """From all rows of ``counted`` (written, as it is read more than once) and all labels."""
        # Drawn by hash, each repeated row once, so that a table has one forest however its files are read.
        lot = F.xxhash64(F.lit(SEED), key, *COUNTS)
        distinct = counts.agg(F.approx_count_distinct(lot).alias("n")).first()["n"]
        bound = min(1 << 32, int((1 << 32) * TREES * TREE_ROWS / max(1, distinct)))
        drawn = counts.filter(F.pmod(lot, F.lit(1 << 32)) < bound).select(key, *COUNTS).distinct().drop(key).collect()
        if not drawn:
            return cls(None, float("inf"))
        forest = Forest(features(np.array(sorted(drawn), np.int64)))
        forest.weigh(mass(counts, forest))
        good = F.col("quality") > 0
        marks = labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias(key)).agg(
            F.count_if(good).alias("good"), F.count_if(~good).alias("bad")
        )
        return cls(forest, threshold_of(scores(counts, forest, key).join(marks, key).select("score", "good", "bad")))

    def kept(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether to keep each row, and its score."""
        if self.forest is None or not len(counts):
            scores = np.zeros(len(counts))
        else:
            scores = self.forest.score(features(counts))
        return ~rules_fail(counts) & (scores <= self.limit), scores


def counted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and the counts of the text, written once."""
    schema = docs.select(key).schema
    for name in COUNTS:
        schema = schema.add(name, "long")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts in measured(batches, text):
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts.T)], names=schema.names)

    return settle(docs.select(key, text).mapInArrow(mapped, schema), "text-counts")


def numbers(batch: pa.RecordBatch) -> np.ndarray:
    """The last columns of a batch, the counts, a row per text."""
    return np.stack([column.to_numpy() for column in batch.columns[-len(COUNTS) :]], axis=1)


def mass(counts: DataFrame, forest: Forest) -> np.ndarray:
    """How many of all rows end in each node of each tree."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TREES, NODES), np.int64)
        for batch in batches:
            for tree, node in enumerate(forest.leaves(features(numbers(batch)))):
                total[tree] += np.bincount(node, minlength=NODES)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.flat[place])], names=["place", "n"])

    rows = counts.select(*COUNTS).mapInArrow(mapped, "place LONG, n LONG").groupBy("place").agg(F.sum("n").alias("n"))
    total = np.zeros((TREES, NODES), np.int64)
    for row in rows.collect():
        total.flat[row["place"]] = row["n"]
    return total


def scores(counts: DataFrame, forest: Forest, key: str) -> DataFrame:
    """``key`` and ``score`` of the documents that pass the rules."""
    schema = counts.select(key).schema.add("score", "double")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = numbers(batch)
            passing = ~rules_fail(rows)
            score = forest.score(features(rows[passing]))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(passing)), pa.array(score)], names=schema.names)

    return counts.select(key, *COUNTS).mapInArrow(mapped, schema)


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the counts, ``base_failed``, ``score`` and ``kept`` of every document."""
    written = counted(docs, key, text)
    judge = Judge.fit(written, labels, key)
    schema = docs.select(key).schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("score", "double").add("kept", "boolean")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = numbers(batch)
            kept, scores = judge.kept(counts)
            columns = [rules_fail(counts), scores, kept]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], names=schema.names)

    return written.mapInArrow(mapped, schema)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that rules and forest keep, with all their columns."""
    judge = Judge.fit(counted(docs, key, text), labels, key)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts in measured(batches, text):
            yield batch.filter(pa.array(judge.kept(counts)[0]))

    return docs.mapInArrow(mapped, docs.schema)
