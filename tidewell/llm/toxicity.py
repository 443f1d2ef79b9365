"""Toxic documents by two Kneser-Ney models, one of toxic and one of ordinary texts, over one shared backoff.

The models are of words as sequences of characters, so that they know words never seen by their parts. Of a
character after up to ``CONTEXT`` characters of its word, class k has

    P_k(x | h) = (max(c_k(hx) - D_k, 0) + D_k N_k(h) P(x | h')) / c_k(h),

N_k(h) being the number of characters that follow h in class k. The backoff P is one for both classes, made
from continuation counts of both together, by the same formula over two, one and no characters of context.
D_k is 1, so that what a class has once, or not at all, it takes from the backoff: rare words are about
equally likely in both, and only what a class uses again and again speaks for it.

The likelihoods of a text are compared per word: over the whole text, and over its one, two, four and eight
most telling words, as a text of any length may have a few toxic words. A logistic function of these, fitted to
labelled rows that the models have not seen, gives the score; with labels of one class only, or none, every
score is the share of toxic rows, as if half a row of either kind had been seen before.

Labelled rows are at most about ``LABEL_ROWS`` of each class, chosen by a hash of the id; a quarter of them
fits the logistic function. The models know the ``MODEL_WORDS`` words most frequent in the others. Every text
is scored as a whole.

Defined results: a null or empty text is scored as one without words; rows that share an id are each scored,
and a label counts for each of them; a document is toxic if any of its labels says so, and labels of a null
id or without a value have no effect; a null id is scored, and held out; an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import LONG_WORD, Recent, crc_bucket, runs_of, starts_of

FOLDS = 5
#: Labelled rows of each class, about, and the share of them that fits the logistic function (one of so many).
LABEL_ROWS = 20_000
FITTING = 4
MODEL_WORDS = 120_000
#: Characters of context.
CONTEXT = 10
#: The discount in a class: what it has once is said by the backoff alone.
ONCE = 1.0
#: The backoff's contexts are this long and shorter.
SHARED = 2
TELLING = (1, 2, 4, 8)
#: Words kept with their value for the next texts, and how many are looked at at once: speed and memory only.
MEMORY, BLOCK = 200_000, 20_000
RUN_CHARS = 1 << 20

WORD = re.compile(r"\w+")
START, END = 2, 3
MULTIPLIERS = np.random.default_rng(5).integers(1 << 62, 1 << 63, CONTEXT + 1, dtype=np.uint64) | np.uint64(1)


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-case words of a text; those of a long one in lists of ``BLOCK`` words."""
    text = text.lower()
    if len(text) < BLOCK:
        yield WORD.findall(text)
        return
    found = (match.group() for match in WORD.finditer(text))
    while block := list(islice(found, BLOCK)):
        yield block


class Grams:
    """Hashes of the characters of ``words`` with what comes before each, in one array after the other."""

    def __init__(self, words: list[str]):
        lengths = np.array([len(word) for word in words], np.int64)
        room = CONTEXT
        #: Of each word the place of its first character, which follows ``room`` places; its end is one after.
        starts = starts_of(lengths + room + 1)
        self.codes = np.zeros(starts[-1] + room, np.uint64)
        at = np.repeat(starts[:-1] + room - starts_of(lengths)[:-1], lengths) + np.arange(lengths.sum())
        self.codes[at] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.codes[starts[:-1] + room - 1] = START
        self.codes[starts[1:] - 1] = END
        self.counts = lengths + 1
        self.first = starts_of(self.counts)[:-1]
        self.here = np.repeat(starts[:-1] + room - self.first, self.counts) + np.arange(self.counts.sum())

    def context(self, length: int) -> np.ndarray:
        total = np.zeros(len(self.here), np.uint64)
        for back in range(1, length + 1):
            total += self.codes[self.here - back] * MULTIPLIERS[back]
        return total

    def whole(self, context: np.ndarray) -> np.ndarray:
        return context + self.codes[self.here] * MULTIPLIERS[0]


class Level:
    """Discounted counts of one length of context, and the share of each context that goes to the level below."""

    def __init__(self, whole: np.ndarray, context: np.ndarray, counts: np.ndarray, discount: float | None = None):
        """Each hash of ``whole`` is there once, in order, with its context and its count."""
        self.whole = whole
        if discount is None:
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once else 0.5
        self.context, inverse = np.unique(context, return_inverse=True)
        total = np.bincount(inverse, counts, len(self.context))
        self.own = np.maximum(counts - discount, 0) / total[inverse]
        self.rest = np.bincount(inverse, np.minimum(counts, discount), len(self.context)) / total

    def smoothed(self, whole: np.ndarray, context: np.ndarray, below: np.ndarray) -> np.ndarray:
        return looked_up(self.whole, self.own, whole, 0) + looked_up(self.context, self.rest, context, 1) * below


def looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, other: float | np.ndarray) -> np.ndarray:
    """The value of each key asked for, or ``other``."""
    if not len(keys):
        return np.broadcast_to(other, len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], other)


class Models:
    """What the two classes say of a character in its context: the log of how much likelier it is in toxic words.

    Where neither class has the character in a context, both give it the same share of the backoff, so that
    only their shares of that context differ; a context that neither has says nothing. Thus all that is kept
    is a number for each character known in its context, and one for each known context.
    """

    def __init__(self, words: list[str], toxic: np.ndarray, ordinary: np.ndarray):
        grams = Grams(words)
        contexts = {length: grams.context(length) for length in (CONTEXT, *range(SHARED + 1))}
        wholes = {length: grams.whole(context) for length, context in contexts.items()}
        self.known, first, at = np.unique(wholes[CONTEXT], return_index=True, return_inverse=True)
        # The shared backoff, from how many longer ones end in each, over both classes.
        kept, shared = first, []
        for length in range(SHARED, -1, -1):
            distinct, place, counts = np.unique(wholes[length][kept], return_index=True, return_counts=True)
            kept = kept[place]
            shared.append(Level(distinct, contexts[length][kept], counts))
        below = np.full(len(first), 1 / (len(shared[-1].whole) + 1))
        for length, level in zip(range(SHARED + 1), reversed(shared), strict=True):
            below = level.smoothed(wholes[length][first], contexts[length][first], below)

        context = contexts[CONTEXT][first]
        self.contexts = np.unique(context)
        likely, shares = [], []
        for of_class in (toxic, ordinary):
            counts = np.bincount(at, np.repeat(of_class, grams.counts), len(first))
            has = counts > 0
            level = Level(self.known[has], context[has], counts[has], ONCE)
            likely.append(level.smoothed(self.known, context, below))
            shares.append(looked_up(level.context, level.rest, self.contexts, 1))
        self.ratio = (np.log(likely[0]) - np.log(likely[1])).astype(np.float32)
        self.share = (np.log(shares[0]) - np.log(shares[1])).astype(np.float32)

    def ratios(self, words: list[str]) -> np.ndarray:
        """Of each word the log of how much likelier it is among toxic words."""
        if not words:
            return np.zeros(0)
        grams = Grams(words)
        context = grams.context(CONTEXT)
        at = np.minimum(np.searchsorted(self.contexts, context), max(0, len(self.contexts) - 1))
        found = np.zeros(len(context))
        if len(self.contexts):
            has = np.nonzero(self.contexts[at] == context)[0]
            found[has] = looked_up(self.known, self.ratio, grams.whole(context)[has], self.share[at[has]])
        return np.add.reduceat(found, grams.first)


class Reader:
    """Compares the likelihoods of texts, remembering the values of words."""

    def __init__(self, models: Models):
        self.models = models
        self.known = Recent(MEMORY)

    def features(self, texts: list[str]) -> np.ndarray:
        """A row for each text. The words of all texts are looked up in one go, those of a long one in parts."""
        rows: list[list[float]] = []
        held: list[list[str]] = []
        for text in texts:
            parts = words_of(text)
            words = next(parts, [])
            if len(words) < BLOCK:
                held.append(words)
                continue
            rows += self._rows(held)
            held = []
            sums = Sums()
            while words:
                sums.add(words, self._learn([words]))
                words = next(parts, [])
            rows.append(sums.features())
        rows += self._rows(held)
        return np.array(rows, np.float64).reshape(len(texts), len(TELLING) + 2)

    def _rows(self, held: list[list[str]]) -> list[list[float]]:
        values, rows = self._learn(held), []
        for words in held:
            sums = Sums()
            sums.add(words, values)
            rows.append(sums.features())
        return rows

    def _learn(self, held: list[list[str]]) -> dict[str, float]:
        """Values of all words, those not remembered in one go."""
        values = {word: self.known.get(word) for word in set().union(*held)}
        new = [word for word, value in values.items() if value is None]
        for word, value in zip(new, self.models.ratios(new).tolist(), strict=True):
            values[word] = value
            self.known.put(word, value)
        return values


class Sums:
    """What is kept of the words of one text."""

    def __init__(self):
        self.total, self.number, self.most = 0.0, 0, []

    def add(self, words: list[str], values: dict[str, float]) -> None:
        told = [values[word] for word in words]
        self.total += sum(told)
        self.number += len(told)
        self.most = heapq.nlargest(TELLING[-1], [*self.most, *told])

    def features(self) -> list[float]:
        most = self.most + [0.0] * (TELLING[-1] - len(self.most))
        means = [sum(most[:n]) / n for n in TELLING]
        return [self.total / max(self.number, 1), *means, float(np.log1p(self.number))]


class Logistic:
    """Fitted by Newton steps with a small penalty on standardised features."""

    def __init__(self, features: np.ndarray, toxic: np.ndarray, steps: int = 30):
        self.middle, self.spread = features.mean(axis=0), features.std(axis=0) + 1e-9
        x, self.weights = self._shaped(features), np.zeros(features.shape[1] + 1)
        penalty = np.diag([1e-6] + [1.0] * features.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (p - toxic) + penalty @ self.weights
            curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
            self.weights -= np.linalg.solve(curve, slope)

    def _shaped(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(features)), (features - self.middle) / self.spread])

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._shaped(features) @ self.weights, -30, 30)))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """``text``, ``toxic`` and ``fits`` (for the logistic function) of the rows to learn from."""
    says = labels.filter(F.col(key).isNotNull() & F.col("toxic").isNotNull())
    says = says.groupBy(F.col(key).alias("key")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    says = says.filter(crc_bucket("key", FOLDS) != 0)
    counted = {row["toxic"]: row["count"] for row in says.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for kind, count in counted.items():
        share = F.when(F.col("toxic") == kind, min(1.0, LABEL_ROWS / count)).otherwise(share)
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share * (1 << 30)
    says = says.filter(drawn).withColumn("fits", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(FITTING)) == 0)
    # At most about LABEL_ROWS ids of each class: small enough for every task, and texts stay where they are.
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.join(F.broadcast(says), "key").select("text", "toxic", "fits")


def _word_counts(rows: DataFrame) -> DataFrame:
    """``word`` and how often it is in toxic and in ordinary rows. Words that no text could share are left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kinds, texts in runs_of(batch, RUN_CHARS):
                counts = Counter(), Counter()
                for kind, text in zip(kinds.to_pylist(), texts, strict=True):
                    for words in words_of(text):
                        counts[kind].update(word for word in words if len(word) <= LONG_WORD)
                every = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(every, pa.string()),
                        *(pa.array([count[word] for word in every], pa.int64()) for count in reversed(counts)),
                    ],
                    names=["word", "n_toxic", "n_ordinary"],
                )

    counts = rows.select("toxic", "text").mapInArrow(counted, "word STRING, n_toxic LONG, n_ordinary LONG")
    return counts.groupBy("word").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary"))


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[Models, Logistic | float]:
    """The models, and the logistic function or the one score of all texts."""
    rows = labelled(docs, labels, key, text)
    words = _word_counts(rows.filter("NOT fits")).orderBy(F.desc(F.expr("n_toxic + n_ordinary")), "word")
    words = words.limit(MODEL_WORDS).toPandas()
    toxic, ordinary = (words[name].to_numpy(np.float64) for name in ("n_toxic", "n_ordinary"))
    models = Models(words["word"].tolist(), toxic, ordinary)
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for batch in batches:
            for kinds, texts in runs_of(batch, RUN_CHARS):
                yield pa.RecordBatch.from_arrays(
                    [kinds, pa.array(reader.features(texts).tolist(), pa.list_(pa.float64()))], names=["toxic", "features"]
                )

    fitting = rows.filter("fits").select("toxic", "text").mapInArrow(measured, "toxic INT, features ARRAY<DOUBLE>")
    fitting = fitting.toPandas()
    seen = fitting["toxic"].to_numpy(np.float64)
    if not 0 < seen.sum() < len(seen):
        return models, float((seen.sum() + 0.5) / (len(seen) + 1))
    return models, Logistic(np.array(fitting["features"].tolist()), seen)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, key, text))
    schema = docs.select(key).schema.add("score", "double")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, score = sent.value
        reader = Reader(models)
        for batch in batches:
            for keys, texts in runs_of(batch, RUN_CHARS):
                scores = np.full(len(texts), score) if isinstance(score, float) else score(reader.features(texts))
                yield pa.RecordBatch.from_arrays([keys, pa.array(scores, pa.float64())], names=[key, "score"])

    held_out = F.coalesce(crc_bucket(key, FOLDS) == 0, F.lit(True))
    found = docs.select(key, text).mapInArrow(mapped, schema)
    predicted = (F.col("score") >= 0.5).cast("int")
    return found.select(key, held_out.alias("held_out"), "score", predicted.alias("predicted"))
