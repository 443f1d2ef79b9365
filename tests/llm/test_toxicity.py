"""The two models against sums over dictionaries, held-out accuracy, and odd input."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewell.llm import queries, toxicity
from tidewell.llm.common import table

DDL = "doc_id LONG, text STRING, lang STRING, score STRING, toxic STRING, key INT, fits INT"


def grams(word, length):
    said = "\0" * (length - 1) + "\2" + word + "\3"
    return [(said[i - length : i], said[i]) for i in range(length, len(said))]


class Counted:
    """One length of context: character counts by context."""

    def __init__(self, counts, discount=None):
        self.counts = defaultdict(dict)
        for (context, char), n in counts.items():
            self.counts[context][char] = n
        every = list(counts.values())
        once, twice = every.count(1), every.count(2)
        self.discount = discount or (once / (once + 2 * twice) if once else 0.5)

    def likely(self, context, char, below):
        known = self.counts.get(context)
        if not known:
            return below
        rest = sum(min(n, self.discount) for n in known.values())
        return (max(known.get(char, 0) - self.discount, 0) + rest * below) / sum(known.values())


def brute_ratio(words, toxic, ordinary):
    n = toxicity.CONTEXT
    top = [Counter(), Counter()]
    for word, *counts in zip(words, toxic, ordinary, strict=True):
        for gram in grams(word, n):
            for k in range(2):
                top[k][gram] += counts[k]
    distinct = {gram for gram in top[0] | top[1]}
    shared = []
    for length in range(toxicity.SHARED, -1, -1):
        shorter = Counter((context[len(context) - length :], char) for context, char in distinct)
        distinct = set(shorter)
        shared.insert(0, Counted(shorter))
    classes = [Counted({gram: c for gram, c in counts.items() if c}, 1.0) for counts in top]

    def ratio(word):
        total = 0.0
        for context, char in grams(word, n):
            below = 1 / (len(distinct) + 1)
            for length, level in enumerate(shared):
                below = level.likely(context[n - length :], char, below)
            total += math.log(classes[0].likely(context, char, below)) - math.log(classes[1].likely(context, char, below))
        return total

    return ratio


def test_ratios_are_those_of_the_formula():
    words = ["idiot", "idea", "the", "then", "a", "élan", "\U0001f600x", "thethethethethe", "i"]
    toxic, ordinary = [9, 1, 3, 0, 2, 1, 2, 1, 0], [0, 4, 20, 5, 0, 1, 0, 2, 1]
    models = toxicity.Models(words, np.array(toxic, float), np.array(ordinary, float))
    asked = [*words, "idiots", "ide", "zebra", "thetheth", "\U0001f600", "x" * 500, "i" * 3]
    ratio = brute_ratio(words, toxic, ordinary)
    assert models.ratios(asked) == pytest.approx([ratio(word) for word in asked], abs=1e-5)
    assert ratio("idiot") > 3 > 0 > ratio("the")
    assert models.ratios([]).tolist() == []
    nothing = toxicity.Models([], np.zeros(0), np.zeros(0))
    assert nothing.ratios(["a", "bc"]).tolist() == [0.0, 0.0]


def test_texts_in_parts_have_the_features_of_the_whole(monkeypatch):
    words = "the idiot then sat and the clown sat".split()
    models = toxicity.Models(words, np.arange(8.0), np.arange(8.0)[::-1].copy())
    texts = ["", "The idiot, the clown.", " ".join(words * 40), "sat", " ".join(words[::-1] * 30)]
    whole = toxicity.Reader(models).features(texts)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert toxicity.Reader(models).features(texts) == pytest.approx(whole)
    assert whole[0].tolist() == [0.0] * 6
    told = sorted(models.ratios("the idiot the clown".split()), reverse=True)
    expected = [sum(told) / 4, told[0], sum(told[:2]) / 2, sum(told) / 4, sum(told) / 8, math.log(5)]
    assert whole[1].tolist() == pytest.approx(expected)


def planted(spark, marks=True):
    """Every fourth text has two words of a family that ordinary texts do not have."""
    draw = np.random.default_rng(2)
    syllables = ["ka", "lo", "mi", "ren", "tu", "sa", "po"]
    word = lambda: "".join(draw.choice(syllables, draw.integers(1, 4)))
    rows, labels = [], []
    for key in range(400):
        said = [word() for _ in range(draw.integers(10, 60))]
        if key % 4 == 0:
            for _ in range(2):
                said.insert(draw.integers(len(said)), "zor" + draw.choice(["ka", "lo", "mi"]))
        rows.append((key, " ".join(said), "en", "s", "t", 1, 2))
        labels.append((key, 1, int(key % 4 == 0) if marks else 0))
    return rows, labels


def held(rows):
    return {key: zlib.crc32(str(key).encode()) % 5 == 0 for key, *_ in rows}


def test_odd_documents(spark):
    """Null and empty texts, null and repeated ids, long texts, labels that repeat, disagree, or say nothing."""
    rows, labels = planted(spark)
    more = [(None, "zorka zorlo", "en"), (1000, None, None), (1001, "", "en"), (1002, " \n", "en"), (1003, "zorka zormi", "fr"),
            (1003, "zorka zormi", "fr"), (1004, "kalo " * 60_000 + "zorka zorlo", "en"), (1005, "x" * 300_000, "en"), (1006, "\ud83d"[:0], "en")]
    rows = rows + [(*row, "s", "t", 1, 2) for row in more]
    labels = labels + [(None, 1, 1), (1, 1, 0), (4, 1, 0), (5, 1, None), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, DDL)
    known = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
    found = toxicity.scored(docs, known)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = found.collect()
    assert len(got) == len(rows)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in got)
    fold = held(rows[:-9])
    assert all(row.held_out == fold[row.doc_id] for row in got if row.doc_id in fold)
    wrong = [row for row in got if row.doc_id is not None and row.doc_id < 400 and row.predicted != (row.doc_id % 4 == 0)]
    assert len(wrong) <= 8
    by = {row.doc_id: row for row in got}
    assert by[None].held_out and by[None].predicted and by[1003].predicted
    assert not by[1000].predicted and by[1000].score == by[1001].score == by[1002].score
    assert toxicity.scored(docs.limit(0), known).count() == 0


def test_labels_of_one_class_or_none(spark):
    rows, labels = planted(spark, marks=False)
    docs = spark.createDataFrame(rows[:40], DDL)
    schema = "doc_id LONG, quality INT, toxic INT"
    one = toxicity.scored(docs, spark.createDataFrame(labels, schema)).collect()
    assert len({row.score for row in one}) == 1 and one[0].score < 0.5
    none = toxicity.scored(docs, spark.createDataFrame([], schema)).collect()
    assert {row.score for row in none} == {0.5}


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    scores = queries.op12_kneser_ney_toxicity(spark, sf)
    rows = scores.join(table(spark, sf, "labels"), "doc_id").filter("held_out").select("predicted", "toxic").collect()
    caught = sum(row.predicted and row.toxic for row in rows)
    assert caught >= 0.85 * sum(row.toxic for row in rows)
    assert caught >= 0.9 * sum(row.predicted for row in rows)
    assert scores.count() == table(spark, sf, "documents").count()
