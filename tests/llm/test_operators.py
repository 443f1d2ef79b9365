"""Every operator and stage on small tables: nulls, ties, repeated rows, empty tables, clashing columns,
and results against brute force."""

import datetime as dt
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidewell.llm import bpe, lm, lsh, main_text, packing, pii, quality, queries, sharding, simhash, url_lists
from tidewell.llm.common import table
from tidewell.llm.oracles import ORACLES
from tidewell.session import settle, workspace

SF = "/root/testdata/sf0.001"
DDL = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars INT, score DOUBLE, fingerprint STRING, kept INT"
WORDS = "the of and to in is that for it was on with as by at be this are or from his an they which you one".split()


def sentence(n, seed=0):
    return " ".join(random.Random(seed).choices(WORDS, k=n)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty and long texts, copies, repeated rows, a null id, and columns of the operators' names."""
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, sentence(60, 1)), (5, sentence(60, 1)), (6, sentence(61, 2)),
        (6, sentence(61, 2)), (7, "word " * 300), (8, sentence(4000, 3)), (None, sentence(50, 4)),
        (9, "Mail me: jo.doe+x@mail.example.com or +1 (555) 123-4567, 4111 1111 1111 1111 at 10.0.0.255."),
        (10, "<|endoftext|> É日本 \U0001f600 ok"),
    ]
    rows = [(i, t, "en", None, None if t is None else len(t), 0.5, "f", 1) for i, t in texts]
    return settle(spark.createDataFrame(rows, DDL), "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (7, 0, 0), (8, 1, 0), (8, None, 0), (99, 0, 1)], "doc_id LONG, quality INT, toxic INT")


def whole(spark):
    return table(spark, SF, "documents")


def near_copies(docs_rows):
    """Smallest id of each component, by comparing all pairs."""
    prints = np.array([simhash.fingerprint(text or "") for _, text in docs_rows], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    label = np.arange(len(prints))
    while True:
        below = np.where(near, label[None, :], len(prints)).min(axis=1)
        if np.array_equal(below, label):
            return prints, label
        label = below


def test_near_duplicates(spark, docs, empty):
    for rows in (whole(spark), docs):
        pairs = [(r.doc_id, r.text) for r in rows.collect()]
        prints, label = near_copies(pairs)
        expected = []
        for (key, _), own, group in zip(pairs, prints, label, strict=True):
            ids = [k for (k, _), other in zip(pairs, label, strict=True) if other == group and k is not None]
            expected.append((key, int(own.astype(np.int64)), min(ids, default=None)))
        got = [tuple(row) for row in simhash.near_duplicates(rows).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_group_stays(spark, docs, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((row.doc_id for row in kept.collect()), key=repr) == sorted([1, 4, 6, 7, 8, None, 9, 10], key=repr)
    assert simhash.keep_one(empty).count() == 0
    alone = docs.filter("doc_id IS NULL OR doc_id = 4")
    assert simhash.keep_one(alone.union(alone)).count() == 2


def test_the_stage_keeps_the_smallest_id_of_each_group(spark, docs):
    """Against all pairs of fingerprints, with columns of the names used inside."""
    rows = [(row.doc_id, row.text) for row in whole(spark).collect()]
    _, label = near_copies(rows)
    least = {}
    for (key, _), group in zip(rows, label, strict=True):
        least[group] = min(key, least.get(group, key))
    clashing = whole(spark).selectExpr("*", "1 AS digest", "2 AS digest_0", "3 AS key", "'x' AS first", "4L AS root")
    kept = corpus_pipeline.keep_one_of_each(spark, clashing, SF)
    assert kept.columns == clashing.columns
    assert sorted(row.doc_id for row in kept.collect()) == sorted(least.values())


def test_small_leaves_and_blocks_give_the_same_groups(spark, monkeypatch):
    prints = settle(simhash.fingerprints(whole(spark)), "prints").select("fingerprint").distinct()
    expected = {tuple(r) for r in simhash.components(simhash.near_edges(prints)).collect()}
    monkeypatch.setattr(simhash, "LEAF_BLOCK", 40)
    monkeypatch.setattr(simhash.math, "sqrt", lambda n: 0.0)
    monkeypatch.setattr(simhash, "max", lambda *a: 8 if a[:1] == (2048,) else max(*a), raising=False)
    assert {tuple(r) for r in simhash.components(simhash.near_edges(prints)).collect()} == expected


def test_quality(spark, docs, empty, labels):
    rows = {row.doc_id: row for row in quality.judged(docs, labels).collect()}
    assert [rows[i].base_failed for i in (1, 2, 3, 7, 8)] == [True] * 4 + [False]
    assert rows[8].kept and not rows[7].kept and rows[7].n_repeat_words == 300
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {row.doc_id for row in kept.collect()} <= {4, 5, 6, 8, None}
    assert quality.judged(empty, labels).count() == 0 and quality.keep_good(empty, labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).count() == 6
    result = queries.op3_isolation_forest(spark, SF).join(table(spark, SF, "labels"), "doc_id").collect()
    good = [row for row in result if row.quality == 1 and not row.base_failed]
    bad = [row for row in result if row.quality == 0]
    assert np.mean([row.kept for row in good]) > 0.95 and np.mean([row.kept for row in bad]) < 0.3


def many_marked(spark):
    """45,000 documents and their labels: all but one in nine, some of them twice or without a verdict."""
    word = lambda i: F.concat(
        F.when(F.xxhash64("id", i) % 11 == 0, "X#").otherwise(""), F.conv(F.pmod(F.xxhash64("id", i), F.lit(900)), 10, 36)
    )
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(24) + F.col("id") % 7), word))
    docs = spark.range(45_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    verdict = F.when(F.col("id") % 50 == 7, None).when(F.xxhash64("id") % 40 == 0, 0).otherwise(1)
    marks = spark.range(45_000).filter("id % 9 > 0").select(F.col("id").alias("doc_id"), verdict.cast("int").alias("quality"))
    return docs, marks.union(marks.filter("doc_id % 100 < 10"))


def all_labels_limit(rows, marks):
    known = rows.join(marks.filter("quality is not null"), "doc_id").select("score", "quality").collect()
    return quality.threshold(np.array([row.score for row in known]), np.array([row.quality > 0 for row in known]))


def test_the_threshold_comes_from_every_label_and_path_lengths_from_every_document(spark):
    docs, marks = many_marked(spark)
    rows = settle(quality.judged(docs, marks), "judged").filter("not base_failed")
    limit = all_labels_limit(rows, marks)
    assert 0 < limit < 1 and rows.count() > 40_000
    assert rows.filter(F.col("kept") != (F.col("score") <= limit)).count() == 0
    counts = quality.counted(docs, "doc_id", "text")
    forest = quality.Judge.fit(counts, marks).forest
    every = quality.mass(counts, forest)
    assert (every.sum(axis=1) == 45_000).all()
    depth = [(node + 1).bit_length() - 1 for node in np.flatnonzero(every[0]).tolist()]
    rest = [forest._rest(quality.TREE_ROWS * n / 45_000) for n in every[0][every[0] > 0]]
    assert forest.path[0, every[0] > 0] == pytest.approx(np.add(depth, rest))


def test_the_pipeline_keeps_what_the_threshold_of_all_labels_keeps(spark, tmp_path):
    docs, marks = many_marked(spark)
    rows = settle(quality.judged(docs, marks), "judged").filter("not base_failed")
    limit = all_labels_limit(rows, marks)
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.keep_good(spark, settle(docs, "docs"), str(tmp_path))
    expected = {row.doc_id for row in rows.filter(F.col("score") <= limit).collect()}
    assert {row.doc_id for row in kept.collect()} == expected


def test_thresholds_of_counted_scores_are_those_of_the_rows(spark, monkeypatch):
    for bins, seed in ((1, 1), (64, 2), (quality.BINS, 3)):
        monkeypatch.setattr(quality, "BINS", bins)
        rng = np.random.default_rng(seed)
        good = rng.random(3000) < 0.9
        scores = np.round(rng.normal(np.where(good, 0.4, 0.45), 0.02), 4).clip(0, 1)
        rows = [(float(x), int(g), int(not g)) for x, g in zip(scores, good)]
        limit = quality.threshold_of(spark.createDataFrame(rows, "score DOUBLE, good LONG, bad LONG"))
        assert limit == quality.threshold(scores, good)
    only = spark.createDataFrame([(0.5, 3, 0)], "score DOUBLE, good LONG, bad LONG")
    assert quality.threshold_of(only) == float("inf") == quality.threshold_of(only.limit(0))


BASE = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == 1:
        return all(int(part) <= 255 for part in match.split("."))
    if kind == 2:
        double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0
    return kind == 0 or 8 <= len(digits) <= 15


def test_personal_data(spark, docs, empty):
    hard = [
        "a@b.c_d@e.f.g @x y@z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.0.0.00255", "+12345678 +1-2 +1(2)3.4-5 67890+44 20 7946 0958",
        "4111111111111111 4111-1111 1111-1111 41111111111111112", "9" * 5000, "a" * 5000 + "@b.c", "+1" + " " * 3000,
        "é\U0001f600 x@y.zz \U0001f600 x@y.zz", "x@y.zz,x@y.zz;x@y.zz " * 200, "jo (at) mail (dot) com 555 123 4567", None,
    ]
    more = spark.createDataFrame([(100 + i, text) for i, text in enumerate(hard)], "doc_id LONG, text STRING")
    rows = settle(whole(spark).select("doc_id", "text").union(docs.select("doc_id", "text")).union(more), "texts")
    spans = {}
    for row in rows.collect():
        text = row.text or ""
        spans[row.doc_id, row.text] = [
            (kind, m.start(), m.end())
            for kind, pattern in enumerate(BASE)
            for m in re.finditer(pattern, text)
            if passes(kind, m[0])
        ]
    got = rows.join(pii.find(rows).withColumnRenamed("doc_id", "d"), F_same("doc_id", "d")).collect()
    seen = [row for row in got if [tuple(x) for x in row.base] == spans[row.doc_id, row.text]]
    assert {(row.doc_id, row.text) for row in seen} == set(spans)
    assert all({tuple(x) for x in row.base} <= {tuple(x) for x in row.spans} for row in got)
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns and pii.redacted(empty).count() == 0
    nine = clean.filter("doc_id = 9").first()
    assert nine.text == "Mail me: [EMAIL] or [PHONE], [CARD] at [IP]." and nine.n_chars == len(nine.text)
    assert clean.filter("doc_id = 8").first().text == docs.filter("doc_id = 8").first().text
    assert clean.filter("text IS NULL").count() == 1


def test_addresses_at_a_domain_that_begins_with_a_hyphen(spark):
    texts = ["ann@-mail.example.com", "x %@-a.b y", "ann@-", "no sign"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = {row.doc_id: [(x.kind, x.start, x.end) for x in row.base] for row in pii.find(rows).collect()}
    assert got == {i: [(0, m.start(), m.end()) for m in re.finditer(BASE[0], text)] for i, text in enumerate(texts)}
    assert pii.redacted(rows).filter("doc_id = 0").first().text == "[EMAIL]"


ADDED = {
    "email": ["jo at mail dot com", "jo (at) mail (dot) com", "jo[at]mail.com", "jo @ mail.com"],
    "ip": ["2001:db8::1", "fe80:0:0:0:1:2:3:4", "10[.]20[.]30[.]40"],
    "card": ["4111.1111.1111.1111", "4111 - 1111 - 1111 - 1111", "3782 822463 10005"],
    "phone": ["555-123-4567", "(555) 123-4567", "020 7946 0958"],
}
REFUSED = [
    "look at the dot on the page", "meet at noon", "a::b and dead::beef", "12:30:45", "00:1a:2b:3c:4d:5e", "4111.1111.1111.1112",
    "2021-10-18", "18.10.2021", "1,234,567", "100 200 3000", "version 1.2.3", "x555-123-4567", "10[.]20[.]30[.]400",
]


def test_the_model_adds_planted_spans_and_refuses_others(spark):
    added = [(kind, text) for kind, texts in ADDED.items() for text in texts]
    planted = [f"word {text}, word" for text in [text for _, text in added] + REFUSED]
    both = [f"ann@mail.com and {added[0][1]}; {added[5][1]} \U0001f600 {added[10][1]} " * 40]
    texts = [(-1 - i, text) for i, text in enumerate(planted + both)]
    rows = spark.createDataFrame(texts, "doc_id LONG, text STRING").union(whole(spark).select("doc_id", "text"))
    got = {row.doc_id: row for row in settle(pii.find(rows), "spans").collect()}
    names = {text: [(pii.KINDS[x.kind], text[x.start : x.end]) for x in got[key].spans] for key, text in texts}
    for kind, text in added:
        assert names[f"word {text}, word"] == [(kind, text)]
    assert {text: names[f"word {text}, word"] for text in REFUSED} == {text: [] for text in REFUSED}
    # The rest of the table has no such spans, so nothing is added to it.
    assert all(row.base == row.spans for key, row in got.items() if key >= 0)
    assert Counter(kind for kind, _ in names[both[0]]) == {"email": 80, "ip": 40, "phone": 40}
    whole_text = settle(pii.redacted(rows.filter(f"doc_id = {-len(texts)} OR doc_id >= 0")), "clean")
    assert whole_text.filter("doc_id < 0").first().text == "[EMAIL] and [EMAIL]; [IP] \U0001f600 [PHONE] " * 40


def test_spans_are_told_apart_like_one_by_one(spark):
    rng = np.random.default_rng(5)
    lists = [[], [(0, 1)], [(0, 5), (5, 9)]]
    for size in (3, 20, 200, 300):
        start = rng.integers(0, 8 * size, size)
        lists.append([(int(a), int(a + b)) for a, b in zip(start, rng.integers(1, 9, size), strict=True)])
    cases = [(i, base, added) for i, (base, added) in enumerate((x, y) for x in lists for y in lists if y)]
    kind = "array<struct<kind:int,start:long,end:long>>"
    as_spans = lambda spans: [(n % 4, *span) for n, span in enumerate(sorted(set(spans)))]
    rows = spark.createDataFrame([(i, as_spans(b), as_spans(a)) for i, b, a in cases], f"i INT, base {kind}, added {kind}")
    rows = rows.select("i", pii._apart(pii._in_order(rows.base, rows.added)).alias("free"))
    got = {row.i: [tuple(x) for x in row.kept] for row in rows.select("i", pii._first_of(rows.free).alias("kept")).collect()}
    apart = lambda x, y: x[2] <= y[1] or y[2] <= x[1]
    for i, base, added in cases:
        free = [x for x in as_spans(added) if all(apart(x, y) for y in as_spans(base))]
        free.sort(key=lambda x: (x[1], x[0], x[2]))
        assert got[i] == [x for n, x in enumerate(free) if all(apart(x, y) for y in free[:n])]


def test_redaction_overwrites_no_column(spark):
    names = ["doc_id", "base_0", "spans_0", "order_0", "ends_0", "blocks_0", "added_0", "free_0", "__base", "Text_2"]
    rows = whole(spark).filter("doc_id < 50").selectExpr(*["doc_id"], *[f"doc_id AS {n}" for n in names[1:]], "text", "n_chars")
    clean = settle(pii.redacted(rows), "clean")
    assert clean.columns == rows.columns
    assert all(len(set(row[: len(names)])) == 1 and row.n_chars == len(row.text) for row in clean.collect())


def F_same(a, b):
    from pyspark.sql import functions as F

    return F.col(a).eqNullSafe(F.col(b))


def test_personal_data_needs_no_python(spark):
    plan = pii.find(whole(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_packing(spark, docs, empty):
    pieces = packing.pack(docs).collect()
    assert sum(row.length for row in pieces if row.start == 0 and row.doc_tokens == 1) >= 2  # null and empty
    for key in {row.doc_id for row in pieces}:
        mine = [row for row in pieces if row.doc_id == key]
        copies = docs.filter("doc_id <=> " + ("NULL" if key is None else str(key))).count()
        assert sum(row.length for row in mine) == copies * mine[0].doc_tokens
    assert packing.pack(empty).count() == 0


def test_pieces_of_the_query_are_those_of_the_tokenizer(spark):
    """Every id of every document in one piece, in order; sequences without gaps and not too long."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op6_window_packing(spark, SF).collect()
    of_doc, of_sequence = {}, {}
    for row in rows:
        of_doc.setdefault(row.doc_id, []).append(row)
        of_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    texts = {row.doc_id: row.text or "" for row in whole(spark).collect()}
    assert of_doc.keys() == texts.keys()
    for key, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for row in sorted(of_doc[key], key=lambda row: row.start):
            piece = ids[at : at + row.length]
            assert (row.start, row.doc_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += row.length
        assert at == len(ids)
    used = padded = 0
    for pieces in of_sequence.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024
        used += ends[-1]
        padded += 0 if ends[-1].bit_count() == 1 else 1024 - ends[-1]
    assert padded < 0.02 * used


@pytest.mark.parametrize("kind", ["smallint", "string", "decimal(9,2)"])
def test_language_model_takes_keys_of_any_type(spark, docs, kind):
    rows = docs.select(F_cast("doc_id", kind), "text").limit(5)
    scored = lm.scored(rows)
    assert dict(scored.dtypes)["doc_id"] == kind and scored.count() == 5


def F_cast(name, kind):
    from pyspark.sql import functions as F

    return F.col(name).cast(kind).alias(name)


def test_sharding(spark, docs, empty):
    path = workspace(spark, "map")
    placed = sharding.shard_records(docs, path, shards=3, slots=64).collect()
    for shard in {row.shard for row in placed}:
        assert sorted(r.place for r in placed if r.shard == shard) == list(range(sum(r.shard == shard for r in placed)))
    assert len(placed) == docs.count() and {row.shard for row in placed} <= {0, 1, 2}
    assert sharding.read_map(spark, path, 1).count() == 64 and sharding.read_map(spark, path).first().version == 2
    assert sharding.shard_records(empty, workspace(spark, "map")).count() == 0
    rows = queries.op7_virtual_slots(spark, SF).collect()
    texts = {row.doc_id: row.text or "" for row in whole(spark).collect()}
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row["size"], row.text_crc32) == (len(data) + 16, zlib.crc32(data))


def test_encoding(spark, docs, empty):
    rows = {row.doc_id: row for row in bpe.encoded(docs).collect()}
    assert rows[1].n_tokens == rows[2].n_tokens == rows[3].n_tokens == 0 and rows[1].decoded == ""
    assert np.frombuffer(rows[10].ids, "<u4")[0] == 49407 and len(rows[10].ids) == 4 * rows[10].n_tokens
    assert bpe.encoded(empty).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    assert queries.op8_backtracking_bpe(spark, SF).filter(f"ids_sha256 = '{nothing}' AND n_tokens > 0").count() == 0


def test_language_model(spark, docs, empty):
    rows = lm.scored(docs).collect()
    assert len(rows) == docs.count() and all(math.isfinite(row.score) for row in rows)
    assert lm.scored(empty).count() == 0
    texts = {row.doc_id: row.text or "" for row in whole(spark).collect()}
    held = {key: zlib.crc32(str(key).encode()) % 10 == 0 for key in texts}
    count = Counter()
    for key, text in texts.items():
        if not held[key]:
            count.update([*text.encode().lower().split(), b""])
    total, distinct = sum(count.values()), len(count)
    scored = lm.scored(whole(spark)).collect()
    for row in scored:
        tokens = [*texts[row.doc_id].encode().lower().split(), b""]
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[row.doc_id], len(tokens), total)
        assert row.n_known == sum(count[t] > 0 for t in tokens) and abs(row.base_score - base) < 1e-6 * abs(base)
    new = [row for row in scored if row.held_out]
    assert sum(row.score for row in new) > sum(row.base_score for row in new)


def test_rare_words_are_looked_up_in_the_table(spark, monkeypatch):
    expected = {row.doc_id: (row.base_score, row.n_known) for row in lm.scored(whole(spark)).collect()}
    monkeypatch.setattr(lm, "COMMON", 300)
    for row in lm.scored(whole(spark)).collect():
        base, known = expected[row.doc_id]
        assert abs(row.base_score - base) < 1e-6 * abs(base) and row.n_known == known


def test_the_end_is_known_where_many_words_are_as_frequent(spark, monkeypatch):
    """A few long documents: all words are as frequent as the end or more so."""
    monkeypatch.setattr(lm, "COMMON", 10)
    line = " ".join(f"word{i}" for i in range(50))
    texts = {i: " ".join([line] * (1 + i % 2)) for i in range(12)}
    train = [key for key in texts if zlib.crc32(str(key).encode()) % 10]
    count = Counter(word for key in train for word in [*texts[key].encode().split(), b""])
    total, distinct = sum(count.values()), len(count)
    rows = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    known, _ = lm.vocabulary(settle(lm.word_counts(rows.select("text")), "counts"))
    assert known.counts[b""] == 12 and known.table.flat[lm.BUCKETS] == 12
    for row in lm.scored(rows).collect():
        tokens = [*texts[row.doc_id].encode().split(), b""]
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        assert row.n_known == len(tokens) and abs(row.base_score - base) < 1e-6 * abs(base)


def test_every_training_document_trains_once(spark, docs, monkeypatch):
    seen = Counter()

    def trained(texts, model, shared):
        seen.update(row.text for row in texts.collect())
        return model

    monkeypatch.setattr(lm, "trained", trained)
    for rows in (whole(spark), docs):
        seen.clear()
        lm.learnt(rows)
        assert seen == Counter(row.text for row in rows.collect() if row.doc_id is None or zlib.crc32(str(row.doc_id).encode()) % 10)


def test_nearest_vectors(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 16)))]
    vectors += [(i, vectors[7][1]) for i in range(300, 340)]  # a frequent vector
    broken = [(900, None), (901, []), (902, [0.0] * 16), (903, [None] * 16), (904, [float("nan")] * 16), (905, [1.0])]
    broken += [(None, vectors[0][1]), (906, [float("inf")] * 16)]
    rows = spark.createDataFrame([(i, v, 1.0) for i, v in vectors + broken], "vec_id LONG, embedding ARRAY<DOUBLE>, score DOUBLE")
    found = lsh.nearest(rows, rows.filter("vec_id % 10 = 0")).collect()
    unit = lsh.unit_of(np.array([v for _, v in vectors]))
    hits = 0
    for query in range(0, 340, 10):
        order = sorted((-round(float(unit[query] @ unit[i]), 12), i) for i in range(340) if i != query)
        got = sorted((row.rank, row.vec_id, row.score) for row in found if row.query_id == query)
        assert [rank for rank, _, _ in got] == [1, 2, 3, 4, 5]
        assert all(abs(score - unit[query] @ unit[i]) < 1e-12 for _, i, score in got)
        assert [(-round(score, 12), i) for _, i, score in got] == sorted((-round(s, 12), i) for _, i, s in got)
        hits += len({i for _, i in order[:5]} & {i for _, i, _ in got})
    assert hits >= 0.9 * 5 * 34
    few = rows.filter("vec_id < 3")
    assert lsh.nearest(few, few).count() == 6 and lsh.nearest(few.limit(0), few.limit(0)).count() == 0
    assert lsh.nearest(rows, rows.filter("vec_id = 7"), k=5).filter("score < 1 - 1e-12").count() == 0


def test_recall_of_each_group_of_mixed_vectors(spark, monkeypatch):
    """Clustered vectors set the usual cosine; those without close neighbours must be found all the same."""
    monkeypatch.setattr(lsh, "BUCKET", 60)
    monkeypatch.setattr(lsh, "BLOCK", 100)
    monkeypatch.setattr(lsh, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((16, 32))
    clustered = np.repeat(centres, 250, axis=0) + 0.1 * rng.standard_normal((4000, 32))
    unit = lsh.unit_of(np.concatenate([clustered, rng.standard_normal((1000, 32))]))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    asked = rows.filter("vec_id % 50 = 0")
    found = {}
    for row in lsh.nearest(rows, asked.unionByName(asked)).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    hits = {True: [], False: []}
    for query in range(0, 5000, 50):
        near = unit @ unit[query]
        near[query] = -2
        assert len(found[query]) == 5
        hits[query < 4000].append(len(found[query] & set(np.argsort(-near)[:5].tolist())) / 5)
    assert np.mean(hits[True]) >= 0.9 and np.mean(hits[False]) >= 0.9


def test_recall_of_the_query(spark):
    folder = SF.replace("0.001", "0.01")
    rows = table(spark, folder, "embeddings").filter("embedding IS NOT NULL").collect()
    ids, unit = np.array([r.vec_id for r in rows]), lsh.unit_of(np.array([r.embedding for r in rows], float))
    found = {}
    for row in queries.op4_multiprobe_lsh(spark, folder).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    assert set(found) == {i for i in ids.tolist() if i % 50 == 0}
    hits = []
    for place in np.nonzero(ids % 50 == 0)[0]:
        near = unit @ unit[place]
        near[place] = -2
        hits.append(len(found[ids[place]] & set(ids[np.argsort(-near)[:5]].tolist())))
    assert sum(hits) >= 0.9 * 5 * len(hits)


def test_searches_that_find_too_little_are_made_whole(spark, monkeypatch):
    monkeypatch.setattr(lsh, "TARGET", 1e-9)
    monkeypatch.setattr(lsh, "BUCKET", 1)
    rows = table(spark, SF, "embeddings")
    found = lsh.nearest(rows, rows.filter("vec_id % 50 = 0"))
    assert {row["count"] for row in found.groupBy("query_id").count().collect()} == {5}


def test_main_texts(spark):
    pages = table(spark, SF, "pages")
    expected = {}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", row.html, re.DOTALL)[1]
        parts = [re.sub(r"</?b>", "", part.replace("<br>", " ")) for part in re.split(r"</?(?:p|h1)>", article)]
        parts = [" ".join(regex.sub("&amp;", "&", regex.sub("&lt;", "<", regex.sub("&gt;", ">", x))).split()) for x in parts]
        expected[row.page_id] = "\n".join(x for x in parts if x)
    got = {row.page_id: row.text for row in main_text.extract(pages).collect()}
    assert np.mean([got[key] == text for key, text in expected.items()]) > 0.95
    odd = spark.createDataFrame([(1, None, None, "a"), (1, "u", "", "b"), (None, "u", "<p>x", "c")], "page_id LONG, url STRING, html STRING, text STRING")
    assert [row.text for row in main_text.extract(odd).filter("page_id = 1").collect()] == ["", ""]
    assert main_text.extract(odd.limit(0)).count() == 0


def test_temporal_lists(spark):
    day = lambda n: dt.date(2024, 1, n)
    changes = spark.createDataFrame(
        [
            ("bad.org", day(2), "add", 1), ("bad.org", day(5), "remove", 2), ("bad.org", day(9), "add", 3),
            ("bad.org", day(9), "remove", 4), ("bad.org", day(11), "add", 5), ("x.bad.org", day(3), "add", 6),
            (None, day(1), "add", 7), ("y.org", None, "add", 8), ("y.org", day(1), None, 9),
        ],
        "entry STRING, day DATE, action STRING, number LONG",
    )
    captures = spark.createDataFrame(
        [(n, f"http://{host}/p", day(n)) for n in range(1, 13) for host in ("bad.org", "a.x.bad.org", "notbad.org")]
        + [(0, None, day(3)), (0, "nonsense", day(3)), (0, "http://bad.org", None)],
        "n INT, url STRING, fetched_on DATE",
    )
    got = {(row.n, row.host): row.entry for row in url_lists.judged(captures, url_lists.intervals(changes)).collect()}
    for n in range(1, 13):
        active = 2 <= n < 5 or n >= 11
        assert got[n, "bad.org"] == ("bad.org" if active else None)
        assert got[n, "a.x.bad.org"] == ("x.bad.org" if n >= 3 else "bad.org" if active else None)
        assert got[n, "notbad.org"] is None
    assert got[0, None] is None and got[0, "bad.org"] is None
    assert url_lists.judged(captures, url_lists.intervals(changes.limit(0))).filter("blocked").count() == 0
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    expected = duck.execute(ORACLES["op1_temporal_lists"])
    columns = [column[0] for column in expected.description]
    rows = queries.op1_temporal_lists(spark, SF).select(*columns).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(expected.fetchall(), key=repr)


def test_hosts_and_hot_domains(spark):
    hosts = {
        "http://user:pw@bad.org/x": "bad.org", "HTTPS://Bad.ORG.:80": "bad.org", "http://a@b@bad.org?u=@c": "bad.org",
        "http://[2001:DB8::1]:80/": "[2001:db8::1]", "http://user@/x": None, "http://...": None, "bad.org": None,
        "svn+ssh://bad.org#@x": "bad.org", "http:///x": None, "http://x/@bad.org": "x", "": None, None: None,
    }
    urls = spark.createDataFrame([(url,) for url in hosts], "url STRING")
    assert {row.url: row.host for row in urls.select("url", url_lists.host().alias("host")).collect()} == hosts
    day = dt.date(2024, 1, 3)
    changes = [("com", day, "add", 1), ("[2001:db8::1]", day, "add", 2), ("org", day, "remove", 3)]
    valid = url_lists.intervals(spark.createDataFrame(changes, "entry STRING, day DATE, action STRING, number LONG"))
    names = [f"h{i}.{'com' if i % 3 else 'org'}" for i in range(90)] + ["[2001:db8::1]"]
    rows = spark.createDataFrame([(f"http://u@{x}./", day) for x in names] + [("http://com/", dt.date(2024, 1, 2))], "url STRING, fetched_on DATE")
    hits = Counter(row.entry for row in url_lists.judged(rows, valid).collect())
    assert hits == {"com": 60, "[2001:db8::1]": 1, None: 31}
    assert url_lists.judged(rows.limit(0), valid).count() == 0


def test_null_and_repeated_ids_leave_shards_equal(spark):
    rows = [(None, f"null {i} " + "x" * (i % 50)) for i in range(1500)] + [(7, "the same row")] * 1500
    rows += [(i, "y" * (i % 90)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    placed = sharding.shard_records(docs, workspace(spark, "map"), shards=10).collect()
    load = Counter()
    for row in placed:
        load[row.shard] += row["size"]
    assert len(placed) == 4500 and len({(row.shard, row.place) for row in placed}) == 4500
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 10
    again = sharding.shard_records(docs.filter("doc_id <> 7").repartition(5), workspace(spark, "map"), shards=10)
    slots = {(row.doc_id, row.text_crc32): row.virtual_slot for row in placed if row.doc_id not in (None, 7)}
    assert all(slots[row.doc_id, row.text_crc32] == row.virtual_slot for row in again.collect())


def test_shards_of_the_query_hold_equal_bytes(spark):
    load, places = Counter(), Counter()
    for row in queries.op7_virtual_slots(spark, SF.replace("0.001", "0.01")).collect():
        load[row.shard] += row["size"]
        places[row.shard, row.slot] += 1
    assert set(load) == set(range(40)) and max(places.values()) == 1
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 40
    for shard in load:
        assert max(slot for at, slot in places if at == shard) == sum(at == shard for at, _ in places) - 1


def test_pipeline_stages_keep_their_columns(spark, labels, tmp_path):
    docs = whole(spark)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "packing"]
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = settle(stage(spark, left, SF), name)
        assert result.columns == docs.columns and 0 < result.count() <= left.count()
        left = result
    assert pii.find(left).filter("size(base) > 0").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert {row.doc_id for row in pieces.select("doc_id").collect()} == {row.doc_id for row in left.select("doc_id").collect()}
