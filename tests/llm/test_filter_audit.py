"""The audit of filters against every order applied document by document."""

import itertools
import re
import statistics

import duckdb

from tidewell.llm import filter_audit, queries
from tidewell.llm.common import table
from tidewell.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"
DDL = "doc_id LONG, text STRING, lang STRING, key INT, part STRING, mask INT, n INT, good INT"
COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def failed(rows, place):
    key, text, _ = rows[place]
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = "A" if len(words) < 100 else ""
    found += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    found += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
    found += "D" if re.search("[#$%&*|]", text) else ""
    copies = [other for other, same, _ in rows if (same or "") == text and None not in (other, key) and other < key]
    return found + ("E" if copies else "")


def brute(rows, labels):
    good = {key for key, quality, _ in labels if quality == 1 and key is not None}
    toxic = {key for key, _, says in labels if says == 1 and key is not None}
    letters = [failed(rows, place) for place in range(len(rows))]
    found = []
    for part in {lang or "" for *_, lang in rows}:
        mine = [(key, x) for (key, _, lang), x in zip(rows, letters, strict=True) if (lang or "") == part]
        removed = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                out = [key for key, x in left if letter in x]
                failing = sum(letter in x for _, x in mine)
                left = [(key, x) for key, x in left if letter not in x]
                removed[letter] += len(out)
                only = sum(x == letter for _, x in mine)
                lost = sum(key in good for key in out), sum(key in toxic for key in out)
                steps.append((part, "".join(order), step, len(left), len(out), failing - len(out), only, *lost, letter))
        found += [(*row[:-1], removed[row[-1]]) for row in steps]
    return sorted(found)


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*row, 1, "p", 2, 3, 4) for row in rows], DDL)
    known = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
    found = filter_audit.audit(filter_audit.marked(docs, known))
    assert found.columns == COLUMNS
    return sorted(tuple(row) for row in found.collect())


def test_odd_documents(spark):
    """Nulls, empty and long texts, copies over parts, repeated rows, ties, labels that repeat or have no document."""
    long = " ".join(f"w{i}" for i in range(120))
    loud = " ".join(f"WORD{i}" for i in range(120))
    rows = [
        (1, None, "en"), (2, "", None), (2, "", ""), (3, "\x0b \t", "en"), (4, long, "en"), (5, long, "de"), (5, long, "de"),
        (4, long, "en"), (None, long, "en"), (None, None, None), (6, loud, "en"), (7, loud + " #", "en"), (8, "é" * 50 + "A" * 5, "fr"),
        (9, "é" * 45 + "A" * 5, "fr"), (9, "A b", "fr"), (10, "same " * 50_000, "de"), (-1, long, "fr"), (11, "a\x1cb", "de"),
    ]
    labels = [(4, 1, 0), (5, 0, 1), (5, 1, None), (6, None, 1), (None, 1, 1), (99, 1, 1), (2, 1, 1), (7, 1, 0)]
    assert audited(spark, rows, labels) == brute(rows, labels)
    assert audited(spark, rows, []) == brute(rows, [])
    assert audited(spark, [], labels) == []


def test_a_third_of_all_rows_are_copies(spark):
    rows = [(i, "the one text" if i % 3 == 0 else f"text {i} #", "en" if i % 2 else "de") for i in range(90)]
    assert audited(spark, rows, []) == brute(rows, [])


def test_potentials_are_shapley_values(spark):
    """Whole numbers at every coalition, and the mean over the orders."""
    cells = [("p", mask, (mask * 37) % 11, mask % 3, mask % 2) for mask in range(8)]
    found = filter_audit.audit(spark.createDataFrame(cells, "part STRING, mask INT, n LONG, good LONG, toxic LONG"), "ABC")
    rows = found.collect()
    assert len(rows) == 18
    for letter in "ABC":
        mine = [row for row in rows if row.filter_order[row.step - 1] == letter]
        assert {row.shapley for row in mine} == {sum(row.removed for row in mine)}
        assert statistics.mean(row.removed for row in mine) == mine[0].shapley / 6


def test_query_equals_its_sql(spark):
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    expected = duck.execute(ORACLES["op13_filter_potential"])
    columns = [column[0] for column in expected.description]
    found = queries.op13_filter_potential(spark, SF)
    assert sorted(tuple(row) for row in found.select(columns).collect()) == sorted(expected.fetchall())
    rows = [tuple(row) for row in table(spark, SF, "documents").select("doc_id", "text", "lang").collect()]
    labels = [tuple(row) for row in table(spark, SF, "labels").select("doc_id", "quality", "toxic").collect()]
    assert sorted(tuple(row) for row in found.select(COLUMNS).collect()) == brute(rows, labels)
