"""The trie of conversations against a dictionary of all prefixes, with small containers, segments and stretches."""

import hashlib
import random
import zlib

import duckdb
import pytest

from tidewell.llm import burst_trie, queries
from tidewell.llm.common import table
from tidewell.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"
DDL = "conv_id LONG, turn LONG, role STRING, text STRING, conv STRING, ids INT, place INT, stretch STRING, head STRING"
ODD = ("x", 1, 2, "y", "z")


def block(role, text):
    said = f"{len(role.encode())}:{role}{text}".encode()
    return hashlib.sha256(said).digest()[:16] + len(text.encode()).to_bytes(8, "big")


def brute(rows, most=9):
    """Nodes by prefix, each of them looked at on its own."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, block(role or "", text or ""))
            own.setdefault(conv, []).append((key, (role or "", text or "")))
    own = {conv: [said for _, said in sorted(turns)] for conv, turns in own.items()}
    paths = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % most
        paths[conv] = tuple(own.get(conv - conv % 5, [])[:h] + turns[h:])
    members = {}
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members.setdefault(path[:depth], []).append(conv)
    children = {path: [other for other in members if other[:-1] == path and other] for path in members}

    def below(path):
        leaves = 0 if children[path] else 1
        saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        for child in children[path]:
            more = below(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    found = []
    for path, convs in members.items():
        ends = ",".join(str(conv) for conv in sorted(convs) if paths[conv] == path)
        parent = min(members[path[:-1]]) if path else None
        found.append(
            (min(convs), len(path), parent, len(convs), len(children[path]), *below(path), hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=repr)


def built(spark, rows, most=9):
    conversations = spark.createDataFrame([(*row, *ODD) for row in rows], DDL)
    found = burst_trie.nodes(burst_trie.rebuilt(conversations, most=most))
    assert found.columns == [field.split()[0] for field in burst_trie.NODE.split(", ")]
    return sorted((tuple(row) for row in found.collect()), key=repr)


def random_rows(seed, convs=60):
    """Few different turns, long shared beginnings, copies, numbers with gaps, ties and nulls."""
    draw = random.Random(seed)
    line = [draw.choice("abc") for _ in range(40)]
    rows = []
    for conv in draw.sample(range(200), convs):
        said = [*line[: draw.choice([0, 3, 20, 40])], *draw.choices("ab", k=draw.randrange(6))]
        for place, text in enumerate(said):
            turn = None if draw.random() < 0.02 else place * draw.choice([1, 1, 7])
            rows.append((conv, turn, draw.choice(["u", "u", "u", None]) if draw.random() < 0.1 else "u", text))
            if draw.random() < 0.03:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize(("container", "segment", "stretch"), [(1 << 14, 1 << 16, 1 << 16), (20, 9, 5)])
def test_nodes_are_those_of_all_prefixes(spark, monkeypatch, container, segment, stretch):
    monkeypatch.setattr(burst_trie, "CONTAINER", container)
    monkeypatch.setattr(burst_trie, "SEGMENT", segment)
    monkeypatch.setattr(burst_trie, "STRETCH", stretch)
    rows = random_rows(3)
    assert built(spark, rows) == brute(rows)


def test_containers_burst_into_runs(spark, monkeypatch):
    """A long beginning that all share, members that end in it, and branches on which others follow."""
    monkeypatch.setattr(burst_trie, "CONTAINER", 30)
    rows = [(conv, place, "u", "long"[: 1 + place % 4]) for conv in range(12) for place in range(10 + (conv > 4) * 5)]
    rows += [(conv, 20 + place, "a", f"{conv % 3}{place}") for conv in range(5, 12) for place in range(8)]
    assert built(spark, rows, most=1) == brute(rows, most=1)


def test_odd_conversations(spark):
    """Null ids, turns, roles and texts; repeated rows; a lender that is not there; one left without turns."""
    bare = next(conv for conv in range(1, 100) if conv % 5 and zlib.crc32(str(conv).encode()) % 9 > 3)
    rows = [
        (None, 0, "user", "no conversation"), (bare, 1, "user", "gone"), (bare, 2, "user", "gone too"),
        (10, None, None, None), (10, 0, "user", ""), (10, 0, "user", ""), (10, 0, "a", "tie"), (-7, 3, "user", "é日\U0001f600"),
        (12, 5, "user", "x" * 100_000), (1 << 60, 1 << 60, "user", "far"), (1 << 60, -(1 << 60), "user", "before"),
    ]
    assert built(spark, rows) == brute([(c, t, r, x) for c, t, r, x in rows])
    assert built(spark, []) == []
    assert [row[:5] for row in built(spark, [(bare, 1, "user", "gone")])] == [(bare, 0, None, 1, 0)]


def test_one_conversation_of_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(burst_trie, "SEGMENT", 64)
    monkeypatch.setattr(burst_trie, "STRETCH", 16)
    rows = [(1, turn, "user", str(turn % 5)) for turn in range(300)]
    rows += [(conv, turn, "user", str(turn % 5)) for conv in range(2, 80) for turn in range(8)]
    assert built(spark, rows) == brute(rows)


def test_query_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    expected = duck.execute(ORACLES["op11_burst_trie"])
    columns = [column[0] for column in expected.description]
    found = queries.op11_burst_trie(spark, SF).select(columns)
    want = sorted(expected.fetchall(), key=repr)
    assert sorted((tuple(row) for row in found.collect()), key=repr) == want
    rows = [tuple(row) for row in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(row) for row in found.select([f.split()[0] for f in burst_trie.NODE.split(", ")]).collect()), key=repr) == brute(rows)
