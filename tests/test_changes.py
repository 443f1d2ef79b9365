import random
import re

import pytest
from pyspark.sql import functions as F

from tests.rows import base_frame, day, executed_plan, fold, in_order, log_frame
from tidewell import apply_deletes, apply_inserts, apply_updates, duplicate_keys, rejects, replay
from tidewell.operators.changes import not_equal

D1 = day("2021-01-01")


def user(key, name):
    return (key, name, "X", D1)


def change(action, key, name=None):
    return (action, key, name, "X", D1)


CASES = {
    "update of a missing key": ([], [change("U", 1, "a")], []),
    "double insert": ([], [change("I", 1, "a"), change("I", 1, "b")], [(1, "a"), (1, "b")]),
    "update hits all copies": ([(1, "a")], [change("I", 1, "b"), change("U", 1, "c")], [(1, "c"), (1, "c")]),
    "insert after update": ([(1, "a")], [change("U", 1, "b"), change("I", 1, "c")], [(1, "b"), (1, "c")]),
    "delete then update": ([(1, "a")], [change("D", 1), change("U", 1, "b")], []),
    "delete then insert": ([(1, "a")], [change("D", 1), change("I", 1, "b")], [(1, "b")]),
    "update, delete, insert": ([(1, "a")], [change("U", 1, "z"), change("D", 1), change("I", 1, "b")], [(1, "b")]),
    "last update wins": ([(1, "a")], [change("U", 1, "z"), change("U", 1, "b")], [(1, "b")]),
    "update to NULL": ([(1, "a")], [change("U", 1, None)], [(1, None)]),
    "unknown action": ([(1, "a")], [change("X", 1, "b"), change(None, 1, "b")], [(1, "a")]),
    "NULL key change": ([(1, "a")], [change("D", None), change("I", None, "b")], [(1, "a")]),
    "NULL key base row": ([(None, "a")], [change("D", 1), change("U", None, "b")], [(None, "a")]),
    "empty log": ([(1, "a")], [], [(1, "a")]),
}


@pytest.mark.parametrize("case", CASES)
def test_replay_case(case, spark):
    rows, changes, expected = CASES[case]
    result = replay(base_frame(spark, [user(*row) for row in rows]), log_frame(spark, changes))
    assert in_order(result) == sorted((user(*row) for row in expected), key=repr)


def random_case(rng, keys, n_base, n_log):
    def image():
        return (
            rng.choice([None, "n%d" % rng.randrange(99)]),
            rng.choice([None, "A", "B"]),
            rng.choice([None, D1, day("2021-02-02")]),
        )

    rows = [(rng.choice([None, *range(keys)]), *image()) for _ in range(n_base)]
    changes = [(rng.choice(["I", "U", "D", "U", "I", "X"]), rng.choice([None, *range(keys)]), *image()) for _ in range(n_log)]
    return rows, changes


@pytest.mark.parametrize("seed", range(6))
def test_replay_equals_fold_and_splits_anywhere(seed, spark):
    rng = random.Random(seed)
    rows, changes = random_case(rng, keys=rng.choice([2, 8, 40]), n_base=40, n_log=rng.choice([10, 120]))
    base, log = base_frame(spark, rows), log_frame(spark, changes)
    expected = fold(rows, changes)
    assert in_order(replay(base, log)) == expected
    cut = F.col("seq") < rng.randrange(len(changes))
    assert in_order(replay(replay(base, log.filter(cut)), log.filter(~cut))) == expected


def test_replay_with_hot_keys_kept_out_of_the_shuffle(spark):
    rng = random.Random(1)
    rows, changes = random_case(rng, keys=6, n_base=200, n_log=60)
    result = replay(base_frame(spark, rows), log_frame(spark, changes), hot=[(3,), (None,)])
    assert in_order(result) == fold(rows, changes)


def test_single_actions(spark):
    rng = random.Random(5)
    rows, changes = random_case(rng, keys=10, n_base=30, n_log=60)
    base, log = base_frame(spark, rows), log_frame(spark, changes)

    def only(action):
        return log.filter(F.col("action") == action), [c for c in changes if c[0] == action]

    for function, action in ((apply_updates, "U"), (apply_deletes, "D"), (apply_inserts, "I")):
        frame, listed = only(action)
        assert in_order(function(base, frame)) == fold(rows, listed)


def test_replay_takes_other_columns_composite_keys_and_struct_order(spark):
    base = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "a INT, b STRING, v DOUBLE")
    log = spark.createDataFrame(
        [("f2", 1, "U", 1, "x", 9.0), ("f1", 2, "U", 1, "x", 8.0), ("f2", 2, "D", 2, "x", None)],
        "file STRING, line INT, op STRING, a INT, b STRING, v DOUBLE",
    ).withColumn("at", F.struct("file", "line"))
    result = replay(base, log, key=["a", "b"], seq="at", action="op")
    assert in_order(result) == [(1, "x", 9.0), (2, "y", 2.0)]


def test_rejects_and_applied_changes_add_up(spark):
    changes = [change("U", 1, "a"), change("X", 1), change(None, 1), change("D", None)]
    found = rejects(log_frame(spark, changes)).groupBy("reason").count()
    assert in_order(found) == [("null key", 1), ("unknown action", 2)]


def test_duplicate_keys_and_not_equal(spark):
    rows = base_frame(spark, [user(1, "a"), user(1, "b"), user(2, None), user(None, "a")])
    assert in_order(duplicate_keys(rows)) == [(1, 2)]
    assert in_order(not_equal(rows, "user_id", 1)) == [user(2, None)]
    assert in_order(not_equal(rows, "name", "a")) == [user(1, "b")]


def test_plan_has_no_python_and_does_not_grow_with_the_log(spark, tmp_path):
    def plan(n):
        path = str(tmp_path / f"log{n}")
        columns = ["id AS seq", "'U' AS action", "CAST(id % 50 AS INT) AS user_id", "'n' AS name", "'c' AS city"]
        spark.range(n).selectExpr(*columns, "DATE'2021-01-01' AS last_login").write.parquet(path)
        result = replay(base_frame(spark, [user(1, "a")]), spark.read.parquet(path))
        return result._jdf.queryExecution().optimizedPlan().toString().count("\n"), executed_plan(result)

    (short, text), (long, _) = plan(10), plan(10_000)
    assert short == long
    assert "Python" not in text


def test_net_changes_are_exchanged_once(spark, tmp_path):
    """Both joins of a replay read the same exchange."""
    spark.range(1000).selectExpr(
        "id AS seq", "'U' AS action", "CAST(id % 50 AS INT) AS user_id", "'n' AS name", "'c' AS city",
        "DATE'2021-01-01' AS last_login",
    ).write.parquet(str(tmp_path / "log"))
    result = replay(base_frame(spark, [user(1, "a")]), spark.read.parquet(str(tmp_path / "log")))
    final = executed_plan(result).split("== Initial Plan ==")[0]
    assert re.search("Reused(Exchange|.*Exchange)", final)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(1000).selectExpr(
        "id AS seq", "'U' AS action", "CAST(id % 50 AS INT) AS user_id", "'n' AS name", "'c' AS city",
        "DATE'2021-01-01' AS last_login", "'unused' AS more",
    ).write.parquet(str(tmp_path / "log"))
    result = replay(base_frame(spark, [user(1, "a")]), spark.read.parquet(str(tmp_path / "log")))
    plan = result._jdf.queryExecution().toString()
    assert "PushedFilters: [In(action, [D,U]), IsNotNull(user_id)]" in plan
    assert "PushedFilters: [IsNotNull(action), EqualTo(action,I), IsNotNull(user_id)]" in plan
    assert "more:string" not in plan.split("== Physical Plan ==")[1]
