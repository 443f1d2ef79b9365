"""City statistics that follow the changes, against a full computation."""

import datetime as dt
import random

import pytest

from tests.rows import base_frame, day
from tests.test_sources import put
from tidewell import SyncedTable
from tidewell.plans import city_counts
from tidewell.plans.city_counts import CityCounts
from tidewell.plans.features import city_stats, normalize_city
from tidewell.sources.files import read_changes

AS_OF = dt.date(2021, 3, 1)
ALIASES = {"X-old": "X"}


def random_change(draw):
    user, city = draw.randrange(30), draw.choice(["X", "Y", "Z", "X-old", "", "V"])
    login = draw.choice(["", "2021-01-05", "2021-02-01", "2020-06-01"])
    return ",".join([draw.choice("IUUDQ"), str(user) if draw.random() < 0.95 else "", f"n{draw.randrange(99)}", city, login])


@pytest.fixture
def table(spark, tmp_path):
    draw = random.Random(1)
    rows = [(None if i % 9 == 0 else i % 25, "a", draw.choice(["X", "Y", None]), day("2021-01-05") if i % 4 else None) for i in range(40)]
    table = SyncedTable(spark, str(tmp_path / "table"))
    table.load(base_frame(spark, rows))
    return table


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame([("X", "Xland"), ("Z", "Zland")], "city STRING, state STRING")


def check(table, counts, dimension):
    expected = city_stats(normalize_city(table.state(), ALIASES), dimension, AS_OF)
    order = expected.columns
    got = counts.stats(dimension, AS_OF).select(order).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_counts_follow_random_logs(spark, table, dimension, tmp_path, monkeypatch):
    """Deletes, moves, copies, null keys; changes that sort before earlier ones; compactions, a reload, folding."""
    monkeypatch.setattr(city_counts, "FOLD", 3)
    draw, counts = random.Random(4), CityCounts(table, aliases=ALIASES)
    with pytest.raises(ValueError, match="nothing counted"):
        counts.stats(dimension, AS_OF)
    counts.refresh()
    for step in range(7):
        name = f"2021{draw.randrange(10_000):04d}-{step:09d}.csv"
        put(tmp_path / "landing", name, *(random_change(draw) for _ in range(12)))
        table.append(read_changes(spark, str(tmp_path / "landing" / name)))
        if step == 3:
            table.compact()
        if step == 5:
            table.load(base_frame(spark, [(1, "a", "Y", None), (2, "b", "X-old", day("2021-01-05"))]))
        if step != 1:  # a step may span appends
            counts.refresh()
            check(table, counts, dimension)
    newest = counts.refresh()
    assert newest == counts.refresh() and newest["base"] > 0


def test_a_step_reads_and_writes_what_changed(spark, table, dimension, tmp_path):
    counts = CityCounts(table, aliases=ALIASES)
    counts.refresh()
    put(tmp_path, "20210101-000000000.csv", "U,3,n,V,2021-02-01")
    table.append(read_changes(spark, str(tmp_path / "20210101-000000000.csv")))
    step = counts.refresh()
    rows = spark.read.parquet(f"{counts.root}/base=0/days/_step={step['step']}").collect()
    copies = table.state().filter("user_id = 3").count()
    assert sorted((row.city, row.n) for row in rows if row.n > 0) == [("V", copies)]
    assert sum(row.n for row in rows) == 0
    check(table, counts, dimension)
    # A step that has no line, as it failed, does not count.
    spark.createDataFrame([("V", 7)], city_counts.CITIES).write.parquet(f"{counts.root}/base=0/cities/_step={step['step'] + 1}")
    check(table, counts, dimension)


def test_published_features_from_counts(spark, table, dimension):
    counts = CityCounts(table, aliases={})
    counts.refresh()
    plain = spark.read.parquet(table.publish_features(dimension, AS_OF)).collect()
    path = table.publish_features(dimension, AS_OF, stats=counts.stats(dimension, AS_OF))
    assert spark.read.parquet(path).collect() == plain
