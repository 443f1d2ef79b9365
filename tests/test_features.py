import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException

from tests.rows import base_frame, day, executed_plan, in_order, log_frame
from tidewell import city_features, city_stats, first_features, replay, sort_features, summary_by_city, summary_by_state
from tidewell.operators.joins import denormalize, lookup_table
from tidewell.operators.windows import login_rate_by_group, rank_by_group, users_by_group
from tidewell.plans.features import normalize_city

AS_OF = dt.date(2021, 10, 18)

# Rows of the sample snapshot, the sample changes, and the features published for them.
SNAPSHOT = [
    (3, "Steve Goodwin", "Charlotte", "2021-09-19"),
    (6, "Mindy George", "Los Angeles", "2021-10-01"),
    (8, "Lebron James", "Denver", "2021-10-17"),
    (9, "Darla Hayes", "Nashville", "2021-10-15"),
    (11, "Francis Davidson", "Austin", "2021-09-20"),
    (17, "Martin Adkins", "Chicago", "2021-09-03"),
    (20, "Domingo Byrd", "Charlotte", "2021-09-10"),
    (36, "Josephine Sherman", "Boston", "2021-08-14"),
    (51, "Jessie Carson", "Nashville-Davidson", "2021-10-01"),
    (69, "Maurice Chandler", "Boston", "2021-09-25"),
    (73, "Oliver Figueroa", "Austin", "2019-10-03"),
    (75, "Malcolm Nelson", "Boston", "2021-07-15"),
    (81, "Samantha Myers", "Austin", "2021-01-01"),
    (93, "Kate Mcbride", "Chicago", "2021-08-13"),
]
CHANGES = [
    ("U", 6, "Mindy George", "Los Angeles", "2021-10-15"),
    ("I", 133, "Bob Ding", "New York", "2021-10-17"),
    ("I", 134, "Ross Green", "Seattle", "2021-10-17"),
    ("I", 135, "Monica Bing", "Portland", "2021-10-17"),
    ("U", 8, "Kevin Durant", "Denver", "2021-10-14"),
    ("U", 9, "Darla Hayes", "New York", "2021-10-17"),
]
STATES = [
    ("Austin", "Minnesota"),
    ("Boston", "Massachusetts"),
    ("Charlotte", "North Carolina"),
    ("Chicago", "Illinois"),
    ("Nashville", "Tennessee"),
]
FIRST_TEN = [
    (73, "Oliver Figueroa", "Austin", "2019-10-03", "Minnesota", 3, 1 / 3, 3),
    (81, "Samantha Myers", "Austin", "2021-01-01", "Minnesota", 2, 1 / 3, 3),
    (11, "Francis Davidson", "Austin", "2021-09-20", "Minnesota", 1, 1 / 3, 3),
    (75, "Malcolm Nelson", "Boston", "2021-07-15", "Massachusetts", 3, 2 / 3, 3),
    (36, "Josephine Sherman", "Boston", "2021-08-14", "Massachusetts", 2, 2 / 3, 3),
    (69, "Maurice Chandler", "Boston", "2021-09-25", "Massachusetts", 1, 2 / 3, 3),
    (20, "Domingo Byrd", "Charlotte", "2021-09-10", "North Carolina", 2, 1.0, 2),
    (3, "Steve Goodwin", "Charlotte", "2021-09-19", "North Carolina", 1, 1.0, 2),
    (93, "Kate Mcbride", "Chicago", "2021-08-13", "Illinois", 2, 1.0, 2),
    (17, "Martin Adkins", "Chicago", "2021-09-03", "Illinois", 1, 1.0, 2),
]


def dated(rows):
    """The same rows with their only date column, given as text, as dates."""
    return [tuple(day(v) if isinstance(v, str) and v[:2] == "20" else v for v in row) for row in rows]


def sample(spark):
    return replay(base_frame(spark, dated(SNAPSHOT)), log_frame(spark, dated(CHANGES)))


def dimension(spark, rows=STATES):
    return spark.createDataFrame(rows, "city STRING, state STRING")


def test_published_features_of_the_sample(spark):
    features = city_features(sample(spark), dimension(spark), AS_OF)
    assert [tuple(row) for row in sort_features(features).limit(10).collect()] == dated(FIRST_TEN)
    assert [tuple(row) for row in first_features(sample(spark), dimension(spark), AS_OF).collect()] == dated(FIRST_TEN)


def test_sample_state(spark):
    state = {row.user_id: row for row in sample(spark).collect()}
    assert len(state) == len(SNAPSHOT) + 3
    assert state[8].name == "Kevin Durant" and state[8].last_login == day("2021-10-14")
    assert state[9].city == "New York" and state[133].name == "Bob Ding"
    features = {row.user_id: row for row in city_features(sample(spark), dimension(spark), AS_OF).collect()}
    assert features[51].city == "Nashville" and features[51].state == "Tennessee"
    assert features[133].state is None and features[133].users_by_city == 2


def city_rows(spark, days):
    return base_frame(spark, [(i, "n", "X", d) for i, d in enumerate(days)])


def test_login_rate_bounds(spark):
    days = [AS_OF - dt.timedelta(days=n) for n in (90, 91, -5)] + [None]
    result = login_rate_by_group(city_rows(spark, days), AS_OF).collect()
    assert {row.login_rate_last_3_months_by_city for row in result} == {2 / 4}


def test_rank_ties_and_null_dates(spark):
    days = [day("2021-02-02"), day("2021-02-02"), day("2021-01-01"), None]
    result = rank_by_group(city_rows(spark, days)).collect()
    assert sorted((row.user_id, row.last_login_rank_by_city) for row in result) == [(0, 1), (1, 1), (2, 2), (3, 3)]


def test_users_count_copies_once_and_null_city_is_a_group(spark):
    rows = [(1, "a", "X", None), (1, "b", "X", None), (None, "c", "X", None), (2, "d", None, None), (3, "e", None, None)]
    result = users_by_group(base_frame(spark, rows)).collect()
    assert {(row.city, row.users_by_city) for row in result} == {("X", 1), (None, 2)}
    assert len(result) == len(rows)


def test_normalize_city(spark):
    rows = base_frame(spark, [(1, "a", "Nashville-Davidson", None), (2, "b", None, None), (3, "c", "Boston", None)])
    assert [row.city for row in normalize_city(rows).orderBy("user_id").collect()] == ["Nashville", None, "Boston"]


def test_lookup_is_exact_and_refuses_repeated_keys(spark):
    rows = base_frame(spark, [(1, "a", "boston", None), (2, "b", "Boston ", None), (3, "c", None, None)])
    dim = dimension(spark, [*STATES, (None, "Nowhere")])
    assert [row.state for row in denormalize(rows, dim, "city").collect()] == [None] * 3
    with pytest.raises(PySparkException, match="not unique: Boston"):
        lookup_table(dimension(spark, [*STATES, ("Boston", "Georgia")]), "city").collect()


def brute_force(rows, states, as_of):
    result = []
    for key, name, city, login in rows:
        same = [row for row in rows if row[2] == city]
        newer = {row[3] for row in same if row[3] is not None and (login is None or row[3] > login)}
        recent = [row for row in same if row[3] is not None and (as_of - row[3]).days <= 90]
        users = {row[0] for row in same} - {None}
        rate = len(recent) / len(same)
        result.append((key, name, city, login, states.get(city), len(newer) + 1, rate, len(users)))
    return sorted(result, key=repr)


def random_rows(n, seed=3):
    rng = random.Random(seed)
    days = [None, *(AS_OF - dt.timedelta(days=d) for d in (-3, 0, 89, 90, 91, 400))]
    cities = [None, "Austin", "Boston", "Boston", "Boston", "Elsewhere"]
    return [(rng.choice([None, *range(n // 2)]), f"n{i % 7}", rng.choice(cities), rng.choice(days)) for i in range(n)]


@pytest.mark.parametrize("hot", [None, [("Boston", None), (None, AS_OF), ("Boston", AS_OF)]])
def test_features_equal_brute_force(hot, spark):
    rows = random_rows(300)
    features = city_features(base_frame(spark, rows), dimension(spark), AS_OF, hot=hot)
    assert in_order(features) == brute_force(rows, dict(STATES), AS_OF)


def test_features_from_written_stats(spark, tmp_path):
    rows = base_frame(spark, random_rows(200))
    path = str(tmp_path / "stats")
    city_stats(normalize_city(rows), dimension(spark), AS_OF).write.parquet(path)
    features = city_features(rows, dimension(spark), AS_OF, stats=spark.read.parquet(path))
    assert in_order(features) == in_order(city_features(rows, dimension(spark), AS_OF))
    assert "BroadcastHashJoin" in executed_plan(features)


def test_first_features_equal_the_head_of_the_sorted_features(spark):
    rows = base_frame(spark, random_rows(250))
    for n in (1, 10, 60):
        head = sort_features(city_features(rows, dimension(spark), AS_OF)).limit(n).collect()
        assert first_features(rows, dimension(spark), AS_OF, n=n).collect() == head


def test_no_python_in_the_feature_plan(spark):
    assert "Python" not in executed_plan(city_features(sample(spark), dimension(spark), AS_OF))


def test_summaries(spark):
    rows = random_rows(200)
    features = brute_force(rows, dict(STATES), AS_OF)
    by_city = summary_by_city(base_frame(spark, rows), dimension(spark), AS_OF).collect()
    expected = {(row[2], row[4], row[6], row[7]) for row in features}
    assert {(row.city, row.state, row.login_rate, row.users) for row in by_city} == expected
    by_state = {row.state: row for row in summary_by_state(base_frame(spark, rows), dimension(spark), AS_OF).collect()}
    without = [row for row in features if row[4] is None]
    assert by_state[None].n_rows == len(without)
    assert by_state[None].users == len({row[0] for row in without} - {None})
    assert sum(row.n_rows for row in by_state.values()) == len(rows)
