import datetime as dt
import os
import random
import time

import pytest

from tests.rows import base_frame, day, fold, in_order
from tests.test_sources import put
from tidewell import SyncedTable, city_features, sort_features
from tidewell.plans.replay_files import replay_files
from tidewell.sources.files import read_changes
from tidewell.streaming.sync import sync_stream

D1 = day("2021-01-01")
BASE = [(1, "a", "X", D1), (2, "b", "Y", D1), (3, "c", "X", None)]
FILES = {
    "20211017-000000000.csv": [("U", 1, "a2", "X", D1), ("I", 4, "d", "Y", D1), ("D", 2, None, None, None)],
    "20211018-000000000.csv": [("I", 2, "b2", "Z", D1), ("U", 1, None, None, None), ("Q", 1, "q", "q", D1)],
    "20211019-000000000.csv": [("U", 4, "d2", "X", D1), ("U", 2, "b3", "Z", D1)],
}


def deliver(folder, *names):
    for name in names:
        put(folder, name, *(",".join("" if v is None else str(v) for v in change) for change in FILES[name]))


def after(*names):
    return fold(BASE, [change for name in sorted(names) for change in FILES[name]])


@pytest.fixture
def table(spark, tmp_path):
    table = SyncedTable(spark, str(tmp_path / "table"))
    table.load(base_frame(spark, BASE))
    return table


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


@pytest.fixture
def sync(table, landing, tmp_path):
    def run(**options):
        sync_stream(table, str(landing), str(tmp_path / "checkpoint"), **options).awaitTermination()

    return run


def test_nothing_loaded(spark, tmp_path):
    table = SyncedTable(spark, str(tmp_path / "none"))
    assert table.current() is None
    with pytest.raises(ValueError, match="nothing loaded"):
        table.state()


def test_versions_append_compact(spark, table, landing):
    first, second, third = FILES
    deliver(landing, first)
    table.append(read_changes(spark, str(landing / first)))
    deliver(landing, second)
    table.append(read_changes(spark, str(landing / second)))
    assert in_order(table.state()) == after(first, second)
    assert in_order(table.state(1)) == after(first)
    assert in_order(table.state(0)) == after()
    assert table.compact() == 3 and table.compact() == 3
    assert in_order(table.state()) == after(first, second)
    deliver(landing, third)
    table.append(read_changes(spark, str(landing / third)))
    assert in_order(table.state()) == after(first, second, third)
    with pytest.raises(ValueError, match="no version 9"):
        table.state(9)


def test_changes_are_ordered_by_name_until_compacted(spark, table, landing):
    first, second, third = FILES
    deliver(landing, *FILES)
    for name in (third, first):
        table.append(read_changes(spark, str(landing / name)))
    assert in_order(table.state()) == after(first, third)
    table.compact()
    table.append(read_changes(spark, str(landing / second)))
    assert in_order(table.state()) == after(first, third)
    assert sorted(row.action for row in table.late().collect()) == ["I", "Q", "U"]


def test_an_uncommitted_write_is_not_seen(spark, table, landing):
    first, second, _ = FILES
    deliver(landing, *FILES)
    read_changes(spark, str(landing / first)).write.parquet(f"{table.root}/log/_snapshot=0/_append=1")
    assert in_order(table.state()) == after()
    table.append(read_changes(spark, str(landing / second)))
    assert in_order(table.state()) == after(second)


def test_stream_equals_batch(spark, table, landing, sync):
    names = list(FILES)
    for i, name in enumerate(names, 1):
        deliver(landing, name)
        sync()
        assert in_order(table.state()) == after(*names[:i])
    version = table.current().version
    sync()
    assert table.current().version == version
    put(landing, "LOAD1.csv", *("1,a,X,2021-01-01", "2,b,Y,2021-01-01", "3,c,X,"))
    assert in_order(replay_files(spark, str(landing))) == in_order(table.state())


def test_stream_with_one_file_per_batch(table, landing, sync):
    deliver(landing, *FILES)
    sync(max_files=1)
    assert in_order(table.state()) == after(*FILES)
    assert table.history().filter("kind = 'append'").count() == len(FILES)


def test_a_repeated_batch_has_no_effect(spark, table, landing):
    first = next(iter(FILES))
    deliver(landing, first)
    changes = read_changes(spark, str(landing))
    assert table.append(changes, stream="s", batch_id=0) == 1
    assert table.append(changes, stream="s", batch_id=0) == 1
    assert in_order(table.state()) == after(first)


def test_a_file_is_added_once_whatever_brings_it(spark, table, landing, tmp_path, sync):
    first, second, third = FILES
    deliver(landing, first, second)
    sync()
    deliver(landing, third)
    table.append(read_changes(spark, str(landing)))
    assert in_order(table.state()) == after(*FILES)
    # A new checkpoint takes all files up again, with batch numbers that begin anew.
    sync_stream(table, str(landing), str(tmp_path / "other checkpoint")).awaitTermination()
    assert in_order(table.state()) == after(*FILES)
    assert table.history().filter("stream IS NOT NULL").select("stream").distinct().count() == 2


def test_late_file_and_repair(spark, table, landing, sync):
    first, second, third = FILES
    deliver(landing, first, third)
    sync(after_batch=SyncedTable.compact)
    deliver(landing, second)
    sync(after_batch=SyncedTable.compact)
    assert in_order(table.state()) == after(first, third)
    assert table.late().count() == len(FILES[second])
    put(landing, "LOAD1.csv", *("1,a,X,2021-01-01", "2,b,Y,2021-01-01", "3,c,X,"))
    table.rebuild(str(landing))
    assert in_order(table.state()) == after(*FILES)
    # What the rebuilt table contains is not applied again.
    table.append(read_changes(spark, str(landing)))
    assert in_order(table.state()) == after(*FILES)


def test_features_are_published_after_each_batch(spark, table, landing, sync):
    dimension = spark.createDataFrame([("X", "Xland")], "city STRING, state STRING")
    as_of, published = dt.date(2021, 2, 1), []
    for name in FILES:
        deliver(landing, name)
        sync(after_batch=lambda t: published.append(t.publish_features(dimension, as_of)))
    assert len(set(published)) == len(FILES)
    expected = sort_features(city_features(table.state(), dimension, as_of)).collect()
    assert sorted(spark.read.parquet(published[-1]).collect(), key=repr) == sorted(expected, key=repr)


def test_another_table_with_a_composite_key(spark, tmp_path, landing):
    ddl = "shop INT, item STRING, price DOUBLE"
    table = SyncedTable(spark, str(tmp_path / "prices"), ddl=ddl, key=["shop", "item"])
    table.load(spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], ddl))
    put(landing, "20211017-000000000.csv", "U,1,a,1.5", "D,1,b,", "I,2,a,3")
    sync_stream(table, str(landing), str(tmp_path / "checkpoint")).awaitTermination()
    assert in_order(table.state()) == [(1, "a", 1.5), (2, "a", 3.0)]


def test_a_file_with_an_old_time_stamp_is_taken(table, landing, sync):
    for name, days in zip(FILES, (0, 8, 0), strict=True):
        deliver(landing, name)
        then = time.time() - days * 86_400
        os.utime(landing / name, (then, then))
        sync()
    assert in_order(table.state()) == after(*FILES)


def test_files_of_one_name_in_two_folders_are_both_taken(table, landing, sync):
    put(landing / "01", "part-0.csv", "U,1,b,X,2021-01-01", "I,5,c,X,2021-01-01")
    sync()
    put(landing / "02", "part-0.csv", "U,1,d,X,2021-01-01", "I,6,e,X,2021-01-01")
    sync()
    changes = [("U", 1, "b", "X", D1), ("I", 5, "c", "X", D1), ("U", 1, "d", "X", D1), ("I", 6, "e", "X", D1)]
    assert in_order(table.state()) == fold(BASE, changes)
    assert table.late().count() == 0


def test_compacted_and_repeated_files_are_not_late(spark, table, landing, sync, tmp_path):
    first, second, third = FILES
    deliver(landing, first, third)
    sync(after_batch=SyncedTable.compact)
    deliver(landing, second)
    sync(after_batch=SyncedTable.compact)
    late = table.late().count()
    assert late == len(FILES[second])
    table.append(read_changes(spark, str(landing)))
    sync_stream(table, str(landing), str(tmp_path / "new checkpoint")).awaitTermination()
    assert table.late().count() == late
    assert in_order(table.state()) == after(first, third)
    put(landing, "LOAD1.csv", *("1,a,X,2021-01-01", "2,b,Y,2021-01-01", "3,c,X,"))
    table.rebuild(str(landing))
    assert table.late().count() == 0
    table.append(read_changes(spark, str(landing)))
    assert table.late().count() == 0 and in_order(table.state()) == after(*FILES)


def test_a_newer_snapshot_file_replaces_the_state(table, landing, sync):
    first, second, third = FILES
    deliver(landing, first)
    put(landing, "LOAD1.csv", "7,z,X,2021-01-01")
    sync()
    base = [(7, "z", "X", D1)]
    assert in_order(table.state()) == fold(base, FILES[first])
    put(landing, "LOAD2.csv", *("1,a,X,2021-01-01", "2,b,Y,2021-01-01", "3,c,X,"))
    sync()
    assert in_order(table.state()) == after()
    deliver(landing, second)
    sync()
    version = table.current().version
    assert in_order(table.state()) == fold(BASE, FILES[second])
    put(landing, "LOAD01.csv", "8,old,X,2021-01-01")  # not newer
    sync()
    assert in_order(table.state()) == fold(BASE, FILES[second])
    sync()
    assert table.current().version == version + 1


def test_all_parts_of_a_snapshot_are_loaded(table, landing, sync):
    first, second, third = FILES
    lines = ("1,a,X,2021-01-01", "2,b,Y,2021-01-01", "3,c,X,")
    for part in (0, 1):
        put(landing / "delivery=LOAD5", f"part-0000{part}-x.csv", lines[part])
    put(landing / "delivery=LOAD5", "_SUCCESS")
    sync(max_files=1)
    assert in_order(table.state()) == fold(BASE[:2], [])
    deliver(landing, first)
    sync(max_files=1)
    put(landing / "delivery=LOAD5", "part-00002-x.csv", lines[2])
    put(landing / "copy" / "delivery=LOAD5", "part-00000-x.csv", lines[0])
    deliver(landing, second)
    sync(max_files=1)
    assert in_order(table.state()) == after(first, second)
    assert table.rejects().filter("seq.file = ''").count() == 0
    table.compact()
    put(landing / "delivery=LOAD5", "part-00003-x.csv", "9,i,X,2021-01-01")
    sync(max_files=1)
    assert [row.user_id for row in table.late().collect()] == [9]
    (landing / "copy" / "delivery=LOAD5" / "part-00000-x.csv").write_text("")
    table.rebuild(str(landing))
    assert in_order(table.state()) == fold([*BASE, (9, "i", "X", D1)], [x for name in (first, second) for x in FILES[name]])


def test_publishing_leaves_the_table_and_earlier_features_alone(spark, table, landing, sync):
    dimension = spark.createDataFrame([("X", "Xland")], "city STRING, state STRING")
    first, second, third = FILES
    deliver(landing, first, third)
    sync()
    one = table.publish_features(dimension, dt.date(2021, 2, 1))
    rows = spark.read.parquet(one).collect()
    two = table.publish_features(dimension, dt.date(2021, 2, 1))
    assert one != two and table.published() == [one, two]
    assert spark.read.parquet(one).collect() == rows
    deliver(landing, second)  # sorts before a published one, and is still in time
    sync()
    assert table.current().mark is None
    assert in_order(table.state()) == after(*FILES)


def test_compaction_by_ratio(table, landing, sync):
    deliver(landing, *FILES)
    sync()
    version = table.current().version
    assert table.compact(ratio=1e9) == version
    assert table.compact(ratio=1e-9) == version + 1
    assert in_order(table.state()) == after(*FILES)


def test_rejects_of_the_table(table, landing, sync):
    deliver(landing, *FILES)
    sync(after_batch=SyncedTable.compact)
    assert [(row.action, row.reason) for row in table.rejects().collect()] == [("Q", "unknown action")]


def test_half_a_delivery_leaves_the_old_state(table, landing, sync):
    """Changes that come while a snapshot is awaited apply to the old state, and then to the new one."""
    first, second, third = FILES
    folder = landing / "delivery=LOAD5"
    deliver(landing, first)
    sync(max_files=1)
    put(folder, "part-00000-x.csv", "1,new,X,2021-01-01")
    sync(max_files=1)
    assert in_order(table.state()) == after(first) and table.current().awaited == "LOAD5"
    deliver(landing, second)
    sync(max_files=1)
    assert in_order(table.state()) == after(first, second)
    table.compact()
    put(folder, "part-00001-x.csv", "4,new,Y,2021-01-01")
    sync(max_files=1)
    assert in_order(table.state()) == after(first, second)
    put(landing, "LOAD4.csv", "9,older,X,2021-01-01")  # complete, but not the newest
    deliver(landing, third)
    sync(max_files=1)
    assert in_order(table.state()) == after(*FILES) and table.current().awaited == "LOAD5"
    put(folder, "_SUCCESS")
    sync(max_files=1)
    new = [(1, "new", "X", D1), (4, "new", "Y", D1)]
    assert in_order(table.state()) == fold(new, FILES[second] + FILES[third])
    assert table.current().number == "5" and table.current().awaited is None
    assert [(row.action, row.reason) for row in table.rejects().collect()] == [("Q", "unknown action")]
    table.append(read_changes(table.spark, str(landing / second)))
    assert in_order(table.state()) == fold(new, FILES[second] + FILES[third])


def test_a_first_snapshot_that_comes_bit_by_bit(spark, landing, tmp_path):
    first, second, _ = FILES
    table = SyncedTable(spark, str(tmp_path / "new table"))
    run = lambda: sync_stream(table, str(landing), str(tmp_path / "checkpoint"), max_files=1).awaitTermination()
    put(landing / "delivery=LOAD1", "part-00000-x.csv", "1,a,X,2021-01-01", "2,b,Y,2021-01-01")
    run()
    assert not table.is_loaded()
    with pytest.raises(ValueError, match="nothing loaded"):
        table.state()
    deliver(landing, first)
    run()
    assert not table.is_loaded() and table.compact() == table.current().version
    put(landing / "delivery=LOAD1", "part-00001-x.csv", "3,c,X,")
    put(landing / "delivery=LOAD1", "_SUCCESS")
    deliver(landing, second)
    run()
    assert in_order(table.state()) == after(first, second)


def nodes(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("\n")


def test_plans_do_not_grow_with_the_number_of_appends(spark, table, landing, monkeypatch):
    """Files are folded into ledgers on the way, and one that came long ago is still known."""
    monkeypatch.setattr("tidewell.plans.synced_table.FOLD", 5)
    changes, sizes = [], {}
    for i in range(1, 13):
        name = f"2021{i:04d}-000000000.csv"
        put(landing, name, f"U,1,a{i},X,2021-01-01", f"I,{i + 10},n,Y,")
        changes += [("U", 1, f"a{i}", "X", D1), ("I", i + 10, "n", "Y", None)]
        table.append(read_changes(spark, str(landing / name)))
        if i == 6:
            table.publish_features(spark.createDataFrame([("X", "s")], "city STRING, state STRING"), dt.date(2021, 2, 1))
        if i in (3, 12):
            sizes[i] = [nodes(frame) for frame in (table.state(), table.taken(), table.late(), table.rejects())]
    assert sizes[3] == sizes[12]
    assert in_order(table.state()) == fold(BASE, changes)
    assert table.current().folded == 10 and table.taken().count() == 12
    table.append(read_changes(spark, str(landing)))
    assert in_order(table.state()) == fold(BASE, changes) and table.taken().count() == 12
    assert in_order(table.state(3)) == fold(BASE, changes[:6])


def test_late_files_are_repaired_by_key(spark, landing, tmp_path, monkeypatch):
    """Random files in random order, with compactions: repaired, the table is that of a rebuild."""
    draw = random.Random(8)
    table = SyncedTable(spark, str(tmp_path / "table"))
    base = [(None if i == 5 else i % 12, f"b{i}", "X", D1) for i in range(20)]
    table.load(base_frame(spark, base))
    assert table.repair() == 0
    files = {}
    for i in range(6):
        name = f"2021100{i}-000000000.csv"
        files[name] = [(draw.choice("IUUD"), draw.randrange(16), f"f{i}-{k}", draw.choice("XYZ"), D1) for k in range(8)]
    come = draw.sample(sorted(files), 6)
    for i, name in enumerate(come):
        put(landing, name, *(",".join(str(value) for value in change) for change in files[name]))
        table.append(read_changes(spark, str(landing / name)))
        if i in (0, 2, 3):
            table.compact()
        if i in (3, 4):
            table.repair()
            assert table.late().count() == 0
            done = [change for name in sorted(come[: i + 1]) for change in files[name]]
            assert in_order(table.state()) == fold(base, done)
    table.repair()
    every = [change for name in sorted(files) for change in files[name]]
    assert in_order(table.state()) == fold(base, every)
    table.compact()
    assert in_order(table.state()) == fold(base, every) and table.rejects().count() == 0
    assert table.repair() == table.current().version


def test_a_rebuilt_table_is_repaired_by_a_rebuild(spark, table, landing):
    first, second, third = FILES
    put(landing, "LOAD1.csv", *("1,a,X,2021-01-01", "2,b,Y,2021-01-01", "3,c,X,"))
    deliver(landing, first, third)
    table.rebuild(str(landing))
    deliver(landing, second)
    table.append(read_changes(spark, str(landing / second)))
    with pytest.raises(ValueError, match="rebuild"):
        table.repair()
    table.rebuild(str(landing))
    assert in_order(table.state()) == after(*FILES) and table.late().count() == 0
