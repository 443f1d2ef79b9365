import pytest

from tests.rows import in_order
from tests.test_features import CHANGES, FIRST_TEN, SNAPSHOT, STATES, dated
from tests.test_sources import put
from tidewell import SyncedTable
from tidewell.__main__ import main
from tidewell.schemas import USERS_DDL
from tidewell.sources.files import read_snapshot

DDL = f"{USERS_DDL}, state STRING, rank INT, rate DOUBLE, users INT"


def lines(rows):
    return [",".join(map(str, row)) for row in rows]


def test_batch_job(spark, tmp_path, capsys):
    landing = tmp_path / "landing"
    put(landing, "LOAD00000001.csv", *lines(SNAPSHOT))
    put(landing, "20211017-194324349.csv", *lines(CHANGES))
    put(tmp_path, "cities.csv", *lines(STATES))
    paths = [str(tmp_path / name) for name in ("landing", "cities.csv", "state", "features")]
    main([*paths[:2], "--state", paths[2], "--features", paths[3], "--as-of", "2021-10-18"])
    assert read_snapshot(spark, paths[2]).count() == len(SNAPSHOT) + 3
    features = in_order(spark.read.schema(DDL).csv(paths[3]))
    assert len(features) == len(SNAPSHOT) + 3 and set(dated(FIRST_TEN)) <= set(features)
    assert "Oliver Figueroa" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main([*paths[:2], "--state", f"{paths[0]}/output", "--features", paths[3]])


def test_incremental_job(spark, tmp_path, capsys):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    arguments = ["sync", str(landing), table, "--checkpoint", str(tmp_path / "checkpoint"), "--compact", "0"]
    put(landing, "LOAD00000001.csv", *lines(SNAPSHOT))
    main(arguments)
    put(landing, "20211017-194324349.csv", *lines(CHANGES), "Q,1,x,y,2021-01-01")
    put(tmp_path, "cities.csv", *lines(STATES))
    main([*arguments, "--dimension", str(tmp_path / "cities.csv"), "--as-of", "2021-10-18"])
    assert SyncedTable(spark, table).state().count() == len(SNAPSHOT) + 3
    assert "rejected 1, late 0" in capsys.readouterr().out
