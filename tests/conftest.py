import pytest

from tidewell.operators import joins
from tidewell.session import BROADCAST_CONF, SPLIT_FLOOR_CONF, build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidewell-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def at_scale(spark, monkeypatch):
    """Treat the small test tables as too large to broadcast or to leave alone."""
    monkeypatch.setattr(joins, "HOT_BYTES", 0)
    settings = {
        SPLIT_FLOOR_CONF: "0",
        BROADCAST_CONF: "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name in settings:
        spark.conf.unset(name)
