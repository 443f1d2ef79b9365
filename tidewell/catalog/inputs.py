"""Base table, change log and dimension, derived from the whole test tables.

``users`` are all customers with the day of their last order. The log has one change per event; which
action it is depends on the event's type and value, and most events have a code that replay does not
know. Event users are spread over the key range and beyond it, so that some changes meet no base row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.functions import DELIVERY
from tidewell.session import workspace
from tidewell.sources.files import mark_complete

AS_OF = dt.date(2001, 8, 1)
FIRST_HALF, LATER = dt.date(2024, 1, 15), dt.date(2024, 4, 20)
USERS_DDL = "user_id BIGINT, name STRING, city STRING, last_login DATE"

_layouts: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its layout is read once, as each reading of it is a Spark job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _layouts:
        _layouts[path] = spark.read.parquet(path).schema
    return spark.read.schema(_layouts[path]).parquet(path)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    last_order = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max(F.col("o_orderdate").cast("date")).alias("last_login"))
    )
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(last_order, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("city"),
            "last_login",
        )
    )


def users_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with NULL cities and dates, and one city under an alias."""
    user = F.col("user_id")
    return users(spark, sf_dir).withColumns(
        {
            "city": F.when(user % 11 == 0, None)
            .when((F.col("city") == "NATION_3") & (user % 2 == 0), "NATION_3-Metro")
            .otherwise(F.col("city")),
            "last_login": F.when(user % 13 == 0, None).otherwise(F.col("last_login")),
        }
    )


ALIASES = {"NATION_3-Metro": "NATION_3"}


def delivered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log, with the name of the day's delivery that brings each change."""
    kind, value = F.col("event_type"), F.col("value")
    # A column of its own, so that the text is parsed once per row.
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    action = (
        F.when((kind == "error") & (value >= 150), "D")
        .when((kind == "signup") & (value >= 100), "I")
        .when(kind.isin("click", "purchase") & (value >= 50), "U")
        .otherwise(F.upper(kind))
    )
    return events.select(
        F.col("event_id").alias("seq"),
        action.alias("action"),
        F.when(k != 99, F.col("user_id") * 11).alias("user_id"),
        F.concat(F.lit("user-"), F.col("event_id").cast("string")).alias("name"),
        F.when(k < 90, F.concat(F.lit("NATION_"), (k % 25).cast("string"))).alias("city"),
        F.when((k < 85) | (k >= 95), F.col("ts").cast("date")).alias("last_login"),
        F.date_format("ts", "yyyyMMdd-000000000").alias("delivery"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered_log(spark, sf_dir).drop("delivery")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City to state; the cities of one region have no state."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .filter(F.col("r_name") != "MIDDLE EAST")
        .select(F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    )


def deliver(rows: DataFrame, landing: str, order: str) -> None:
    """Write ``rows`` as headerless CSV, one folder per ``delivery``, each sorted by ``order``.

    ``order`` itself is written only if it is the key: the order of changes is that of their rows.
    """
    columns = [name for name in rows.columns if name != "seq"]
    (
        rows.repartitionByRange("delivery", order)
        .sortWithinPartitions("delivery", order)
        .select(*columns)
        .write.mode("append")
        .partitionBy(DELIVERY)
        .csv(landing)
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots: an older one, from before any login, and the users as they are."""
    now = users(spark, sf_dir)
    before = now.withColumn("last_login", F.lit(None).cast("date"))
    return before.withColumn("delivery", F.lit("LOAD9")).unionByName(now.withColumn("delivery", F.lit("LOAD10")))


def deliver_snapshots(rows: DataFrame, landing: str) -> None:
    """Deliver ``snapshots`` whole."""
    deliver(rows, landing, "user_id")
    for name in ("LOAD9", "LOAD10"):
        mark_complete(rows.sparkSession, landing, name)


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder with two snapshots and the change files of every day."""
    landing = workspace(spark, "landing")
    deliver_snapshots(snapshots(spark, sf_dir), landing)
    deliver(delivered_log(spark, sf_dir), landing, "seq")
    return landing


def broken_landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder of text lines, some of them with a bad number or date, a column too few or too many."""
    landing = workspace(spark, "landing")
    log, base = delivered_log(spark, sf_dir), users(spark, sf_dir).withColumn("delivery", F.lit("LOAD1"))
    for rows, number, lead in ((base, "user_id", []), (log, "seq", [F.col("action")])):
        kind = F.col(number) % 29
        user = F.when(kind == 3, F.concat(F.lit("x"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
        login = F.when(kind == 5, "2024-99-01").when(kind == 7, "soon").otherwise(F.col("last_login").cast("string"))
        text = [F.coalesce(part, F.lit("")) for part in (*lead, user, F.col("name"), F.col("city"), login)]
        line = F.when(kind == 11, F.concat_ws(",", *text[:-1])).when(kind == 13, F.concat_ws(",", *text, F.lit("more")))
        lines = rows.select(F.coalesce(line, F.concat_ws(",", *text)).alias("value"), "delivery", number)
        lines = lines.repartitionByRange("delivery", number).sortWithinPartitions("delivery", number)
        lines.select("value", "delivery").write.mode("append").partitionBy(DELIVERY).text(landing)
    return landing


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second base table, for replay with other columns."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of orders, one per line item, ordered by ship date, line and part."""
    quantity = F.col("l_quantity")
    action = (
        F.when((F.col("l_returnflag") == "R") & (quantity >= 40), "D").when(quantity <= 10, "I").otherwise("U")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.struct("l_shipdate", "l_linenumber", "l_partkey").alias("seq"),
        action.alias("action"),
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
    )
