"""City statistics of a synced table that follow its changes instead of being counted anew.

Kept are the number of rows of each (city, last_login) and of users of each city, as signed differences::

    counts/base=<step>/days/_step=<n>/     city, last_login, n
    counts/base=<step>/cities/_step=<n>/   city, users
    counts/steps/<n>.json                  base, first, last: the table's version and its append

A step takes the keys that changes since the last step address, and only the rows of these keys, as they were
and as they are: all rows of a user have one key, so both differences follow from them. The two states are
read with a filter on these keys, column by column and without a shuffle of the base; what is aggregated,
shuffled and written follows the changes. Every FOLD steps the differences are summed up into a new base, and
after a load, which replaces the table, everything is counted once. A step is visible by its line only, so a
failed one is repeated. There must be one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.windows import USERS
from tidewell.plans.features import normalize_city, stats_of_counts
from tidewell.plans.synced_table import SyncedTable
from tidewell.storage import names, read_text, write_once

FOLD = 16
DAYS, CITIES = "city STRING, last_login DATE, n BIGINT", "city STRING, users BIGINT"


class CityCounts:
    """Counts of a table with the columns ``user_id`` (its key), ``city`` and ``last_login``."""

    def __init__(self, table: SyncedTable, *, aliases: dict[str, str] | None = None):
        self.table = table
        self.spark = table.spark
        self.root = f"{table.root}/counts"
        self.aliases = aliases

    def refresh(self) -> dict:
        """Count what has changed since the last step; returns the newest step."""
        step, now = self._newest(), self.table.current()
        if step is not None and step["version"] == now.version:
            return step
        number = 0 if step is None else step["step"] + 1
        fields = {"step": number, "version": now.version, "loaded": now.loaded}
        if step is None or step["loaded"] != now.loaded:
            days, cities = self._counted(self.table.state())
            return self._write({**fields, "base": number}, days, cities)
        then = self.table.version(step["version"])
        keys = self.table.changed_keys(then)
        before, after = (
            self._counted(state.join(keys, self.table.key, "left_semi"))
            for state in (self.table.state(then.version), self.table.state(now.version))
        )
        days = _difference(after[0], before[0], ["city", "last_login"], "n")
        cities = _difference(after[1], before[1], ["city"], "users")
        if number - step["base"] < FOLD:
            return self._write({**fields, "base": step["base"]}, days, cities)
        days = _summed(self._read("days", step, DAYS).unionByName(days), ["city", "last_login"], "n")
        cities = _summed(self._read("cities", step, CITIES).unionByName(cities), ["city"], "users")
        return self._write({**fields, "base": number}, days, cities)

    def stats(self, dimension: DataFrame, as_of: dt.date, *, days: int = 90) -> DataFrame:
        """``city_stats`` of the table as of the last step."""
        step = self._newest()
        if step is None:
            raise ValueError("nothing counted yet")
        pairs = _summed(self._read("days", step, DAYS), ["city", "last_login"], "n").withColumnRenamed("n", "_n")
        # A city whose last user is gone has no row in ``pairs``.
        users = self._read("cities", step, CITIES).groupBy("city").agg(F.sum("users").cast("int").alias(USERS))
        return stats_of_counts(pairs, users, dimension, as_of, days=days)

    def _counted(self, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = normalize_city(state, self.aliases).select("city", "last_login", "user_id")
        days = rows.groupBy("city", "last_login").agg(F.count(F.lit(1)).alias("n"))
        return days, rows.groupBy("city").agg(F.countDistinct("user_id").alias("users"))

    def _newest(self) -> dict | None:
        steps = names(self.spark, f"{self.root}/steps")
        return json.loads(read_text(self.spark, f"{self.root}/steps/{max(steps)}")) if steps else None

    def _write(self, step: dict, days: DataFrame, cities: DataFrame) -> dict:
        for folder, rows in (("days", days), ("cities", cities)):
            path = f"{self.root}/base={step['base']}/{folder}/_step={step['step']}"
            rows.write.mode("overwrite").parquet(path)
        write_once(self.spark, f"{self.root}/steps/{step['step']:012d}.json", json.dumps(step))
        return step

    def _read(self, folder: str, step: dict, ddl: str) -> DataFrame:
        path = f"{self.root}/base={step['base']}/{folder}"
        rows = self.spark.read.schema(f"{ddl}, _step BIGINT").option("basePath", path).parquet(path)
        return rows.filter(F.col("_step") <= step["step"]).drop("_step")


def _summed(rows: DataFrame, by: list[str], count: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(count).alias(count)).filter(F.col(count) != 0)


def _difference(after: DataFrame, before: DataFrame, by: list[str], count: str) -> DataFrame:
    return _summed(after.unionByName(before.withColumn(count, -F.col(count))), by, count)
