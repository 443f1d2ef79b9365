"""URL filters whose lists change over time: every capture meets the entries active when it was fetched.

Dated changes of a list become validity intervals of its entries. A capture is blocked if its host, or a
domain above it, has an entry whose interval holds the fetch day. Captures are first reduced to distinct
hosts and days, so a host with a third of all captures is looked up once a day, and changes to one row per
entry and day; both are combined before the shuffle. The intervals of an entry, at most one a day, are one
row of the lookup, so a domain above very many hosts is kept out of the shuffle like any hot key.

A host is what stands between a user name with password, if any, and the port, in lower case and without
its last dots; an address of IP version 6 is a host as it stands in its brackets, and has no domain above it.

Defined results: a null or unreadable address has a null host and is not blocked, nor is a capture without
a day; of several changes of an entry on a day, the one with the largest number counts (of equal numbers,
"add" does not); changes with a null entry, day or action are left out; an action other than "add" ends an
entry; repeated captures are all returned; empty tables give no intervals and no blocked captures. Columns
of the captures are kept, and ``host``, ``blocked``, ``entry`` and ``active_since`` are added in their
place if the captures have columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.joins import join_unique

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?+(\[[^\]/?#]*\]|[^:/?#\[\]@]*[^.:/?#\[\]@])"


def host(url: str = "url") -> Column:
    """The host of an address in lower case, null if there is none."""
    found = F.regexp_extract(F.lower(F.col(url)), HOST, 1)
    return F.when(found != "", found)


def intervals(changes: DataFrame) -> DataFrame:
    """``entry, valid_from, valid_to`` (exclusive, null if open) from ``entry, day, action, number``."""
    known = changes.filter(F.col("entry").isNotNull() & F.col("day").isNotNull() & F.col("action").isNotNull())
    daily = known.groupBy("entry", "day").agg(
        F.max(F.struct("number", (F.col("action") != "add").alias("ends"))).alias("last")
    )
    ends = F.lead("day").over(Window.partitionBy("entry").orderBy("day"))
    return (
        daily.withColumn("valid_to", ends)
        .filter(~F.col("last.ends"))
        .select("entry", F.col("day").alias("valid_from"), "valid_to")
    )


def domains(name: Column) -> Column:
    """A host and the domains above it."""
    labels = F.when(name.startswith("["), F.array(name)).otherwise(F.split(name, r"\."))
    count = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(labels, i, count - i + 1), ".")
    )


def judged(captures: DataFrame, valid: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """The captures with ``host``, ``blocked``, and for blocked ones the longest active ``entry`` and since
    when it is active."""
    rows = captures.withColumn("host", host(url))
    asked = rows.select("host", F.col(day).alias("__day")).filter("host IS NOT NULL AND __day IS NOT NULL").distinct()
    each = asked.withColumn("entry", F.explode(domains(F.col("host"))))
    lists = valid.groupBy("entry").agg(F.collect_list(F.struct("valid_from", "valid_to")).alias("__spans"))
    active = F.filter(
        "__spans",
        lambda x: (x["valid_from"] <= F.col("__day")) & (x["valid_to"].isNull() | (F.col("__day") < x["valid_to"])),
    )
    longest = F.max(F.struct(F.length("entry").alias("size"), "entry", "valid_from"))
    hits = (
        join_unique(each, lists, ["entry"])
        .select("host", "__day", "entry", F.array_max(active)["valid_from"].alias("valid_from"))
        .filter("valid_from IS NOT NULL")
        .groupBy(F.col("host").alias("__host"), "__day")
        .agg(longest.alias("__hit"))
    )
    found = join_unique(
        rows.withColumn("__host", F.col("host")).withColumn("__day", F.col(day)), hits, ["__host", "__day"]
    )
    return found.select(
        *[name for name in captures.columns if name not in ("host", "blocked", "entry", "active_since")],
        "host",
        F.col("__hit").isNotNull().alias("blocked"),
        F.col("__hit.entry").alias("entry"),
        F.col("__hit.valid_from").alias("active_since"),
    )
