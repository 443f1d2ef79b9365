"""Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def rewrite(column: Column, mapping: dict[str, str]) -> Column:
    """Replace listed values, keep all others (NULL included)."""
    result = column
    for old, new in mapping.items():
        result = F.when(column == old, F.lit(new)).otherwise(result)
    return result


def is_recent(day: Column, as_of: dt.date, days: int = 90) -> Column:
    """True if ``day`` is at most ``days`` days before ``as_of``; future days count, NULL does not."""
    return F.coalesce(day >= F.lit(as_of - dt.timedelta(days=days)), F.lit(False))


# Deliveries of many files are written by Spark as folders "delivery=<name>".
DELIVERY = "delivery"


def plain_path(path: Column) -> Column:
    """The path of a file as it is written, from the form with ``%`` signs that file metadata has."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), decoded).otherwise(path)


def folder_of(path: Column) -> Column:
    return F.substring(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)))


def _in_delivery(path: Column) -> Column:
    return F.substring_index(path, "/", -2).startswith(f"{DELIVERY}=")


def part_number(path: Column) -> Column:
    """Number of a part file in a delivery folder, so that part 100000 comes after part 99999; else 0.

    Evaluated for every row, hence no regular expressions.
    """
    digits = F.substring_index(F.substring_index(F.substring_index(path, "/", -1), "part-", -1), "-", 1)
    number = F.substring_index(digits, ".", 1).try_cast("decimal(38,0)")
    return F.when(_in_delivery(path), F.coalesce(number, F.lit(0))).otherwise(F.lit(0)).cast("decimal(38,0)")


def drop_name(path: Column) -> Column:
    """The name a file was delivered under: that of its delivery folder, else its own."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(_in_delivery(path), F.substring_index(folder, "=", -1)).otherwise(F.substring_index(path, "/", -1))


def is_snapshot_name(name: Column, marker: str = "LOAD") -> Column:
    return name.contains(marker)


def first_number(text: Column) -> Column:
    """First run of digits without leading zeros, as text of any length; NULL if there is none."""
    digits = F.regexp_extract(text, r"(\d+)", 1)
    return F.when(digits != "", F.regexp_replace(digits, r"^0+(?=\d)", ""))
