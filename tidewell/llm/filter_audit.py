"""How filters that are applied one after the other take each other's work: an audit of all orders.

The documents of a part are a removal game: a coalition of filters is worth the documents that at least one
of them removes. Its Hart-Mas-Colell potential is 0 for no filter, and else

    P(S) = (worth(S) + sum of P(S without i) over its filters i) / size of S.

The potential of all filters minus that without filter i is the mean of what i removes over all orders, its
Shapley value; a step of an order is a difference of two coalitions. Potentials are kept times the least
common multiple of the sizes, which makes every one of them a whole number.

Texts are read once, into a bit for each filter that a document fails by itself. Copies are counted by a
digest of the text (SHA-256), aggregated before each shuffle, so that a group of copies with a third of all
rows is a few rows for each task. What is left is one row of counts for each part and set of failed filters;
games, potentials and steps are array expressions over it.

Defined results: a null text is empty; a null part is the part of the empty text; a document with a null id
is no copy of another and none is a copy of it; rows that share id and text are no copies of each other, and
each counts; a document has a label if any of its label rows has it; labels with a null id or of no document
have no effect; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from itertools import permutations
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.joins import join_unique

SPACE = r"[\x20\x09-\x0D]+"
#: The filters of ``marked``, in the order of their bits.
FILTERS = "ABCDE"
COPY = FILTERS.index("E")


def failed_alone(text: Column) -> list[Column]:
    """Whether ``text`` fails filters A to D: few words, repeated words, capitals, symbols."""
    words = F.filter(F.split(text, SPACE), lambda word: word != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals > 10 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def _bits(failed: list[Column]) -> Column:
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(failed)), F.lit(0))


def marked(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Documents by ``part``, ``mask`` (a bit for each filter failed), with counts ``n``, ``good``, ``toxic``."""
    read = docs.select(
        F.col(key).alias("key"), F.coalesce(part, F.lit("")).alias("part"), F.coalesce(text, F.lit("")).alias("text")
    )
    alone = read.select(
        "key", "part", F.unhex(F.sha2("text", 256)).alias("same"), _bits(failed_alone(F.col("text"))).alias("mask")
    )
    says = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)))
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    rows = join_unique(alone, known.agg(says("quality").alias("good"), says("toxic").alias("toxic")), ["key"])
    rows = rows.fillna(False, ["good", "toxic"])
    # Now ids are unique in a group, so that what is counted at the least id is that of all its rows.
    rows = rows.groupBy("key", "same", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    copies = rows.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("key").alias("least"),
        F.min_by("n", "key").alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
    )
    first = F.min("least").over(Window.partitionBy("same"))
    own = F.when(F.col("least") == first, F.col("at_least")).otherwise(0)
    copies = copies.withColumn(
        "later", F.when(F.col("least").isNull(), 0).otherwise(F.col("n") - F.col("nameless") - own)
    )
    counted = copies.select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("later")).alias("n")),
                F.struct((F.col("mask") + (1 << COPY)).alias("mask"), F.col("later").alias("n")),
            )
        ).alias("cell"),
    )
    n = F.col("cell.n")
    of = lambda name: F.sum(F.when(F.col(name), n).otherwise(0)).alias(name)
    return counted.groupBy("part", F.col("cell.mask").alias("mask")).agg(F.sum(n).alias("n"), of("good"), of("toxic"))


def _worth(count: str, coalitions: int) -> Column:
    """For each coalition, the documents that fail one of its filters at least."""
    every = F.sequence(F.lit(0), F.lit(coalitions - 1))
    counted = F.map_from_entries(F.collect_list(F.struct("mask", count)))

    def worth(coalition: Column) -> Column:
        of = lambda mask: F.coalesce(F.try_element_at(counted, mask), F.lit(0).cast("long"))
        hit = lambda mask: F.when(mask.bitwiseAND(coalition) != 0, of(mask)).otherwise(0)
        return F.aggregate(every, F.lit(0).cast("long"), lambda total, mask: total + hit(mask))

    return F.transform(every, worth)


def _potential(worth: Column, filters: int) -> Column:
    """The potential of each coalition, times ``lcm(1..filters)``; a coalition comes after all its parts."""
    scale = lcm(*range(1, filters + 1))

    def extended(known: Column, coalition: Column) -> Column:
        without = (
            F.when(coalition.bitwiseAND(1 << i) != 0, known[coalition.bitwiseXOR(F.lit(1 << i))]).otherwise(0)
            for i in range(filters)
        )
        total = sum(without, scale * worth[coalition])
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(coalition))))

    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), start, extended)


def audit(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from the rows of ``marked``.

    ``names`` has a letter for each bit of ``mask``; there are as many orders as permutations of it.
    """
    filters, everything = len(names), (1 << len(names)) - 1
    of_part = cells.groupBy("part").agg(
        F.sum("n").alias("total"), *(_worth(x, everything + 1).alias(f"{x}_worth") for x in ("n", "good", "toxic"))
    )
    of_part = of_part.withColumn("potential", _potential(F.col("n_worth"), filters))
    orders = F.array(*(F.lit("".join(order)) for order in permutations(names)))
    rows = of_part.withColumn("filter_order", F.explode(orders))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(filters))))

    bit = lambda place: F.call_function(
        "shiftleft", F.lit(1), F.instr(F.lit(names), F.substring("filter_order", place, 1)) - 1
    )
    before = sum((F.when(F.col("step") > i, bit(i)).otherwise(0) for i in range(1, filters)), F.lit(0))
    own = F.coalesce(*(F.when(F.col("step") == i, bit(i)) for i in range(1, filters + 1)))
    rows = rows.withColumns({"before": before, "own": own})
    lost = lambda x: F.col(f"{x}_worth")[F.col("before") + F.col("own")] - F.col(f"{x}_worth")[F.col("before")]
    rest = F.lit(everything) - F.col("own")
    orders_by_scale = len(list(permutations(names))) // lcm(*range(1, filters + 1))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("n_worth")[F.col("before") + F.col("own")]).alias("kept"),
        lost("n").alias("removed"),
        (F.col("n_worth")[F.col("own")] - lost("n")).alias("redundant"),
        (F.col("n_worth")[everything] - F.col("n_worth")[rest]).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        (orders_by_scale * (F.col("potential")[everything] - F.col("potential")[rest])).alias("shapley"),
    )
