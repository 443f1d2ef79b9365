"""Personal data: fixed patterns, and boosted trees that judge further candidates.

Four kinds have fixed patterns with checks; their spans are always found. Generators with high recall
propose more spans, which may overlap those and each other: e-mail addresses with spelt-out or spaced signs,
addresses of IP version 6 (also with ``::``) and version 4 with bracketed dots, card numbers with other separators
or of 13 to 15 digits, and phone numbers without a country code. A proposal must have the form of its kind
(``formed``: Luhn's check digit, parts of an address); a gradient-boosted model scores it by how it is written and by
its context, and never sees that check. It is trained on candidates whose label is known, over all documents:
spans of a fixed pattern are positive if they pass its check and negative if not; words around an ``at`` without
a dotted domain, and numbers of documents without any span, outside of what generators propose, are negative. A kind's
threshold is calibrated on the same counts, in which a negative weighs as much as its chance to pass ``formed`` by luck.
Chosen spans that overlap a fixed one, or an earlier chosen one, are left out.

All of it is built from DataFrame functions; only counts of feature cells reach the driver. Patterns are
written so that they take linear time: repeated groups are possessive or bounded, and a pattern starts only where
its first character class does or where the match before ended. Spans are told apart by running ends, and texts are
put together from blocks, so that a text's cost grows in line with its length and its spans.

Positions of matches are running sums over the lengths of what a split by the pattern leaves and of the
matches themselves.

Defined results: a null text is empty; repeated rows and null ids are kept, each row judged alone; an
empty table gives an empty result. ``find`` returns the key and the spans; ``redacted`` returns all
columns of its input, whatever their names, with spans in ``text`` replaced by their kind and ``n_chars`` counted anew.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.boosting import Tree, boosted, threshold

#: Fixed: kinds in their order of output, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = [
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
#: Without one of these, a text has no match: tested first, as most texts have none.
SIGNS = [r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9]", r"\+[0-9]"]

#: What generators propose, per kind.
AT = r"(?:\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?|\x20(?i:at)\x20|\x20?@\x20?)"
DOT = r"(?:\.|\x20?[\[({]\x20?(?i:dot|\.)\x20?[\])}]\x20?|\x20(?i:dot)\x20)"
LOCAL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+"
LABEL = r"[A-Za-z0-9-]{1,63}+"
HEX = r"[0-9A-Fa-f]{1,4}"
PROPOSED = [
    rf"{LOCAL}{AT}{LABEL}(?:{DOT}{LABEL})++",
    rf"(?<![0-9A-Za-z:.])(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}}"
    r"|[0-9]{1,3}+(?:\x20?[\[({]\x20?(?i:dot|\.)\x20?[\])}]\x20?[0-9]{1,3}+){3})(?![0-9A-Za-z:]|\.[0-9])",
    r"(?<![0-9A-Za-z+.,/_-])[0-9](?:[\x20./_-]{0,3}+[0-9]){12,18}+(?![0-9A-Za-z]|[.,/_-][0-9])",
    r"(?<![0-9A-Za-z+(.,:/_-])(?:\([0-9]{2,5}\)\x20?|0[0-9]{1,4}[\x20./-]|[2-9][0-9]{2}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}"
    r"(?![0-9A-Za-z]|[\x20.,:/_-][0-9])",
]
PROPOSED_SIGNS = [
    r"(?i)[\x20\[({]dot[\x20\])}]|[\[({]\x20?at\x20?[\])}]|[\x20]@|@\x20|\x20at\x20[a-z0-9-]{1,63}+\.[a-z0-9]",
    r"[0-9A-Fa-f]:[0-9A-Fa-f:]|[0-9]\x20?[\[({]",
    r"[0-9][\x20./_-]{0,2}[0-9]",
    r"[0-9)][\x20./-]?[0-9]{3}",
]
#: Words around an ``at`` without a dotted domain, and numbers.
NO_ADDRESS = rf"{LOCAL}{AT}{LABEL}(?!{DOT}[A-Za-z0-9-])"
NO_ADDRESS_SIGN = r"@|(?i)[\x20\[({]at[\x20\])}]"
NUMBER = r"[0-9]++(?:[\x20.,:/-][0-9]++)*+"
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
#: Words before a span that name its kind.
NAMES = [
    "e-?mail|mail|correo|courriel|contact|kontakt|write|reach",
    "ip|server|host|addr|gateway|node|ping|dns",
    "card|visa|mastercard|amex|pay|karte|carte|tarjeta|credit",
    "phone|tel|call|fax|mobile|cell|whatsapp|sms|dial",
]
#: How domains often end.
ENDS = ["com", "org", "net", "edu", "gov", "io", "info", "biz", "dev", "de", "fr", "es", "uk", "eu", "ch", "test"]
#: The chance that a number of another kind has the form of a kind: one of ten check digits fits.
LUCK = [1.0, 1.0, 0.1, 1.0]
#: What the chosen proposals of a kind must reach on the counts, and the recall at which a threshold goes no lower.
PRECISION = 0.9
RECALL = 0.95
BLOCK = 64
#: Sums of the same leaves in another order differ by less.
ROUNDING = 1e-9
#: Characters of a block of text.
STRETCH = 256
#: Beyond every place in a text.
FAR = 1 << 40


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; in a function of array elements it would be computed for each."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, both: Callable[[Column, Column], Column] = operator.add) -> Column:
    """Running sums (or, with ``both``, ``F.greatest``) of an array of whole numbers, none below 0, in blocks, so that long
    arrays stay cheap."""
    empty = F.array().cast("array<long>")
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long"))
    grow = lambda a, x: F.concat(a, F.array(both(last(a), x)))

    def lifted(blocks: Column) -> Column:
        tops = F.aggregate(F.transform(blocks, last), F.array(F.lit(0).cast("long")), grow)
        return _bound(tops, lambda t: F.flatten(F.transform(blocks, lambda block, b: F.transform(block, lambda x: both(x, F.get(t, b))))))

    def sums(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return _bound(F.transform(numbers, lambda b: F.aggregate(F.slice(v, b * BLOCK + 1, BLOCK), empty, grow)), lifted)

    return _bound(values, sums)


def _long(length: Column) -> Column:
    return length.cast("long")


def matches(text: Column, pattern: str) -> Column:
    """Array of ``match, start, end, before, after``: leftmost matches that do not overlap, their places in
    code points, and up to 24 characters before and one after."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rest = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(rest, 1, F.size(found)), found, lambda part, match: _long(F.length(part)) + _long(F.length(match))
    )
    return F.transform(
        F.arrays_zip(found.alias("match"), _running(steps).alias("end"), F.slice(rest, 1, F.size(found)).alias("part"),
                     F.slice(rest, 2, F.size(found)).alias("next")),
        lambda x: F.struct(
            x["match"].alias("match"),
            (x["end"] - F.length(x["match"])).alias("start"),
            x["end"].alias("end"),
            F.right(x["part"], F.lit(24)).alias("before"),
            F.left(x["next"], F.lit(1)).alias("after"),
        ),
    )


MATCHES = "array<struct<match:string,start:long,end:long,before:string,after:string>>"


def _found(text: Column, pattern: str, sign: str) -> Column:
    """``matches`` where the text has ``sign``, else none."""
    some = F.when(text.rlike(sign), F.when(F.regexp_count(text, F.lit(pattern)) > 0, matches(text, pattern)))
    return F.coalesce(some, F.array().cast(MATCHES))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits; for short digit strings."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(double - F.when(double > 9, 9).otherwise(0))

    return F.aggregate(places, F.lit(0), lambda total, i: total + worth(i)) % 10 == 0


def passes(kind: int, match: Column) -> Column:
    """The check of a fixed pattern."""
    digits = digits_of(match)
    if KINDS[kind] == "email":
        return F.lit(True)
    if KINDS[kind] == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if KINDS[kind] == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def formed(kind: int, match: Column) -> Column:
    """Whether a proposal has the form of its kind."""
    digits = digits_of(match)
    if KINDS[kind] == "email":
        return F.lit(True)
    if KINDS[kind] == "ip":
        plain = F.regexp_replace(match, r"[^0-9A-Fa-f:]+", ".")
        groups = F.regexp_count(match, F.lit("[0-9A-Fa-f]+"))
        six = (groups == 8) | (match.contains("::") & (groups <= 7))
        return F.when(match.contains(":"), six & match.rlike("[0-9]")).otherwise(
            F.regexp_replace(plain, r"(?i)[^0-9.]", "").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
        )
    if KINDS[kind] == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 12)


def cell(kind: int, x: Column) -> Column:
    """Features of a candidate, all small whole numbers, in the order of ``FEATURES``."""
    match, zero = x["match"], F.lit(0)
    n = F.length(digits_of(match))
    one = lambda yes: F.when(yes, 1).otherwise(0)
    size = F.when(n < 7, 0).when(n < 13, 1).when(n < 20, 2).otherwise(3)
    parts = F.when(match.contains("::"), 5).otherwise(F.least(F.lit(5), F.regexp_count(match, F.lit("[0-9A-Fa-f]+"))))
    shape = (
        F.when(match.rlike("[,:/]"), 1)
        .when(match.rlike(r"[().-]|^[0+].*\x20"), 3)
        .when(match.contains(" "), 2)
        .otherwise(0)
    )
    tail = one(match.rlike(r"[0-9]{3}[^0-9]?[0-9]{3,4}$") & match.rlike("[^0-9]"))
    ends = one(F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1)).isin(ENDS))
    email, ip, phone = (KINDS[kind] == name for name in ("email", "ip", "phone"))
    return F.array(
        F.lit(kind),
        zero if email else size,
        shape if phone else zero,
        tail if phone else zero,
        parts if ip else zero,
        ends if email else zero,
        one(x["before"].rlike(r"[A-Za-z0-9_\"'=/:-]$")),
        one(x["after"].rlike(r"^[A-Za-z0-9_\"'=/-]")),
        one(x["before"].rlike(rf"(?i)(?<![a-z])(?:{NAMES[kind]})\w{{0,4}}\W{{0,3}}\w{{0,4}}\W{{0,3}}$")),
    )


FEATURES = ["kind", "digits", "shape", "tail", "parts", "ends", "glued_before", "glued_after", "named"]


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _fixed(text: Column) -> list[Column]:
    return [_found(text, pattern, sign) for pattern, sign in zip(PATTERNS, SIGNS, strict=True)]


def _all(arrays: list[Column]) -> Column:
    return F.concat(*arrays)


class Model:
    """Per kind: starting score, trees, and the score from which on a proposal is taken."""

    def __init__(self, starts: list[float], trees: list[list[Tree]], limits: list[float]):
        self.starts, self.trees, self.limits = starts, trees, limits

    @classmethod
    def fit(cls, docs: DataFrame, text: str = "text") -> Model:
        """From counts of feature cells over all documents; there are fewer than 2,000 cells."""
        signs = [*SIGNS, NO_ADDRESS_SIGN]
        texts = docs.select(_text(text).alias("t")).filter(reduce(lambda a, b: a | b, (F.col("t").rlike(s) for s in signs)))
        rows = texts.select("t", *[found.alias(f"m{kind}") for kind, found in enumerate(_fixed(F.col("t")))])
        good = [
            F.transform(F.col(f"m{k}"), lambda x: F.struct(passes(k, x["match"]).alias("good"), cell(k, x).alias("cell")))
            for k in range(len(KINDS))
        ]
        rows = rows.select("t", *[column.alias(f"g{k}") for k, column in enumerate(good)])
        none = reduce(lambda a, b: a & b, (~F.exists(F.col(f"g{k}"), lambda x: x["good"]) for k in range(len(KINDS))))
        rest = F.regexp_replace("t", "|".join(f"(?:{p})" for p in PROPOSED[1:]), "\u00a4")
        numbers = F.coalesce(F.when(none, _found(rest, NUMBER, "[0-9]")), F.array().cast(MATCHES))
        rows = rows.withColumn("numbers", numbers).withColumn("words", _found(F.col("t"), NO_ADDRESS, NO_ADDRESS_SIGN))
        other = [("words", KINDS.index("email")), *(("numbers", k) for k in range(1, len(KINDS)))]
        others = [
            F.transform(F.col(name), lambda x: F.struct(F.lit(False).alias("good"), cell(k, x).alias("cell")))
            for name, k in other
        ]
        counts = (
            rows.select(F.explode(_all([*[F.col(f"g{k}") for k in range(len(KINDS))], *others])).alias("x"))
            .groupBy("x.cell")
            .agg(F.count_if("x.good").alias("good"), F.count_if(~F.col("x.good")).alias("bad"))
        )
        found = {tuple(row["cell"]): (row["good"], row["bad"]) for row in counts.collect()}
        cells = {c: (p, n * LUCK[c[0]]) for c, (p, n) in found.items()}
        # Each kind has trees of its own, so that a frequent kind does not decide for a rare one.
        trees, starts, limits = [], [], []
        for k in range(len(KINDS)):
            start, grown = boosted({c: n for c, n in cells.items() if c[0] == k})
            scored = [(start + sum(t.score(c) for t in grown), *n) for c, n in sorted(cells.items()) if c[0] == k]
            starts.append(start)
            trees.append(grown)
            limits.append(threshold(scored, PRECISION, RECALL))
        return cls(starts, trees, limits)

    def score(self, kind: int, cell: Column) -> Column:
        return reduce(lambda a, b: a + b, (_value(tree, cell) for tree in self.trees[kind]), F.lit(self.starts[kind]))


def _value(tree: Tree, cell: Column) -> Column:
    if tree.left is None:
        return F.lit(tree.value)
    left, right = _value(tree.left, cell), _value(tree.right, cell)
    return F.when(F.get(cell, F.lit(tree.feature)) <= tree.cut, left).otherwise(right)


def _spans(kind: int, found: Column) -> Column:
    return F.transform(
        found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    )


def with_spans(docs: DataFrame, text: str, base: str, spans: str) -> DataFrame:
    """``docs`` with the arrays ``base`` and ``spans`` of ``kind`` (its number), ``start`` and ``end``."""
    model = Model.fit(docs, text)
    t = _text(text)
    fixed = [
        _spans(kind, F.filter(found, lambda x: passes(kind, x["match"])))
        for kind, found in enumerate(_fixed(t))
    ]
    docs = docs.withColumn(base, _all(fixed))
    added = []
    for kind, limit in enumerate(model.limits):
        if limit < float("inf"):
            found = F.filter(_found(t, PROPOSED[kind], PROPOSED_SIGNS[kind]), lambda x: formed(kind, x["match"]))
            seen = F.transform(found, lambda x: F.struct(x["start"], x["end"], cell(kind, x).alias("cell")))
            added.append(_spans(kind, F.filter(seen, lambda x: model.score(kind, x["cell"]) >= limit - ROUNDING)))
    if not added:
        return docs.withColumn(spans, F.col(base))
    own = [_unused(docs, f"{name}_") for name in ("added", "order", "free")]
    docs = docs.withColumn(own[0], _all(added))
    some = lambda yes, column: F.when(yes, column)
    docs = docs.withColumn(own[1], some(F.size(own[0]) > 0, _in_order(F.col(base), F.col(own[0]))))
    docs = docs.withColumn(own[2], some(F.size(own[0]) > 0, _apart(F.col(own[1]))))
    every = F.sort_array(F.concat(F.col(base), _first_of(F.col(own[2]))))
    return docs.withColumn(spans, F.when(F.size(own[2]) > 0, every).otherwise(F.col(base))).drop(*own)


def _unused(rows: DataFrame, name: str) -> str:
    """A name that no column has."""
    taken = {column.lower() for column in rows.columns}
    return next(f"{name}{i}" for i in range(len(taken) + 1) if f"{name}{i}" not in taken)


def _in_order(base: Column, added: Column) -> Column:
    """All spans by start, fixed ones first; ``new`` is 0 for those."""

    def rows(spans: Column, new: int) -> Column:
        names = [F.lit(new).alias("new"), "kind", "end"]
        return F.transform(
            spans, lambda x: F.struct(x["start"].alias("start"), *[x[n].alias(n) if isinstance(n, str) else n for n in names])
        )

    return F.sort_array(F.concat(rows(base, 0), rows(added, 1)))


def _apart(order: Column) -> Column:
    """The added ones that overlap no fixed one: none before ends behind their start, none after starts before their end."""
    none = F.lit(0).cast("long")
    ended = _running(F.transform(order, lambda x: F.when(x["new"] == 0, x["end"]).otherwise(none)), F.greatest)
    ahead = F.transform(F.reverse(order), lambda x: F.when(x["new"] == 0, F.lit(FAR) - x["start"]).otherwise(none))
    coming = F.reverse(_running(ahead, F.greatest))
    rows = F.arrays_zip(order.alias("x"), ended.alias("ended"), coming.alias("coming"))
    clear = lambda r: (r["ended"] <= r["x"]["start"]) & (F.lit(FAR) - r["coming"] >= r["x"]["end"])
    return F.transform(F.filter(rows, lambda r: (r["x"]["new"] == 1) & clear(r)), lambda r: r["x"])


def _first_of(free: Column) -> Column:
    """Of spans in order, those that no earlier one overlaps, as ``kind, start, end``."""
    ended = _running(F.transform(free, lambda x: x["end"]), F.greatest)
    before = lambda e, i: F.coalesce(F.get(e, i - 1), F.lit(0).cast("long"))
    kept = _bound(ended, lambda e: F.filter(free, lambda x, i: before(e, i) <= x["start"]))
    return F.transform(kept, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def listed(spans: str | Column) -> Column:
    """``kind:start:end`` of each span, with commas between."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(F.col(spans) if isinstance(spans, str) else spans, one), ",")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``base`` (spans of the fixed patterns) and ``spans`` (all), by kind and start."""
    return with_spans(docs.select(key, text), text, "__base", "__spans").select(
        key, F.col("__base").alias("base"), F.col("__spans").alias("spans")
    )


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in brackets.

    Of spans that overlap, the first gives the name, and the rest of the later one goes too.
    """
    base, spans, order, ends, blocks = (_unused(docs, name) for name in ("base_", "spans_", "order_", "ends_", "blocks_"))
    rows = with_spans(docs, text, base, spans)
    some = F.size(spans) > 0
    by_start = F.sort_array(
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    )
    rows = rows.withColumn(order, F.when(some, by_start))
    rows = rows.withColumn(ends, F.when(some, _running(F.transform(order, lambda x: x["end"]), F.greatest)))
    stretches = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))
    rows = rows.withColumn(blocks, F.when(some, stretches))
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])

    def part(start: Column, end: Column) -> Column:
        """Characters of the text from the blocks that hold them."""
        first = F.floor(start / STRETCH).cast("int")
        held = F.slice(F.col(blocks), first + 1, F.floor(end / STRETCH).cast("int") - first + 1)
        return F.substring(F.array_join(held, ""), (start - first * STRETCH + 1).cast("int"), (end - start).cast("int"))

    def piece(x: Column, i: Column) -> Column:
        done = F.coalesce(F.get(F.col(ends), i - 1), F.lit(0).cast("long"))
        return F.when(x["start"] >= done, F.concat(part(done, x["start"]), F.get(names, x["kind"]))).otherwise("")

    rest = part(F.element_at(F.col(ends), -1), F.length(F.col(f"`{text}`")).cast("long"))
    clean = F.concat(F.array_join(F.transform(F.col(order), piece), ""), rest)
    rows = rows.withColumn(text, F.when(some, clean).otherwise(F.col(f"`{text}`")))
    if length in docs.columns:
        counted = F.length(F.col(text)).cast(docs.schema[length].dataType)
        rows = rows.withColumn(length, F.when(some, counted).otherwise(F.col(length)))
    return rows.select(*[F.col(f"`{name}`") for name in docs.columns])
