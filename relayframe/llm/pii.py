"""Personal data: candidates from wide patterns, judged by boosted trees, next to the strict base kinds.

Base kinds are patterns with a validity test (``BASE``). Wider generators propose overlapping spans: digit
groups in any punctuation, addresses spelled out, assigned credentials. A candidate is described by its
format and context alone. Trees learn from all candidates of the corpus how often such a description
goes with a valid value (Luhn, octets, a known ending, a mix of letters and digits), tests that the
description does not show; so a mistyped card number in the place of one is found too. Each generator's
threshold is the lowest score from which at least ``PRECISION`` of its candidates are valid. Base spans
always stay; a candidate inside one is dropped. Cards, phones, ids and runs of 13 to 19 digits inside a longer
group of numbers are candidates of their own (``PARTS``).

Descriptions are small whole numbers, so the corpus comes down to one count per description and validity
(at most ``len(KINDS)`` times the product of ``LEVELS`` rows, a few hundred in practice), on which
the trees are grown exactly, at any corpus size. Everything else is DataFrame functions.

Spans count code points and exclude their end. Defined results: a null or empty text has no spans. Rows
are told apart by their place in the input, so repeated rows and null ids give rows of their own. An
empty table, or one with valid candidates only or none, gets base spans alone. Other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relayframe.session import checkpointed

_LOCAL = "A-Za-z0-9._%+-"
#: Leftmost matches of these are those of the plain patterns: a start inside a run of the first class
#: could only match if the run's first character did, unless a match ended there (``\G``). Possessive
#: repeats keep them linear on any text.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "number": r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20.()/-]{0,2}[0-9])++",
    "address": rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?(?:\(at\)|\[at\]|\{{at\}}|\x20at\x20|@)\x20?[A-Za-z0-9-]++"
    r"\x20?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20|\.)\x20?[A-Za-z]{2,}+",
    "secret": r"(?i)(?<![A-Za-z])(?:token|secret|password|passwd|pwd|api[_-]?key)[\"']?\x20{0,2}[=:]\x20{0,2}"
    r"[\"']?[A-Za-z0-9+/_.-]{8,}+",
}
#: Parts of a ``number`` from one border of its groups of digits to another, overlapping each other and the
#: number: values that stand beside other numbers. Longest first; every length is looked for at every border.
PARTS = {
    "card_4444": r"[0-9]{4}(?:[\x20-]?[0-9]{4}){3}",
    "card_465": r"[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}",
    "phone_334": r"\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}",
    "id_324": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
} | {f"run_{n}": rf"[0-9](?:[\x20.()/-]{{0,2}}[0-9]){{{n - 1}}}" for n in range(13, 20)}
GENERATORS = BASE | WIDE
KINDS = [*GENERATORS, "part"]
#: A text without this cannot match; cheaper than the pattern.
NEEDS = {"email": "@", "phone": "+"}

CONTEXT_CHARS = 40
#: At least the longest match of a part, and the context before it.
LONGEST_PART = 60
STRETCH = 200
PRECISION = 0.8
ROUNDS = 40
SHRINKAGE = 0.3

# Context words, and endings of addresses.
_CONTEXT = [
    r"(?i)\b(?:mail|e-mail|email|contact|write|reach)\b",
    r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|cell)\b",
    r"(?i)\b(?:card|visa|mastercard|credit|iban|account|payment)\b",
    r"(?i)\b(?:ip|host|server|address|ping)\b",
    r"(?i)\b(?:ssn|passport|social|tax|license)\b",
]
_ENDINGS = r"(?i)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|us|co)$"
LEVELS = {"digits": 8, "groups": 5, "length": 5, "marks": 5, "context": 6, "left": 4, "right": 4}


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn checksum of 0."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def is_valid(kind: str, match: Column) -> Column:
    """The test of a base kind; email has none."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _is_plausible(kind: str, match: Column) -> Column:
    """What the trees learn to expect: tests on the value that the description does not hold."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind in ("number", "part"):
        return F.when(n >= 12, (n <= 19) & _luhn(F.substring(digits, 1, 19))).otherwise(
            match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
            | match.rlike(r"^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$")
            | match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
        )
    if kind == "address" or kind == "email":
        return match.rlike(_ENDINGS)
    if kind == "secret":
        value = F.regexp_extract(match, r"[A-Za-z0-9+/_.-]+$", 0)
        return value.rlike("[0-9].*[0-9]") & value.rlike("[A-Za-z].*[A-Za-z]") & (F.length(value) >= 16)
    return is_valid(kind, match)


def _bucket(value: Column, edges: Sequence[int]) -> Column:
    """How many of the edges a value reaches."""
    return reduce(lambda a, b: a + b, [(value >= e).cast("int") for e in edges])


def _boundary(char: Column) -> Column:
    return F.when(char == "", 0).when(char.rlike(r"^\s$"), 1).when(char.rlike(r"^[\p{L}\p{N}]$"), 3).otherwise(2)


def _description(match: Column, before: Column, after: Column) -> list[Column]:
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    groups = F.size(F.split(match, "[^0-9]+"))
    marks = (
        F.when(match.contains("@"), 4)
        .when(match.rlike(r"[=:]"), 3)
        .when(match.rlike(r"^\+|[()]"), 2)
        .when(match.rlike("[A-Za-z]"), 1)
        .otherwise(0)
    )
    context = reduce(
        lambda rest, i: F.when(before.rlike(_CONTEXT[i]), i + 1).otherwise(rest), reversed(range(len(_CONTEXT))), F.lit(0)
    )
    return [
        _bucket(digits, (1, 7, 9, 12, 16, 17, 20)).alias("digits"),
        F.least(groups - 1, F.lit(4)).alias("groups"),
        _bucket(F.length(match), (8, 16, 24, 40)).alias("length"),
        marks.alias("marks"),
        context.alias("context"),
        _boundary(F.right(before, F.lit(1))).alias("left"),
        _boundary(F.left(after, F.lit(1))).alias("right"),
    ]


def _proposal(kind: int, part: Column, at: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        at.alias("at"),
        part.getField("match").alias("match"),
        F.length(part.getField("gap")).alias("gap"),
        F.right(part.getField("gap"), F.lit(CONTEXT_CHARS)).alias("before"),
        F.left(part.getField("next"), F.lit(1)).alias("after"),
    )


def _parts(each: DataFrame) -> DataFrame:
    """Candidates of kind ``part`` inside those of kind ``number``.

    A run of numbers is cut into stretches that carry ``LONGEST_PART`` characters of both neighbours, so a
    part is found where it starts and rows stay short however long the run is.
    """
    run = F.col("match")
    is_run = (F.col("kind") == KINDS.index("number")) & run.rlike("[^0-9]") & (F.length(F.regexp_replace(run, "[^0-9]", "")) > 9)
    cut = each.where(is_run).select(
        "row",
        "id",
        (F.col("end") - F.length(run)).alias("first"),
        F.length(run).alias("long"),
        "before",
        "after",
        F.regexp_extract_all(run, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0)).alias("own"),
    )
    none = F.array(F.lit(""))
    zipped = F.arrays_zip(
        F.concat(none, F.slice("own", F.lit(1), F.size("own") - 1)).alias("left"),
        F.col("own"),
        F.concat(F.slice("own", F.lit(2), F.size("own")), none).alias("right"),
    )
    stretches = cut.select("row", "id", "first", "long", "before", "after", F.posexplode(zipped).alias("n", "s")).select(
        "*",
        F.right("s.left", F.lit(LONGEST_PART)).alias("prior"),
        # The blank gives the first character one before it.
        F.concat(F.lit(" "), F.right("s.left", F.lit(LONGEST_PART)), "s.own", F.left("s.right", F.lit(LONGEST_PART))).alias("piece"),
    )
    lowest = F.length("prior") + 2

    def char(at: Column) -> Column:
        return F.substr("piece", at, F.lit(1))

    def opens(at: Column) -> Column:
        return char(at).between("0", "9") | (char(at) == "(")

    places = F.sequence(lowest, lowest + F.length("s.own") - 1)
    borders = F.filter(places, lambda at: opens(at) & ~opens(at - 1))
    placed = stretches.withColumn("at", F.explode(borders))
    tail = F.substr("piece", F.col("at"), F.lit(LONGEST_PART + 1))
    shapes = [F.regexp_extract(tail, f"^({pattern})(?![0-9])", 1) for pattern in PARTS.values()]
    # One candidate a place, whatever shapes it has; a whole run is a candidate already.
    found = F.array_distinct(F.filter(F.array(*shapes), lambda p: F.length(p).between(F.lit(1), F.col("long") - 1)))
    offset = F.col("n").cast("long") * STRETCH + F.col("at") - lowest
    part = F.col("part")
    return placed.withColumn("part", F.explode(found)).select(
        "row",
        "id",
        F.lit(KINDS.index("part")).alias("kind"),
        F.lit(0).alias("at"),
        part.alias("match"),
        F.lit(0).alias("gap"),
        F.right(F.concat("before", F.substr("piece", F.lit(2), F.col("at") - 2)), F.lit(CONTEXT_CHARS)).alias("before"),
        F.left(F.concat(char(F.col("at") + F.length(part)), "after"), F.lit(1)).alias("after"),
        (F.col("first") + offset + F.length(part)).alias("end"),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per candidate: ``row, id, kind, start, end, is_base``, its description and ``is_plausible``; a
    text without candidates has one row whose ``kind`` is null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    found = []
    for kind, pattern in GENERATORS.items():
        may = F.col("text").contains(NEEDS[kind]) if kind in NEEDS else F.col("text").rlike(pattern)
        none = F.array().cast("array<string>")
        found.append(F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none).alias(f"m_{kind}"))
        found.append(F.when(may, F.split("text", pattern, -1)).otherwise(none).alias(f"g_{kind}"))
    rows = rows.select("row", "id", *found)
    lists = []
    for i, kind in enumerate(GENERATORS):
        n = F.size(f"m_{kind}")
        parts = F.arrays_zip(
            F.col(f"m_{kind}").alias("match"),
            F.slice(f"g_{kind}", F.lit(1), n).alias("gap"),
            F.slice(f"g_{kind}", F.lit(2), F.greatest(n, F.lit(0))).alias("next"),
        )
        lists.append(F.transform(parts, partial(_proposal, i)))
    each = rows.select("row", "id", F.explode_outer(F.concat(*lists)).alias("c")).select("row", "id", "c.*")
    passed = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(passed)
    # Kept, because row numbers may differ from one scan to the next.
    each = checkpointed(each.withColumn("end", end))
    each = each.unionByName(_parts(each))
    match = F.col("match")

    def by_kind(test, kinds) -> Column:
        return reduce(lambda rest, k: F.when(F.col("kind") == KINDS.index(k), test(k, match)).otherwise(rest), kinds, F.lit(False))

    return each.select(
        "row",
        "id",
        "kind",
        (F.col("end") - F.length("match")).alias("start"),
        "end",
        by_kind(is_valid, BASE).alias("is_base"),
        by_kind(_is_plausible, KINDS).alias("is_plausible"),
        *_description(match, F.col("before"), F.col("after")),
    )


class Split(NamedTuple):
    feature: int
    at_most: int
    low: float | tuple
    high: float | tuple


def _grow(rows: list[tuple], depth: int) -> float | Split:
    """A regression tree of Newton steps over (description, weight, gradient, hessian) rows."""
    g, h = sum(r[2] for r in rows), sum(r[3] for r in rows)
    leaf = SHRINKAGE * g / (h + 1.0)
    if depth == 0 or len(rows) < 2:
        return leaf
    best, choice = 1e-9, None
    for f in range(len(rows[0][0])):
        sums: dict[int, list[float]] = {}
        for r in rows:
            s = sums.setdefault(r[0][f], [0.0, 0.0])
            s[0] += r[2]
            s[1] += r[3]
        lg = lh = 0.0
        for value in sorted(sums)[:-1]:
            lg, lh = lg + sums[value][0], lh + sums[value][1]
            gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
            if gain > best:
                best, choice = gain, (f, value)
    if choice is None:
        return leaf
    f, value = choice
    parts = [r for r in rows if r[0][f] <= value], [r for r in rows if r[0][f] > value]
    return Split(f, value, *(_grow(p, depth - 1) for p in parts))


def _apply(tree: float | Split, description: tuple) -> float:
    while isinstance(tree, Split):
        tree = tree.low if description[tree.feature] <= tree.at_most else tree.high
    return tree


class Model(NamedTuple):
    trees: list[float | Split]
    thresholds: dict[int, float]  # by generator; one that is missing adds nothing


def fit(counts: Sequence[tuple[tuple, int, int]], rounds: int = ROUNDS, precision: float = PRECISION) -> Model:
    """Boosts trees over (description, plausible, other) counts; a description starts with its kind."""
    counts = sorted(counts)
    score = [0.0] * len(counts)
    trees = []
    for _ in range(rounds):
        rows = []
        for (description, yes, no), s in zip(counts, score):
            p = 1 / (1 + math.exp(-s))
            rows.append((description, yes + no, yes - (yes + no) * p, (yes + no) * p * (1 - p)))
        if not rows:
            break
        tree = _grow(rows, 3)
        trees.append(tree)
        score = [max(-30.0, min(30.0, s + _apply(tree, c[0]))) for s, c in zip(score, counts)]
    thresholds = {}
    for kind in range(len(KINDS)):
        own = sorted(((s, c[1], c[2]) for s, c in zip(score, counts) if c[0][0] == kind), reverse=True)
        yes = no = 0
        for i, (s, y, n) in enumerate(own):
            yes, no = yes + y, no + n
            if (i + 1 == len(own) or own[i + 1][0] < s) and yes >= precision * (yes + no):
                thresholds[kind] = s - 1e-9
    return Model(trees, thresholds)


def _tree_column(tree: float | Split, names: list[str]) -> Column:
    if isinstance(tree, Split):
        return F.when(F.col(names[tree.feature]) <= tree.at_most, _tree_column(tree.low, names)).otherwise(
            _tree_column(tree.high, names)
        )
    return F.lit(float(tree))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, id`` and ``spans``, an array of (start, kind number, end, is_base) in that order, of every row."""
    names = ["kind", *LEVELS]
    found = checkpointed(candidates(docs, id_col, text_col))
    counts = found.where("kind is not null").groupBy(*names).agg(
        F.count_if("is_plausible").alias("yes"), F.count_if(~F.col("is_plausible")).alias("no")
    )
    model = fit([(tuple(r[:-2]), r.yes, r.no) for r in counts.collect()])
    score = reduce(lambda a, b: a + b, [_tree_column(t, names) for t in model.trees], F.lit(0.0))
    chosen = reduce(
        lambda rest, k: F.when(F.col("kind") == k, F.col("score") >= model.thresholds[k]).otherwise(rest),
        model.thresholds,
        F.lit(False),
    )
    # Base kinds that fail their test are proposals like the others.
    judged = found.withColumn("score", score).withColumn("keep", F.col("is_base") | chosen)
    base_end = F.max(F.when(F.col("is_base"), F.col("end"))).over(
        Window.partitionBy("row").orderBy("start", F.desc("is_base"), F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    )
    inside = ~F.col("is_base") & (base_end >= F.col("end"))
    spans = F.struct("start", "kind", "end", "is_base")
    return (
        judged.withColumn("inside", F.coalesce(inside, F.lit(False)))
        .groupBy("row", "id")
        .agg(F.array_sort(F.collect_list(F.when(F.col("keep") & ~F.col("inside"), spans))).alias("spans"))
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    kind = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        skipped = s["end"] <= a["at"]
        between = F.substr(text, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(skipped, a["out"]).otherwise(F.concat(a["out"], between, F.get(kind, s["kind"]))).alias("out"),
        )

    done = F.aggregate(spans, start, step)
    return F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int")))
