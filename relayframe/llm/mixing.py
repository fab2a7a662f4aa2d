"""Mix sources to target weights by pivotal dependent rounding.

Every row of a source gets the same expected number of copies, its source's target over its source's
size. The fractional parts are rounded in pairs: a random transfer moves mass from one row to the other
until one is whole, so that the words the pair takes do not change. Pairs are rows of one source and one
size class (sizes between two powers of two). What is left of each task, one fraction a source and class,
meets in a tree of further rounds. In the last one the fractions left over are settled from the largest
row down: each is paired with all smaller ones of its source together, which take what it leaves. So a
source's taken words differ from its target by about one of its smallest rows, unless one row is larger
than all that could make up for it, and no row ever needs its source to be in one place.

Rows that agree in source, id, size and text form a unit with a count; a unit of any size is rounded at
once, so repeated rows cost no more than one.

Defined results: a null text has size 0; rows of size 0 take no words. Null sources form a source of
their own, the last. Units are dealt by a hash of their content and their random numbers follow from
seed, round and content, so reruns agree. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relayframe.llm.common import partitions_for, word_count
from relayframe.session import checkpointed

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
UNITS_PER_TASK = 250_000
TREE_FAN_IN = 64
#: Fractions of a source and size class that the last round keeps to settle from the largest down.
KEPT = 8
UNIT_KEYS = ["source", "id", "size", "text_hash"]
ROUNDED = "source string, id long, size long, text_hash long, copies long, rows long, fraction double"


def targets(
    sizes: dict[str | None, int], weights: Sequence[float], total_share: float, most_copies: float
) -> dict[str | None, float]:
    """Words to take from each source: shares by weight, cut at ``most_copies`` times the source's size,
    with the excess shared among the others by weight until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_sources, result = total_share * sum(sizes.values()), list(names), {}
    while open_sources:
        share = left / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if share * weight[s] > most_copies * sizes[s]]
        if not full:
            return result | {s: share * weight[s] for s in open_sources}
        for s in full:
            result[s] = most_copies * sizes[s]
            left -= result[s]
        open_sources = [s for s in open_sources if s not in result]
    return result


class _Unit(NamedTuple):
    key: tuple  # source, id, size, text hash
    whole: int
    fraction: float


def _uniform(seed: int, step: int, *keys: tuple) -> float:
    return xxhash.xxh64_intdigest(repr((seed, step, keys)).encode(), seed=seed) / 2.0**64


def _transfer(a: _Unit, b: _Unit, draw: float) -> tuple[_Unit, _Unit]:
    """Move mass between two fractions until one is whole; size * fraction summed over both stays."""
    x, y = a.key[2], b.key[2]
    up = min(1 - a.fraction, b.fraction * y / x)
    down = min(a.fraction, (1 - b.fraction) * y / x)
    if draw * (up + down) < down:
        fa = 1.0 if up == 1 - a.fraction else a.fraction + up
        fb = 0.0 if up == b.fraction * y / x else b.fraction - up * x / y
    else:
        fa = 0.0 if down == a.fraction else a.fraction - down
        fb = 1.0 if down == (1 - b.fraction) * y / x else b.fraction + down * x / y
    return a._replace(fraction=fa), b._replace(fraction=fb)


def _is_whole(fraction: float) -> bool:
    return not 1e-12 < fraction < 1 - 1e-12


def _settle(units: list[_Unit], draw) -> list[_Unit]:
    """Whole copies for all units of a source, from the largest down: a unit is paired with all smaller ones
    together, whose fractions move by as much each until it is whole. ``draw`` gives a number for a unit.

    Where a fraction would leave 0 to 1 that way they move towards 0 or 1 in proportion; where they cannot
    make up for the unit at all, the end that leaves less over is taken."""
    left = sorted(units, key=lambda u: (-u.key[2], repr(u.key)))
    done = []
    while left:
        unit, left = left[0], left[1:]
        size, f = unit.key[2], unit.fraction
        taken = math.fsum(u.fraction * u.key[2] for u in left)
        words = sum(u.key[2] for u in left)
        over = {1: (1 - f) * size, 0: -f * size}  # words that the rest takes less
        missing = {1: max(0.0, over[1] - taken), 0: max(0.0, -over[0] - (words - taken))}
        up = int(draw(unit) < f)
        if missing[up] > 1e-9 and missing[1 - up] < missing[up]:
            up = 1 - up
        done.append(unit._replace(fraction=float(up)))
        if not left:
            break
        moved = [u.fraction - over[up] / words for u in left]
        if not all(0 <= m <= 1 for m in moved):
            if up:
                rest = max(0.0, 1 - over[up] / taken) if taken else 0.0
                moved = [u.fraction * rest for u in left]
            else:
                rest = max(0.0, 1 + over[up] / (words - taken)) if words > taken else 0.0
                moved = [1 - (1 - u.fraction) * rest for u in left]
        left = [u._replace(fraction=m) for u, m in zip(left, moved)]
    return done


def _rounder(seed: int, step: int, last: bool):
    kept = KEPT if last else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[str | None, int], list[_Unit]] = {}  # up to ``kept`` fractions of a source and size class
        for batch in batches:
            out: list[tuple] = []
            for source, id_, size, text_hash, whole, rows, fraction in zip(*(c.to_pylist() for c in batch.columns)):
                key = (source, id_, size, text_hash)
                if rows > 1:
                    # Rows of a unit are alike: so many of them take one more, and one row keeps the rest.
                    more = math.floor(rows * fraction)
                    rest = rows * fraction - more
                    out.append((*key, whole + 1, more, None))
                    out.append((*key, whole, rows - more - 1, None))
                    fraction = rest
                unit = _Unit(key, whole, fraction)
                if size == 0 or _is_whole(fraction):
                    out.append((*key, whole + round(fraction) * (size > 0), 1, None))
                    continue
                mine = waiting.setdefault((source, size.bit_length()), [])
                mine.append(unit)
                if len(mine) > kept:
                    pair = mine.pop(0), mine.pop()
                    for moved in _transfer(*pair, _uniform(seed, step, pair[0].key, pair[1].key)):
                        if _is_whole(moved.fraction):
                            out.append((*moved.key, moved.whole + round(moved.fraction), 1, None))
                        else:
                            mine.insert(0, moved)
            yield _batch(out)
        rest = [u for units in waiting.values() for u in units]
        if last:
            by_source: dict[str | None, list[_Unit]] = {}
            for unit in rest:
                by_source.setdefault(unit.key[0], []).append(unit)
            for units in by_source.values():
                settled = _settle(units, lambda u: _uniform(seed, step + 1, u.key))
                yield _batch([(*u.key, u.whole + round(u.fraction), 1, None) for u in settled])
        else:
            yield _batch([(*u.key, u.whole, 1, u.fraction) for u in rest])

    return run


_ARROW = pa.schema(
    [("source", pa.string())]
    + [(c, pa.int64()) for c in ("id", "size", "text_hash", "copies", "rows")]
    + [("fraction", pa.float64())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kept = [r for r in rows if r[5] > 0]
    columns = zip(*kept) if kept else [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def mix_units(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_copies: float = MOST_COPIES,
    seed: int = 42,
    units_per_task: int = UNITS_PER_TASK,
) -> DataFrame:
    """Units (source, id, size, text_hash) with ``copies``, the number of ``rows`` that take so many,
    and ``source_size`` and ``target`` of the source.

    One row per source passes through the driver, as many as the mix has weights to give.
    """
    spark = docs.sparkSession
    units = checkpointed(
        docs.select(
            F.col(source_col).cast("string").alias("source"),
            F.col(id_col).cast("long").alias("id"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        )
        .groupBy(*UNIT_KEYS)
        .agg(F.count("*").alias("rows"))
    )
    summary = (
        units.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("rows")).alias("words"), F.count("*").alias("units"))
        .collect()
    )
    sizes = {r.source: r.words for r in summary}
    target = targets(sizes, weights, total_share, most_copies)
    sources = spark.createDataFrame(
        [(s, sizes[s], target[s], target[s] / sizes[s] if sizes[s] else 0.0) for s in sizes],
        "source string, source_size long, target double, expected double",
    )
    same = F.col("u.source").eqNullSafe(F.col("s.source"))
    whole = F.floor("expected").cast("long")
    open_units = (
        units.alias("u")
        .join(F.broadcast(sources.alias("s")), same)
        .select(
            *[f"u.{c}" for c in UNIT_KEYS],
            whole.alias("copies"),
            "rows",
            (F.col("expected") - whole).alias("fraction"),
        )
    )
    tasks, step, settled = partitions_for(sum(r.units for r in summary), units_per_task), 0, []
    while True:
        dealt = open_units.repartition(tasks, *UNIT_KEYS).sortWithinPartitions(*UNIT_KEYS)
        rounded = checkpointed(dealt.mapInArrow(_rounder(seed, step, tasks == 1), ROUNDED))
        settled.append(rounded.where("fraction is null"))
        if tasks == 1:
            break
        open_units = rounded.where("fraction is not null")
        tasks, step = partitions_for(tasks, TREE_FAN_IN), step + 2
    every = settled[0]
    for more in settled[1:]:
        every = every.unionByName(more)
    return (
        every.drop("fraction")
        .alias("u")
        .join(F.broadcast(sources.alias("s")), same)
        .select(*[f"u.{c}" for c in [*UNIT_KEYS, "copies", "rows"]], "source_size", "target")
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The input's rows and columns, each row as often as the mix takes it."""
    units = mix_units(docs, id_col, text_col, source_col, **options)
    plan = units.groupBy(*[F.col(c).alias(f"u_{c}") for c in UNIT_KEYS]).agg(
        F.min("copies").alias("least"),
        F.sum("rows").alias("rows"),
        F.sum(F.col("copies") * F.col("rows")).alias("taken"),
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(
        F.col(source_col).cast("string").alias("k_source"),
        F.col(id_col).cast("long").alias("k_id"),
        word_count(F.col(text_col)).alias("k_size"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k_text_hash"),
        row.alias("row"),
    )
    match = F.lit(True)
    for c in UNIT_KEYS:
        match = match & F.col(f"k_{c}").eqNullSafe(F.col(f"u_{c}"))
    joined = keyed.join(plan, match)
    once = joined.where("rows = 1").select("row", F.col("taken").alias("copies"))
    # A unit's rows are alike but for other columns: the first ones, by those, take one more.
    rank = F.row_number().over(Window.partitionBy(*[f"k_{c}" for c in UNIT_KEYS]).orderBy(F.to_json("row")))
    repeated = (
        joined.where("rows > 1")
        .withColumn("rank", rank)
        .select("row", (F.col("least") + (F.expr("rank <= taken - least * rows")).cast("long")).alias("copies"))
    )
    return (
        once.unionByName(repeated)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("row.*")
    )
