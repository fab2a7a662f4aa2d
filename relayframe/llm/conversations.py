"""Conversation structure repair by block tables of normalised cost vectors.

A conversation should read ``(system)? (user assistant)+``, or be empty. Its rows are symbols: the role's
initial, whether the text is cut off, or that the row has to go (a blank text, a copy of an earlier row).
Reading backward, four costs, one for each state of the pattern, say what the rest costs at best; with
them goes the order of the four texts of edits that reach it, so that of equal costs the edits that come
first in ASCII win. Costs less their least, together with that order, take few values. So a table, built
once for each worker from the edit costs, maps each such vector and each block of ``BLOCK`` symbols to the
vector before the block and the states the block leads to. Blocks are passed by lookup from the end; then
each block is expanded backward on its own, from the vector behind it, to get its edits.

A conversation's rows are dealt by range of (conversation, turn, role, beginning of the text) and cut into
segments of bounded size, so a very long conversation spreads over tasks. Its segments are summarised for
every possible vector; the summaries, a few hundred bytes each, are chained, and all segments are then
expanded at once. Equal rows of one turn are one row with a number.

Defined results: null roles and texts count as one space, a null conversation id is one conversation, null
turns come first. Rows of one turn are taken by role, then by text. Repeated rows are copies that have to
go. An empty table has no conversations. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayframe.session import checkpointed, lookup_join

BLANKS = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
BLOCK = 4
SEGMENT_ROWS = 4_096
SEGMENT_CHARS = 1 << 20
#: Characters of the text that deal rows of one turn and role over tasks.
RANGE_CHARS = 24

# States: nothing read, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
INITIALS = "sua"
# Symbols: an initial or any other (0-3), the same cut off (4-7), a row that has to go, no row.
OTHER, TRUNCATED, GONE, NONE = 3, 4, 8, 9
SYMBOLS = 10
_KEEPS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}


class Edit(NamedTuple):
    """What happens to a row in a state: rows inserted before it, then its own edit."""

    cost: int
    text: tuple
    edits: str
    state: int


def _with_inserts(best: list[Edit | None]) -> list[Edit]:
    """Allows rows inserted before each of four ways to go on."""
    for _ in range(STATES):
        for q in range(STATES):
            to = ASSISTANT if q == USER else USER
            if best[to] is not None:
                found = Edit(best[to].cost + INSERT, ("I", *best[to].text), "I" + best[to].edits, best[to].state)
                if best[q] is None or found[:2] < best[q][:2]:
                    best[q] = found
    return best


def _normalised(best: list[Edit]) -> tuple:
    least = min(b.cost for b in best)
    order = sorted({b.text for b in best})
    return tuple(b.cost - least for b in best), tuple(order.index(b.text) for b in best)


def _step(vector: tuple, symbol: int) -> list[Edit]:
    """The best edits of one row, for each state before it, given the vector behind it."""
    costs, ranks = vector
    if symbol == NONE:
        return [Edit(costs[q], (ranks[q],), "", q) for q in range(STATES)]
    extra = CUT_OFF if TRUNCATED <= symbol < GONE else 0
    best = []
    for q in range(STATES):
        ways = [(DELETE, "D", q)]
        if symbol != GONE:
            ways.append((REROLE + extra, "R", ASSISTANT if q == USER else USER))
            if (q, symbol % TRUNCATED) in _KEEPS:
                ways.append((extra, "K", _KEEPS[q, symbol % TRUNCATED]))
        best.append(min(Edit(cost + costs[to], (edit, ranks[to]), edit, to) for cost, edit, to in ways))
    return _with_inserts(best)


class Tables(NamedTuple):
    """Vector 0 stands behind the last row. ``before`` and ``leads`` are indexed by vector and block."""

    steps: list[list[list[Edit]]]
    step_before: np.ndarray
    before: np.ndarray
    leads: np.ndarray
    #: Edits after the last row, by state.
    last: list[str]


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    end = _with_inserts([Edit(0, (), "", START), None, None, Edit(0, (), "", ASSISTANT)])
    vectors, steps = [_normalised(end)], []
    number = {vectors[0]: 0}
    for vector in vectors:  # grows while it is read
        steps.append([_step(vector, symbol) for symbol in range(SYMBOLS)])
        for best in steps[-1]:
            if number.setdefault(_normalised(best), len(vectors)) == len(vectors):
                vectors.append(_normalised(best))
    step_before = np.array([[number[_normalised(best)] for best in row] for row in steps])
    step_leads = np.array([[[b.state for b in best] for best in row] for row in steps])
    before, leads = step_before, step_leads
    for _ in range(BLOCK - 1):  # one more symbol in front
        first = np.arange(SYMBOLS)[None, :, None]
        leads = np.take_along_axis(leads[:, None, :, :], step_leads[before[:, None, :], first], axis=3)
        before = step_before[before[:, None, :], first]
        before, leads = before.reshape(len(vectors), -1), leads.reshape(len(vectors), -1, STATES)
    return Tables(steps, step_before, before, leads, [b.edits for b in end])


def blocks_of(symbols: bytes) -> list[int]:
    """Numbers of the blocks of a row of symbols, the last one filled up with no rows."""
    held = np.frombuffer(symbols, np.uint8)
    held = np.concatenate([held, np.full(-len(held) % BLOCK, NONE, np.uint8)]).astype(np.int64)
    return (held.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()


def summary(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each vector behind a segment: the vector before it, and where it leads from each state."""
    t = tables()
    vector = np.arange(len(t.steps))
    leads = np.tile(np.arange(STATES), (len(vector), 1))
    for block in reversed(blocks_of(symbols)):
        leads = np.take_along_axis(leads, t.leads[vector, block], axis=1)
        vector = t.before[vector, block]
    return vector, leads


def edits_of(symbols: bytes, behind: int = 0, state: int = START) -> tuple[list[str], int]:
    """The edits at each row, rows inserted before it first, and the state behind the segment."""
    t = tables()
    vectors = [behind]
    blocks = blocks_of(symbols)
    for block in reversed(blocks):
        vectors.append(t.before[vectors[-1], block])
    found = []
    for i, vector in zip(range(0, len(symbols), BLOCK), vectors[-2::-1]):
        inside = symbols[i : i + BLOCK]
        ways = []
        for symbol in reversed(inside):
            ways.append(t.steps[vector][symbol])
            vector = t.step_before[vector, symbol]
        for way in reversed(ways):
            found.append(way[state].edits)
            state = way[state].state
    return found, state


# -- segments ----------------------------------------------------------------------------------------

_KEYS = ["conv_key", "part", "seq"]
_SEGMENT = (
    "conv_key string, part int, seq int, is_open boolean, turns array<long>, roles array<string>, "
    "texts array<string>, counts array<long>, symbols binary"
)


def _key(conv: Column) -> Column:
    return F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string")))


def conv_id(dtype: str = "long") -> Column:
    return F.when(F.col("conv_key") != "", F.expr("substring(conv_key, 2)")).cast(dtype).alias("conv_id")


def segments(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows in order, in segments of bounded size. ``is_open``: the conversation may go on outside of it."""
    space = F.lit(" ")
    plain = rows.select(
        _key(F.col(conv_col)).alias("conv_key"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), space).alias("text"),
    )
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    counted = (
        plain.groupBy("conv_key", "turn", "role", "text")
        .agg(F.count("*").alias("n"))
        .withColumn("end", end)
        .withColumn("digest", F.sha2("text", 256))
    )
    again = (
        counted.where("end <> ''")
        .groupBy("conv_key", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
        .where("turns > 1")
        .select("conv_key", "role", "digest", "first")
    )
    named = lookup_join(counted, checkpointed(again), ["conv_key", "role", "digest"])
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    initial = F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))
    symbol = F.when((F.col("end") == "") | later, GONE).otherwise(
        F.when((F.col("role") == "") | (initial == 0), OTHER).otherwise(initial - 1)
        + F.when(F.col("end").isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_key", "turn", "role"]
    dealt = (
        named.select(*order, "text", "n", symbol.cast("int").alias("symbol"))
        .repartitionByRange(tasks, *order, F.left("text", F.lit(RANGE_CHARS)))
        .sortWithinPartitions(*order, "text")
    )
    return checkpointed(dealt.mapInArrow(_cut, _SEGMENT))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    schema = pa.schema(
        [("conv_key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("is_open", pa.bool_())]
        + [("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
        + [("counts", pa.list_(pa.int64())), ("symbols", pa.binary())]
    )
    held: list[tuple] = []
    chars, seq, is_open, key = 0, 0, True, None

    def segment(open_end: bool) -> tuple:
        turns, roles, texts, counts, symbols = zip(*held)
        return (key, part, seq, is_open or open_end, turns, roles, texts, counts, bytes(symbols))

    done = []
    for batch in batches:
        for conv, turn, role, text, n, symbol in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (conv != key or len(held) >= SEGMENT_ROWS or chars >= SEGMENT_CHARS):
                done.append(segment(conv == key))
                # The first conversation of a task may have begun in the task before.
                is_open = conv == key
                held, chars, seq = [], 0, seq + 1
            key = conv
            held.append((turn, role, text, n, symbol))
            chars += len(text)
        if done:
            yield _batch(done, schema)
            done = []
    if held:
        yield _batch([segment(True)], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _chain(open_segments: DataFrame) -> DataFrame:
    """For segments of conversations that go on: the vector behind, the state, turn and initial before."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for symbols in batch.column(3).to_pylist():
                vector, leads = summary(symbols)
                found.append((vector.astype("<u2").tobytes(), leads.astype(np.uint8).tobytes()))
            columns = [*batch.columns[:3], *(pa.array(c, pa.binary()) for c in zip(*found)), *batch.columns[4:]]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [*_KEYS, "vectors", "leads", "turn", "initial"]
    small = open_segments.select(
        *_KEYS, "symbols", F.element_at("turns", -1).alias("turn"), F.left(F.element_at("roles", -1), F.lit(1)).alias("initial")
    ).mapInArrow(
        summarise, "conv_key string, part int, seq int, vectors binary, leads binary, turn long, initial string"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for _, parts in groupby(rows, key=lambda row: row[0]):
            found, vector = [], 0
            for key, part, seq, vectors, leads, turn, initial in parts:  # from the last to the first
                found.append((key, part, seq, vector, leads[vector * STATES : (vector + 1) * STATES], turn, initial))
                vector = int(np.frombuffer(vectors, "<u2")[vector])
            state, before, linked = START, (None, None), []
            for i, (key, part, seq, vector, leads, turn, initial) in enumerate(reversed(found)):
                linked.append((key, part, seq, vector, state, i > 0, *before, i == len(found) - 1))
                state, before = leads[state], (turn, initial)
            yield _batch(linked, schema)

    schema = pa.schema(
        [("conv_key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("behind", pa.int32())]
        + [("state", pa.int32()), ("goes_on", pa.bool_()), ("turn_before", pa.int64())]
        + [("initial_before", pa.string()), ("is_last", pa.bool_())]
    )
    ordered = small.repartition("conv_key").sortWithinPartitions("conv_key", F.desc("part"), F.desc("seq"))
    return ordered.mapInArrow(
        link,
        "conv_key string, part int, seq int, behind int, state int, goes_on boolean, turn_before long, "
        "initial_before string, is_last boolean",
    )


_REPAIRED = (
    "conv_key string, part int, seq int, is_open boolean, blank long, duplicate long, truncated long, illegal long, "
    "cost long, distinct_turns long, min_turn long, max_turn long, audit string, "
    "repaired array<struct<role string, text string>>"
)


def repair(rows: DataFrame, **columns: str) -> DataFrame:
    """Segments with their faults, their edits (``audit``) and their repaired rows, in order.

    Segments of one conversation follow each other by ``part`` and ``seq``; most are whole conversations.
    """
    cut = segments(rows, **columns)
    chained = checkpointed(_chain(cut.where("is_open")))
    return lookup_join(cut, chained, _KEYS).mapInArrow(_finish, _REPAIRED)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = tables()
    row_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    schema = pa.schema(
        [("conv_key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("is_open", pa.bool_())]
        + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
        + [(c, pa.int64()) for c in ("distinct_turns", "min_turn", "max_turn")]
        + [("audit", pa.string()), ("repaired", row_type)]
    )
    for batch in batches:
        found = []
        for s in batch.to_pylist():
            symbols, counts, texts, roles = s["symbols"], s["counts"], s["texts"], s["roles"]
            state = s["state"] or START
            edits, after = edits_of(symbols, s["behind"] or 0, state)
            audit = "".join(e + "D" * (n - 1) for e, n in zip(edits, counts))
            last = t.last[after] if s["is_last"] is not False else ""
            repaired = []
            for edit, role, text in zip([*edits, last], [*roles, None], [*texts, None]):
                for e in edit:
                    if e == "D":
                        continue
                    if e == "K":
                        state = _KEEPS[state, INITIALS.index(role[0])]
                    else:
                        state = ASSISTANT if state == USER else USER
                        role_now = "assistant" if state == ASSISTANT else "user"
                    repaired.append((role if e == "K" else role_now, "" if e == "I" else text))
            audit += last
            blank = sum(n for n, x in zip(counts, texts) if not x.strip(BLANKS))
            gone = sum(n for n, y in zip(counts, symbols) if y == GONE)
            cut_off = [i for i, y in enumerate(symbols) if TRUNCATED <= y < GONE]
            kept_cut_off = sum(edits[i][-1] != "D" for i in cut_off)
            cost = DELETE * audit.count("D") + REROLE * (audit.count("R") + audit.count("I")) + CUT_OFF * kept_cut_off
            initials = [r[:1] for r in roles]
            if s["goes_on"]:
                initials.insert(0, s["initial_before"])
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
            turns = {x for x in s["turns"] if x is not None}
            fresh = turns - {s["turn_before"]}
            found.append(
                (s["conv_key"], s["part"], s["seq"], s["is_open"], blank)
                + (gone - blank + sum(n - 1 for n, y in zip(counts, symbols) if y != GONE), len(cut_off))
                + (illegal + sum(n - 1 for n in counts), cost)
                + (len(fresh), min(turns, default=None), max(turns, default=None), audit)
                + ([{"role": r, "text": x} for r, x in repaired],)
            )
        if found:
            yield _batch(found, schema)


# -- per conversation --------------------------------------------------------------------------------


def repaired_rows(repaired: DataFrame, dtype: str = "long") -> DataFrame:
    """One row for each row of the repaired conversations, in the order of ``part, seq, at``."""
    return repaired.select(conv_id(dtype), "part", "seq", F.posexplode("repaired").alias("at", "row")).select(
        "conv_id", "part", "seq", "at", "row.*"
    )


def reports(repaired: DataFrame, dtype: str = "long") -> DataFrame:
    """One row for each conversation: its faults, the edits, and the SHA-256 of its repaired rows.

    Whole conversations are reported where they are. Others are put together from their segments, in
    order and segment by segment: a digest reads its text from the first to the last byte.
    """
    body = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    turns = ["min_turn", "max_turn", "distinct_turns"]
    pieces = repaired.select(*_KEYS, "is_open", *turns, *counts, "audit", F.size("repaired").alias("n_rows"), body.alias("body"))
    pieces = checkpointed(pieces)
    whole = pieces.where("not is_open").select("conv_key", *turns, *counts, "audit", F.sha2("body", 256).alias("repaired_sha256"))
    opened = pieces.where("is_open")
    sums = opened.groupBy("conv_key").agg(
        F.min("min_turn").alias("min_turn"), F.max("max_turn").alias("max_turn"), F.sum("distinct_turns").alias("distinct_turns"),
        *[F.sum(c).alias(c) for c in counts],
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*batch.columns))
        for key, parts in groupby(rows, key=lambda row: row[0].as_py()):
            sha, audit, fresh = hashlib.sha256(), [], True
            for _, piece_audit, n_rows, piece in parts:
                audit.append(piece_audit.as_py())
                if n_rows.as_py():
                    sha.update((b"" if fresh else b"\n") + piece.as_py().encode())
                    fresh = False
            columns = [key, "".join(audit), sha.hexdigest()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.string()) for c in columns], ["conv_key", "audit", "repaired_sha256"]
            )

    ordered = opened.select(*_KEYS, "audit", "n_rows", "body").repartition("conv_key").sortWithinPartitions(*_KEYS)
    digests = ordered.select("conv_key", "audit", "n_rows", "body").mapInArrow(
        digest, "conv_key string, audit string, repaired_sha256 string"
    )
    gaps = F.coalesce(F.expr("max_turn - min_turn + 1 - distinct_turns"), F.lit(0).cast("long")).alias("gaps")
    every = whole.unionByName(sums.join(digests, "conv_key").select(*whole.columns))
    return every.select(conv_id(dtype), gaps, *counts, "audit", "repaired_sha256")
