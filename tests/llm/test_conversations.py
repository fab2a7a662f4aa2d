"""Conversation repair next to plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from relayframe.llm import conversations as C
from relayframe.llm import queries

BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        if not text.strip(BLANKS):
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif text.rstrip(BLANKS)[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


def plain(rows):
    """``rows`` in order as (turn, role, text): the digest's values, edits by exhaustive recursion."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    kinds = faults(rows)

    @lru_cache(None)
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in "0a" else []
        to = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[to]
        if inserted < 3:
            cost, text, out = best(i, to, inserted + 1)
            ways.append((cost + 3, "I" + text, (name + ":", *out)))
        if i < len(rows):
            _, role, text = rows[i]
            extra = 3 if kinds[i] == "truncated" else 0
            cost, edits, out = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + edits, out))
            if kinds[i] not in ("blank", "duplicate"):
                cost, edits, out = best(i + 1, to, 0)
                ways.append((cost + 3 + extra, "R" + edits, (f"{name}:{text}", *out)))
                if role[:1] == to or (state == "0" and role[:1] == "s"):
                    cost, edits, out = best(i + 1, role[0], 0)
                    ways.append((cost + extra, "K" + edits, (f"{role}:{text}", *out)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, out = best(0, "0", 0)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damaged(conv, turn, role, text):
    turn_, role, text = (" " if x is None else x for x in (turn, role, text))
    conv_ = " " if conv is None else conv
    kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = "".join(c for c in text if c not in ".!?")
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * (2 if kind == 3 else 1)


def expected(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv].extend(damaged(conv, turn, role, text))
    return {conv: plain(tuple(rows)) for conv, rows in convs.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def random_rows(seed, n_convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(n_convs):
        for _ in range(rng.randint(1, most)):
            turn = rng.choice([None, *range(6)])
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "sys"])
            text = rng.choice(["Yes.", "No!", "cut", " ", "", None, "a.\n", "b? \t", f"{rng.random()}."])
            rows.append((conv if conv else None, turn, role, text))
    return rows


def check(found, table):
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found} == expected(table)


SCHEMA = "conv_id long, turn long, role string, text string, part int, seq int, conv_key string, n long"


def test_query_on_its_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    check(queries.op11_conversation_repair(spark, sf_dir).collect(), table)


@pytest.mark.parametrize("small", [False, True])
def test_nulls_ties_copies_and_segments(spark, tmp_path, monkeypatch, small):
    """``small`` cuts conversations into segments of two rows over several tasks."""
    rows = random_rows(1, 60, 9) + random_rows(2, 1, 40)
    if small:
        monkeypatch.setattr(C, "SEGMENT_ROWS", 2)
    spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA).repartition(3).write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    check(queries.op11_conversation_repair(spark, str(tmp_path)).collect(), rows)


def test_long_conversation_spreads_over_segments(spark, monkeypatch):
    """One conversation of many rows, in segments of 7: the plain edits, row by row."""
    monkeypatch.setattr(C, "SEGMENT_ROWS", 7)
    rng = random.Random(4)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"{i}.") for i in range(150)]
    found = C.reports(C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found] == [plain(tuple(r[1:] for r in rows))]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op11_conversation_repair(spark, str(tmp_path)).collect() == []


def test_blocks_agree_with_plain_edits():
    rng = random.Random(3)
    for _ in range(500):
        symbols = bytes(rng.randrange(9) for _ in range(rng.randint(0, 13)))
        rows, kinds = [], []
        for i, y in enumerate(symbols):
            role = "x" if y == C.GONE else "suax"[y % 4]
            end = " " if y == C.GONE else f"{i}" if y >= C.TRUNCATED else f"{i}."
            rows.append((i, role, end))
            kinds.append(y)
        found, state = C.edits_of(symbols)
        assert "".join(found) + C.tables().last[state] == plain(tuple(rows))[6]


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Well."), (1, 2, "user", "Well.")]
    found = C.repaired_rows(C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert [tuple(r)[4:] for r in found.orderBy("part", "seq", "at").collect()] == [("user", "Hi."), ("assistant", "Well.")]
