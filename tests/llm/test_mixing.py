from collections import defaultdict

import pytest

from relayframe.llm import mixing
from tests.llm.helpers import documents


def test_targets():
    # 150 by 3, 1, 2: a stops at 20; of 130 by 1, 2 the last stops at 80; b takes what is left.
    got = mixing.targets({"a": 10, "b": 50, None: 40}, (3, 1, 2), 1.5, 2)
    assert got == pytest.approx({"a": 20, "b": 50, None: 80})
    assert mixing.targets({}, (1,), 1.5, 2) == {}
    assert mixing.targets({"a": 0}, (1,), 1.5, 2) == {"a": 0}


def mixed(df, **options):
    totals = defaultdict(int)
    units = mixing.mix_units(df, **options).collect()
    for u in units:
        assert 0 <= u.copies <= 2
        totals[u.source] += u.copies * u.rows * u.size
    return units, totals


def test_sources_come_near_their_targets(spark):
    texts = ["w " * (1 + i % 37) for i in range(900)]
    sources = [("hot", "b", "c", None)[min(3, i % 6 // 2 if i % 6 else 0)] for i in range(900)]
    docs = documents(spark, texts, sources).repartition(5)
    units, totals = mixed(docs, units_per_task=40)
    targets = {u.source: u.target for u in units}
    assert set(targets) == set(sources)
    for s, t in targets.items():
        assert abs(totals[s] - t) <= 2
    again, _ = mixed(docs.repartition(2), units_per_task=40)
    assert sorted(map(repr, units)) == sorted(map(repr, again))


def test_long_rows_leave_nothing_over(spark):
    """Sources of few rows, one of them a fifth of all words: the smallest rows make up for it."""
    sizes = [900, 400, 400, 300, 250, *range(60, 220, 8), *range(3, 23)]
    texts = ["w " * n for n in sizes] * 4
    sources = [f"s{i // len(sizes)}" for i in range(len(texts))]
    for seed in range(4):
        units, totals = mixed(documents(spark, texts, sources).repartition(3), seed=seed)
        for u in units:
            assert abs(totals[u.source] - u.target) <= 3, (seed, u.source)


def test_settling_keeps_words_and_expectation():
    units = [mixing._Unit(("s", i, n, 0), 0, 0.3) for i, n in enumerate(range(30, 0, -1))]
    words, takes, trials = sum(u.key[2] * u.fraction for u in units), [0.0] * 10, 2000
    for trial in range(trials):
        settled = mixing._settle(units, lambda u: mixing._uniform(trial, 0, u.key))
        assert len(settled) == len(units) and all(u.fraction in (0.0, 1.0) for u in settled)
        assert abs(sum(u.key[2] * u.fraction for u in settled) - words) <= 3
        for u in settled:
            if u.key[1] < len(takes):
                takes[u.key[1]] += u.fraction / trials
    assert takes == pytest.approx([0.3] * len(takes), abs=0.04)
    # A row larger than all others: the end that leaves less over.
    alone = mixing._settle([mixing._Unit(("s", 0, 100, 0), 0, 0.1), mixing._Unit(("s", 1, 2, 0), 0, 0.5)], lambda u: 0.0)
    assert alone[0].fraction == 0.0


def test_repeated_rows_nulls_and_the_stage(spark):
    docs = documents(spark, ["a b c"] * 50 + [None, "", "d e", "f"], ids=[1] * 50 + [2, 3, None, 5], sources=["s"] * 52 + ["t"] * 2)
    units, totals = mixed(docs)
    assert sum(u.rows for u in units) == 54
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.source] += len((r.text or "").split())
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in totals.items() if n}
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_expectation_is_kept():
    a, b = mixing._Unit(("s", 1, 3, 0), 0, 0.4), mixing._Unit(("s", 2, 5, 0), 0, 0.7)
    moved = [mixing._transfer(a, b, (i + 0.5) / 1000) for i in range(1000)]
    for x, y in moved:
        assert 3 * x.fraction + 5 * y.fraction == pytest.approx(3 * 0.4 + 5 * 0.7)
        assert mixing._is_whole(x.fraction) or mixing._is_whole(y.fraction)
    assert sum(x.fraction for x, _ in moved) / 1000 == pytest.approx(0.4, abs=0.01)
