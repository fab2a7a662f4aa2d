import math
import random

from pyspark.sql import functions as F

from relayframe.llm import topk


def brute_force(rows, k, step):
    valid = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in valid]
    out = []
    for n, (q, asked) in enumerate(whole):
        if q % step == 0:
            scores = [(-sum(a * b for a, b in zip(asked, v)), i) for m, (i, v) in enumerate(whole) if m != n and len(v) == len(asked)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def run(spark, rows, k=5, step=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string, dim string, ids string")
    found = topk.top_k(df.repartition(3), F.col("vec_id") % step == 0, k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


def test_matches_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(10)]) for i in range(160)]
    rows += [(200 + i, rows[7][1]) for i in range(8)]  # ties
    rows += [(300, None), (301, [1.0, None]), (305, [float("nan")] * 10), (None, [1.0] * 10), (310, []), (315, [0.5] * 3), (316, [0.25] * 3)]
    rows += [(20, rows[20][1]), (25, [9.0] * 10)]  # repeated ids
    clash = [(*r, None, None, None) for r in rows]
    assert run(spark, clash) == brute_force(rows, 5, 5)
    assert run(spark, [r for r in clash if r[0] == 315]) == []
    assert run(spark, []) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 2.0**22 for _ in range(4)]) for i in range(30)]
    small = [(i, [x / 2.0**10 for x in v]) for i, v in rows]
    for case in (rows[:12], small):
        want = [(q, n, i, max(-(2**63), min(2**63 - 1, s))) for q, n, i, s in brute_force(case, 3, 5)]
        assert run(spark, [(*r, None, None, None) for r in case], k=3) == want


def test_rows_that_take_no_part_do_not_silence_their_id(spark):
    rows = [(50, [float("nan"), 1.0]), (50, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (50, None), (55, [2.0, 1.0]), (55, [2.0, 1.0])]
    got = run(spark, [(*r, None, None, None) for r in rows])
    assert got == brute_force(rows, 5, 5)
    assert [r[2] for r in got if r[0] == 50] == [55, 55, 1, 2]
    assert [r[1:3] for r in got if r[0] == 55 and r[1] == 1] == [(1, 55), (1, 55)]
