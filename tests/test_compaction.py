import random

import pytest

from relayframe.operators.compaction import compaction_plan, label_chunks

SCHEMA = (
    "topic string, bucket string, partition int, min_offset bigint, max_offset bigint, "
    "size_bytes bigint, n_rows bigint"
)


def one_by_one(chunks, limit):
    """Chunks taken in order, the way the rule is stated."""
    groups, labels = [], []
    for low, high, size, rows in chunks:
        if groups and groups[-1][1] >= high:
            labels.append((low, high, first, True))
            continue
        if groups and groups[-1][2] <= limit:
            last = groups[-1]
            groups[-1] = (last[0], high, last[2] + size, last[3] + rows)
        else:
            groups.append((low, high, size, rows))
            first = high
        labels.append((low, high, first, False))
    return groups, labels


def random_chunks(rng, n, span, sizes):
    found = {}
    for _ in range(n):
        low = rng.randrange(span)
        high = low + rng.choice([0, 1, 3, 9, 30])
        found[(low, high)] = (rng.choice(sizes), high - low + 1)
    return [(low, high, *rest) for (low, high), rest in sorted(found.items())]


CASES = [(1, [1], 4), (2, [1, 2, 7], 10), (3, [0, 5, 50], 20), (4, [3], 10**9), (5, [100], 5)]


@pytest.mark.parametrize(
    "seed, sizes, limit, tile, fan_in",
    [(*case, 10_000, 256) for case in CASES] + [(*case, 12, 3) for case in CASES] + [(*CASES[1], 4, 2)],
)
def test_plan_equals_one_by_one(spark, seed, sizes, limit, tile, fan_in):
    rng = random.Random(seed)
    prefixes = {("t", "b", p): random_chunks(rng, n, 300, sizes) for p, n in enumerate([1, 5, 60, 150])}
    rows = [(*prefix, *chunk) for prefix, chunks in prefixes.items() for chunk in chunks]
    manifest = spark.createDataFrame(rows, SCHEMA)

    expected_labels, expected_plan = [], []
    for prefix, chunks in prefixes.items():
        groups, labels = one_by_one(chunks, limit)
        expected_plan += [(*prefix, *g) for g in groups]
        expected_labels += [(*prefix, *label) for label in labels]

    labels = label_chunks(manifest, limit, tile, fan_in)
    got = labels.select("topic", "bucket", "partition", "min_offset", "max_offset", "group_id", "stale")
    assert sorted(map(tuple, got.collect())) == sorted(expected_labels)
    plan = compaction_plan(manifest, limit, tile, fan_in).drop("n_chunks")
    plan = plan.select("topic", "bucket", "partition", "min_offset", "max_offset", "size_bytes", "n_rows")
    assert sorted(map(tuple, plan.collect())) == sorted(expected_plan)


def test_copies_of_a_chunk_count_once(spark):
    rows = [("t", "b", 0, 0, 9, 5, 10)] * 20 + [("t", "b", 0, 10, 19, 5, 10)]
    plan = compaction_plan(spark.createDataFrame(rows, SCHEMA), limit=100).collect()
    assert [(r["min_offset"], r["max_offset"], r["size_bytes"], r["n_chunks"]) for r in plan] == [(0, 19, 10, 2)]


def test_empty_manifest(spark):
    assert compaction_plan(spark.createDataFrame([], SCHEMA)).count() == 0
