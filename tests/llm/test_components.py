"""Components on every path next to a plain search."""

import random

import pytest

from relayframe.llm import components


@pytest.mark.parametrize("small", [400_000, 50, 3])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_components(spark, monkeypatch, small, kind):
    """``small``: one task for the whole forest; or star steps, after forests of a part of the edges."""
    monkeypatch.setattr(components, "SMALL_EDGES", small)
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400, 400 + i) for i in range(1, 40)]
    edges += [(500 + i, 501 + i) for i in range(30)]
    named = (lambda x: f"k{x:04}") if kind == "string" else int
    edges = [(named(a), named(b)) for a, b in edges]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, f"a {kind}, b {kind}").repartition(5)
    found = dict(map(tuple, components.connected_components(df).collect()))
    assert found == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
