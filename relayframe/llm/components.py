"""Connected components of a graph given by edges, by alternating large-star and small-star steps.

Each task first replaces its edges by a spanning forest of them, without a shuffle. If what is left of all
tasks fits ``SMALL_EDGES``, counted, one more pass names the components; else star steps do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayframe.llm.common import partitions_for
from relayframe.session import checkpointed

EDGES_PER_TASK = 100_000
#: A forest of so many edges, some 60 MB of text keys at most, is finished in one task.
SMALL_EDGES = 400_000


def smallest_linked(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest of ``n`` positions that each position is linked to, directly or not."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (label[label] != label).any():
            label = label[label]


def _roots(a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Every node of the edges and the smallest node of its component."""
    every = pa.concat_arrays([a, b]).dictionary_encode()
    order = pc.sort_indices(every.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    at = place[every.indices.to_numpy()]
    label = smallest_linked(len(order), at[: len(a)], at[len(a) :])
    nodes = every.dictionary.take(order)
    return nodes, nodes.take(pa.array(label))


def _by_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star-shaped forests of up to SMALL_EDGES edges at a time."""
    held: list[pa.RecordBatch] = []

    def forest() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        nodes, roots = _roots(*(pa.concat_arrays(c.chunks) for c in table.columns))
        linked = pc.not_equal(nodes, roots)
        return pa.RecordBatch.from_arrays([nodes.filter(linked), roots.filter(linked)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= SMALL_EDGES:
            held = [forest()]
            if held[0].num_rows * 2 > SMALL_EDGES:
                yield held.pop()
    if held:
        yield forest()


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b`` edges to ``node, root``, for every node of an edge; ``root`` is the component's smallest node.

    A step keeps at most one edge per edge, and minima are pre-aggregated per task, so a node with very
    many neighbours stays one row per task until its partition is joined, which AQE may split.
    """
    edges = edges.where("a <> b").select("a", "b")
    edges = checkpointed(edges.mapInArrow(_by_forest, edges.schema))
    n_edges = edges.count()
    if n_edges <= SMALL_EDGES:

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                table = pa.Table.from_batches(held).combine_chunks()
                found = _roots(*(pa.concat_arrays(c.chunks) for c in table.columns))
                yield pa.RecordBatch.from_arrays(list(found), ["node", "root"])

        shape = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).schema
        return edges.coalesce(1).mapInArrow(name, shape)
    return _by_stars(edges.distinct(), n_edges)


def _by_stars(edges: DataFrame, n_edges: int) -> DataFrame:
    before = None
    while True:
        # A small graph is kept in few files, whatever the number of shuffle partitions.
        tasks = partitions_for(before[0] if before else n_edges, EDGES_PER_TASK)
        edges = checkpointed(_small_star(_large_star(edges)).coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour, or itself if smaller."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
