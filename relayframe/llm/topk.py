"""Exact top-k inner products, with bounds from segment means and deviations, coarse to fine.

A vector's segments have a mean m and a deviation s. The squared distance of two vectors is at least
the sum of length * ((m - m')**2 + (s - s')**2) over segments, so with their norms their inner product
is at most the sum of length * (m * m' + s * s'). Blocks of queries meet blocks of all rows: bounds of a
few long segments drop most pairs or none, bounds of shorter ones more, and exact products are taken of
what is left. The score to beat is the query's k-th best in the task so far.

Components are whole numbers, floor(256 * x), so scores are exact: products beyond the 53 bits of a
double are taken with Python's integers.

Defined results: a vector that is null or holds a null or a component that is not finite takes no part,
nor does a row with a null id. Vectors of different lengths are not compared. A query's candidates are all
rows but its own row, also others of its id; every row that asks is a query of its own, so an id that asks
in several rows has the ranks of each. Scores beyond 64 bits are held at the bounds. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relayframe.llm.common import partitions_for
from relayframe.session import checkpointed, lookup_join

SCALE = 256
QUERY_BLOCK = 512
ROW_BLOCK = 8_192
PLACE_BITS = 14  # a block holds fewer than twice ROW_BLOCK rows
SEGMENTS = (4, 16)
EXACT = 2.0**53


def _quantised(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors of the valid rows, by length."""
    column = column.cast(pa.list_(pa.float64()))
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        vectors = values[starts[rows][:, None] + np.arange(n)]
        finite = np.isfinite(vectors).all(axis=1)
        yield rows[finite], np.floor(SCALE * vectors[finite])


ASKED = "row long, id long, dim int, vector binary"
BLOCK = "block long, dim int, rows binary, ids binary, asks binary, vectors binary"


def _packed(parts: list, block: int) -> pa.RecordBatch:
    """One row of ``BLOCK`` of (rows, ids, asks, vectors) parts; rows None: numbered by their place."""
    ids, asks, vectors = (np.concatenate(x) for x in zip(*(p[1:] for p in parts)))
    if parts[0][0] is None:
        rows = np.int64(block) << PLACE_BITS | np.arange(len(ids))
    else:
        rows = np.concatenate([p[0] for p in parts])
    columns = [pa.array([block], pa.int64()), pa.array([vectors.shape[1]], pa.int32())]
    columns += [pa.array([x.tobytes()], pa.binary()) for x in (rows, ids, asks, vectors)]
    return pa.RecordBatch.from_arrays(columns, ["block", "dim", "rows", "ids", "asks", "vectors"])


def _row_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs rows of ``id, vector, asks`` into blocks; a row's number is its block's and its place in it."""
    block = TaskContext.get().partitionId() << 24
    held: dict[int, list] = {}
    for batch in batches:
        ids, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        for places, vectors in _quantised(batch.column(1)):
            for at in range(0, len(places), ROW_BLOCK):
                mine, dim = places[at : at + ROW_BLOCK], vectors.shape[1]
                parts = held.setdefault(dim, [])
                parts.append((None, ids[mine], asks[mine].astype(bool), vectors[at : at + ROW_BLOCK]))
                if sum(len(p[1]) for p in parts) >= ROW_BLOCK:
                    block += 1
                    yield _packed(held.pop(dim), block)
    for parts in held.values():
        block += 1
        yield _packed(parts, block)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``BLOCK`` that ask, one by one."""
    for batch in batches:
        for _, dim, rows, ids, asks, vectors in zip(*batch.columns):
            n = dim.as_py()
            some = np.flatnonzero(np.frombuffer(asks.as_py(), bool))
            rows, ids = (np.frombuffer(x.as_py(), np.int64)[some] for x in (rows, ids))
            vectors = np.frombuffer(vectors.as_py()).reshape(-1, n)[some]
            columns = [pa.array(rows), pa.array(ids), pa.array([n] * len(some), pa.int32())]
            columns.append(pa.array([v.tobytes() for v in vectors], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "dim", "vector"])


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs rows of ``ASKED`` into blocks."""
    block = TaskContext.get().partitionId() << 24
    held: dict[int, list] = {}
    for batch in batches:
        for row, id_, dim, vector in zip(*(c.to_pylist() for c in batch.columns)):
            parts = held.setdefault(dim, [])
            parts.append((np.array([row]), np.array([id_]), np.array([True]), np.frombuffer(vector).reshape(1, -1)))
            if len(parts) == QUERY_BLOCK:
                block += 1
                yield _packed(held.pop(dim), block)
    for parts in held.values():
        block += 1
        yield _packed(parts, block)


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of segments, weighted so that their product bounds the inner product."""
    n = -(-vectors.shape[1] // segments)
    padded = np.pad(vectors, ((0, 0), (0, n * segments - vectors.shape[1])))
    parts = padded.reshape(len(vectors), segments, n)
    return np.concatenate([parts.mean(axis=2), parts.std(axis=2)], axis=1) * np.sqrt(n)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    most = queries.shape[1] * np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0)
    if most < EXACT:
        return queries @ rows.T
    whole = [[[int(x) for x in v] for v in m] for m in (queries, rows)]
    return np.array([[sum(a * b for a, b in zip(q, r)) for r in whole[1]] for q in whole[0]], object).reshape(
        len(queries), len(rows)
    )


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    order = sorted(places, key=lambda i: (-scores[i], ids[i]))
    return np.array(order[:k], np.int64)


def block_top_k(
    asked: np.ndarray, queries: np.ndarray, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, beat: np.ndarray
) -> Iterator[tuple[int, int, int]]:
    """(place of the query, id, score) of rows that may be among a query's k best. ``asked`` and ``numbers``
    are the row numbers of both sides. ``beat`` holds the k-th best score of each query so far and is raised."""
    slack = 1e-9 * (1 + np.linalg.norm(queries, axis=1).max() * np.linalg.norm(rows, axis=1).max())
    bound = segment_statistics(queries, SEGMENTS[0]) @ segment_statistics(rows, SEGMENTS[0]).T + slack
    own = asked[:, None] == numbers[None, :]
    bound[own] = -np.inf
    # The rows of the highest bounds give a first score to beat.
    if len(ids) > 4 * k:
        first = np.argpartition(-bound, 4 * k, axis=1)[:, : 4 * k]
        for q in range(len(queries)):
            mine = first[q][bound[q, first[q]] > -np.inf]
            if len(mine) >= k:
                scores = _products(queries[q : q + 1], rows[mine])[0]
                beat[q] = max(beat[q], float(np.sort(scores)[-k]))
    # Scores this large may round down as doubles: keep what a rounded comparison could drop.
    limit = np.where(np.abs(beat) < EXACT, beat, beat - np.abs(beat) * 1e-12)
    alive = (bound >= limit[:, None]) & ~own
    for segments in SEGMENTS[1:]:
        some = np.flatnonzero(alive.any(axis=0))
        finer = segment_statistics(queries, segments) @ segment_statistics(rows[some], segments).T + slack
        alive[:, some] &= finer >= limit[:, None]
    some = np.flatnonzero(alive.any(axis=0))
    scores = _products(queries, rows[some])
    for q in range(len(queries)):
        mine = np.flatnonzero(alive[q, some])
        for i in mine[_best(scores[q, mine], ids[some[mine]], k)]:
            yield q, int(ids[some[i]]), max(-(2**63), min(2**63 - 1, int(scores[q, i])))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its k highest inner products among all other rows."""
    spark = vectors.sparkSession
    asks = F.coalesce(is_query, F.lit(False)).alias("asks")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), asks)
    rows = rows.where("id is not null")
    tasks = partitions_for(rows.count(), ROW_BLOCK)
    blocks = checkpointed(rows.repartition(tasks).mapInArrow(_row_blocks, BLOCK))
    asked = checkpointed(blocks.mapInArrow(_asked, ASKED))
    asked = asked.repartition(partitions_for(asked.count(), QUERY_BLOCK))
    queries = checkpointed(asked.mapInArrow(_query_blocks, BLOCK)).select(
        F.col("block").alias("asked"), "dim", F.col("rows").alias("query_rows"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")
    )
    # Every block of queries meets every block of rows of its length; the list of blocks is two numbers each.
    places = blocks.select("block", "dim")
    pairs = lookup_join(queries, places, ["dim"], "inner")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), places.count())
    pairs = (
        pairs.drop("dim")
        .repartition(tasks, "block", "asked")
        .join(blocks, "block")
        .select("asked", "query_rows", "query_ids", "queries", "dim", "rows", "ids", "vectors")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beat: dict[int, np.ndarray] = {}
        for batch in batches:
            for asked, query_rows, query_ids, queries, dim, rows, ids, vectors in zip(*batch.columns):
                qr, qi, cr, ci = (np.frombuffer(x.as_py(), np.int64) for x in (query_rows, query_ids, rows, ids))
                q, c = (np.frombuffer(x.as_py()).reshape(-1, dim.as_py()) for x in (queries, vectors))
                best = beat.setdefault(asked.as_py(), np.full(len(qr), -np.inf))
                found = [(qr[n], qi[n], i, s) for n, i, s in block_top_k(qr, q, cr, ci, c, k, best)]
                columns = zip(*found) if found else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in columns], ["query_row", "query_id", "vec_id", "score"]
                )

    found = pairs.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
