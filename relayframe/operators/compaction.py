"""Which small chunks to merge.

Chunks of a prefix are taken in offset order. A chunk that ends at or before an earlier end is
stale. Any other is merged into the group before it while that group's size is within the limit,
and opens a new group otherwise. Whether a chunk opens a group depends on all chunks before it, so
this is a scan. A prefix of a usual size is scanned by one task. The chunks of larger ones are cut
into tiles of equal size, and the scan is made parallel the usual way: each tile is summarised as a
function from the group open before it to the group open after it, summaries are composed in a
tree, and once a tile's incoming group is known its chunks are labelled independently of the others.

A summary needs one entry per chunk at which the incoming group could first outgrow the limit.
Those lie within the first ``limit`` bytes of a tile, so summaries stay small however large the
prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relayframe.schemas import PREFIX
from relayframe.session import checkpointed, lookup_join

# Fixed value: a chunk up to this compressed size takes in the next one.
MERGE_LIMIT = 5 * 1024 * 1024
# Chunks of one prefix that one task scans.
TILE_CHUNKS = 50_000
# Summaries composed by one task.
FAN_IN = 256
# Stands for no group or no offset yet. Nulls would turn whole numbers into floats in pandas.
NONE = -1

_PREFIX_DDL = "topic string, bucket string, partition int"
_SUMMARY_DDL = (
    f"{_PREFIX_DDL}, node bigint, breaks array<bigint>, exit_size array<bigint>, "
    "exit_group array<bigint>, exit_open array<boolean>, total bigint, first_group bigint"
)
_ENTRY_DDL = f"{_PREFIX_DDL}, node bigint, open_size bigint, open_group bigint, is_open boolean"
_LABEL_DDL = (
    f"{_PREFIX_DDL}, min_offset bigint, max_offset bigint, size_bytes bigint, n_rows bigint, "
    "group_id bigint, stale boolean"
)


def _summariser(limit: int):
    """Per tile: the group left open after it, for every place the incoming group may close."""

    def summarise(key, pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["min_offset", "max_offset"], kind="stable")
        ends = pdf["max_offset"].to_numpy()
        seen = pdf["seen_max"].to_numpy()
        before = np.maximum.accumulate(np.concatenate(([seen[0]], ends[:-1])))
        kept = pdf[ends > before]
        sizes = kept["size_bytes"].to_numpy(dtype="int64")
        ids = kept["max_offset"].to_numpy(dtype="int64")
        n = len(sizes)
        sums = np.cumsum(sizes)
        base = sums - sizes
        closes = np.searchsorted(sums, base + limit, side="right")
        # after[k]: (size, id, open) left by chunks k.. when no group is open before them;
        # an id of NONE stands for whichever group closed last.
        after = [(0, NONE, False)] * (n + 1)
        for k in range(n - 1, -1, -1):
            close = closes[k]
            if close >= n:
                after[k] = (int(sums[-1] - base[k]), int(ids[k]), True)
            else:
                later = after[close + 1]
                after[k] = (0, int(ids[k]), False) if later[1] == NONE else later
        n_breaks = min(n, int(np.searchsorted(sums, limit, side="right")) + 1)
        exits = after[1 : n_breaks + 1]
        row = dict(zip(["topic", "bucket", "partition", "node"], key))
        row.update(
            breaks=sums[:n_breaks].tolist(),
            exit_size=[e[0] for e in exits],
            exit_group=[e[1] for e in exits],
            exit_open=[e[2] for e in exits],
            total=int(sums[-1]) if n else 0,
            first_group=int(ids[0]) if n else NONE,
        )
        return pd.DataFrame([row])

    return summarise


def _passer(limit: int):
    """How a summary changes the open group ``(size, id, open)``."""
    from bisect import bisect_right

    def enter(node, state):
        size, group, is_open = state
        return (size, group) if is_open else (0, node.first_group)

    def go(node, state):
        if not len(node.breaks):
            return state
        size, group = enter(node, state)
        at = bisect_right(node.breaks, limit - size)
        if at == len(node.breaks):
            return (size + node.total, group, True)
        left = node.exit_group[at]
        return (node.exit_size[at], group if left == NONE else left, node.exit_open[at])

    return go


def _node_reader():
    """Summary rows of one group in order, with plain Python values."""
    from types import SimpleNamespace

    def nodes_of(pdf):
        for r in pdf.sort_values("node").to_dict("records"):
            arrays = {k: r[k].tolist() for k in ["breaks", "exit_size", "exit_group", "exit_open"]}
            whole = {k: int(r[k]) for k in ["node", "total", "first_group"]}
            yield SimpleNamespace(**arrays, **whole)

    return nodes_of


def _composer(limit: int, go, nodes_of):
    """Summary of consecutive nodes as one node."""

    def compose(key, pdf):
        import pandas as pd

        nodes = [n for n in nodes_of(pdf) if n.breaks]
        breaks, exits, total = [], [], 0
        for i, node in enumerate(nodes):
            later = nodes[i + 1 :]
            reached = {}
            for j, cut in enumerate(node.breaks):
                if breaks and breaks[-1] > limit:
                    break
                state = (node.exit_size[j], node.exit_group[j], node.exit_open[j])
                if state not in reached:
                    end = state
                    for n in later:
                        end = go(n, end)
                    reached[state] = end
                breaks.append(total + cut)
                exits.append(reached[state])
            total += node.total
        row = dict(zip(["topic", "bucket", "partition", "node"], key))
        row.update(
            breaks=breaks,
            exit_size=[e[0] for e in exits],
            exit_group=[e[1] for e in exits],
            exit_open=[e[2] for e in exits],
            total=total,
            first_group=nodes[0].first_group if nodes else NONE,
        )
        return pd.DataFrame([row])

    return compose


def _chainer(go, nodes_of):
    """The group open before each node, given the one open before the first."""

    def chain(key, pdf):
        import pandas as pd

        first = pdf.iloc[0]
        state = (int(first["open_size"]), int(first["open_group"]), bool(first["is_open"]))
        rows = []
        for node in nodes_of(pdf):
            rows.append((*key[:3], node.node, *state))
            state = go(node, state)
        return pd.DataFrame(
            rows, columns=["topic", "bucket", "partition", "node", "open_size", "open_group", "is_open"]
        )

    return chain


def _labeller(limit: int):
    """Stream over sorted chunks, giving each its group; only the open group is held."""

    identity = ["topic", "bucket", "partition"]

    def label(batches):
        tile = None
        for pdf in batches:
            starts = zip(*[pdf[c].tolist() for c in [*identity, "_tile"]])
            values = zip(*[pdf[c].tolist() for c in ["max_offset", "size_bytes"]])
            entered = zip(*[pdf[c].tolist() for c in ["seen_max", "open_size", "open_group", "is_open"]])
            groups, stale = [], []
            for here, (high, added), entry in zip(starts, values, entered):
                if here != tile:
                    tile = here
                    seen, size, group, is_open = entry
                stale.append(high <= seen)
                if high > seen:
                    seen = high
                    if not is_open:
                        size, group = 0, high
                    size += added
                    is_open = size <= limit
                groups.append(group)
            kept = pdf[[*identity, "min_offset", "max_offset", "size_bytes", "n_rows"]]
            yield kept.assign(group_id=groups, stale=stale)

    return label


def _nothing_open() -> dict[str, Column]:
    return {
        "open_size": F.lit(0).cast("bigint"),
        "open_group": F.lit(NONE).cast("bigint"),
        "is_open": F.lit(False),
    }


def _incoming_groups(tiles: DataFrame, limit: int, fan_in: int, n_tiles: int) -> DataFrame:
    """The group open before each tile."""
    go = _passer(limit)
    nodes_of = _node_reader()
    summaries = tiles.withColumnRenamed("_tile", "node").groupBy(*PREFIX, "node")
    levels = [checkpointed(summaries.applyInPandas(_summariser(limit), _SUMMARY_DDL))]
    span = (n_tiles - 1) // fan_in
    parent = F.call_function("div", F.col("node"), F.lit(fan_in))
    while span > 0:
        up = levels[-1].groupBy(*PREFIX, parent.alias("parent"))
        levels.append(checkpointed(up.applyInPandas(_composer(limit, go, nodes_of), _SUMMARY_DDL)))
        span //= fan_in

    # Back down: every level learns the group open before its nodes from the level above.
    entries = None
    for level in reversed(levels):
        below = level.withColumn("parent", parent)
        if entries is None:
            below = below.withColumns(_nothing_open())
        else:
            below = below.join(entries.withColumnRenamed("node", "parent"), [*PREFIX, "parent"])
        entries = below.groupBy(*PREFIX, "parent").applyInPandas(_chainer(go, nodes_of), _ENTRY_DDL)
    return entries.withColumnRenamed("node", "_tile")


def _labelled(chunks: DataFrame, limit: int) -> DataFrame:
    keys = [*PREFIX, "_tile"]
    in_order = chunks.repartition(*keys).sortWithinPartitions(*keys, "min_offset", "max_offset")
    return in_order.mapInPandas(_labeller(limit), _LABEL_DDL)


def _labelled_in_tiles(chunks: DataFrame, n_tiles: int, limit: int, fan_in: int) -> DataFrame:
    # Range partitioning cuts by sampled quantiles, so tiles are of a size whatever the offsets.
    # The checkpoint fixes which chunk is in which tile.
    tiles = checkpointed(
        chunks.repartitionByRange(n_tiles, *PREFIX, "min_offset", "max_offset").withColumn(
            "_tile", F.spark_partition_id().cast("bigint")
        )
    )
    keys = [*PREFIX, "_tile"]
    before = Window.partitionBy(*PREFIX).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tops = tiles.groupBy(*keys).agg(F.max("max_offset").alias("_top"))
    tops = tops.select(*keys, F.coalesce(F.max("_top").over(before), F.lit(NONE)).alias("seen_max"))
    tiles = checkpointed(lookup_join(tiles, tops, keys, "inner"))
    entries = checkpointed(_incoming_groups(tiles, limit, fan_in, n_tiles))
    return _labelled(lookup_join(tiles, entries, keys, "inner"), limit)


def label_chunks(
    manifest: DataFrame,
    limit: int = MERGE_LIMIT,
    tile_chunks: int = TILE_CHUNKS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Each distinct chunk with the id of its group, and whether it is stale.

    The id is the end of the group's first chunk: ends rise from group to group, starts may repeat.
    A stale chunk is put with the group that was last when it came up. Copies of a chunk count once.
    """
    chunks = (
        manifest.groupBy(*PREFIX, "min_offset", "max_offset")
        .agg(F.min(F.struct("size_bytes", "n_rows")).alias("_one"))
        .select(*PREFIX, "min_offset", "max_offset", "_one.size_bytes", "_one.n_rows")
    )
    counts = chunks.groupBy(*PREFIX).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile_chunks)
    large = checkpointed(counts)
    n_large = large.agg(F.sum("n")).first()[0] or 0
    usual = chunks if not n_large else lookup_join(chunks, large.select(*PREFIX), PREFIX, "left_anti")
    start = {"_tile": F.lit(0), "seen_max": F.lit(NONE).cast("bigint"), **_nothing_open()}
    labelled = _labelled(usual.withColumns(start), limit)
    if not n_large:
        return labelled
    n_tiles = -(-n_large // tile_chunks)
    cut = lookup_join(chunks, large.select(*PREFIX), PREFIX, "left_semi")
    return labelled.unionByName(_labelled_in_tiles(cut, n_tiles, limit, fan_in))


def compaction_plan(
    manifest: DataFrame,
    limit: int = MERGE_LIMIT,
    tile_chunks: int = TILE_CHUNKS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """The chunks an archive is left with: bounds, size and row count of every group."""
    return (
        label_chunks(manifest, limit, tile_chunks, fan_in)
        .where(~F.col("stale"))
        .groupBy(*PREFIX, "group_id")
        .agg(
            F.min("min_offset").alias("min_offset"),
            F.max("max_offset").alias("max_offset"),
            F.sum("size_bytes").alias("size_bytes"),
            F.sum("n_rows").alias("n_rows"),
            F.count(F.lit(1)).alias("n_chunks"),
        )
        .drop("group_id")
    )
