"""Near duplicates by SimHash, with a hierarchical index over fingerprints in Gray order.

Fingerprints are sorted by their rank in the reflected Gray code, so neighbours share most high bits.
The order is cut into blocks; a block, and every node above it, stands for its fingerprints by the bits
they all share (a mask and a pattern). Pairs of nodes are compared from the root down: a pair whose
shared bits differ too often is dropped with all fingerprints below, and only children of the pairs that
are left are compared further. Above the blocks this runs as joins of parents with children, inside a
pair of blocks on arrays. Each pair of blocks returns a spanning forest of its links, never all of them.

Equal fingerprints are one entry of the index whatever their number, so copies cost nothing there.

Defined results: a null or blank text has no shingles and fingerprint zero, which links like any other;
a text of fewer words than a shingle has one shingle, all its words. Null ids count as largest: a
component has a null id only if all its ids are. Repeated rows are rows of their own. Other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relayframe.llm.common import partitions_for
from relayframe.llm.components import connected_components
from relayframe.session import checkpointed, lookup_join

SEED = 42
MAX_BITS = 3
BLOCK = 16_384
FAN_OUT_BITS = 3
SHINGLES_AT_ONCE = 65_536
LEAF = 16
PAIRS_AT_ONCE = 4_096

# Samples of a text: each is the fingerprint of the SAMPLED shingles that come first in an order of its
# own. Texts that share 0.8 of their shingles agree in a sample with probability 0.8**3 = 0.51, so in
# one of 12 with probability 0.9998.
SAMPLES = 12
SAMPLED = 3
#: In a group of texts that agree in a sample, each is first compared with the first and with so many before
#: it in Gray order, within slices of about SLICE texts. What that leaves apart is compared in blocks of
#: about SETS texts or SHINGLES_AT_ONCE shingles; BLOCKS blocks of a group meet in one task.
NEIGHBOURS = 3
SLICE = 1_000
SETS = 64
BLOCKS = 32


# -- fingerprints ------------------------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def _shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included, in arrays of bounded length."""
    if not words:
        return
    if len(words) <= size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    for start in range(0, len(words) - size + 1, SHINGLES_AT_ONCE):
        part = words[start : start + SHINGLES_AT_ONCE + size - 1]
        shingles = map(b" ".join, zip(*(islice(part, i, None) for i in range(size))))
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(part) - size + 1)


def _majority(hashes: Iterator[np.ndarray]) -> int:
    total, ones = 0, np.zeros(64, np.int64)
    for h in hashes:
        total += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Signed 64-bit SimHash: a bit is set if it is in over half of the shingles' hashes."""
    return _majority(_shingle_hashes(words_of(text), shingle_words))


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3
) -> DataFrame:
    """``id, fingerprint`` of every row, the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fingerprint long")


# -- the index ---------------------------------------------------------------------------------------


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in the reflected Gray code, shifted so that signed order is its order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(2**63)).cast("long"))


def gray_blocks(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of neighbouring fingerprints: ``node, all_ones, any_ones, members`` (little-endian)."""
    tasks = partitions_for(distinct.count(), block)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, chunk = TaskContext.get().partitionId(), 0
        held = np.zeros(0, np.int64)
        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy()])
            while len(held) >= block:
                yield row(task, chunk, held[:block])
                held, chunk = held[block:], chunk + 1
        if len(held):
            yield row(task, chunk, held)

    def row(task: int, chunk: int, fps: np.ndarray) -> pa.RecordBatch:
        values = (task << 20 | chunk, int(np.bitwise_and.reduce(fps)), int(np.bitwise_or.reduce(fps)))
        columns = [pa.array([v], pa.int64()) for v in values] + [pa.array([fps.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["node", "all_ones", "any_ones", "members"])

    ordered = distinct.select("fingerprint", gray_rank(F.col("fingerprint")).alias("rank"))
    ordered = ordered.repartitionByRange(tasks, "rank").sortWithinPartitions("rank")
    return checkpointed(
        ordered.select("fingerprint").mapInArrow(pack, "node long, all_ones long, any_ones long, members binary")
    )


def block_pairs(blocks: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a <= b`` of blocks whose shared bits differ at most ``max_bits`` times, from the root down."""
    nodes = blocks.select("node", "all_ones", "any_ones")
    levels = [nodes]
    width = int(nodes.agg(F.max("node")).first()[0] or 0)
    shift = 20
    while True:
        up = (
            levels[-1]
            .groupBy(F.shiftright("node", shift).alias("node"))
            .agg(F.bit_and("all_ones").alias("all_ones"), F.bit_or("any_ones").alias("any_ones"))
        )
        levels[-1] = levels[-1].withColumn("parent", F.shiftright("node", shift))
        levels.append(checkpointed(up))
        width >>= shift
        shift = FAN_OUT_BITS
        if width == 0:
            break
    pairs = levels.pop().select(F.col("node").alias("a"), F.col("node").alias("b"))
    while levels:
        children = levels.pop()
        left, right = (
            children.select(*[F.col(c).alias(f"{c}_{side}") for c in children.columns]) for side in ("a", "b")
        )
        shared = F.expr("~(all_ones_a ^ any_ones_a) & ~(all_ones_b ^ any_ones_b)")
        apart = F.bit_count(F.col("all_ones_a").bitwiseXOR(F.col("all_ones_b")).bitwiseAND(shared))
        pairs = (
            pairs.join(left, pairs.a == left.parent_a)
            .join(right, pairs.b == right.parent_b)
            .where((F.col("node_a") <= F.col("node_b")) & (apart <= max_bits))
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        )
    return checkpointed(pairs)


def _tree(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pattern, mask) of the fingerprints, then of groups of LEAF, of LEAF groups, up to one node."""
    ones, any_ones = fps, fps
    levels = [(fps, np.full(len(fps), np.uint64(2**64 - 1)))]
    while len(ones) > 1:
        starts = np.arange(0, len(ones), LEAF)
        ones, any_ones = np.bitwise_and.reduceat(ones, starts), np.bitwise_or.reduceat(any_ones, starts)
        levels.append((ones, ~(ones ^ any_ones)))
    return levels


def near_in_blocks(left: np.ndarray, right: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of fingerprints at most ``max_bits`` apart, in parts of bounded size."""
    trees = [_tree(left), _tree(right)]
    depth = max(map(len, trees))
    for t in trees:  # a shallow tree keeps its root on the levels above
        t.extend([t[-1]] * (depth - len(t)))
    steps = np.arange(LEAF)

    def below(parents: np.ndarray, level: int, tree: list) -> np.ndarray:
        if len(tree[level][0]) == len(tree[level + 1][0]):
            return parents[:, None]
        return parents[:, None] * LEAF + steps

    def descend(i: np.ndarray, j: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(i), PAIRS_AT_ONCE):
            a = below(i[at : at + PAIRS_AT_ONCE], level, trees[0])
            b = below(j[at : at + PAIRS_AT_ONCE], level, trees[1])
            u = np.repeat(a, b.shape[1], axis=1).ravel()
            v = np.tile(b, (1, a.shape[1])).ravel()
            (pu, mu), (pv, mv) = trees[0][level], trees[1][level]
            inside = (u < len(pu)) & (v < len(pv))
            u, v = u[inside], v[inside]
            near = np.bitwise_count((pu[u] ^ pv[v]) & mu[u] & mv[v]) <= max_bits
            u, v = u[near], v[near]
            if not len(u):
                continue
            if level:
                yield from descend(u, v, level - 1)
            else:
                yield u, v

    root = np.zeros(1, np.int64)
    if depth == 1:
        yield from [(root, root)] if np.bitwise_count(left ^ right)[0] <= max_bits else []
    else:
        yield from descend(root, root, depth - 2)


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position linked to each of ``n`` positions, directly or not."""
    label = np.arange(n)
    for u, v in links:
        while True:
            a, b = label[u], label[v]
            apart = a != b
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (label[label] != label).any():
                label = label[label]
    return label


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct ``fingerprint`` values at most ``max_bits`` apart."""
    blocks = gray_blocks(distinct, block)
    pairs = block_pairs(blocks, max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                left = np.frombuffer(x, np.uint64)
                right = left if a == b else np.frombuffer(y, np.uint64)
                offset = 0 if a == b else len(left)
                every = left if a == b else np.concatenate([left, right])
                label = _forest(len(every), ((u, v + offset) for u, v in near_in_blocks(left, right, max_bits)))
                linked = np.flatnonzero(label != np.arange(len(label)))
                ends = (every[linked].view(np.int64), every[label[linked]].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    n = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), partitions_for(pairs.count(), 64))
    left = blocks.select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = blocks.select(F.col("node").alias("b"), F.col("members").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.repartition(n, "a", "b").mapInArrow(run, "a long, b long")


def near_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``id, fingerprint`` rows with ``component_id``, the smallest id reachable over links."""
    fps = checkpointed(fps)
    distinct = checkpointed(fps.groupBy("fingerprint").agg(F.min("id").alias("least")))
    roots = connected_components(fingerprint_links(distinct.select("fingerprint"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return fps.join(named, "fingerprint")


# -- near copies of whole documents ------------------------------------------------------------------


def _samples(hashes: np.ndarray) -> list[int]:
    """Fingerprints of SAMPLES samples of a text's distinct shingles."""
    found = []
    for j in range(SAMPLES):
        # An order of its own for each sample: multiply by an odd constant and mix the halves.
        mixed = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(29)
        first = np.argpartition(mixed, SAMPLED)[:SAMPLED] if len(mixed) > SAMPLED else np.arange(len(mixed))
        found.append(_majority(iter([hashes[first]])))
    return found


def _shingle_set(text: str, size: int) -> np.ndarray:
    parts = [np.unique(h) for h in _shingle_hashes(words_of(text), size)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """``text_key, component`` for texts that resemble another: texts with the same component belong together.

    Candidates are all pairs of texts that the index's links between whole fingerprints connect or that
    agree in a sample. A candidate counts if the shingle sets' Jaccard similarity, exact, is at least
    ``similarity``. Each text is compared with the first of its group and with its neighbours in Gray
    order; then all pairs of a group that are not connected by that are compared too. Texts without words
    are left alone. ``text_key`` is xxhash64 and sha2 free of the id, so copies share a row.
    """
    key = text_key(text_col)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps, sizes, samples = [], [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(t.as_py())
                if words:
                    hashes = list(_shingle_hashes(words, shingle_words))
                    keys.append(k)
                    fps.append(_majority(iter(hashes)))
                    distinct = np.unique(np.concatenate(hashes))
                    sizes.append(len(distinct))
                    samples.append(_samples(distinct))
            columns = [pa.array(keys, pa.string()), pa.array(fps, pa.int64()), pa.array(sizes, pa.int64())]
            columns.append(pa.array(samples, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["text_key", "fingerprint", "size", "samples"])

    texts = docs.select(key.alias("text_key"), F.col(text_col).cast("string").alias("text"))
    sketches = checkpointed(
        texts.mapInArrow(sketch, "text_key string, fingerprint long, size long, samples array<long>")
        .dropDuplicates(["text_key"])
        .withColumn("rank", gray_rank(F.col("fingerprint")))
    )
    links = fingerprint_links(sketches.select("fingerprint").distinct())
    roots = connected_components(links)
    whole = sketches.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        F.lit(-1).alias("sample"), F.coalesce("root", "fingerprint").alias("value"), "text_key", "rank", "size"
    )
    sampled = sketches.select("text_key", "rank", "size", F.posexplode("samples").alias("sample", "value"))
    members = checkpointed(whole.unionByName(sampled.select(*whole.columns)))
    # Each sample has a first text of its own, by a hash, so that texts meet several of their group.
    place = F.struct(F.xxhash64("text_key", "sample"), "text_key")
    sizes = members.groupBy("sample", "value").agg(F.count("*").alias("n"), F.min_by("text_key", place).alias("first"))
    grouped = members.join(sizes.where("n > 1"), ["sample", "value"])
    # Neighbours are found in slices of a large group, so that no task has to sort it alone.
    part = F.pmod(F.xxhash64("text_key"), F.expr(f"n div {SLICE} + 1"))
    order = Window.partitionBy("sample", "value", part).orderBy("rank", "text_key")
    before = [F.lag("text_key", i).over(order).alias(f"before_{i}") for i in range(1, NEIGHBOURS + 1)]
    near = grouped.select("text_key", "first", *before).select(
        F.col("text_key").alias("a"),
        F.explode(F.array("first", *[f"before_{i}" for i in range(1, NEIGHBOURS + 1)])).alias("b"),
    )
    pairs = checkpointed(
        near.where("b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    needed = pairs.select(F.explode(F.array("a", "b")).alias("text_key")).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_shingle_set(t.as_py(), shingle_words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["text_key", "shingles"])

    wanted = lookup_join(texts, needed, ["text_key"], "left_semi").dropDuplicates(["text_key"])
    shingles = checkpointed(wanted.mapInArrow(sets, "text_key string, shingles binary"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both >= similarity * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = shingles.select(F.col("text_key").alias("a"), F.col("shingles").alias("left"))
    right = shingles.select(F.col("text_key").alias("b"), F.col("shingles").alias("right"))
    verified = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(verify, "a string, b string")
    linked = checkpointed(
        connected_components(verified).select(F.col("node").alias("text_key"), F.col("root").alias("component"))
    )
    # Groups of up to NEIGHBOURS + 1 texts have been compared pair by pair.
    large = members.join(sizes.where(f"n > {NEIGHBOURS + 1}").select("sample", "value"), ["sample", "value"])
    further = connected_components(_links_of_rest(large, linked, shingles, similarity))
    every = linked.unionByName(
        further.join(linked, further.node == linked.text_key, "left_anti").select(
            F.col("node").alias("text_key"), F.col("node").alias("component")
        )
    )
    return every.join(further.withColumnRenamed("node", "component"), "component", "left").select(
        "text_key", F.coalesce("root", "component").alias("component")
    )


def _links_of_rest(members: DataFrame, linked: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` between components of texts that are in one group (``sample, value``) and alike.

    Every pair of a group is compared unless both are in one component. The texts outside the largest
    component of their group meet all texts of the group, in blocks, so a group that is connected costs
    nothing and no pair is a row.
    """
    group = ["sample", "value"]
    members = members.join(linked, "text_key", "left").withColumn("component", F.coalesce("component", "text_key"))
    members = checkpointed(members.select(*group, "text_key", "size", "component"))
    kinds = members.groupBy(*group, "component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    groups = (
        kinds.groupBy(*group)
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("main"),
            F.count("*").alias("kinds"),
            F.expr(f"greatest(sum(n) div {SETS}, sum(size) div {SHINGLES_AT_ONCE}) + 1").alias("blocks"),
        )
        .where("kinds > 1")
    )
    groups = checkpointed(groups.drop("kinds"))
    rest = lookup_join(members.drop("size"), groups, group, "inner")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("text_key"), F.col("blocks"))).join(shingles, "text_key")
    sets = F.collect_list(F.struct("component", "shingles"))
    is_rest = F.col("component") != F.col("main")
    blocks = checkpointed(
        rest.groupBy(*group, "blocks", "block").agg(
            sets.alias("every"), F.collect_list(F.when(is_rest, F.struct("component", "shingles"))).alias("rest")
        )
    )
    salts = F.sequence(F.lit(0).cast("long"), F.expr(f"(blocks - 1) div {BLOCKS}"))
    left = blocks.where(F.size("rest") > 0).select(*group, F.explode(salts).alias("salt"), "rest")
    right = blocks.select(*group, F.expr(f"block div {BLOCKS}").alias("salt"), "every")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                found = _alike(x.as_py(), y.as_py(), similarity)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)] or [pa.array([], pa.string())] * 2, ["a", "b"])

    both = left.join(right, [*group, "salt"]).select("rest", "every")
    return both.mapInArrow(run, "a string, b string")


def _alike(left: list[dict], right: list[dict], similarity: float) -> list[tuple[str, str]]:
    """Pairs of different components of which two texts are alike."""
    sets = [[np.frombuffer(t["shingles"], np.uint64) for t in side] for side in (left, right)]
    names = [np.array([t["component"] for t in side]) for side in (left, right)]
    apart = names[0][:, None] != names[1][None, :]
    if not apart.any():
        return []
    sizes = [np.array([len(s) for s in side]) for side in sets]
    values = [np.concatenate(side) for side in sets]
    owners = [np.repeat(np.arange(len(n)), n) for n in sizes]
    common = np.intersect1d(*values)
    both = np.zeros(apart.shape, np.int64)
    for start in range(0, len(common), SHINGLES_AT_ONCE):
        part = common[start : start + SHINGLES_AT_ONCE]
        holds = []
        for v, o, n in zip(values, owners, sizes):
            at = np.minimum(np.searchsorted(part, v), len(part) - 1)
            inside = part[at] == v
            held = np.zeros((len(n), len(part)), np.float32)
            held[o[inside], at[inside]] = 1
            holds.append(held)
        both += np.rint(holds[0] @ holds[1].T).astype(np.int64)
    alike = apart & (both >= similarity * (sizes[0][:, None] + sizes[1][None, :] - both))
    return sorted({(names[0][i].item(), names[1][j].item()) for i, j in np.argwhere(alike)})


def text_key(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """The input's rows and columns with one document of each group of near copies: that of the smallest id.

    Copies of one text belong together as well. Rows without words stay.
    """
    named = near_copies(docs, id_col, text_col, shingle_words, similarity)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(
        text_key(text_col).alias("text_key"), F.col(id_col).cast("long").alias("id"), row.alias("row")
    )
    blank = F.trim(F.regexp_replace(F.coalesce(F.col(f"row.{text_col}"), F.lit("")), r"[\x09-\x0D]", " ")) == ""
    ids = checkpointed(keyed.where(~blank).groupBy("text_key", "id").agg(F.count("*").alias("rows")))
    placed = ids.join(named, "text_key", "left").withColumn("component", F.coalesce("component", "text_key"))
    best = placed.groupBy("component").agg(
        F.min_by(F.struct("text_key", "id"), F.struct(F.col("id").isNull(), "id", "text_key")).alias("best"),
        F.sum("rows").alias("rows"),
    )
    crowded = checkpointed(best.where("rows > 1").select("best.*", "component"))
    gone = placed.join(crowded.select("component"), "component", "left_semi").select("text_key", "id")
    gone = checkpointed(gone.distinct())
    match = ["text_key", "id"]
    stay = _null_safe(keyed, gone, "left_anti").select("row.*")
    chosen = (
        _null_safe(keyed, crowded.select(*match), "left_semi")
        .groupBy(*match)
        .agg(F.max_by("row", F.to_json("row")).alias("row"))
        .select("row.*")
    )
    return stay.unionByName(chosen)


def _null_safe(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = keys.select(F.col("text_key").alias("k_key"), F.col("id").alias("k_id"))
    if keys.count() <= 200_000:  # two short columns: under 60 MB
        keys = F.broadcast(keys)
    return rows.join(keys, (F.col("text_key") == F.col("k_key")) & F.col("id").eqNullSafe(F.col("k_id")), how)
