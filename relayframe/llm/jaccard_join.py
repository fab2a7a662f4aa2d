"""Similarity join of shingle sets by prefixes under several token orders.

If two sets resemble each other enough, the first few tokens of one and of the other, under any fixed order
of all tokens, share a token. So a pair has to share one under every order: the prefixes under the first
order propose pairs, the prefixes under the others have to agree, and only then the sets are compared. To
agree is to share as many tokens as the set whose prefix ends first in the order cannot do without.

All orders put rare tokens first, by classes of a count over the whole corpus, so that a passage that many
documents share comes last in each; within a class each order has a sequence of its own. Counts are kept for
``SLOTS`` hash values of tokens, whatever the size of the corpus; an order stays an order if counts coincide.

What proposes are not single tokens, which more and more texts share by chance as a corpus grows, but bundles: the
tokens of a set, but for common ones, are dealt by value into a few more parts than alike sets differ in tokens, and
what a part holds is a bundle. Alike sets have some bundles in common, so the first bundles of one and of the other,
those of many rare tokens first, share one. Only sets of mostly common tokens are proposed by the first order's prefix.

Documents of equal sets are one entry, known by a 128-bit digest. The group of a bundle or token is dealt over
classes of sizes, two for each member, so that any two members that may be alike meet in one. In each group
every member is proposed with the group's leader. Groups of three and more that this leaves in several
components are then compared inside tasks, what is outside the largest component with all members: groups
of up to ``SETS`` by their prefixes under the second order, which proposes further pairs, larger ones in blocks and
by their sets, which returns a forest of links for each two blocks. Pairs meet by short sketches first, which bound
from below in how many tokens two sets differ, then one order at a time, so that the prefixes, which are long for
long texts, are carried only for the pairs that are left. So no pair of a group is left out, and a large group's pairs are never rows. Groups of
the same members are compared once. Sets are not kept; they are made again from the texts that need them.

Defined results: a null or blank text has no shingles and is linked with nothing, whatever its copies. A text
of fewer words than a shingle has one shingle, all its words. Null ids count as largest. Repeated rows are
rows of their own, linked with each other. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayframe.llm.components import connected_components
from relayframe.session import checkpointed, lookup_join, scratch_path

SLOTS = 1 << 18
SLOTS_PER_ROW = 1 << 12
#: Seeds of the orders' sequences. The first proposes, the others have to agree.
ORDERS = (11, 12, 13)
SETS = 64
SET_BYTES = 4 << 20
BLOCKS = 32
#: Members of a group up to which its pairs are compared one by one.
FEW = 16
TOKENS_AT_ONCE = 32_768
#: Class from which a token is common: twice the mean, and COMMON_FROM documents.
COMMON = 2
COMMON_FROM = 64
#: Uncommon tokens for each one that alike sets may differ in, from which a set is dealt into bundles.
BUNDLED_FROM = 4
SKETCH_BITS = 12
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of 64-bit numbers, a different one for each seed."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int = 3) -> np.ndarray:
    """Hashes of the different shingles, in order."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        mixed = _mix(mixed * _M2 + hashes[i : i + len(mixed)], i)
    return np.unique(mixed)


def _stored(df: DataFrame) -> DataFrame:
    """A frame written to shared storage and read again; smaller there than a checkpoint."""
    path = scratch_path(df.sparkSession, "jaccard")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, id_key, text``; ``id_key`` stands for null ids as well."""
    number = F.col(id_col).cast("long")
    return docs.select(
        number.alias("id"), F.coalesce(number.cast("string"), F.lit("")).alias("id_key"), F.col(text_col).cast("string").alias("text")
    )


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _keys_and_counts(docs: DataFrame, size: int) -> DataFrame:
    """``id, id_key, n, key`` of every row, and each task's counts of tokens by slot in rows of their own."""
    names = ["id", "id_key", "n", "key", "part", "counts"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column(2):
                found = shingle_set(text.as_py(), size)
                sizes.append(len(found))
                keys.append(_digest(found))
                np.add.at(counts, (found % SLOTS).astype(np.int64), 1)
            nothing = [pa.nulls(len(keys), t) for t in types[4:]]
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *nothing]
            yield pa.RecordBatch.from_arrays(columns, names)
        if counts.any():
            parts = counts.reshape(-1, SLOTS_PER_ROW)
            columns = [pa.nulls(len(parts), t) for t in types[:4]]
            columns += [pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return _stored(docs.mapInArrow(run, "id long, id_key string, n long, key binary, part int, counts binary"))


def token_classes(counted: DataFrame) -> bytes:
    """How common the tokens of each slot are: 0 up to the mean, then two classes for each doubling."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(*(c.to_pylist() for c in batch.columns)):
                held = sums.setdefault(part, np.zeros(SLOTS_PER_ROW, np.int64))
                held += np.frombuffer(packed, np.uint32)
        columns = [pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "counts"])

    # SLOTS numbers in all, whatever the size of the corpus.
    rows = counted.where("part is not null").select("part", "counts")
    summed = rows.repartition("part").mapInArrow(add, "part int, counts binary").collect()
    counts = np.zeros((SLOTS // SLOTS_PER_ROW, SLOTS_PER_ROW))
    for row in summed:
        counts[row["part"]] = np.frombuffer(row["counts"], np.int64)
    relative = counts.ravel() / max(counts.mean(), COMMON_FROM / 2 ** (COMMON / 2))
    return np.floor(2 * np.log2(np.maximum(relative, 1))).astype(np.uint8).tobytes()


def early_length(n: int, percent: int) -> int:
    """How many first tokens of a set are enough to meet an alike set of its size or larger, within that one's prefix.

    They share at least ``2 * percent * n / (100 + percent)`` tokens.
    """
    return n - -(-2 * percent * n // (100 + percent)) + 1


def prefix(shingles: np.ndarray, classes: np.ndarray, seed: int, percent: int, length: int | None = None) -> np.ndarray:
    """The first tokens of a set under an order; one of them is in any set that resembles it."""
    n = len(shingles)
    length = length or n - -(-percent * n // 100) + 1
    if length >= n:
        return shingles
    kinds, places = classes[shingles % SLOTS], _mix(shingles, seed)
    # Whole classes first, then the first places of the class that is cut.
    last = np.partition(kinds, length - 1)[length - 1]
    whole = kinds < last
    rest = np.flatnonzero(kinds == last)
    at = length - int(whole.sum())
    cut = np.partition(places[rest], at - 1)[at - 1]
    whole[rest[places[rest] <= cut]] = True
    return shingles[whole]


@functools.lru_cache(maxsize=65_536)
def levels_of(n: int, percent: int) -> list[int]:
    """Numbers of tokens that may differ, rounded up in steps, between a set of ``n`` and an alike one no smaller,
    for every size that has."""
    least, most = (2 * m * (100 - percent) // (100 + percent) for m in (n, 100 * n // percent))
    level, found = 1, []
    while most > 0:
        if level >= least:
            found.append(level)
        if level >= most:
            break
        level = max(level + 1, level * 7 // 5)
    return found


@functools.lru_cache(maxsize=1024)
def _parts(parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Borders of equal parts of the hash values, and a number for each part."""
    borders = np.array([-(-i * 2**64 // parts) for i in range(parts)], np.uint64)
    return borders, np.arange(parts, dtype=np.uint64) * _M2


def bundles(rare: np.ndarray, kinds: np.ndarray, levels: list[int]) -> list[np.ndarray]:
    """A prefix of the bundles of a set's tokens for each level: two sets that differ in up to so many share one.

    The tokens are dealt by value into more parts than may differ. What a part holds makes one bundle; bundles of many
    rare tokens come first in their order, and as many as parts are bound to be equal, less one, are left out.
    """
    sums, weights = np.zeros(len(rare) + 1, np.uint64), np.zeros(len(rare) + 1, np.int64)
    np.cumsum(_mix(rare, ORDERS[0]), out=sums[1:])
    np.cumsum(COMMON - kinds.astype(np.int64), out=weights[1:])
    found = []
    for level in levels:
        borders, numbers = _parts(level + 2 + level // 8)
        starts = np.searchsorted(rare, borders)
        ends = np.append(starts[1:], len(rare))
        keys = _mix(sums[ends] - sums[starts] + numbers, len(borders))
        found.append(keys[np.lexsort((keys, weights[starts] - weights[ends]))[: level + 1]])
    return found


def proposing(shingles: np.ndarray, classes: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """What a set meets alike sets by, early ones first, and how many those are.

    Alike sets differ in no more uncommon tokens than in all. So if one has ``BUNDLED_FROM + 1`` of them for each that
    may differ, the other has ``BUNDLED_FROM``, and both have bundles; if neither has, both have the first order's prefix.
    """
    n = len(shingles)
    levels = levels_of(n, percent)
    kinds = classes[shingles % SLOTS]
    uncommon = kinds < COMMON
    rare, kinds = shingles[uncommon], kinds[uncommon]
    found = bundles(rare, kinds, [level for level in levels if len(rare) >= BUNDLED_FROM * level])
    early, late = sum(map(len, found)), []
    if any(len(rare) < (BUNDLED_FROM + 1) * level for level in levels):
        first = prefix(shingles, classes, ORDERS[0], percent)
        found.append(prefix(first, classes, ORDERS[0], percent, early_length(n, percent)))
        early += len(found[-1])
        late = [np.setdiff1d(first, found[-1], assume_unique=True)]
    return np.concatenate([np.zeros(0, np.uint64), *found, *late]), early


def sketch(shingles: np.ndarray, percent: int) -> bytes:
    """Parities of the counts of tokens by their last bits, some 12 bits for each token that may differ.

    Two sets differ in as many tokens as their sketches in bits, at least.
    """
    bits = max(64, 1 << (SKETCH_BITS * 2 * len(shingles) * (100 - percent) // (100 + percent)).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketches_differ(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, after the longer one is folded to the length of the other."""
    x, y = (np.frombuffer(s, np.uint8) for s in (a, b))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _signatures(docs: DataFrame, classes: bytes, size: int, percent: int) -> DataFrame:
    """``node, key, n, first, early, others, sketch`` of every different set: a number for it, what the first order
    proposes it by, early ones first, how many those are, 16 bits of each token of the other orders' prefixes,
    which are equal wherever the tokens are, and a sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = np.frombuffer(classes, np.uint8)
        for batch in batches:
            rows = []
            for text in batch.column(0):
                found = shingle_set(text.as_py(), size)
                if len(found):
                    others = (prefix(found, kinds, seed, percent) for seed in ORDERS[1:])
                    short = [(o >> np.uint64(48)).astype("<u2").tobytes() for o in others]
                    first, early = proposing(found, kinds, percent)
                    rows.append((_digest(found), len(found), first.view(np.int64), early, short, sketch(found, percent)))
            columns = list(zip(*rows)) or [()] * 6
            types = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.binary()), pa.binary())
            names = ["key", "n", "first", "early", "others", "sketch"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    shape = "key binary, n long, first array<long>, early long, others array<binary>, sketch binary"
    once = docs.select("text").mapInArrow(run, shape).dropDuplicates(["key"])
    return _stored(once.withColumn("node", F.monotonically_increasing_id()))


def _sets_of(docs: DataFrame, nodes: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of the needed nodes, from the text of the least id that holds each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), size) for t in batch.column(0)]
            columns = [[_digest(s) for s in found], [s.tobytes() for s in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["key", "shingles"])

    wanted = checkpointed(lookup_join(nodes.select("node", "key", "id_key"), needed, ["node"], "left_semi"))
    texts = lookup_join(docs, wanted.select("id_key").distinct(), ["id_key"], "left_semi").select("text")
    sets = lookup_join(texts.mapInArrow(run, "key binary, shingles binary"), wanted.drop("id_key"), ["key"], "inner")
    return sets.select("node", "shingles").dropDuplicates(["node"])


def needed_in_prefix(n_a, n_b, percent: int):
    """Least number of tokens that the prefixes of two sets of these sizes share if the sets are alike.

    Alike sets share ``least`` tokens or more, so each lacks few of the other's. The prefix that ends first in
    the order lies, as far as it is shared at all, within the other one.
    """
    least = -(-percent * (n_a + n_b) // (100 + percent))
    larger = np.maximum(n_a, n_b) if isinstance(n_a, np.ndarray) else max(n_a, n_b)
    return least + -percent * larger // 100 + 1


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values of each of the left arrays are in each of the right ones."""
    owners = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (left, right)]
    values = [np.concatenate(side) for side in (left, right)]
    common = np.intersect1d(*values)
    found = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(common), TOKENS_AT_ONCE):
        part = common[start : start + TOKENS_AT_ONCE]
        held = []
        for owner, value, side in zip(owners, values, (left, right)):
            at = np.minimum(np.searchsorted(part, value), len(part) - 1)
            inside = part[at] == value
            held.append(np.zeros((len(side), len(part)), np.float32))
            np.add.at(held[-1], (owner[inside], at[inside]), 1)
        found += held[0] @ np.minimum(held[1], 1).T
    return found


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def candidates(left: list[dict], right: list[dict], percent: int) -> np.ndarray:
    """Places of members of different components whose sizes and prefixes allow them to be alike."""
    sizes = [np.array([m["n"] for m in side]) for side in (left, right)]
    names = [np.array([m["component"] for m in side]) for side in (left, right)]
    smaller, larger = np.minimum.outer(*sizes), np.maximum.outer(*sizes)
    open_pairs = (names[0][:, None] != names[1][None, :]) & (100 * smaller >= percent * larger)
    needed = needed_in_prefix(sizes[0][:, None], sizes[1][None, :], percent)
    for i in range(len(left[0]["others"]) if left else 0):
        if not open_pairs.any():
            break
        prefixes = [[np.frombuffer(m["others"][i], "<u2") for m in side] for side in (left, right)]
        open_pairs &= _shared(*prefixes) >= needed
    return np.argwhere(open_pairs)


def pairs_of_group(held: list[dict], percent: int) -> list[tuple[int, int]]:
    """The same within one small group, as nodes; plain sets cost less here than matrices."""
    if len(held) > FEW:
        found = candidates(held, held, percent)
        return [(held[i]["node"], held[j]["node"]) for i, j in found if held[i]["node"] > held[j]["node"]]
    held = sorted(held, key=lambda m: m["n"])
    prefixes = [[np.frombuffer(o, "<u2").tolist() for o in m["others"]] for m in held]
    values = [[set(o) for o in member] for member in prefixes]
    found = []
    for j, large in enumerate(held):
        for i in range(j - 1, -1, -1):
            small = held[i]
            if 100 * small["n"] < percent * large["n"]:
                break
            if small["component"] == large["component"]:
                continue
            needed = needed_in_prefix(small["n"], large["n"], percent)
            if all(sum(map(y.__contains__, x)) >= needed for x, y in zip(prefixes[i], values[j])):
                found.append((max(small["node"], large["node"]), min(small["node"], large["node"])))
    return found


_PAIRS = "a long, b long"
_GROUP = ["token", "class"]


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def _members(signatures: DataFrame, percent: int) -> DataFrame:
    """``token, class, node, n, members, leader`` for every group of several members.

    Alike sets share a token that is early in the smaller one, or in one of two of a size. So a member that holds
    the token later on stays only if the token is early in a member no larger than it.
    """
    postings = signatures.select("node", "n", "early", F.posexplode("first").alias("place", "token")).select(
        "token", "node", "n", (F.col("place") < F.col("early")).alias("early")
    )
    from_size = F.min(F.when(F.col("early"), F.col("n"))).alias("from_size")
    several = (F.col("members") > 1) & F.col("from_size").isNotNull()
    stays = F.col("early") | (F.col("n") >= F.col("from_size"))
    held = postings.groupBy("token").agg(F.count("*").alias("members"), from_size).where(several).drop("members")
    several = _stored(lookup_join(postings, checkpointed(held), ["token"], "inner").where(stays).drop("from_size"))
    # Sizes that differ by no more than the ratio allows are in one class or in neighbouring ones.
    size_class = F.floor(F.log("n") / (1.0001 * math.log(100 / percent))).cast("int")
    dealt = several.withColumn("class", F.explode(F.array(size_class, size_class + 1)))
    groups = (
        dealt.groupBy(*_GROUP)
        .agg(F.count("*").alias("members"), F.min("node").alias("leader"), from_size)
        .where("members > 1 and from_size is not null")
    )
    return _stored(lookup_join(dealt.drop("early"), checkpointed(groups.drop("from_size")), _GROUP, "inner"))


def set_links(docs: DataFrame, keys: DataFrame, classes: bytes, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` that connect all of the different sets that are alike, and ``node, key, id_key`` of all."""
    signatures = _signatures(docs, classes, size, percent)
    nodes = checkpointed(signatures.select("node", "key").join(keys.select("key", "id_key"), "key"))
    members = _members(signatures, percent)
    pairs = members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()

    pairs = checkpointed(_agreeing(pairs, signatures, None, percent))
    for order in range(len(ORDERS) - 1):
        pairs = _agreeing(pairs, signatures, order, percent)
    verified = _verified(docs, nodes, checkpointed(pairs), size, percent)
    named = connected_components(verified).select(F.col("node"), F.col("root").alias("component"))
    groups, members = _open_groups(members, checkpointed(named))
    small = lookup_join(members, groups.where(f"rows <= {SETS}").select(*_GROUP), _GROUP, "left_semi")
    links = verified.unionByName(_verified(docs, nodes, _small_groups(small, signatures, percent), size, percent))
    large = checkpointed(lookup_join(members, groups.where(f"rows > {SETS}"), _GROUP, "inner"))
    return links.unionByName(_large_groups(docs, nodes, large, signatures, size, percent)), nodes


def _agreeing(pairs: DataFrame, signatures: DataFrame, order: int | None, percent: int) -> DataFrame:
    """The pairs whose sizes and prefixes under one of the other orders, or else sketches, allow them to be alike."""

    def may_be(x: bytes, y: bytes, n: int, m: int) -> bool:
        if order is None:
            return sketches_differ(x, y) <= n + m - 2 * -(-percent * (n + m) // (100 + percent))
        return np.isin(np.frombuffer(x, "<u2"), np.frombuffer(y, "<u2")).sum() >= needed_in_prefix(n, m, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [may_be(*row) for row in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(node: str, tokens: str) -> DataFrame:
        held = F.col("sketch") if order is None else F.col("others")[order]
        return signatures.select(F.col("node").alias(node), F.col("n").alias(f"n_{node}"), held.alias(tokens))

    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").where(near).select("a", "b", "x", "y", "n_a", "n_b")
    return both.mapInArrow(run, _PAIRS)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                _alike(*(np.frombuffer(p.as_py(), np.uint64) for p in both), percent)
                for both in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    sets = _sets_of(docs, nodes, needed, size)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return checkpointed(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, _PAIRS))


def _open_groups(members: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of three and more members in several components, and all members with their component."""
    members = lookup_join(members.where("members > 2").select(*_GROUP, "node", "n"), named, ["node"])
    members = _stored(members.withColumn("component", F.coalesce("component", "node")))
    mark = [F.bit_xor(F.xxhash64("node", F.lit(s))).alias(f"mark_{s}") for s in (1, 2)]
    kinds = members.groupBy(*_GROUP, "component").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), *mark)
    groups = (
        kinds.groupBy(*_GROUP)
        .agg(
            F.max_by("component", F.struct("rows", "component")).alias("main"),
            F.count("*").alias("kinds"),
            F.sum("rows").alias("rows"),
            F.expr(f"greatest(sum(rows) div {SETS}, sum(n) * 8 div {SET_BYTES}) + 1").alias("blocks"),
            *[F.bit_xor(f"mark_{s}").alias(f"mark_{s}") for s in (1, 2)],
        )
        .where("kinds > 1")
    )
    # Groups of the same members are one.
    once = groups.groupBy("rows", "mark_1", "mark_2").agg(F.min(F.struct(*_GROUP, "main", "blocks")).alias("g"))
    return checkpointed(once.select("rows", "g.*")), members


def _small_groups(members: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Further pairs: those of different components of a group that agree under the other orders, of which the
    groups carry the first alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column(0):
                yield _pairs_batch(pairs_of_group(group.as_py(), percent))

    member = F.struct("node", "component", "n", "others")
    second = signatures.select("node", F.slice("others", 1, 1).alias("others"))
    groups = members.join(second, "node").groupBy(*_GROUP).agg(F.collect_list(member).alias("held"))
    pairs = checkpointed(groups.select("held").mapInArrow(run, _PAIRS).distinct())
    pairs = _agreeing(pairs, signatures, None, percent)
    for order in range(1, len(ORDERS) - 1):
        pairs = _agreeing(pairs, signatures, order, percent)
    return checkpointed(pairs)


def _large_groups(
    docs: DataFrame, nodes: DataFrame, members: DataFrame, signatures: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links between the components of large groups, in blocks that carry the sets."""
    sets = _sets_of(docs, nodes, checkpointed(members.select("node").distinct()), size)
    member = F.struct("node", "component", "n", "others", "shingles")
    outside = F.col("component") != F.col("main")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).join(sets, "node")
    blocks = checkpointed(
        dealt.join(signatures.select("node", "others"), "node")
        .groupBy(*_GROUP, "blocks", "block")
        .agg(F.collect_list(member).alias("every"), F.collect_list(F.when(outside, member)).alias("rest"))
    )
    salts = F.sequence(F.lit(0).cast("long"), F.expr(f"(blocks - 1) div {BLOCKS}"))
    left = blocks.where(F.size("rest") > 0).select(*_GROUP, F.explode(salts).alias("salt"), "rest")
    right = blocks.select(*_GROUP, F.expr(f"block div {BLOCKS}").alias("salt"), "every")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                sides = x.as_py(), y.as_py()
                held = [[np.frombuffer(m["shingles"], np.uint64) for m in side] for side in sides]
                linked, above = [], {}

                def top(component: int) -> int:
                    while component in above:
                        component = above[component]
                    return component

                for i, j in candidates(*sides, percent):
                    # A link joins two components that no other links have joined here.
                    a, b = top(sides[0][i]["component"]), top(sides[1][j]["component"])
                    if a != b and _alike(held[0][i], held[1][j], percent):
                        above[a] = b
                        linked.append((sides[0][i]["node"], sides[1][j]["node"]))
                yield _pairs_batch(linked)

    return left.join(right, [*_GROUP, "salt"]).select("rest", "every").mapInArrow(run, _PAIRS)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, percent: int = 90
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row: the set's size and the smallest id reachable by links."""
    docs = _docs(docs, id_col, text_col)
    counted = _keys_and_counts(docs, shingle_words)
    rows = counted.where("part is null").select("id", "n", "key")
    least = F.struct(F.col("id").isNull(), "id", "id_key")
    keys = checkpointed(
        counted.where("n > 0").groupBy("key").agg(F.min(least).alias("least"), F.count("*").alias("rows"))
    ).select("key", F.col("least.id").alias("least"), F.col("least.id_key").alias("id_key"), "rows")
    links, nodes = set_links(docs, keys, token_classes(counted), shingle_words, percent)
    placed = nodes.drop("id_key").join(keys.drop("id_key"), "key")
    rooted = lookup_join(placed, checkpointed(connected_components(links)), ["node"])
    rooted = checkpointed(rooted.select("key", F.coalesce("root", "node").alias("root"), "least", "rows"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows")).where("rows > 1")
    linked = checkpointed(lookup_join(rooted.select("key", "root"), checkpointed(named.drop("rows")), ["root"], "inner").drop("root"))
    return lookup_join(rows, linked, ["key"]).select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
