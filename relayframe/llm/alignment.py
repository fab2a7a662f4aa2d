"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both tokenizers cut the same bytes, a space and the text. Places where a token of each ends cut the bytes
into groups. The two arrays of token ends are compared at the current shift between their indices: whole
stretches at once, of doubled length while they are equal and of halved length once they are not, so a
one-to-one stretch is jumped in few steps. Where the ends differ, the one that is behind advances until both
meet; that group is irregular and the shift is whatever it leaves behind.

Each token of a group is linked with each of the other side. Of a document only its different links are
kept, with how often each occurs. How many documents hold a link is counted over the whole corpus, with
partial counts in each task; the counts go back to the documents by a join whose size is checked.

Defined results: a null or empty text, and one that either tokenizer does not give back byte by byte, has no
tokens. Special tokens' names inside a text are plain text. Repeated rows are documents of their own. Other
columns, whatever their names, are not looked at. An empty table has no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayframe.llm import bpe
from relayframe.session import checkpointed, lookup_join

MARK = "▁"
ROWS_AT_ONCE = 64
#: Groups of more links than this are counted by their different tokens, not link by link.
LARGE_GROUP = 4_096
B_BITS = 32


class ByteLevel:
    """The byte-level tokenizer: ids of a text, and each id's bytes."""

    def __init__(self, path: str):
        self.model = bpe.Tokenizer(path)
        last = max(self.model.core.max_token_value, *self.model.special.values(), 0)
        self.bytes = [b""] * (last + 1)
        for i in range(last + 1):
            try:
                self.bytes[i] = self.model.core.decode_single_token_bytes(i)
            except KeyError:  # an id without a token
                continue
        self._of_word = functools.lru_cache(100_000)(self._word)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= bpe.MOST_CHARS:
            return self.model.core.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array([i for word in self.model._split.finditer(text) for i in self._of_word(word.group())], np.int64)

    def _word(self, word: str) -> list[int]:
        halves = [word.encode()]
        while len(halves[0]) > bpe.LEAF_BYTES:
            halves = [h for p in halves for h in (p[: len(p) // 2], p[len(p) // 2 :])]
        return self.model.join_all([self.model.encode_piece(h) for h in halves])


class Pieces:
    """The piece tokenizer. It puts a space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces, list[np.ndarray]]:
    """One pair for each Python worker."""
    pair = ByteLevel(path_a), Pieces(path_b)
    return *pair, [np.array([len(x) for x in t.bytes], np.int64) for t in pair]


def group_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Numbers of tokens of each side up to the end of each group, from the tokens' ends in bytes.

    Both lists rise and end in the same number.
    """
    ends_a, ends_b = _group_ends(a, b)
    return ends_a.tolist(), ends_b.tolist()


def _group_ends(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    i = j = 0
    n = len(a)
    # For each one-to-one stretch and the irregular group behind it: the stretch's end in a, the group's in both.
    runs: list[int] = []
    ends_i: list[int] = []
    ends_j: list[int] = []
    while i < n:
        at = i
        # Many stretches are empty or one token long; those are told without cutting the lists.
        if a[i] == b[j]:
            width, grows, shift, at = 2, True, j - i, i + 1
            while width > 1:
                found = a[at : at + width]
                if found and found == b[at + shift : at + shift + width]:
                    at += len(found)
                    width = width * 2 if grows else width // 2
                else:
                    grows, width = False, width // 2
            if at < n and a[at] == b[at + shift]:
                at += 1
            i, j = at, at + shift
        if i < n:
            end_a, end_b = a[i], b[j]
            i, j = i + 1, j + 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a = a[i]
                    i += 1
                else:
                    end_b = b[j]
                    j += 1
        runs.append(at)
        ends_i.append(i)
        ends_j.append(j)
    lasts = [np.array(x, np.int64) for x in (ends_i, ends_j)]
    starts = [_before(x) for x in lasts]
    ones = np.array(runs, np.int64) - starts[0]
    irregular = lasts[0] - starts[0] > ones
    sizes = ones + irregular
    first = np.cumsum(sizes) - sizes
    steps = np.arange(1, int(sizes.sum()) + 1)
    behind = (first + ones)[irregular]
    found = []
    for start, last in zip(starts, lasts):
        ends = np.repeat(start - first, sizes) + steps
        ends[behind] = last[irregular]
        found.append(ends)
    return found[0], found[1]


def _before(ends: np.ndarray) -> np.ndarray:
    """Where each stretch starts that ends there."""
    starts = np.zeros_like(ends)
    starts[1:] = ends[:-1]
    return starts


def _links(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Different links ``a << 32 | b`` in order, how often each occurs, and how many there are."""
    starts_a, starts_b = _before(ends_a), _before(ends_b)
    n_a, n_b = ends_a - starts_a, ends_b - starts_b
    large = n_a * n_b > LARGE_GROUP
    group = np.repeat(np.arange(len(n_a)), n_a)
    at_a = np.flatnonzero(~large[group])
    group = group[at_a]
    times = n_b[group]
    first = np.repeat(np.cumsum(times) - times, times)
    at_b = np.arange(len(first)) - first + np.repeat(starts_b[group], times)
    pairs, counts = np.unique(np.repeat(a[at_a], times) << B_BITS | b[at_b], return_counts=True)
    parts = [(pairs, counts)]
    for g in np.flatnonzero(large):
        sides = [np.unique(x[s[g] : e[g]], return_counts=True) for x, s, e in ((a, starts_a, ends_a), (b, starts_b, ends_b))]
        (x, n), (y, m) = sides
        parts.append(((x[:, None] << B_BITS | y[None, :]).ravel(), (n[:, None] * m[None, :]).ravel()))
    if len(parts) > 1:
        pairs, inverse = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        every = np.concatenate([c for _, c in parts])
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, inverse, every)
    return pairs, counts, int((n_a * n_b).sum())


@functools.lru_cache(maxsize=1)
def _written(size: int) -> list[str]:
    """Ids as they are written: inside a side of a group, last of the first side, last of the second."""
    return [f"{i}{end}" for end in ",|;" for i in range(size)]


def _groups_text(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
    size = int(max(a.max(), b.max())) // 65_536 * 65_536 + 65_536
    a, b = a.copy(), b.copy()
    a[ends_a - 1] += size
    b[ends_b - 1] += 2 * size
    # Each token stands behind those of its own side before it and the other side's earlier groups.
    starts_b = _before(ends_b)
    written = np.empty(len(a) + len(b), np.int64)
    written[np.arange(len(a)) + np.repeat(starts_b, ends_a - _before(ends_a))] = a
    written[np.arange(len(b)) + np.repeat(ends_a, ends_b - starts_b)] = b
    return "".join(map(_written(size).__getitem__, written.tolist()))[:-1]


_EMPTY = np.zeros(0, np.int64)
_NOTHING = (0, 0, 0, 0, "", _EMPTY, _EMPTY)


def align_text(text: str | None, path_a: str, path_b: str) -> tuple:
    """``n_a, n_b, n_groups, n_links``, the groups as text, different links and how often each occurs."""
    if not text:
        return _NOTHING
    one, other, lengths = tokenizers(path_a, path_b)
    whole = " " + text
    a, b = one.encode(whole), other.encode(text)
    data = whole.encode()
    if one.model.core.decode_bytes(a.tolist()) != data or b"".join(map(other.bytes.__getitem__, b)) != data:
        return _NOTHING
    ids = [a, np.array(b, np.int64)]
    ends = _group_ends(*(np.cumsum(n[x]).tolist() for n, x in zip(lengths, ids)))
    pairs, counts, n_links = _links(*ids, *ends)
    return len(a), len(b), len(ends[0]), n_links, _groups_text(*ids, *ends), pairs, counts


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, id, n_a, n_b, n_groups, n_links, groups, links, times`` of every row.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, ids of both sides by group; ``links`` are the different
    ``a << 32 | b`` and ``times`` how often each occurs. ``row`` tells rows of one id apart.
    """
    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "times"]

    def lists(arrays: list[np.ndarray]) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = list(zip(*(align_text(x.as_py(), path_a, path_b) for x in part.column(1))))
                columns = [pa.array(range(row, row + part.num_rows), pa.int64()), part.column(0)]
                columns += [pa.array(c, pa.int64()) for c in found[:4]] + [pa.array(found[4], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, lists(found[5]), lists(found[6])], names)
                row += part.num_rows

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<long>, "
        "times array<long>",
    )


def link_counts(aligned: DataFrame) -> DataFrame:
    """``link, n, best``: how many rows hold each link, and whether no link of its first id is held by more."""
    counts = checkpointed(aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n")))
    first = F.shiftright("link", B_BITS)
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return lookup_join(counts.withColumn("a", first), most, ["a"]).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame) -> DataFrame:
    """The aligned rows, without their links, with ``n_best`` and ``count_sum``: of all occurrences of links,
    those that are their first id's most common, and the sum of their counts. Each row once."""
    aligned = checkpointed(aligned)
    held = aligned.select("row", F.explode(F.arrays_zip("links", "times")).alias("held")).select(
        "row", F.col("held.links").alias("link"), F.col("held.times").alias("times")
    )
    sums = (
        lookup_join(held, checkpointed(link_counts(aligned)), ["link"])
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    zero = F.lit(0).cast("long")
    rest = [c for c in aligned.columns if c not in ("links", "times")]
    return aligned.select(*rest).join(sums, "row", "left").select(
        *rest, *[F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")]
    )
