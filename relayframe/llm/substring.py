"""Repeated passages by relative Lempel-Ziv parsing against an index of the whole corpus.

A passage counts if a window of ``window`` consecutive words starts at two places. Every document is cut
greedily into factors: maximal runs of windows that own the same anchor, the least of their short word
sequences in a fixed hash order. Equal windows own equal anchors at equal places, so a window can repeat
only inside factors with the same anchor. The index of all factors is dealt into reference blocks by
anchor; each factor meets the one block in which it can occur. A factor of at least ``window`` words
found there a second time is a duplicate span as a whole. Factors whose anchor repeats but which as a
whole do not are cut off somewhere: at these boundaries each window is looked up by itself.

Equal factors are counted before they are shuffled, so copies and common passages are one row a task.
Only factors whose anchor repeats leave their task: a bitmap of FILTER_BITS bits, of one size for every
corpus, marks those anchors. Anchors that share a bit with one let a factor through in vain, no more.
Factors and windows are told apart by 128 bits of hash, texts by 96.

Defined results: a null text has no words. A document of fewer words than a window keeps all of them.
Repeated rows are copies like any others: all words of a repeated text of at least ``window`` words go.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayframe.session import checkpointed, lookup_join

WINDOW = 35
TEXTS_AT_ONCE = 64
#: Longer texts are parsed in stretches of so many words; every window lies in one of them.
WORDS_AT_ONCE = 2**20
CACHED_WORDS = 400_000
FILTER_BITS = 2**28  # 32 MB
FILTER_PAGES = 1_024
_PLACE_BITS = 24
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))


class _WordHashes(dict):
    """XXH64 of words, remembered up to a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def _words_in_parts(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text in lists of at most WORDS_AT_ONCE."""
    rest = (text or "").encode()
    while True:
        words = rest.split(None, WORDS_AT_ONCE)
        rest = words.pop() if len(words) > WORDS_AT_ONCE else b""
        yield words
        if not rest:
            return


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _grams(w: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of ``size`` words from each place on, from hashes of 1, 2, 4, ... words."""
    n = len(w) - size + 1
    total, done, power, step, block = np.zeros(n, np.uint64), 0, np.uint64(1), 1, w
    factor = base  # base ** step
    while True:
        if size & step:
            total += block[done : done + n] * power
            power, done = power * factor, done + step
        if done == size:
            return total
        block = block[: len(block) - step] + block[step:] * factor
        factor, step = factor * factor, step * 2


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        x, reach = np.minimum(x[:-reach], x[reach:]), reach * 2
    rest = width - reach
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class _Parsed:
    """Windows and factors of several texts, or stretches of texts, laid end to end."""

    def __init__(self, texts: list[list[bytes]], window: int):
        sizes = np.array([len(t) for t in texts])
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.empty = sizes.sum() < window
        if self.empty:
            return
        with np.errstate(over="ignore"):
            w = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(texts)), np.uint64, int(sizes.sum()))
            self.first = _mix(_grams(w, window, _BASES[0]))
            self.second = _mix(_grams(_mix(w), window, _BASES[1]))
            short = max(1, window * 12 // 35)
            anchors = _mix(_grams(w, short, _BASES[0]))
        # The first of equal anchors counts. Places are those in parts of the array, which overlap by a window.
        low, reach = np.uint64(2**_PLACE_BITS - 1), window - short + 1
        owners, step = [], 2**_PLACE_BITS - reach
        if step < 1:
            raise ValueError("a window of too many words")
        for at in range(0, len(anchors) - reach + 1, step):
            part = anchors[at : at + step + reach - 1]
            placed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
            owners.append((_sliding_min(placed, reach) & low).astype(np.int64) + at)
        owner = np.concatenate(owners)
        text = np.repeat(np.arange(len(sizes)), np.maximum(sizes - window + 1, 0))
        at = np.arange(len(text)) - np.repeat(
            np.cumsum(np.maximum(sizes - window + 1, 0)) - np.maximum(sizes - window + 1, 0),
            np.maximum(sizes - window + 1, 0),
        )
        self.text, self.at = text, at  # of each window inside a text
        self.place = self.starts[text] + at
        owned = owner[self.place]
        head = np.flatnonzero(np.r_[True, owned[1:] != owned[:-1]]) if len(owned) else np.zeros(0, np.int64)
        self.head = head  # first window of each factor
        self.count = np.diff(np.r_[head, len(owned)])
        self.anchor = anchors[owned[head]]

    def factor_hash(self) -> np.ndarray:
        """The first and last window of a factor overlap, so together they hold all of its words."""
        with np.errstate(over="ignore"):
            lo, hi = self.place[self.head], self.place[self.head + self.count - 1]
            return _mix(self.first[lo] * _BASES[1] + _mix(self.second[hi] + self.count.astype(np.uint64)))


def _stretches(text: str | None, window: int) -> Iterator[tuple[int, list[bytes]]]:
    """First word and words of the stretches of a text; they depend on the text alone."""
    at, before = 0, []
    for words in _words_in_parts(text):
        yield at - len(before), before + words
        at += len(words)
        before = (before + words)[1 - window :] if window > 1 else []


def _parse(texts: pa.Array, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, _Parsed]]:
    """Rows and first words of stretches with what was parsed of them, in parts of bounded size."""
    rows, firsts, held, size = [], [], [], 0
    for row, text in enumerate(texts):
        for first, words in _stretches(text.as_py(), window):
            rows.append(row)
            firsts.append(first)
            held.append(words)
            size += len(words)
            if len(held) >= TEXTS_AT_ONCE or size >= WORDS_AT_ONCE:
                yield np.array(rows), np.array(firsts), _Parsed(held, window)
                rows, firsts, held, size = [], [], [], 0
    if held:
        yield np.array(rows), np.array(firsts), _Parsed(held, window)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def text_keys(text_col: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.xxhash64(text).alias("key"), F.crc32(text).alias("check")


def _anchors(texts: DataFrame, window: int) -> DataFrame:
    """The anchor of every factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, p in _parse(batch.column(0), window):
                if not p.empty:
                    yield pa.RecordBatch.from_arrays([_signed(p.anchor)], ["anchor"])

    return texts.select("text").mapInArrow(run, "anchor long")


def _bitmap(anchors: DataFrame) -> Broadcast:
    """Broadcasts FILTER_BITS bits with those of the anchors set, put together in pages by tasks."""
    spark = anchors.sparkSession
    page_bits = FILTER_BITS // FILTER_PAGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            bits = batch.column(0).to_numpy()
            for page in np.unique(bits // page_bits).tolist():
                mine = pages.setdefault(page, np.zeros(page_bits // 8, np.uint8))
                inside = bits[bits // page_bits == page] % page_bits
                np.bitwise_or.at(mine, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        for page, mine in pages.items():
            columns = [pa.array([page], pa.int32()), pa.array([mine.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["page", "bits"])

    bit = F.pmod("anchor", F.lit(FILTER_BITS).cast("long")).alias("bit")
    dealt = anchors.select(bit).repartition(16, (F.col("bit") / page_bits).cast("int"))
    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in dealt.mapInArrow(run, "page int, bits binary").toLocalIterator():
        at = r.page * page_bits // 8
        whole[at : at + page_bits // 8] |= np.frombuffer(r.bits, np.uint8)
    return spark.sparkContext.broadcast(whole.tobytes())


def factors(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Factors of ``key, check, text`` rows whose anchor may occur twice: ``anchor, factor`` hashes, ``key``,
    ``place`` (check and first word) and ``n`` windows."""
    counts = _anchors(texts, window).groupBy("anchor").agg(F.count("*").alias("n"))
    marked = _bitmap(counts.where("n > 1").select("anchor"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(marked.value, np.uint8)
        for batch, rows, firsts, p in ((b, *part) for b in batches for part in _parse(b.column(2), window)):
            if p.empty:
                continue
            bit = p.anchor & np.uint64(FILTER_BITS - 1)
            maybe = np.flatnonzero(bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
            of = p.text[p.head][maybe]
            key = batch.column(0).to_numpy()[rows[of]]
            place = (batch.column(1).to_numpy()[rows[of]] << 32) | (p.at[p.head][maybe] + firsts[of])
            columns = [_signed(p.anchor[maybe]), _signed(p.factor_hash()[maybe]), _signed(key), _signed(place)]
            columns.append(pa.array(p.count[maybe].astype(np.int16), pa.int16()))
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "factor", "key", "place", "n"])

    return texts.mapInArrow(run, "anchor long, factor long, key long, place long, n short")


def _boundary_windows(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Hashes of single windows, ``first, second, key, place``, of the ``wanted`` factors (of each key a
    list of place, n, weight)."""
    lists = wanted.groupBy("key", F.shiftrightunsigned("place", 32).alias("check")).agg(
        F.collect_list(F.struct("place", "n", "weight")).alias("wanted")
    )
    keys = lists.select("key", "check")
    rows = lookup_join(texts, keys, ["key", "check"], "left_semi").join(lists, ["key", "check"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, firsts, p in ((b, *part) for b in batches for part in _parse(b.column(2), window)):
            if p.empty:
                continue
            out = []
            for i, (row, first) in enumerate(zip(rows.tolist(), firsts.tolist())):
                for f in batch.column(3)[row].as_py():
                    # A factor lies in the stretch that it was parsed in.
                    start = (f["place"] & 0x7FFFFFFF) - first
                    if 0 <= start <= p.sizes[i] - window:
                        at = np.arange(f["n"]) + start
                        out.append((at + p.starts[i], at + first, np.full(len(at), row), np.full(len(at), f["weight"])))
            if not out:
                continue
            where, at, of, weight = (np.concatenate(x) for x in zip(*out))
            key = batch.column(0).to_numpy()[of]
            place = (batch.column(1).to_numpy()[of] << 32) | at
            columns = [_signed(p.first[where]), _signed(p.second[where]), _signed(key), _signed(place)]
            columns.append(pa.array(weight.astype(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["first", "second", "key", "place", "weight"])

    return rows.select("key", "check", "text", "wanted").mapInArrow(
        run, "first long, second long, key long, place long, weight long"
    )


def duplicate_spans(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, check`` of a text with ``spans``, word ranges (``start``, ``n`` windows) that occur elsewhere."""
    texts = docs.select(*text_keys(text_col), F.col(text_col).cast("string").alias("text"))
    parsed = checkpointed(factors(texts, window))
    # One row a distinct factor; the first of its places stands for it.
    index = (
        parsed.groupBy("anchor", "factor")
        .agg(F.count("*").alias("weight"), F.min(F.struct("key", "place", "n")).alias("at"))
    )
    repeated = index.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("weight").alias("total"))
    index = checkpointed(
        index.join(repeated.where("total > 1"), "anchor").select("anchor", "factor", "weight", "kinds", "at")
    )
    found = parsed.join(index.where("weight > 1").select("anchor", "factor"), ["anchor", "factor"]).select(
        "key", "place", F.col("n").cast("int").alias("n")
    )
    boundary = index.where("kinds > 1").select("at.*", "weight")
    windows = checkpointed(_boundary_windows(texts, boundary, window))
    twice = windows.groupBy("first", "second").agg(F.sum("weight").alias("total")).where("total > 1")
    alone = windows.where("weight = 1").join(twice.drop("total"), ["first", "second"]).select(
        "key", "place", F.lit(1).alias("n")
    )
    return (
        found.unionByName(alone)
        .groupBy("key", F.shiftrightunsigned("place", 32).alias("check"))
        .agg(F.collect_set(F.struct(F.col("place").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("start"), "n")).alias("spans"))
    )


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``id``, ``n_words``, ``n_removed`` and ``kept``, the words left joined by one space, of every row."""
    spans = duplicate_spans(docs, text_col, window)
    rows = docs.select(
        *text_keys(text_col), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    ).join(spans, ["key", "check"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, TEXTS_AT_ONCE)):
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                ranges = spans.as_py() or ()
                starts = np.sort(np.array([s["start"] for s in ranges], np.int64))
                ends = np.sort(np.array([s["start"] + s["n"] + window - 1 for s in ranges], np.int64))
                n, left, parts = 0, 0, []
                for words in _words_in_parts(text.as_py()):
                    at = np.arange(n, n + len(words))
                    stay = np.searchsorted(starts, at, "right") == np.searchsorted(ends, at, "right")
                    n, left = n + len(words), left + int(stay.sum())
                    if stay.any():
                        parts.append(b" ".join(compress(words, stay.tolist())))
                n_words.append(n)
                n_removed.append(n - left)
                kept.append(b" ".join(parts).decode())
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])

    shape = docs.select(F.col(id_col).alias("id")).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return rows.select("id", "text", "spans").mapInArrow(run, shape)
