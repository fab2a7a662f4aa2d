"""Byte-level BPE encoding and decoding, with long unsplit text encoded as a tree of halves.

Text is cut where the tokenizer's own splitting always cuts: between a character that is no white space
and white space. What follows such a place does not depend on what stands before it, and nothing before
it depends on what follows. A stretch without such places for ``MOST_CHARS`` characters is split by the
tokenizer's pattern; a piece still too long is halved at byte level, and halves are encoded in parallel,
as rows. Joining two halves re-encodes a window of tokens around the join and widens it until both ends
agree: the tokens next to each end of the window, encoded together with their neighbour outside, stay
as they are. A token sequence whose neighbours all agree in this way is the encoding.

Encoding runs on the tokenizer's ranks; a tokenizer whose merges are not in the order of its ids, or
that has another pre-tokenizer or a normalizer, is refused.

Defined results: a null text is encoded as the empty one, which has no tokens and decodes to the empty
text. Other columns are not looked at; repeated rows give repeated results.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayframe.llm.common import text_or_empty

#: Texts up to this length are encoded in one go, as are pieces of longer ones.
MOST_CHARS = 32_768
#: Bytes of an unsplit piece that one leaf of the tree encodes.
LEAF_BYTES = 8_192
FIRST_WINDOW = 8
ROWS_AT_ONCE = 128

# Fixed value: the splitting pattern of byte-level BPE tokenizers ("use_regex").
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAFE_CUT = regex.compile(r"(?<=\S)(?=\s)")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """A byte-level BPE tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if (
            spec["normalizer"]
            or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space")
            or not split.get("use_regex", True)
            or model["type"] != "BPE"
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        byte = _byte_of_char()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in w): i for w, i in model["vocab"].items() if w not in self.special}
        merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merged]
        if ids != sorted(ids):
            raise ValueError(f"the ids of {path} are not in the order of its merges")
        self.core = tiktoken.Encoding(
            path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )
        self._names = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._split = regex.compile(PATTERN)

    def encode(self, text: str) -> list[int]:
        return self.core.encode(text, allowed_special="all", disallowed_special=())

    def encode_piece(self, piece: bytes) -> list[int]:
        """Tokens of bytes that are not split any further."""
        return self.core._encode_single_piece(piece)

    def encode_packed(self, text: str) -> bytes:
        return self.core.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4").tobytes()

    def decode_packed(self, packed: bytes) -> str:
        return self.core.decode_bytes(unpack(packed)).decode("utf-8", errors="replace")

    def pieces(self, text: str) -> Iterator[tuple[str, str | bytes]]:
        """``text`` in order as ("text", part) to encode alone, or ("half", bytes), halves of one piece
        following each other up to a ("end", b"")."""
        start, length = 0, len(text)
        while length - start > MOST_CHARS:
            limit = start + MOST_CHARS
            cut = self._last_cut(text, start, limit)
            if cut is None:
                following = _SAFE_CUT.search(text, limit)
                cut = following.start() if following else length
                yield from self._unsplit(text[start:cut])
            else:
                yield "text", text[start:cut]
            start = cut
        if start < length:
            yield "text", text[start:]

    @staticmethod
    def _last_cut(text: str, start: int, limit: int) -> int | None:
        for at in range(limit, start, -1):
            if text[at].isspace() and not text[at - 1].isspace() and _SAFE_CUT.match(text, at):
                return at
        return None

    def _unsplit(self, text: str) -> Iterator[tuple[str, str | bytes]]:
        at = 0
        for name in self._names.finditer(text):
            yield from self._words(text[at : name.start()])
            yield "text", name.group()
            at = name.end()
        yield from self._words(text[at:])

    def _words(self, text: str) -> Iterator[tuple[str, bytes]]:
        for word in self._split.finditer(text):
            data = word.group().encode()
            parts = [data]
            while len(parts[0]) > LEAF_BYTES:
                parts = [h for p in parts for h in (p[: len(p) // 2], p[len(p) // 2 :])]
            for part in parts:
                yield "half", part
            yield "end", b""

    def _agree(self, left: int, right: int) -> bool:
        pair = self.core.decode_single_token_bytes(left) + self.core.decode_single_token_bytes(right)
        return self.encode_piece(pair) == [left, right]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring halves of one piece, from the encodings of each."""
        width = FIRST_WINDOW
        while True:
            before, after = left[:-width], right[width:]
            middle = self.encode_piece(self.core.decode_bytes(left[-width:] + right[:width]))
            if (not before or self._agree(before[-1], middle[0])) and (
                not after or self._agree(middle[-1], after[0])
            ):
                return before + middle + after
            width *= 2

    def join_all(self, halves: list[list[int]]) -> list[int]:
        """Joins neighbours level by level, as they were halved."""
        while len(halves) > 1:
            halves = [
                self.join(*halves[i : i + 2]) if i + 1 < len(halves) else halves[i] for i in range(0, len(halves), 2)
            ]
        return halves[0] if halves else []


def pack(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, dtype="<u4").tolist()


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """One for each Python worker."""
    return Tokenizer(path)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded size, so that a task holds few tokens at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def encode_texts(texts: DataFrame, path: str, text_col: str = "text", decode: bool = False) -> DataFrame:
    """The rows with ``ids``, packed as little-endian unsigned 32-bit integers, in place of a column of
    that name; with ``decode`` also ``decoded``, the text that the ids decode to.

    Rows of up to ``MOST_CHARS`` characters are encoded where they are. Longer texts are encoded once
    for all their copies, in pieces dealt over all tasks, and put together per text.
    """
    text = text_or_empty(text_col)
    added = ["ids", "decoded"] if decode else ["ids"]
    kept = [c for c in texts.columns if c not in added]
    rows = texts.select(*[F.col(f"`{c}`") for c in kept])
    position = kept.index(text_col)
    shape = rows.withColumn("ids", F.lit(None).cast("binary"))
    if decode:
        shape = shape.withColumn("decoded", F.lit(None).cast("string"))

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in _rows(batches):
            found = [t.encode_packed(x.as_py() or "") for x in batch.column(position)]
            columns = [*batch.columns, pa.array(found, pa.binary())]
            if decode:
                columns.append(pa.array(map(t.decode_packed, found), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    done = rows.where(F.length(text) <= MOST_CHARS).mapInArrow(encode_rows, shape.schema)
    long = rows.where(F.length(text) > MOST_CHARS).withColumn("text_key", F.sha2(text, 256))
    tokens = _encode_long(long.select("text_key", text.alias("text")).dropDuplicates(["text_key"]), path, decode)
    joined = long.join(tokens, "text_key").select(*[F.col(f"`{c}`") for c in kept], *added)
    return done.unionByName(joined)


def _encode_long(texts: DataFrame, path: str, decode: bool) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for key, text in zip(*batch.columns):
                pieces = list(t.pieces(text.as_py()))
                columns = [
                    pa.array([key.as_py()] * len(pieces), pa.string()),
                    pa.array(range(len(pieces)), pa.int64()),
                    pa.array([kind for kind, _ in pieces], pa.string()),
                    pa.array([p.encode() if isinstance(p, str) else p for _, p in pieces], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "at", "kind", "piece"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in _rows(batches):
            key, at, kind, piece = batch.columns
            ids = [
                t.encode_packed(p.decode()) if k == "text" else pack(t.encode_piece(p)) if p else b""
                for k, p in zip(kind.to_pylist(), piece.to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([key, at, kind, pa.array(ids, pa.binary())], ["text_key", "at", "kind", "ids"])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for key, parts in zip(*batch.columns):
                ids, halves = [], []
                for part in parts.as_py():
                    if part["kind"] == "text":
                        ids.append(part["ids"])
                    elif part["kind"] == "half":
                        halves.append(unpack(part["ids"]))
                    else:
                        ids.append(pack(t.join_all(halves)))
                        halves = []
                packed = b"".join(ids)
                columns = [pa.array([key.as_py()], pa.string()), pa.array([packed], pa.binary())]
                if decode:
                    columns.append(pa.array([t.decode_packed(packed)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "ids", "decoded"][: len(columns)])

    tasks = max(2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        texts.mapInArrow(cut, "text_key string, at long, kind string, piece binary")
        .repartition(tasks, "text_key", "at")
        .mapInArrow(encode, "text_key string, at long, kind string, ids binary")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_list(F.struct("at", "kind", "ids"))).alias("parts"))
        .mapInArrow(put_together, "text_key string, ids binary" + ", decoded string" * decode)
    )


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text of the packed ``ids_col``; null ids decode to ''."""
    kept = [c for c in rows.columns if c != "decoded"]
    position = kept.index(ids_col)
    rows = rows.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in _rows(batches):
            found = [t.decode_packed(x.as_py() or b"") for x in batch.column(position)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*kept, "decoded"])

    return rows.mapInArrow(run, rows.withColumn("decoded", F.lit(None).cast("string")).schema)


def n_tokens(ids_col: str = "ids") -> Column:
    return (F.octet_length(ids_col) / 4).cast("long")
