"""Token counts of a unigram tokenizer, without building the tokens.

Words are cut at the tokenizer's word mark. Aho-Corasick finds every vocabulary piece that ends at each
character of a word; dynamic programming carries the best score up to there and the number of pieces on
the way. Ties are the tokenizer's: of equal scores the piece that starts first stays, an unknown
character is a path of its own only where no piece of one character starts, and it costs the vocabulary's
least score less ten. With byte fallback an unknown character counts its UTF-8 bytes.

Scores add up in the order of the text, in doubles, as the tokenizer adds them. Where all scores are
whole numbers, sums are exact and words are cut further, at characters that no piece holds.

Defined results: a null or empty text has 0 tokens. Other columns are not looked at; repeated rows give
repeated results.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The word mark, and the penalty of an unknown character, of unigram tokenizers.
MARK = "▁"
UNKNOWN_PENALTY = 10.0

CACHED_WORDS = 500_000
_NONE = float("-inf")


class Vocabulary(NamedTuple):
    """Pieces with scores. ``byte_fallback``: unknown characters become a piece for each byte."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))
    names = {p for p, _ in pieces}
    return Vocabulary(pieces, all(f"<0x{b:02X}>" in names for b in range(256)))


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.byte_fallback = vocabulary.byte_fallback
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.matcher = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self.exact = all(float(s).is_integer() for _, s in vocabulary.pieces)
        self.known = set("".join(p for p, _ in vocabulary.pieces))
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of the best way through a word."""
        n = len(word)
        best = [0.0] + [_NONE] * n
        count = [0] * (n + 1)
        unknown_end = -1  # the last end that an unknown character reached
        single, done = self.single, 0
        # Matches come by their end, the longest and so the earliest first.
        for last, (length, score) in self.matcher.iter(word):
            while done < last:
                done += 1
                if word[done - 1] not in single:
                    unknown_end = self._unknown(word, done, best, count, unknown_end)
            start = last + 1 - length
            total = score + best[start]
            if total > best[last + 1]:
                best[last + 1], count[last + 1] = total, count[start] + 1
        while done < n:
            done += 1
            if word[done - 1] not in single:
                unknown_end = self._unknown(word, done, best, count, unknown_end)
        return count[n]

    def _unknown(self, word: str, end: int, best: list[float], count: list[int], unknown_end: int) -> int:
        total = self.unknown + best[end - 1]
        if total <= best[end]:
            return unknown_end
        more = len(word[end - 1].encode()) if self.byte_fallback else unknown_end != end - 1
        best[end], count[end] = total, count[end - 1] + more
        return end

    def _parts(self, word: str) -> Iterator[str]:
        """A word cut around characters in no piece, where that changes nothing."""
        if not self.exact or not self.byte_fallback or self.known.issuperset(word):
            yield word
            return
        start = 0
        for i, c in enumerate(word):
            if c not in self.known:
                if i > start:
                    yield word[start:i]
                yield c
                start = i + 1
        if start < len(word):
            yield word[start:]

    def text(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if marked[0] != MARK:
            marked = MARK + marked
        total, cache = 0, self.cache
        # A word is a mark with what follows up to the next mark.
        for rest in marked[1:].split(MARK):
            n = cache.get(rest)
            if n is None:
                n = sum(map(self.word, self._parts(MARK + rest)))
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                if len(rest) < 64:
                    cache[rest] = n
            total += n
        return total


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One for each Python worker."""
    return Counter(load_vocabulary(path))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``n_tokens`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).text
        for batch in batches:
            found = [count(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, rows.select("id").schema.add("n_tokens", "long"))
