"""Toxicity scores: a learned lexicon, matched through Levenshtein automata, in its context.

The lexicon is learned from labelled rows: words, and beginnings of words, that occur in clean documents
far more seldom than in toxic ones. Its trie is the automaton: a state is a set of trie places with the
errors made on the way, so running a word through it intersects the word's Levenshtein automaton with
the trie; states are built when first met. A word that can no longer come near any term is dropped at
that character.

Each match is weighed by its context window: between quotation marks or beside reporting words it counts
as quoted, beside words of address as abuse. A logistic model over these sums, the term weights and the
text's length gives the score.

The fit uses at most ``TRAIN_ROWS`` labelled rows, the first in a fixed hash order of their ids. Terms are
bounded by evidence alone, see ``CHANCE_TERMS``. Scoring reads every word of every text.

Defined results: a null or empty text has no matches and gets the model's score of that; without
labelled rows of both kinds every score is 0. Rows with a null id or label are not learned from. Labels
are never joined to scored rows. Repeated rows are scored alike; other columns are not looked at.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayframe.session import checkpointed

TRAIN_ROWS = 20_000
LEAST_LOG_ODDS = 2.5
LEAST_DOCS = 2  # the words of one document are no evidence of their own each
#: Terms that chance alone would let through, expected over the whole lexicon.
CHANCE_TERMS = 50.0
SHORTEST, LONGEST = 4, 12
CONTEXT_CHARS = 60
MOST_STATES = 50_000
CACHED_STRINGS = 250_000

# Small word lists and marks of the context window, in the languages of the corpus.
REPORTING = frozenset(
    "said says called word words term quote quoted quotes means wrote insult insults phrase "
    "wort wörter begriff sagte nannte zitat mot mots terme dit appelé citation palabra palabras término dijo".split()
)
ADDRESS = frozenset("you your youre u ur du dich dir ihr tu toi vous te ti usted eres".split())
QUOTES = "\"“”„«»‹›`"



def _characters(*categories: str) -> str:
    """A character class body of the code points of some Unicode categories."""
    points = [c for c in map(chr, range(0x110000)) if unicodedata.category(c)[0] in categories]
    starts = [c for i, c in enumerate(points) if not i or ord(points[i - 1]) + 1 != ord(c)]
    ends = [c for i, c in enumerate(points) if i + 1 == len(points) or ord(points[i + 1]) - 1 != ord(c)]
    return "".join(a if a == b else f"{a}-{b}" for a, b in zip(starts, ends))


# Words of texts, both where terms are learned and where they are looked for: a letter, then letters and marks.
_LETTER = _characters("L")
_WORD = re.compile(f"[{_LETTER}][{_LETTER}{_characters('M')}]*")
#: Most characters between the parts of a word that is misspelled with other signs; each is an error.
MOST_SIGNS = 2


class Term(NamedTuple):
    text: str
    is_stem: bool  # the beginning of words, not a whole word
    weight: float


def errors_allowed(term: Term) -> int:
    """Misspellings that a term may be found through; beginnings have to be right."""
    if term.is_stem or len(term.text) < 5:
        return 0
    return 2 if len(term.text) >= 10 else 1


class Lexicon:
    """A trie of terms, run as a Levenshtein automaton."""

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]  # terms that end at a place
        self.budget = [0]  # most errors that a term below a place allows
        for i, term in enumerate(terms):
            at, allowed = 0, errors_allowed(term)
            self.budget[0] = max(self.budget[0], allowed)
            for c in term.text:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.budget.append(0)
                at = self.children[at][c]
                self.budget[at] = max(self.budget[at], allowed)
            self.ends[at].append(i)
        self._forget()
        self.hits: set[str] = set()
        self.misses: set[str] = set()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.stems: list[tuple[int, int] | None] = []  # the best term that a state has reached
        self.wholes: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, places: dict[int, int]) -> int:
        """Adds places reached by leaving out characters of a term, and numbers the set."""
        todo = list(places.items())
        while todo:
            at, errors = todo.pop()
            for child in self.children[at].values():
                if errors + 1 <= self.budget[child] and errors + 1 < places.get(child, 99):
                    places[child] = errors + 1
                    todo.append((child, errors + 1))
        key = frozenset(places.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.stems.append(self._best(key, True))
            self.wholes.append(self._best(key, False))
        return self.states[key]

    def _step(self, state: int, char: str) -> int:
        after: dict[int, int] = {}

        def reach(place: int, errors: int) -> None:
            if errors <= self.budget[place] and errors < after.get(place, 99):
                after[place] = errors

        for at, errors in self.sets[state]:
            reach(at, errors + 1)  # a character too many
            for c, child in self.children[at].items():
                reach(child, errors + (c != char))
        number = self._state(after) if after else -1
        self.steps[state][char] = number
        return number

    def find(self, word: str) -> tuple[int, int] | None:
        """The term that a word spells, with the fewest errors, and the number of errors."""
        if len(self.sets) > MOST_STATES:
            self._forget()
        state, stem, steps = self.start, None, self.steps
        for c in word:
            number = steps[state].get(c)
            if number is None:
                number = self._step(state, c)
            if number < 0:
                return stem
            state = number
            stem = stem or self.stems[state]
        return min(filter(None, (self.wholes[state], stem)), key=lambda f: f[1], default=None)

    def _best(self, places: frozenset, stems: bool) -> tuple[int, int] | None:
        hits = [
            (i, errors)
            for at, errors in places
            for i in self.ends[at]
            if self.terms[i].is_stem == stems and errors <= errors_allowed(self.terms[i])
        ]
        return min(hits, key=lambda h: (h[1], h[0]), default=None)

    def spelled(self, string: str) -> list[tuple[int, int, tuple[int, int]]]:
        """Start, end and find of every term in a string between blanks: its words, and parts of a word that
        digits or other signs have cut up, such as ``id1ot``."""
        words = [(m.start(), m.end()) for m in _WORD.finditer(string)]
        found = [self.find(string[start:end]) for start, end in words]
        out = [(*w, f) for w, f in zip(words, found) if f is not None]
        if len(words) < 2:
            return out
        i = 0
        while i < len(words):
            # The fewest errors count, then the shortest; every sign is one of the errors.
            best, last, signs = None, i, 0
            for j in range(i, len(words) if found[i] is None else i):
                signs += words[j][0] - words[j - 1][1] if j > i else 0
                if signs > MOST_SIGNS or found[j] is not None:
                    break
                f = self.find(string[words[i][0] : words[j][1]]) if j > i else None
                if f is not None and (best is None or f[1] < best[1]):
                    best, last = f, j
            if best is not None:
                out.append((words[i][0], words[last][1], best))
            i = last + 1
        return sorted(out)

    def matching(self, text: str) -> set[str]:
        """The strings between blanks of a lower-case text in which a word spells a term; each string is
        judged once."""
        strings = set(text.split())
        new = strings - self.misses
        new -= self.hits
        for string in new:
            (self.hits if self.spelled(string) else self.misses).add(string)
        found = strings & self.hits
        if len(self.misses) > CACHED_STRINGS:
            self.misses.clear()
        if len(self.hits) > CACHED_STRINGS:
            self.hits.clear()
        return found


def _places(text: str, string: str) -> Iterator[int]:
    """Where a string stands between blanks."""
    at = text.find(string)
    while at >= 0:
        end = at + len(string)
        if (at == 0 or text[at - 1].isspace()) and (end == len(text) or text[end].isspace()):
            yield at
        at = text.find(string, at + 1)


N_FEATURES = 8


def features(lexicon: Lexicon, text: str | None) -> list[float]:
    """What a text's matches and their contexts add up to."""
    lowered = (text or "").lower()
    plain = near = quoted = address = weight = top = 0.0
    for string in lexicon.matching(lowered):
        terms = lexicon.spelled(string)
        for at in _places(lowered, string):
            for start, end, (term, errors) in terms:
                left = lowered[max(0, at + start - CONTEXT_CHARS) : at + start]
                right = lowered[at + end : at + end + CONTEXT_CHARS]
                context = set(_WORD.findall(left)) | set(_WORD.findall(right))
                opened = sum(map(left.count, QUOTES)) % 2 == 1 and any(q in right for q in QUOTES)
                if opened or context & REPORTING:
                    quoted += 1
                    continue
                plain += errors == 0
                near += errors > 0
                address += bool(context & ADDRESS)
                w = lexicon.terms[term].weight / (1 + errors)
                weight += w
                top = max(top, w)
    return [
        math.log1p(plain),
        math.log1p(near),
        math.log1p(quoted),
        math.log1p(address),
        math.log1p(round(weight, 6)),
        top / 5,
        float(plain + near > 0),
        math.log1p(len(lowered)) / 10,
    ]


class Model(NamedTuple):
    terms: list[Term]
    coefficients: list[float]  # the last one stands alone; empty: every score is 0


def is_training(id_col: str = "doc_id") -> Column:
    """Rows that labels may be learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 4 != 2


def _learned_terms(train: DataFrame) -> list[Term]:
    """Words and beginnings of words that toxic documents hold more often than chance explains.

    The chance that so many of a term's documents are toxic, at the share of toxic ones among all, is at most
    exp(-documents * divergence of both shares). Terms for which that times the number of terms stays
    below ``CHANCE_TERMS`` are learned, so how many documents a term needs follows from the size of the training set.
    """
    counts = {r.toxic: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(_WORD.findall(t.as_py().lower()))) for t in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "id", "words"])

    rows = train.select(F.col("toxic").cast("int"), "id", "text").mapInArrow(words, "toxic int, id long, words array<string>")
    each = checkpointed(rows.select("toxic", F.explode("words").alias("word"), "id").where(F.length("word") >= SHORTEST))
    whole = each.select("id", "toxic", F.col("word").alias("term"), F.lit(False).alias("is_stem"))
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.length("word") - 1, F.lit(LONGEST)))
    longer = each.where(F.length("word") > SHORTEST)
    stems = longer.select(
        "id", "toxic", F.explode(F.transform(sizes, lambda n: F.substr("word", F.lit(1), n))).alias("term"), F.lit(True).alias("is_stem")
    )
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    odds = F.log((F.col("hit") + 0.5) / (n_toxic + 1)) - F.log((F.col("miss") + 0.5) / (n_clean + 1))
    counted = checkpointed(
        whole.unionByName(stems.distinct())
        .groupBy("term", "is_stem")
        .agg(F.sum("toxic").alias("hit"), F.sum(1 - F.col("toxic")).alias("miss"))
    )
    n_terms = counted.count()
    base = min(max(n_toxic / max(n_toxic + n_clean, 1), 1e-9), 1 - 1e-9)
    share = F.col("hit") / (F.col("hit") + F.col("miss"))
    clean = F.when(F.col("miss") > 0, F.col("miss") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    evidence = F.col("hit") * F.log(share / base) + clean
    found = (
        counted.where(F.col("hit") >= LEAST_DOCS)
        .withColumn("weight", odds)
        .where((F.col("weight") >= LEAST_LOG_ODDS) & (evidence >= math.log(max(n_terms, 1) / CHANCE_TERMS)))
        .orderBy(F.desc("weight"), F.desc("hit"), F.length("term"), "term", "is_stem")
        .collect()
    )
    rows = {(r.term, r.is_stem): r for r in found}
    words_found = sorted(t for t, is_stem in rows if not is_stem)

    def covered(r) -> bool:
        """A beginning of the term says as much for more documents, or the whole word is all there is of it.
        A word that may be misspelled stays, because beginnings may not."""
        if errors_allowed(Term(r.term, r.is_stem, r.weight)):
            return False
        for n in range(SHORTEST, len(r.term) + (not r.is_stem)):
            s = rows.get((r.term[:n], True))
            if s is not None and s.hit > r.hit and s.weight >= r.weight - 0.1:
                return True
        # A beginning of one word only is that word, which may then be misspelled.
        if r.is_stem:
            first = bisect.bisect_left(words_found, r.term)
            longer = itertools.takewhile(lambda t: t.startswith(r.term), itertools.islice(words_found, first, None))
            return any(rows[t, False].hit >= r.hit for t in longer)
        return False

    return [Term(r.term, r.is_stem, r.weight) for r in found if not covered(r)]


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Newton steps for a logistic model with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.1)
    ridge[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Learns from at most ``train_rows`` labelled rows, and only from those of ``is_training``."""
    chosen = (
        labels.where(is_training(id_col) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(label_col).cast("int").alias("toxic"))
        .orderBy(F.xxhash64(F.col("id").cast("string")), "id")
        .limit(train_rows)
    )
    # At most train_rows rows of two numbers.
    train = checkpointed(
        docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
            F.broadcast(chosen), "id"
        )
    )
    terms = _learned_terms(train)
    shape = f"{', '.join(f'f{i} double' for i in range(N_FEATURES))}, toxic int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            rows = [features(lexicon, t.as_py()) for t in batch.column(0)]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows)] if rows else [pa.array([], pa.float64())] * N_FEATURES
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column(1).cast(pa.int32())], [*[f"f{i}" for i in range(N_FEATURES)], "toxic"]
            )

    rows = np.array(train.select("text", "toxic").mapInArrow(run, shape).collect(), float).reshape(-1, N_FEATURES + 1)
    y = rows[:, -1]
    if not len(rows) or y.min() == y.max():
        return Model(terms, [])
    # The sum of a column must not depend on the order in which tasks came back.
    rows = rows[np.lexsort(rows.T)]
    return Model(terms, _fit_logistic(rows[:, :-1], rows[:, -1]))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The rows with ``score_col`` between 0 and 1 in place of a column of that name."""
    kept = [c for c in docs.columns if c != score_col]
    position = kept.index(text_col)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = Lexicon(model.terms), model.coefficients
        for batch in batches:
            if weights:
                x = (features(lexicon, t.as_py()) for t in batch.column(position))
                z = [sum(a * b for a, b in zip(f, weights)) + weights[-1] for f in x]
                scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in z]
            else:
                scores = [0.0] * batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*kept, score_col])

    return rows.mapInArrow(run, rows.withColumn(score_col, F.lit(None).cast("double")).schema)
