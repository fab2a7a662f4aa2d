import random
from collections import Counter

from relayframe.llm import substring
from relayframe.llm.substring import remove_repeated
from tests.llm.helpers import documents


def brute_force(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(words) for _ in range(90)]
    texts = [None, "", "a", "x " * 200, " ".join(passage), "é\x0b" * 40 + "tail"]
    for i in range(60):
        w = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if i % 3 == 0:  # parts of a passage at window boundaries, in other surroundings
            n, at = rng.choice([33, 34, 35, 36, 37, 60]), rng.randint(0, 20)
            k = rng.randint(0, len(w))
            w[k:k] = passage[at : at + n]
        texts.append(" ".join(w))
    texts += [texts[10], texts[10], " \t".join(passage[:50] * 3)]
    rows = {r.id: (r.n_words, r.n_removed, r.kept) for r in remove_repeated(documents(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == brute_force(texts, 35)


def test_windows_of_other_sizes_and_few_words(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(30)]
    rows = {r.id: (r.n_words, r.n_removed, r.kept) for r in remove_repeated(documents(spark, texts), window=7).collect()}
    assert [rows[i] for i in range(len(texts))] == brute_force(texts, 7)


def test_empty_table(spark):
    assert remove_repeated(documents(spark, ["a"]).limit(0)).count() == 0


def test_texts_longer_than_a_stretch_match_brute_force(spark, monkeypatch):
    """Stretches are short where the words are parsed; a batch holds more words than places have bits for."""
    rng = random.Random(12)
    monkeypatch.setattr(substring, "WORDS_AT_ONCE", 50)
    monkeypatch.setattr(substring, "_PLACE_BITS", 6)
    passage = [f"p{i}" for i in range(130)]
    texts = []
    for i in range(24):
        w = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(0, 400))]
        k = rng.randint(0, len(w))
        texts.append(" ".join(w[:k] + passage[rng.randint(0, 60) : rng.randint(70, 130)] + w[k:]))
    texts += ["x " * 180, " ".join(passage) + " \n", None, "a b", texts[3]]
    window = 12

    def parsed(text):  # in this process, where the sizes are changed
        return [(first, p) for _, firsts, p in substring._parse([_Text(text)], window) if not p.empty for first in firsts]

    for text in texts:
        starts = [f + at for f, p in parsed(text) for at in p.at.tolist()]
        assert sorted(set(starts)) == list(range(max(0, len((text or "").split()) - window + 1)))
        assert len(starts) == len(set(starts))
    owned = {}
    for text in texts:  # equal windows own equal anchors, wherever stretches are cut
        words = (text or "").split()
        for f, p in parsed(text):
            for head, n, anchor in zip(p.head.tolist(), p.count.tolist(), p.anchor.tolist()):
                for at in (p.at[head : head + n] + f).tolist():
                    assert owned.setdefault(tuple(words[at : at + window]), anchor) == anchor


class _Text(str):
    def __new__(cls, text):
        return super().__new__(cls, text or "")

    def as_py(self):
        return str(self)
