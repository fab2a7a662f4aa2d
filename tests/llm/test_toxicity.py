import random
import zlib

from relayframe.llm import toxicity
from relayframe.llm.toxicity import Lexicon, Term
from tests.llm.helpers import documents


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = random.Random(3)
    terms = [Term("".join(rng.choice("abc") for _ in range(rng.randint(2, 11))), False, 1.0) for _ in range(12)]
    terms += [Term("cabba", True, 1.0), Term("bbbb", True, 1.0)]
    lexicon = Lexicon(terms)
    for _ in range(4000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        near = [
            0 if t.is_stem else distance(word, t.text)
            for t in terms
            if (word.startswith(t.text) if t.is_stem else distance(word, t.text) <= toxicity.errors_allowed(t))
        ]
        found = lexicon.find(word)
        assert (found[1] if found else None) == min(near, default=None), word


def test_held_out_documents_are_told_apart(spark):
    rng = random.Random(5)
    clean = ["".join(rng.choice("aeioumnrst") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    bad = ["wretch", "villain", "scoundrel"]
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice(clean) for _ in range(40)]
        if i % 4 == 0:
            words[rng.randint(0, 39)] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append((i, int(i % 4 == 0), None))
    n = len(texts)
    texts += ["you are a vilain", 'he said the word "villain" once', None, "", "a b " * 30_000]
    docs = documents(spark, texts)
    frame = spark.createDataFrame(labels + [(None, 1, None), (9999, None, None)], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, frame)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(n) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all((scores[i] >= 0.3) == (i % 4 == 0) for i in held)
    assert scores[n] >= 0.3 > scores[n + 1]
    assert all(0 <= scores[n + i] < 0.3 for i in (2, 3, 4))
    assert toxicity.fit(docs, frame) == model


def test_without_labels(spark):
    docs = documents(spark, ["a", None])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0, 0.0]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_words_cut_up_by_signs_are_found():
    lexicon = Lexicon([Term("idiot", False, 3.0), Term("moron", False, 3.0), Term("scoundrels", False, 3.0), Term("vill", True, 3.0)])
    one = ["id1ot", "mor0n", "id*ot", "(mo_ron)", "sc0undre1s", "x,id1ot!", "id-iot", "idiot,id1ot"]
    assert [len(lexicon.spelled(s)) for s in one] == [1] * 7 + [2]
    assert [lexicon.spelled(s) for s in ("id11ot", "i.d.1.o.t", "a1b", "2024", "id1 ot")] == [[]] * 5
    assert lexicon.spelled("vill-ain") == [(0, 4, (3, 0))]
    plain, near = toxicity.features(lexicon, "what an id1ot you are")[:2]
    assert plain == 0 and near > 0


def test_terms_with_marks_and_misspelled_stems_are_learned_and_found(spark):
    marked = "e\u0301cre\u0301tin"
    rows = [(f"day {i} {marked} wretched", 1) if i % 2 else (f"day {i} fine calm", 0) for i in range(60)]
    rows += [(f"day {i} wretches", 1) for i in range(60, 80)]
    train = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "id long, text string, toxic int")
    terms = toxicity._learned_terms(train)
    lexicon = Lexicon(terms)
    assert lexicon.spelled(marked) and lexicon.spelled(marked)[0][:2] == (0, len(marked))
    assert any(t.is_stem and "wretched".startswith(t.text) for t in terms)
    assert {"wretched", "wretches"} <= {t.text for t in terms if not t.is_stem}
    assert [len(lexicon.spelled(w)) for w in ("wret0hed", "wr3tches")] == [1, 1]


def test_terms_need_evidence_and_have_no_limit(spark):
    """Words of toxic documents against their counts in plain Python; more terms than any fixed limit of before."""
    rng = random.Random(4)
    common = [f"common{c}" for c in "abcdefghij"]
    rude = ["x" + "".join(rng.choice("bcdfghklmnprst") for _ in range(9)) for _ in range(2_300)]
    rows = [(i, i % 4 == 0, rng.sample(common, 5) + (rude if i % 4 == 0 and i < 80 else [])) for i in range(400)]
    rows += [(400 + i, False, [rude[0]]) for i in range(40)]  # a rude word that clean documents hold as well
    train = spark.createDataFrame([(i, int(t), " ".join(w)) for i, t, w in rows], "id long, toxic int, text string")
    got = {t.text for t in toxicity._learned_terms(train.select("toxic", "id", "text")) if not t.is_stem}
    assert got == set(rude[1:])
    few = train.where("id < 4 or toxic = 0")
    assert not toxicity._learned_terms(few.select("toxic", "id", "text"))
