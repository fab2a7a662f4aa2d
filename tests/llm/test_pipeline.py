"""The stages one by one over the small tables, each against plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline
from relayframe.llm import bpe, simhash, toxicity
from relayframe.llm.common import table
from relayframe.llm.queries import TOXIC_FROM

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    w = simhash.words_of(text)
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, frames = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF_DIR).cache())
    rows = [f.collect() for f in frames]
    assert all(f.columns == columns for f in frames[:-1])

    model = toxicity.fit(docs, table(spark, SF_DIR, "labels"))
    lexicon = toxicity.Lexicon(model.terms)

    def score(text):
        z = sum(a * b for a, b in zip(toxicity.features(lexicon, text), model.coefficients)) + (model.coefficients or [0])[-1]
        return 1 / (1 + 2.718281828459045**-z)

    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in rows[0] if not model.coefficients or score(r.text) < TOXIC_FROM}

    last = {}
    for r in rows[1]:
        last[r.text or ""] = max(last.get(r.text or "", -1), r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(last.values())

    sets = {r.doc_id: shingles(r.text) for r in rows[2]}
    near = {i: i for i in sets}

    def find(i):
        while near[i] != i:
            i = near[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                near[y] = x
    assert sorted(r.doc_id for r in rows[3]) == sorted(i for i in near if find(i) == i)

    copies = Counter(r.doc_id for r in rows[4])
    sizes = {r.doc_id: len(simhash.words_of(r.text)) for r in rows[3]}
    assert set(copies) <= set(sizes) and max(copies.values()) <= 2
    taken, total = defaultdict(int), 1.5 * sum(sizes.values())
    for r in rows[4]:
        taken[r.source] += sizes[r.doc_id]
    assert abs(sum(taken.values()) - total) <= len(taken) * max(sizes.values())

    assert Counter(r.doc_id for r in rows[5]) == copies
    texts = {r.doc_id: r.text or "" for r in rows[4]}
    tokenizer = bpe.tokenizer(corpus_pipeline.tokenizer_path(corpus_pipeline.BYTE_BPE))
    for r in rows[5]:
        assert r.decodes and bytes(r.ids) == tokenizer.encode_packed(texts[r.doc_id]) and r.n_tokens == len(r.ids) // 4


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "encoding"]
