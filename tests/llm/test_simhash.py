import random

import numpy as np
import xxhash

from relayframe.llm import simhash
from tests.llm.helpers import documents


def slow_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, monkeypatch):
    texts = [None, "", " \n", "One", "a b", "A b c", "É é x\x0by z", "w " * 500, "ÀB cd ef gh ij kl"]
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert [simhash.fingerprint(t) % 2**64 for t in texts] == [slow_fingerprint(t) for t in texts]


def components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_index_finds_every_link(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in list(fps):
        for bits in (1, 3, 4):
            g = f
            for b in rng.sample(range(64), bits):
                g ^= 1 << b
            fps.append(g)
    fps += [0, 2**64 - 1, 2**63, 7] * 3
    rows = [(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "id long, fingerprint long")
    got = {r.id: r.component_id for r in simhash.near_components(df).collect()}
    assert [got[i] for i in range(len(fps))] == components(fps, 3)


def test_small_blocks_lose_no_link(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 40, np.int64)
    fps = np.unique(np.concatenate([base, base ^ 1, base ^ 6, base ^ (7 << 40), base ^ (15 << 50)]))
    df = spark.createDataFrame([(int(f),) for f in fps], "fingerprint long")
    links = simhash.fingerprint_links(df, 3, block=16)
    from relayframe.llm.components import connected_components

    roots = {r.node: r.root for r in connected_components(links).collect()}
    want = components([int(f) % 2**64 for f in fps], 3)
    got = [roots.get(int(f), int(f)) for f in fps]
    assert len(set(got)) == len(set(want)) and len(set(zip(got, want))) == len(set(want))


def test_near_copies_and_what_stays(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [[word() for _ in range(120)] for _ in range(12)]
    texts = [" ".join(b) for b in base]
    for b in base[:6]:  # one word of 120 is changed: 111 of 121 shingles stay
        texts.append(" ".join([*b[:60], word(), *b[61:]]))
    for b in base[6:9]:  # a word in ten is changed: far below 0.8
        texts.append(" ".join(word() if i % 10 == 0 else w for i, w in enumerate(b)))
    texts += [texts[0], "", None, "", "one two", "one two"]
    out = simhash.drop_near_duplicates(documents(spark, texts))
    assert out.columns == documents(spark, texts).columns
    kept = sorted(r.doc_id for r in out.collect())
    assert kept == [*range(12), 18, 19, 20, 22, 23, 24, 25]


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert simhash.near_components(simhash.fingerprints(docs)).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_star_of_edits_is_one_group(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    original = [word() for _ in range(300)]
    texts = [original]
    for _ in range(200):  # six words far from each other are changed: 30 of 296 shingles
        edit = list(original)
        for slot in rng.sample(range(20), 6):
            edit[slot * 15 + rng.randint(0, 9)] = word()
        texts.append(edit)
    texts.append([word() for _ in range(300)])
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    root = list(range(len(texts)))  # brute force
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and alike(sets[i], sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    assert len(set(root)) == 2 and not any(alike(sets[i], sets[i + 1]) for i in range(1, 200))
    got = {r.text_key: r.component for r in simhash.near_copies(documents(spark, [" ".join(t) for t in texts])).collect()}
    assert len(got) == 201 and len(set(got.values())) == 1
