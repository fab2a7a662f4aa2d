"""The set join next to all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from relayframe.llm import jaccard_join, queries
from tests.llm.helpers import SCHEMA, documents

SF_DIR = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:], words[2:]))


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    owners = {}
    for i, s in enumerate(sets):
        for x in s:
            owners.setdefault(x, []).append(i)
    pairs = {p for held in owners.values() for p in combinations(held, 2)}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(s), least.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr)


def write(spark, path, rows):
    documents(spark, [t for _, t in rows], ids=[i for i, _ in rows]).repartition(3).write.parquet(f"{path}/documents.parquet")


def check(spark, path, rows):
    write(spark, path, rows)
    assert sorted(map(tuple, queries.op12_jaccard_join(spark, str(path)).collect()), key=repr) == plain(rows)


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def families(seed, n_families, copies, edits):
    rng = random.Random(seed)
    rows = []
    passage = [f"p{i}" for i in range(40)]
    for _ in range(n_families):
        words = [f"w{rng.randrange(3_000)}" for _ in range(rng.randint(60, 150))]
        words[10:10] = passage
        rows += [edited(rng, words, rng.randint(0, edits)) for _ in range(copies)]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


def test_families_and_a_shared_passage(spark, tmp_path):
    check(spark, tmp_path, families(1, 12, 8, 6))


def test_edge_cases(spark, tmp_path):
    texts = [None, "", " \t", "one", "ONE", "one two", "one  two", "one two three", "a b c d", None, "a b c d", "É é", "é é"]
    rows = list(enumerate(texts, 5)) + [(5, "a b c d"), (5, "a b c d"), (None, "one"), (None, "only here, null")]
    check(spark, tmp_path, rows)


def test_empty_table(spark, tmp_path):
    check(spark, tmp_path, [])


def test_star_of_edits_in_blocks(spark, tmp_path, monkeypatch):
    """Many edits of one text, each alike with it and hardly with each other, in blocks of two sets."""
    monkeypatch.setattr(jaccard_join, "SETS", 2)
    monkeypatch.setattr(jaccard_join, "BLOCKS", 2)
    check(spark, tmp_path, families(2, 1, 60, 4))


def test_small_groups_propose_the_same_pairs(monkeypatch):
    rng = np.random.default_rng(2)
    held = []
    for node in range(14):
        n = int(rng.integers(20, 30))
        others = [rng.integers(0, 6, 4, dtype=np.uint16).astype("<u2").tobytes() for _ in range(2)]
        held.append({"node": node, "component": node // 2, "n": n, "others": others})
    def shared(x, y):
        x, y = (np.frombuffer(o, "<u2").tolist() for o in (x, y))
        return min(sum(v in y for v in x), sum(v in x for v in y))

    needed = {
        (a["node"], b["node"])
        for a in held
        for b in held
        if a["node"] > b["node"] and a["component"] != b["component"]
        and 100 * min(a["n"], b["n"]) >= 90 * max(a["n"], b["n"])
        and all(shared(x, y) >= jaccard_join.needed_in_prefix(a["n"], b["n"], 90) for x, y in zip(a["others"], b["others"]))
    }
    assert needed and needed <= set(jaccard_join.pairs_of_group(held, 90))
    monkeypatch.setattr(jaccard_join, "FEW", 0)
    assert needed <= set(jaccard_join.pairs_of_group(held, 90))


def test_prefixes_meet_under_every_order():
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 3, jaccard_join.SLOTS, dtype=np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        gone = int(len(base) * 0.1)
        other = np.unique(np.concatenate([base[gone // 2 :], rng.integers(0, 2**63, gone // 3, dtype=np.uint64)]))
        if jaccard_join._alike(base, other, 90):
            for seed in jaccard_join.ORDERS:
                both = [jaccard_join.prefix(s, classes, seed, 90) for s in (base, other)]
                assert len(np.intersect1d(*both)) >= jaccard_join.needed_in_prefix(len(base), len(other), 90) >= 1


@pytest.mark.parametrize("sf_dir", [SF_DIR])
def test_query_on_its_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op12_jaccard_join(spark, sf_dir).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows)
    assert len({r["component_id"] for r in found}) < len(rows)


def test_the_first_shared_token_is_early_in_the_smaller_set():
    rng = np.random.default_rng(5)
    classes = rng.integers(0, 6, jaccard_join.SLOTS).astype(np.uint8)
    for n in (1, 2, 9, 10, 19, 20, 57, 300):
        for _ in range(60):
            base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            other = base[rng.random(len(base)) > rng.choice([0, 0.03, 0.08])]
            other = np.union1d(other, rng.integers(0, 2**63, rng.integers(0, n // 18 + 1), dtype=np.uint64))
            small, large = sorted((base, other), key=len)
            if len(small) and jaccard_join._alike(small, large, 90):
                first = [jaccard_join.prefix(s, classes, jaccard_join.ORDERS[0], 90) for s in (small, large)]
                length = jaccard_join.early_length(len(small), 90)
                early = jaccard_join.prefix(first[0], classes, jaccard_join.ORDERS[0], 90, length)
                assert len(early) == min(length, len(small)) and len(np.intersect1d(early, first[1]))


def test_members_that_hold_a_token_late_need_one_no_larger_that_holds_it_early(spark):
    # Token 7 is late in all; 8 is early in the set of 100 alone, which those of 95 are too small for.
    rows = [(1, 100, [8, 7], 1), (2, 95, [5, 7, 8], 1), (3, 95, [6, 7, 8], 1), (4, 104, [9, 8], 1), (5, 104, [9, 7], 1)]
    signatures = spark.createDataFrame(rows, "node long, n long, first array<long>, early long")
    found = {(r.token, r.node) for r in jaccard_join._members(signatures, 90).collect()}
    assert found == {(8, 1), (8, 4), (9, 4), (9, 5)}


def near(rng, n):
    """A set and one that may be alike."""
    base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    other = base[rng.random(len(base)) > rng.choice([0, 0.03, 0.08])]
    return base, np.union1d(other, rng.integers(0, 2**64, rng.integers(0, n // 12 + 2), dtype=np.uint64))


@pytest.mark.parametrize("common", [0, 0.3, 0.5, 0.9])
def test_alike_sets_have_something_early_in_common(common):
    rng = np.random.default_rng(6)
    classes = np.where(rng.random(jaccard_join.SLOTS) < common, rng.integers(0, 9, jaccard_join.SLOTS), 0).astype(np.uint8)
    met = 0
    for n in [*range(1, 60), 95, 100, 237, 700]:
        for _ in range(12):
            pair = sorted(near(rng, n), key=len)
            if not len(pair[0]) or np.array_equal(*pair) or not jaccard_join._alike(*pair, 90):
                continue
            (small, early), (large, _) = (jaccard_join.proposing(s, classes, 90) for s in pair)
            assert len(np.intersect1d(small[:early], large))
            met += 1
    assert met > 100


def test_sketches_differ_in_no_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(7)
    for n in (1, 9, 10, 50, 100, 237, 700, 1500):
        for a, b in [near(rng, n) for _ in range(20)]:
            differ = jaccard_join.sketches_differ(*(jaccard_join.sketch(s, 90) for s in (a, b)))
            assert differ <= len(np.setxor1d(a, b))


def test_texts_that_share_shingles_by_chance_do_not_meet(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefghijkl", k=100)) for _ in range(300)]
    docs = jaccard_join._docs(documents(spark, texts), "doc_id", "text")
    classes = jaccard_join.token_classes(jaccard_join._keys_and_counts(docs, 3))
    signatures = jaccard_join._signatures(docs, classes, 3, 90)
    # Every shingle is in some 17 texts.
    assert signatures.count() == 300 and not jaccard_join._members(signatures, 90).count()
