"""Alignment of two tokenizers next to a plain version over the libraries themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from relayframe.llm import alignment, queries
from tests.llm.helpers import SCHEMA

A_PATH, B_PATH = (queries.tokenizer_path(p) for p in (queries.BYTE_BPE, queries.PIECES))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_level():
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {c: b for b, c in zip(plain + [b for b in range(256) if b not in plain], [*map(chr, plain), *map(chr, range(256, 324))])}


@pytest.fixture(scope="module")
def plain():
    one = Tokenizer.from_file(A_PATH)
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    chars = byte_level()

    def piece(i):
        p = other.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if other.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        a, b = one.encode(" " + text, add_special_tokens=False).ids, other.encode(text)
        tokens = [[(i, bytes(chars[c] for c in one.id_to_token(i))) for i in a], [(i, piece(i)) for i in b]]
        if any(b"".join(x for _, x in side) != (" " + text).encode() for side in tokens):
            return []
        ends = [list(np.cumsum([len(x) for _, x in side])) for side in tokens]
        common = np.array(sorted(set(ends[0]) & set(ends[1])))
        found = [([], []) for _ in common]
        for side, (ids, side_ends) in enumerate(zip((a, b), ends)):
            for i, end in zip(ids, side_ends):
                found[np.searchsorted(common, end)][side].append(i)
        return found

    def corpus(texts):
        every = [groups(t) for t in texts]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for g in every]
        counts = Counter(p for found in links for p in found)
        most = defaultdict(int)
        for (a, _), n in counts.items():
            most[a] = max(most[a], n)
        for g, found in zip(every, links):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            yield (
                sum(len(a) for a, _ in g),
                sum(len(b) for _, b in g),
                len(g),
                sum(found.values()),
                sum(n for p, n in found.items() if counts[p] == most[p[0]]),
                sum(n * counts[p] for p, n in found.items()),
                hashlib.sha256(text.encode()).hexdigest() if g else "",
            )

    return corpus


TEXTS = [
    None, "", " ", "  two  spaces ", "Hello, world! Hello world.", "<|endoftext|> and <s></s> <unk>", "a▁b", "\t\n\r\n x",
    "naïve café — ŒUVRE ﬁ ２３", "日本語のテキスト 🦜🦜👩‍👩‍👧", "é   ​", "=" * 100 + "-" * 37, "x" * 3000,
    "1234567890" * 30, "Hello, world! Hello world.", "\x00 nul", "éa" * 200, " ".join(["word"] * 500),
]


def write(spark, path, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "en", "s", 0, "clash", 1, "clash") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")


def test_hard_texts(spark, tmp_path, plain):
    write(spark, tmp_path, TEXTS)
    found = queries.op13_alignment(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found] == list(plain(TEXTS))


def test_repeated_rows_count_apart(spark, tmp_path, plain):
    texts = ["Hello, world!", "Hello, world!", "Hello"]
    write(spark, tmp_path, texts, [7, 7, None])
    found = queries.op13_alignment(spark, str(tmp_path)).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in found) == sorted(plain(texts))


def test_query_on_its_table(spark, plain):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    found = queries.op13_alignment(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found] == list(plain([d["text"] for d in docs]))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_alignment(spark, str(tmp_path)).collect() == []


def test_long_text_equals_library(plain):
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("aeioustrn,.é😀", k=rng.randint(1, 9))) for _ in range(9_000)) + "z" * 20_000
    found = alignment.align_text(text, A_PATH, B_PATH)
    expected = next(plain([text]))
    assert found[:4] == expected[:4]
    assert hashlib.sha256(found[4].encode()).hexdigest() == expected[6]


def test_group_ends_of_any_cuts():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(1, 60)
        a, b = (sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))}) for _ in range(2))
        if rng.random() < 0.5:
            b = sorted(set(a) ^ {rng.randint(1, n)} | {n})
        common = sorted(set(a) & set(b))
        assert alignment.group_ends(a, b) == ([a.index(c) + 1 for c in common], [b.index(c) + 1 for c in common])


def test_large_groups_count_the_same(monkeypatch):
    text = "éa" * 50 + " some words, and 日本語 " * 20
    usual = alignment.align_text(text, A_PATH, B_PATH)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    large = alignment.align_text(text, A_PATH, B_PATH)
    assert [list(x) for x in usual[5:]] == [list(x) for x in large[5:]] and usual[:5] == large[:5]


def test_empty_stretches_cut_no_lists():
    class Ends(list):
        cuts = 0

        def __getitem__(self, at):
            Ends.cuts += isinstance(at, slice)
            return super().__getitem__(at)

    a, b = Ends(range(2, 202, 2)), Ends(sorted({*range(1, 200, 2), *range(4, 201, 4)}))
    ends = alignment.group_ends(a, b)
    assert [a[i - 1] for i in ends[0]] == [b[j - 1] for j in ends[1]] == list(range(4, 201, 4))
    assert Ends.cuts == 0


def test_ends_of_groups_are_made_in_arrays():
    """A text's groups are told without a list entry of their own for each one-to-one group."""
    found = alignment._group_ends([1, 2, 3, 5, 9, 10], [1, 2, 3, 4, 9, 10])
    assert [x.dtype for x in found] == [np.int64] * 2
    assert [x.tolist() for x in found] == [[1, 2, 3, 5, 6]] * 2
    assert [x.tolist() for x in alignment._group_ends([], [])] == [[], []]
