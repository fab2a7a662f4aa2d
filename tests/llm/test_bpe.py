import os
import random

import pytest

from relayframe.llm import bpe
from relayframe.llm.queries import BYTE_BPE, tokenizer_path
from tests.llm.helpers import documents

PATH = tokenizer_path(BYTE_BPE)


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def in_pieces(tokenizer, text):
    ids, halves = [], []
    for kind, piece in tokenizer.pieces(text):
        if kind == "text":
            ids += bpe.unpack(tokenizer.encode_packed(piece))
        elif kind == "half":
            halves.append(tokenizer.encode_piece(piece))
        else:
            ids += tokenizer.join_all(halves)
            halves = []
    return ids


def test_joined_halves_are_the_encoding(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_CHARS", 150)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 24)
    rng = random.Random(5)
    unsplit = ["a", "b", "e", "th", "er", "in", "ing", "tion"]
    mixed = ["a", "the", " ", "  ", "\n", "é", "日本", "<|endoftext|>", "<|endo", "'s", "12", "!!", "ing"]
    texts = ["".join(rng.choice(unsplit) for _ in range(rng.randint(80, 600))) for _ in range(100)]
    texts += ["".join(rng.choice(mixed) for _ in range(rng.randint(50, 400))) for _ in range(100)]
    texts += [c * n + end for c in ("a", "\n", " ", "=", "日", "0") for n in (149, 150, 151, 1000) for end in ("", "x", " y")]
    for text in texts:
        assert in_pieces(bpe.tokenizer(PATH), text) == library.encode(text, add_special_tokens=False).ids


def test_rows(spark, library):
    texts = [None, "", "plain text", "日本 é", "<|endoftext|> x", "a" * 70_000, "a" * 70_000, "word " * 9_000]
    docs = documents(spark, texts)
    rows = bpe.encode_texts(docs, PATH, decode=True).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        text = texts[r.doc_id] or ""
        assert bpe.unpack(r.ids) == library.encode(text, add_special_tokens=False).ids
        assert r.decoded == text and r.key == "clash"
    again = bpe.decode_ids(bpe.encode_texts(docs, PATH).drop("text"), PATH).collect()
    assert {r.doc_id: r.decoded for r in again} == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.encode_texts(docs.limit(0), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Tokenizer(tokenizer_path("word_bpe_49k.json"))
