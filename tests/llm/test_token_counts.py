import os
import random

import pytest

from relayframe.llm import token_counts
from relayframe.llm.queries import PIECES, tokenizer_path
from tests.llm.helpers import documents


def library(vocabulary):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=vocabulary.byte_fallback)
    t = Tokenizer(model)
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_ties_and_unknown_characters(byte_fallback):
    rng = random.Random(1)
    for _ in range(150):
        pieces = {"<unk>": 0.0}
        if byte_fallback:
            pieces |= {f"<0x{b:02X}>": 0.0 for b in range(256)}
        for _ in range(12):
            piece = "".join(rng.choice("abcd▁é") for _ in range(rng.randint(1, 3)))
            pieces[piece] = rng.choice([-1.0, -2.0, -3.0, -2.5, -0.1])
        vocabulary = token_counts.Vocabulary(tuple(pieces.items()), byte_fallback)
        count, slow = token_counts.Counter(vocabulary), library(vocabulary)
        for _ in range(20):
            text = "".join(rng.choice("abcdexé日 \n") for _ in range(rng.randint(0, 30)))
            assert count.text(text) == slow(text), (text, pieces)


def test_rows(spark):
    path = tokenizer_path(PIECES)
    slow = library(token_counts.load_vocabulary(path))
    texts = [None, "", " ", "Hello, world", "日本 é\n\n", "z" * 20_000, "word " * 5_000, "a  b", "<s> <0x41>"]
    docs = documents(spark, texts + texts)
    got = [(r.id, r.n_tokens) for r in token_counts.token_counts(docs, path).collect()]
    assert sorted(got) == [(i, slow(t or "")) for i, t in enumerate(texts + texts)]
    assert token_counts.token_counts(docs.limit(0), path).count() == 0
