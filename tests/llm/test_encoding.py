import random

import numpy as np
import pytest

from ledgerloom.llm import encoding, queries

VOCAB = f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def encoder():
    return encoding.load(VOCAB)


ALPHABETS = ["ab", "abcdefgh'", "קדגכשלום", "a1!' \n", "  \n\tx", "'sret!", "é日本😀a", "aaaaab", "-=_.", "0123456789"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_tree_concatenation_is_exact(encoder, alphabet):
    rng = random.Random(7)
    for size in (1, 3, 7, 50, 333):
        for _ in range(20):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 2000)))
            pieces = encoding.cut(text, size)
            assert "".join(p for p, _ in pieces) == text
            parts = [encoding._ids(encoder, p) for p, _ in pieces]
            got = encoding.concatenate(encoder, parts, [s for _, s in pieces])
            assert got.tolist() == encoder.encode_ordinary(text)


def test_defined_cases(spark, encoder):
    long_unsplit, long_words = "אבגדהוזabc" * 700, "one two, three's; " * 500
    rows = [(1, None), (2, ""), (3, "x"), (4, "<|endoftext|>"), (5, long_unsplit), (6, long_words), (6, long_words), (None, "a b")]
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, ids string, key string")
    got = sorted(((r.doc_id, r.ids) for r in encoding.encode(df, "doc_id", "text", VOCAB, piece_chars=1000).collect()), key=str)
    want = sorted(((i, encoder.encode_ordinary(t) if t else []) for i, t in rows), key=str)
    assert got == want
    assert encoding.encode(df.limit(0), "doc_id", "text", VOCAB).count() == 0


def test_round_trip(encoder):
    text = "Überraschung — שלום, 12 quires or so\n\n" * 40
    ids = encoding._ids(encoder, text)
    assert ids.dtype == np.int32 and encoder.decode(ids.tolist()) == text
