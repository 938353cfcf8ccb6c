import os
import random
import unicodedata

import numpy as np
import pytest

from gridweave.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def own():
    with open(tokens.VOCABULARY, "rb") as f:
        return tokens.Encoder(tokens.read_ranks(f.read()))


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


HARD = [
    "", " ", "  ", "\n", " \n ", "a", " a", "a ", "  a", "a  b", "don't", "DON'T", "'s", " 's", "x's's", "''s", "'re're", "it'sabc", "we'llx", "'", "' ", "a'", " x", "x  y", "\t\tx", " \tx",
    "1234567890", " 12 345", "a1b2", "½²Ⅷ", "日本語のテキスト", "مرحبا بالعالم", "🙂🙃 👩‍👩‍👧", "<|endoftext|>", "a<|endoftext|>b", "\u0000\u0001", "​zero​width", "é é", "x" * 1000, "ab" * 700, " " * 500, "!?!?" * 200,
    "line\r\nline sep\u0085nel", "﻿bom", "…—–", "𝔘𝔫𝔦", " ogham", "tab\x1cfs\x1fus", "'d'm've", "o'clock I'd've", "a　b",
]


def ids_of(own, texts):
    counts, flat = own.encode_texts(texts)
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if texts else []


def test_hard_texts(own, reference):
    got = ids_of(own, HARD)
    for t, g, w in zip(HARD, got, reference(HARD)):
        assert g == w, repr(t[:40])


def test_random_texts(own, reference):
    rng = random.Random(1)
    pool = ["the", " lab", "'s", "'", " ", "  ", "\n", "A", "é", "ß", "1", "99", ".", "--", "日", "🙂", " ", "\t", "ing", "<|", "|>", "́"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert ids_of(own, texts) == reference(texts)


def test_every_sign(own, reference):
    signs = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    texts = [f"a{c}1{c}{c} {c}b" for c in signs]
    bad = [hex(ord(s)) for s, g, w in zip(signs, ids_of(own, texts), reference(texts)) if g != w]
    assert not bad


def test_backtracking_equals_merging(own):
    rng = random.Random(2)
    for _ in range(400):
        piece = bytes(rng.choice(b"abcdefgh eaotin\xc3\xa9\xe6") for _ in range(rng.randrange(1, 40)))
        assert own.encode(piece) == own.merge(piece)


def test_table(spark, reference):
    rows = [(1, None, "clash"), (2, "", "x"), (3, "Hello world", "x"), (3, "Hello world", "x"), (None, "no id", "x"), (4, "long text. " * 200_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"] or 0, len(r["ids"]), r["ids"][:5]) for r in tokens.encode(df, "doc_id", "text").collect()))
    want = sorted((i or 0, len(w), w[:5]) for (i, *_), w in zip(rows, reference([t or "" for _, t, _ in rows])))
    assert got == want
    counts = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in tokens.count(df, "doc_id", "text").collect())
    assert counts == [g[:2] for g in got]
    assert tokens.encode(df.where("false"), "doc_id", "text").count() == 0


def test_safe_cuts():
    text = "word  and more " * 30
    parts = tokens.safe_cuts(text, 50)
    assert "".join(parts) == text and all(p[0] == " " for p in parts[1:]) and len(parts) > 5
    assert tokens.safe_cuts("x" * 200, 50) == ["x" * 200]
