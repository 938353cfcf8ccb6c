import random

import numpy as np
import pytest

from gridweave.llm import spans


def brute(docs, k):
    seen = {}
    for d, t in docs:
        for i in range(len(t or "") - k + 1):
            seen.setdefault(t[i : i + k], set()).add(d)
    out = set()
    for d, t in docs:
        covered = np.zeros(len(t or "") + 1, int)
        for i in range(len(t or "") - k + 1):
            if len(seen[t[i : i + k]]) > 1:
                covered[i : i + k] = 1
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered])))
        out |= {(d, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])}
    return out


def corpus(seed, n=60, k=30):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha ", "be ta", "é🙂", "\n", "gamma-", "x", "0123"])
    make = lambda size: "".join(word() for _ in range(size))
    shared = [make(20) for _ in range(5)]
    docs = []
    for i in range(n):
        parts = [make(rng.randrange(15)) for _ in range(4)]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(4), rng.choice(shared))
        docs.append((i, "".join(parts)))
    docs += [(n, docs[0][1]), (n + 1, "aaaa" * 40), (n + 2, "aaaa" * 50), (n + 3, None), (n + 4, ""), (n + 5, "y" * (k - 1)), (n + 6, docs[3][1] + docs[3][1])]
    return docs


def run(spark, docs, k, **kw):
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, mini string")
    return {tuple(r) for r in spans.shared_spans(df, "doc_id", "text", k, **kw).collect()}


@pytest.mark.parametrize("seed, kw", [(1, {}), (2, {}), (3, {"bucket_signs": 60}), (4, {"bucket_signs": 0}), (6, {"bucket_signs": 0, "hash_bytes": 1}), (7, {"bucket_signs": 0, "hash_bytes": 0})])
def test_against_brute_force(spark, seed, kw):
    docs = corpus(seed)
    assert run(spark, docs, 30, m=10, **kw) == brute(docs, 30)


def test_hot_minimisers_and_windows(spark, make_hot):
    make_hot(spans, 3)
    docs = corpus(5) + [(100 + i, "the same boiler plate of all these texts, " * 3 + str(i)) for i in range(20)]
    docs += [(200 + i, "one text that stands here many times over and over again") for i in range(10)]
    assert run(spark, docs, 30, m=10) == brute(docs, 30)


def test_large_buckets_of_one_sign_and_of_boilerplate(spark):
    """Texts of one repeated sign, each of its own length, and texts around one boilerplate: as many windows as signs, few of them different."""
    docs = [(i, "a" * (200 + 7 * i)) for i in range(400)]
    got = run(spark, docs, 200, bucket_signs=1000)
    assert got == {(i, 0, 200 + 7 * i) for i in range(400)}
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    plate = noise(1500)
    docs = [(i, noise(100 + i) + plate + noise(50)) for i in range(200)]
    got = run(spark, docs, 200, bucket_signs=5000)
    assert len(got) == 200 and all(a <= 100 + d and b >= 1600 + d and b - a < 1520 for d, a, b in got)


def test_edges(spark):
    assert run(spark, [], 30, m=10) == set()
    text = "a text that is long enough to hold a window"
    assert run(spark, [(1, text), (1, text)], 30, m=10) == set()
    assert run(spark, [(1, text), (None, text)], 30, m=10) == set()
    assert run(spark, [(1, text), (2, text)], len(text), m=10) == {(1, 0, len(text)), (2, 0, len(text))}
    assert run(spark, [(1, text), (2, text)], len(text) + 1, m=10) == set()


def test_windows_share_their_bucket():
    rng = random.Random(7)
    a = "".join(rng.choice("abc") for _ in range(300))
    b = "".join(rng.choice("abc") for _ in range(50)) + a[40:260]
    cp = spans.code_points([a, b])
    mini, owner, start, n = spans.super_kmers(cp, np.array([len(a), len(b)]), 60, 16)
    of = {(o, s + i): m for m, o, s, c in zip(mini.tolist(), owner.tolist(), start.tolist(), n.tolist()) for i in range(c)}
    assert len(of) == (300 - 59) + (270 - 59)
    for i in range(220 - 59):
        assert of[0, 40 + i] == of[1, 50 + i]


def test_colliding_hashes_fall_back(monkeypatch):
    monkeypatch.setattr(spans, "rolling", lambda cp, length, base: np.zeros(max(0, len(cp) - length + 1), np.uint64))
    texts = ["abcdefgh", "xbcdefgy", "zzzzzzzz"]
    flags = spans.repeated_windows(texts, np.array([1, 2, 3]), 5)
    assert flags.tolist() == [False, True, True, False, False, True, True, False] + [False] * 4


def test_share(spark):
    df = spark.createDataFrame([(1, "x" * 10), (2, None), (3, "")], "doc_id long, text string")
    found = spark.createDataFrame([(1, 0, 4)], "doc_id long, start_pos int, end_pos int")
    got = {r["doc_id"]: (r["n_chars"], r["n_shared"], r["share"]) for r in spans.shared_share(df, "doc_id", "text", found).collect()}
    assert got == {1: (10, 4, 0.4), 2: (0, 0, 0.0), 3: (0, 0, 0.0)}
