import random

import numpy as np
import pytest

from gridweave.llm import packing
from gridweave.llm.packing import Capacity


def check(rows, sizes, cap):
    """Every item once, its pieces whole and in order, no capacity exceeded, no overlap in a container."""
    by_item, bins = {}, {}
    for doc, piece, n, container, start, place in rows:
        by_item.setdefault(doc, []).append((piece, n))
        bins.setdefault(container, []).append((start, n, place))
    assert {d: sum(n for _, n in p) for d, p in by_item.items()} == sizes
    for d, p in by_item.items():
        p.sort()
        assert [x for x, _ in p] == list(range(1, len(p) + 1)) and all(n == cap.longest for _, n in p[:-1])
        assert len(p) == 1 or sizes[d] > cap.longest
    for items in bins.values():
        items.sort(key=lambda x: x[2])
        assert [x[2] for x in items] == list(range(1, len(items) + 1)) and len(items) <= cap.documents
        at = 0
        for start, n, _ in items:
            assert start == at
            at += n
        assert at <= cap.tokens
        if cap.attention:
            assert sum(n * n for _, n, _ in items) <= cap.attention
    assert sorted(bins) == list(range(len(bins)))
    return len(bins)


def pack(spark, sizes, cap):
    df = spark.createDataFrame([(d, n, "clash") for d, n in sizes.items()], "id long, n long, piece string")
    return [tuple(r) for r in packing.pack(df, "id", "n", cap).collect()]


@pytest.mark.parametrize("cap", [Capacity(100), Capacity(100, rule="dot"), Capacity(100, documents=3), Capacity(100, attention=2500), Capacity(100, documents=4, attention=6000, rule="dot"), Capacity(100, attention=10_000), Capacity(100, attention=10**6, rule="dot")])
def test_random_items(spark, cap):
    rng = random.Random(1)
    sizes = {i: rng.choice([0, 1, 7, 33, 50, 50, 99, 100, 101, 250, rng.randrange(100)]) for i in range(500)}
    n = check(pack(spark, sizes, cap), sizes, cap)
    if cap == Capacity(100):
        assert n <= -(-sum(sizes.values()) // 100) * 1.03 + 1


def test_hot_size_and_edges(spark):
    cap = Capacity(10)
    assert check(pack(spark, dict.fromkeys(range(300), 5), cap), dict.fromkeys(range(300), 5), cap) == 150
    assert pack(spark, {}, cap) == []
    zeros = dict.fromkeys(range(600), 0)
    assert check(pack(spark, zeros, cap), zeros, cap) == 3
    df = spark.createDataFrame([(1, None), (2, 4), (2, 4)], "id long, n long")
    got = packing.pack(df, "id", "n", cap).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == [(1, 0), (2, 4), (2, 4)] and len({(r["container"], r["place"]) for r in got}) == 3


def test_hot_sizes_are_ranked_in_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE_ROWS", 7)
    rng = random.Random(2)
    sizes = {i: rng.choice([5, 5, 5, 0, rng.randrange(12), 25]) for i in range(400)}
    check(pack(spark, sizes, Capacity(10)), sizes, Capacity(10))


def test_attention_chooses_among_equal_room():
    """Two containers with as much room: a short item goes to the one whose documents cost less, whose attention room it fills least."""
    counts = np.zeros(101, np.int64)
    counts[[80, 40, 20]] = [1, 2, 1]
    places = {}
    for att in (None, 10_000):
        runs, bins = packing.best_fit(counts, Capacity(100, attention=att, weights=(1.0, 0.0, 1.0)))
        places[att] = {(int(s), int(rank)): int(c) for s, rank, _, c, _, _ in runs}
        assert bins == 2
    assert places[10_000][20, 0] == places[10_000][80, 0] and places[None] != {}


def test_best_fit_of_single_items():
    """With one item of each size the classes hold one container each: the plain best-fit decreasing."""
    rng = random.Random(3)
    sizes = sorted(rng.sample(range(1, 1000), 200), reverse=True)
    left = []
    for s in sizes:
        fit = [i for i, r in enumerate(left) if r >= s]
        if fit:
            left[min(fit, key=lambda i: left[i])] -= s
        else:
            left.append(1000 - s)
    counts = np.bincount(sizes, minlength=1001)
    _, bins = packing.best_fit(counts, Capacity(1000, weights=(1.0, 0.0, 0.0)))
    assert bins == len(left)


def test_work_does_not_grow_with_items():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, 513)
    few, _ = packing.best_fit(counts, Capacity(512))
    many, bins = packing.best_fit(counts * 10_000, Capacity(512))
    assert len(many) < 20 * len(few) and bins * 512 < (counts * 10_000 * np.arange(513)).sum() * 1.02
