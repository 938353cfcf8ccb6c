import random
from datetime import datetime, timedelta

import pytest

from gridweave.operators import orphans

T0 = datetime(2024, 1, 1)
REFS = "id long, k1 string, k2 string, t timestamp_ntz, loaded_at string, reason string"
PARENTS = "k1 string, k2 string, loaded timestamp_ntz, deleted timestamp_ntz, id string"


def brute(refs, parents):
    out = []
    for i, k1, k2, t, *_ in refs:
        own = [(a, b) for p1, p2, a, b, *_ in parents if None not in (k1, k2) and (p1, p2) == (k1, k2)]
        by_then = [(a, b) for a, b in own if a is not None and (t is None or a <= t)]
        live = [1 for a, b in by_then if b is None or (t is not None and b > t)]
        if not live:
            out.append((i, "missing" if not own else "deleted" if by_then else "late"))
    return sorted(out)


def run(spark, refs, parents):
    r, p = spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS)
    got = orphans.find_orphans(r, p, ["k1", "k2"], "t", "loaded", "deleted", ["id"])
    assert got.columns == ["id", "reason"]
    return sorted(map(tuple, got.collect()))


def random_case(seed, n=300):
    rng = random.Random(seed)
    day = lambda most: None if rng.random() < 0.1 else T0 + timedelta(days=rng.randrange(most))
    key = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else rng.choice("abcdefgh")
    refs = [(i, key(), "x", day(20), "other", "clash") for i in range(n)]
    refs += refs[:5]
    parents = []
    for _ in range(n // 3):
        a, life = day(20), rng.randrange(6)
        parents.append((key(), rng.choice(["x", "x", "y", None]), a, None if a is None or rng.random() < 0.3 else a + timedelta(days=life), "clash"))
    return refs, parents + parents[:3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    refs, parents = random_case(seed)
    assert run(spark, refs, parents) == brute(refs, parents)


@pytest.mark.parametrize("seed", [4, 5])
def test_hot_keys_are_cut_without_changing_the_result(spark, make_hot, seed):
    make_hot(orphans, 10)
    refs, parents = random_case(seed, 600)
    assert run(spark, refs, parents) == brute(refs, parents)


def test_hot_key_of_one_moment(spark, make_hot):
    make_hot(orphans, 10)
    refs = [(i, "hot", "x", T0, "", "") for i in range(100)] + [(100, "hot", "x", T0 - timedelta(days=1), "", "")]
    parents = [("hot", "x", T0, None, "")] * 20
    assert run(spark, refs, parents) == [(100, "late")]


def test_edges(spark):
    t = T0
    assert run(spark, [], []) == []
    assert run(spark, [(1, "a", "x", t, "", "")], []) == [(1, "missing")]
    assert run(spark, [], [("a", "x", t, None, "")]) == []
    # deleted at the very moment is gone, loaded at the very moment is there
    assert run(spark, [(1, "a", "x", t, "", "")], [("a", "x", t, t, "")]) == [(1, "deleted")]
    assert run(spark, [(1, "a", "x", t, "", "")], [("a", "x", t, None, "")]) == []
    # a version that was never loaded exists, but is late
    assert run(spark, [(1, "a", "x", t, "", "")], [("a", "x", None, None, "")]) == [(1, "late")]


def test_report(spark):
    refs, parents = random_case(6)
    r, p = spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS)
    found = orphans.find_orphans(r, p, ["k1", "k2"], "t", "loaded", "deleted", ["id", "k2"])
    total = sum(x["n_refs"] for x in orphans.report(found, ["k2"]).collect())
    assert total == len(brute(refs, parents))
