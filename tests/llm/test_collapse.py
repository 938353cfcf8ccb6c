import random
import re

import pytest
from pyspark.sql import functions as F

from gridweave.llm import collapse

SCHEMA = "id long, p string, a int, kind string, text string, occ int, key string, keep string"


def canon(kind, text):
    plain = lambda s: "".join(c for c in s if c.isalnum()).lower()
    k = plain(kind or "")
    if text is None:
        return None
    if k in ("abbreviation", "legend"):
        t = "\x01".join(sorted(e for e in map(plain, re.split(r"[;\n\r\x0b\x0c\x85  ]+", text)) if e))
    else:
        t = plain(text)
    return (k, t) if t else None


def frames(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    kind, text = collapse.note_key(F.col("kind"), F.col("text"))
    return collapse.keyed(df, "id", [F.col("p"), F.col("a"), kind], text, {c: F.col(c) for c in ("p", "a", "occ")})


def brute(rows):
    groups = {}
    for i, p, a, kind, text, occ in rows:
        if (c := canon(kind, text)) is not None:
            groups.setdefault((p, a, c), []).append((i, occ))
    kept = {(min(i for i, _ in g), len(g), sum(o for _, o in g if o is not None) if any(o is not None for _, o in g) else None) for g in groups.values()}
    pairs = sorted((min(i for i, _ in g), i) for g in groups.values() for i, _ in g if i != min(j for j, _ in g))
    return kept, pairs


def sample(seed, n=300):
    rng = random.Random(seed)
    texts = ["Not  fasting.", "not fasting", "NOT-FASTING!", "A=b; C=d", "C = d;\nA = b", "C=d; A=b; A=b", "", " .", None, "Ünïcode², ok", "ünïcode² OK", "x" * 3000, "X" * 3000 + "!"]
    rows = [(i, rng.choice(["p", None]), rng.choice([0, 1, None]), rng.choice(["footnote", "Foot-note", "legend", "LEGEND.", "abbreviation", None]), rng.choice(texts), rng.choice([1, 2, None])) for i in range(n)]
    return rows + [(1000 + i, "hot", 0, "footnote", rng.choice(["Hot note", "hot  NOTE"]), 1) for i in range(n // 2)]


@pytest.mark.parametrize("hot", [False, True])
def test_against_brute_force(spark, make_hot, hot):
    if hot:
        make_hot(collapse, 20)
    rows = sample(1)
    kept, pairs = brute(rows)
    keyed = frames(spark, rows)
    assert {(r["keep_key"], r["n_copies"], r["total"]) for r in collapse.collapse(keyed, "occ").collect()} == kept
    assert sorted(map(tuple, collapse.copies(keyed).collect())) == pairs


def test_empty_and_repeated(spark):
    assert collapse.copies(frames(spark, [])).count() == 0 and collapse.collapse(frames(spark, []), "occ").count() == 0
    rows = [(1, "p", 0, "footnote", "x", 1)] * 3
    assert collapse.copies(frames(spark, rows)).count() == 0
    assert collapse.collapse(frames(spark, rows), "occ").first()["n_copies"] == 3
