import random
import re

import pytest

from gridweave.functions.markers import DISPLAY_CHARS, MARKER_CHARS, values_of
from gridweave.operators import packed

BRUTE = re.compile(r'"((?:[^"]|"")*)"|\'([^\']*)\'|“([^”]*)”|([%s]+)' % MARKER_CHARS)


def brute(text):
    out = []
    for m in BRUTE.finditer(text or ""):
        v = m[1].replace('""', '"') if m[1] is not None else m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
        if v:
            out.append(v)
    return out


CASES = [
    "a,b", "a, b ;c", '"a b";c', "'x,y'|z", "“n 1/2”, k", '"10""2" 3', "10\"2", "a''b", "", "  ", None, ",", "c1,,c2", "‡‡ ,§", "w & w", "a\nb\tc", "i，a、b·c", "(c1)(c2)",
    '"a""b', '"""a""", b', "'a", "“a”“b”", '""', "a" * 5000 + ",b", '"' + "x" * 20000 + '",y', '"' + '""' * 3000 + ",z", "T1:c1, T2-4:d", "é1,ü2", "a;a;a", '"q" \'r\' “s” t',
]


def split(spark, rows, chars=MARKER_CHARS, least=2):
    df = spark.createDataFrame(rows, "id long, field string, item_pos string, fid int, n string")
    got = packed.split_packed(df, ["id"], "field", chars, least)
    return sorted((r["id"], r["item_pos"], r["item_value"]) for r in got.collect())


def want(rows, least=2):
    return sorted((i, p, v) for i, f, *_ in rows if len(brute(f)) >= least for p, v in enumerate(brute(f), 1))


def test_values_follow_the_rule(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "i int, f string")
    got = {r["i"]: r["v"] for r in df.select("i", values_of(F.col("f"), MARKER_CHARS).alias("v")).collect()}
    for i, c in enumerate(CASES):
        assert (got[i] or []) == brute(c), c[:40]


def test_split_equals_the_rule(spark):
    rows = [(i, c, "clash", 0, "x") for i, c in enumerate(CASES)]
    assert split(spark, rows) == want(rows)
    assert split(spark, rows, least=1) == want(rows, 1)


@pytest.mark.parametrize("hot", [False, True])
def test_random_fields(spark, make_hot, hot):
    if hot:
        make_hot(packed, 2)
    rng = random.Random(3)
    bits = ["a", "c1", "‡", '"', "'", "“", "”", ",", ";", " ", "|", "/", "-", '""', "x y", "\n"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(9))), "", 0, "") for i in range(400)] + [(1000 + i, "a, b", "", 0, "") for i in range(200)]
    assert split(spark, rows) == want(rows)


def test_dialects(spark):
    fields = [(1, "a,b"), (2, "a,b"), (3, "c;d"), (4, "a,b;c"), (5, '"a b",c'), (6, "alone")] + [(i, f"only{i}") for i in range(10, 30)]
    df = spark.createDataFrame(fields, "id long, field string")
    got = {r["id"]: r["dialect"] for r in packed.split_packed(df, ["id"], "field", MARKER_CHARS, 1).collect()}
    assert got[1] == got[2] == "comma/none" and got[3] == "semicolon/none" and got[4] == "any/all" and got[5] == "comma/double" and got[6] == "whole/none"


def test_empty_and_display(spark):
    assert split(spark, []) == []
    assert split(spark, [(1, "T1:c1, T2-4:d", "", 0, "")], DISPLAY_CHARS) == [(1, 1, "T1:c1"), (1, 2, "T2-4:d")]
