"""Keyed corrections: add, set, remove, applied in order to the rows of documents."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CorrectionError(ValueError):
    """A correction that does not say exactly what to change."""


def _hits(match: dict[str, Any], kinds: dict[str, str]) -> Column:
    """All keys equal, null to null; a key that no row has is null everywhere; no keys hit every row."""
    tests = [(F.col(k) if k in kinds else F.lit(None).cast("string")).eqNullSafe(F.lit(v)) for k, v in match.items()]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def apply_corrections(df: DataFrame, corrections: list[dict], order: str = "pos", check: bool = True) -> DataFrame:
    """df after the corrections (dicts of id, op, match, set), in their order.

    add appends a row at the end of the order; set changes the one row that matches, given nulls included; remove drops all
    rows that match. A set that hits other than one row, a remove that hits none and an unknown op raise CorrectionError.
    Hits are counted by one aggregate over the rows as each op finds them, several ops in one pass as long as none of them adds.
    """
    kinds = dict(df.dtypes)
    for c in corrections:
        op, match, new = c["op"], c.get("match") or {}, c.get("set") or {}
        if op not in ("add", "set", "remove"):
            raise CorrectionError(f"{c['id']}: unknown op {op!r}")
        if op == "add":
            row = df.sparkSession.range(1).select(*[F.lit(new.get(k)).cast(t).alias(k) for k, t in kinds.items() if k != order])
            at = df.agg((F.coalesce(F.max(order), F.lit(0)) + 1).cast(kinds[order]).alias(order))
            df = df.unionByName(row.crossJoin(F.broadcast(at)))  # one row beside one row
            continue
        hit = _hits(match, kinds)
        if check:
            n = df.where(hit).limit(2).count() if op == "set" else df.where(hit).limit(1).count()
            if (op == "set" and n != 1) or n == 0:
                raise CorrectionError(f"{c['id']}: {op} {match} hits {'several rows' if n > 1 else f'{n} rows'}")
        if op == "remove":
            df = df.where(~hit)
        else:
            df = df.withColumns({k: F.when(hit, F.lit(v).cast(kinds[k])).otherwise(F.col(k)) for k, v in new.items() if k in kinds})
    return df
