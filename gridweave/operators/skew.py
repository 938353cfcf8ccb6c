"""Helpers against hot keys: exact detection, and joins that never send a hot key through one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds at least this share of the rows, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 512
#: ... and at least so many rows; below that, no task suffers.
HOT_ROWS = 5000


def hot_keys(rows: DataFrame, key: str, weight: str | None = None, share: float = HOT_SHARE, least: int = HOT_ROWS) -> list:
    """Values of `key` that hold at least `share` of all rows (or of the summed `weight`) and at least `least`.

    Counted exactly, with partial counts before the shuffle. The result has at most 1 / share entries whatever the size of
    the data, so it may be collected; callers pass keys of fixed width (hashes). A null key is never reported.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias("_n")).where(F.col("_n") >= least)
    top = counts.orderBy(F.desc("_n")).limit(math.ceil(1 / share)).collect()
    if not top:
        return []
    total = rows.agg(n.alias("_n")).first()["_n"] or 0
    return [r[key] for r in top if r["_n"] >= share * total]


def is_in(key: Column | str, values: list) -> Column:
    """key in values, false for a null key and for no values."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(c.isin(values), F.lit(False)) if values else F.lit(False)


def lookup_join(rows: DataFrame, table: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """Join rows with a table that has one row of fixed width per key.

    Rows of hot keys meet the at most len(hot) table rows by broadcast, where they are; all others by a shuffle on the key.
    """
    if not hot:
        return rows.join(table, key, how)
    few = F.broadcast(table.where(is_in(key, hot)))
    cold = rows.where(~is_in(key, hot)).join(table.where(~is_in(key, hot)), key, how)
    return rows.where(is_in(key, hot)).join(few, key, how).unionByName(cold)
