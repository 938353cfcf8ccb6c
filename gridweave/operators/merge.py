"""Deduplication by a normal form with first-wins values and merged references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_equal(df: DataFrame, group: list[str], key: Column, order: str, first: list[str], refs: list[str] = (), occurrence: list[str] = ()) -> DataFrame:
    """One row for each group and key: the `first` columns of the first row in order, the arrays `refs` united in order of
    first appearance, the `occurrence` columns as an ordered list of structs, and n_occurrences.

    The key is hashed to a fixed width for the shuffle of the aggregation. A null key is a key of its own.
    """
    keyed = df.withColumn("_key", F.sha2(F.coalesce(F.concat(F.lit("="), key), F.lit("")), 256))
    firsts = [F.min_by(F.struct(*first), order).alias("_first")] if first else []
    united = [F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_at"), F.coalesce(r, F.array().cast(dict(df.dtypes)[r])).alias("_v")))), lambda x: x["_v"]))).alias(r) for r in refs]
    occ = [F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_at"), F.struct(*occurrence).alias("_v")))), lambda x: x["_v"]).alias("occurrences")] if occurrence else []
    out = keyed.groupBy(*group, "_key").agg(*firsts, F.min(order).alias("first_order"), *united, *occ, F.count(F.lit(1)).alias("n_occurrences"))
    return out.select(*group, *(["_first.*"] if first else []), "first_order", *refs, *(["occurrences"] if occurrence else []), "n_occurrences")


def display_markers(df: DataFrame, group: list[str], marker: str, number: str, name: str = "display", order: str | None = None) -> DataFrame:
    """group and its markers as text: T1:e, T2-4:a; numbers of a marker as a range if they follow one another without repeat,
    else as a list; markers by their smallest number, then by their first row in `order`, else by themselves."""
    first = (F.min(order) if order else F.min(marker)).alias("_f")
    per = df.groupBy(*group, marker).agg(F.sort_array(F.collect_list(number)).alias("_n"), first)
    low, high, n = F.array_min("_n"), F.array_max("_n"), F.size("_n")
    spread = (n > 1) & (F.size(F.array_distinct("_n")) == n) & (high - low + 1 == n)
    body = F.when(n == 1, low.cast("string")).when(spread, F.concat(low.cast("string"), F.lit("-"), high.cast("string"))).otherwise(F.array_join(F.transform("_n", lambda x: x.cast("string")), ","))
    text = per.select(*group, low.alias("_low"), F.col("_f").alias("_m"), F.concat(F.lit("T"), body, F.lit(":"), F.col(marker)).alias("_t"))
    return text.groupBy(*group).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_low", "_m", "_t"))), lambda x: x["_t"]), ", ").alias(name))
