"""Runs, gaps, clusters and bands along an ordered axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, group: list[str], order: list[str], breaks: Column, name: str = "island") -> DataFrame:
    """df numbered by island: a new one starts at every row where `breaks` is true (it may use lag over the same order)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_new", F.coalesce(breaks, F.lit(True)).cast("int")).withColumn(name, F.sum("_new").over(w)).drop("_new")


def gap_islands(df: DataFrame, group: list[str], axis: str, gap: float, ties: list[str] = ()) -> DataFrame:
    """Islands of values no further apart than gap."""
    w = Window.partitionBy(*group).orderBy(axis, *ties)
    return islands(df, group, [axis, *ties], F.col(axis) - F.lag(axis).over(w) > gap)


def runs(df: DataFrame, group: list[str], axis: str, gap: float = 1, ties: list[str] = ()) -> DataFrame:
    """group, first, last and number of rows of each island."""
    return gap_islands(df, group, axis, gap, ties).groupBy(*group, "island").agg(F.min(axis).alias("first"), F.max(axis).alias("last"), F.count(F.lit(1)).alias("n"))


def longest_run(df: DataFrame, group: list[str], axis: str) -> DataFrame:
    """group and the length of its longest run of neighbouring positions."""
    return runs(df.select(*group, axis).distinct(), group, axis).groupBy(*group).agg(F.max("n").alias("longest"))


def consensus(df: DataFrame, group: list[str], position: str, column: str, gap: int = 3, least: int = 2, n_columns: str | None = None) -> DataFrame:
    """Positions that several columns agree on: group, position (rounded mean of the distinct ones, half to even), n_columns.

    A cluster of distinct positions no further apart than gap is kept if at least min(least, all columns of the group) saw it.
    """
    seen = df.groupBy(*group, position).agg(F.collect_set(column).alias("_cols"))
    clusters = gap_islands(seen, group, position, gap).groupBy(*group, "island").agg(
        F.bround(F.avg(position)).cast("long").alias("position"), F.size(F.array_distinct(F.flatten(F.collect_list("_cols")))).alias("n_columns")
    )
    if n_columns is None:
        total = df.groupBy(*group).agg(F.countDistinct(column).alias("_total"))
    else:
        total = df.groupBy(*group).agg(F.max(n_columns).alias("_total"))
    both = clusters.join(total, group) if group else clusters.crossJoin(F.broadcast(total))
    return both.where(F.col("n_columns") >= F.least(F.lit(least), F.col("_total"))).drop("_total", "island")


def bands(df: DataFrame, group: list[str], position: str, least: float) -> DataFrame:
    """The gaps between neighbouring positions that are at least so wide: group, a, b."""
    w = Window.partitionBy(*group).orderBy(position)
    return df.select(*group, F.col(position).alias("a"), F.lead(position).over(w).alias("b")).where(F.col("b") - F.col("a") >= least)


def merged_spans(df: DataFrame, group: list[str], axis: str, joins_next: str) -> DataFrame:
    """Spans of a cell over neighbouring bands: group, first, last of every maximal run whose bands join the next one."""
    w = Window.partitionBy(*group).orderBy(axis)
    numbered = islands(df, group, [axis], ~F.coalesce(F.lag(joins_next).over(w), F.lit(False)))
    return numbered.groupBy(*group, "island").agg(F.min(axis).alias("first"), F.max(axis).alias("last")).where("first < last").drop("island")


def after_first(df: DataFrame, group: list[str], order: list[str], found: str, name: str = "in_body") -> DataFrame:
    """df with a flag that is true from the first row of its group where found is true."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.coalesce(F.max(found).over(w), F.lit(False)))


def changes(df: DataFrame, group: list[str], order: list[str], key: str, name: str = "starts") -> DataFrame:
    """df with a flag where the key differs from the row before, and the ids of the neighbours for navigation."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.coalesce(~F.col(key).eqNullSafe(F.lag(key).over(w)), F.lit(True)))
