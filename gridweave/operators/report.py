"""Reports: rollups, comparisons, filters over inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.functions.classify import conclusion
from gridweave.functions.text import is_blank


def percent_less(n: Column, of: Column) -> Column:
    """round((1 - n / of) * 100) with halves to the even number; 0 of nothing."""
    return F.when(of > 0, F.bround((1 - n / of) * 100).cast("int")).otherwise(0)


def zero_filled(df: DataFrame, group: list[str], key: str, values: list[str]) -> DataFrame:
    """group and a count column n_<value> for each of the values."""
    return df.groupBy(*group).agg(*[F.count_if(F.col(key) == v).alias(f"n_{v}") for v in values])


def compare_properties(df: DataFrame, group: list[str], table: str, kind: str, name: str, n_tables: DataFrame) -> DataFrame:
    """group, n, n_types, n_names and the conclusion over tables; n_tables gives the number of tables of (a prefix of) group."""
    shared = [c for c in n_tables.columns if c in group]
    per = df.groupBy(*group).agg(F.countDistinct(table).alias("n"), F.countDistinct(kind).alias("n_types"), F.countDistinct(name).alias("n_names"))
    return per.join(n_tables, shared).withColumn("conclusion", conclusion(F.col("n"), F.col("n_tables"), F.col("n_types"), F.col("n_names")))


def commonality(df: DataFrame, group: list[str], cell: list[str], track: str, value: str) -> DataFrame:
    """group, cell, n_with, n_tracks, common: whether the value of a cell stands in all tracks of the group."""
    tracks = df.where(F.col(track).isNotNull()).groupBy(*group).agg(F.countDistinct(track).alias("n_tracks"))
    cells = df.where(F.col(track).isNotNull() & ~is_blank(F.col(value))).groupBy(*group, *cell).agg(F.countDistinct(track).alias("n_with"))
    return cells.join(tracks, group).withColumn("common", F.col("n_with") >= F.col("n_tracks"))


def search(df: DataFrame, fields: list[str], equal: dict[str, object] | None = None, needle: str | None = None, hide: list[str] = (), need: list[str] = ()) -> DataFrame:
    """Rows with all given equalities, without the flags to hide, with the flags needed, and with the needle in one of the
    fields, whatever its case."""
    for k, v in (equal or {}).items():
        df = df.where(F.col(k) == F.lit(v))
    for h in hide:
        df = df.where(~F.coalesce(F.col(h), F.lit(False)))
    for n in need:
        df = df.where(F.coalesce(F.col(n), F.lit(False)))
    if needle:
        df = df.where(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lower(F.lit(needle))))
    return df


def colour_index(df: DataFrame, group: list[str], key: str, order: str, n: int = 6) -> DataFrame:
    """group, key and an index below n by first appearance."""
    first = df.where(F.col(key).isNotNull()).groupBy(*group, key).agg(F.min(order).alias("_o"))
    return first.withColumn("colour", F.pmod(F.row_number().over(Window.partitionBy(*group).orderBy("_o", key)) - 1, F.lit(n))).drop("_o")


def neighbours(df: DataFrame, group: list[str], order: list[str], ident: str) -> DataFrame:
    """group, ident and the idents before and after it."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.select(*group, ident, F.lag(ident).over(w).alias("prev"), F.lead(ident).over(w).alias("next"))


def level_first(df: DataFrame, group: list[str], level: str, kind: str, pos: str) -> DataFrame:
    """df ranked within its group: rows with a level by it, then those without by kind, else in their order."""
    w = Window.partitionBy(*group).orderBy(F.col(level).isNull(), F.coalesce(level, F.lit(0)), F.when(F.col(level).isNull(), F.col(kind)), pos)
    return df.withColumn("rank", F.row_number().over(w))


def column_identifier(values: Column) -> Column:
    """The identifying value of a column from its array of struct(property_type, level, value): the first non-empty of visit,
    cycle and study_day, else that of the lowest level that is no empty epoch; levels that are null count as 99."""
    def named(kind: str) -> Column:
        of_kind = F.filter(values, lambda v: (v["property_type"] == kind) & (F.coalesce(v["value"], F.lit("")) != ""))
        return F.try_element_at(of_kind, F.lit(1))["value"]

    typed = [named(t) for t in ("visit", "cycle", "study_day")]
    rest = F.filter(values, lambda v: F.coalesce(v["value"], F.lit("")) != "")
    lowest = F.array_sort(F.transform(rest, lambda v: F.struct(F.coalesce(v["level"], F.lit(99)).alias("l"), v["value"].alias("v"))))
    return F.coalesce(*typed, F.try_element_at(lowest, F.lit(1))["v"], F.lit(""))
