"""Sparse matrices: several sources to one value a cell, and grids for presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consolidate_cells(df: DataFrame, cell: list[str], source: str, value: str, order: str) -> DataFrame:
    """cell, consolidated_value, source_values: of each source its last non-empty value; one distinct value stands as it is,
    several as "[a, b]" in order; cells without any value are left out."""
    each = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*cell, source).agg(F.max_by(value, order).alias("_v"))
    per = each.groupBy(*cell).agg(F.array_sort(F.collect_set("_v")).alias("_s"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(source).cast("string"), "_v")))).alias("source_values"))
    one = F.when(F.size("_s") == 1, F.col("_s")[0]).otherwise(F.concat(F.lit("["), F.array_join("_s", ", "), F.lit("]")))
    return per.select(*cell, one.alias("consolidated_value"), "source_values")


def composite_label(df: DataFrame, column: list[str], value: str, order: list[str]) -> DataFrame:
    """column and its non-empty values joined by " / " in encounter order; a column without any has an empty label."""
    seq = F.sort_array(F.collect_list(F.struct(*order, F.coalesce(F.col(value), F.lit("")).alias("_v"))))
    parts = F.filter(F.transform(seq, lambda s: s["_v"]), lambda v: v != "")
    return df.groupBy(*column).agg(F.array_join(parts, " / ").alias("composite_label"))


def grid(df: DataFrame, row: list[str], column: str, value: str, columns: list | None = None, prefix: str = "c") -> DataFrame:
    """One row a row of the grid, a column for each of the given column keys; without them for each that occurs, which are as many as
    the widest table has columns."""
    if columns is None:
        columns = sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())
    wide = df.groupBy(*row).pivot(column, columns).agg(F.max(value))
    return wide.select(*row, *[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in columns])


def grid_map(df: DataFrame, row: list[str], column: str, value: str) -> DataFrame:
    """One row a row of the grid, with cells, a map from each column key that the row has to its value; a row whose cells all
    lack a column key has an empty map."""
    each = df.groupBy(*row, column).agg(F.max(value).alias("_v"))
    cell = F.when(F.col(column).isNotNull(), F.struct(column, "_v"))
    return each.groupBy(*row).agg(F.map_from_entries(F.sort_array(F.collect_list(cell))).alias("cells"))
