"""Values that a merged cell gives to the cells it covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fill_merged(df: DataFrame, group: list[str], span: str, value: str, order: list[str], row: str | None = None) -> DataFrame:
    """df with value filled: an empty cell of a merge range takes the range's first non-empty value in the given order.

    By default cells are pooled by the text of their range alone; with `row`, by row as well. Cells without range stay.
    One shuffle on group and range; a null value counts as empty and stays null if its range has no value.
    """
    key = [*group, span, *([row] if row else [])]
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = F.nullif(F.col(value), F.lit(""))
    anchor = F.first(filled, ignorenulls=True).over(w)
    return df.withColumn(value, F.when(F.coalesce(F.col(span), F.lit("")) != "", F.coalesce(filled, anchor, F.col(value))).otherwise(F.col(value)))
