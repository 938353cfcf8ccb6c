"""Identifiers from positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mint(prefix: str, n: Column) -> Column:
    """prefix-NNN; more than three digits where n needs them."""
    return F.format_string(f"{prefix}-%03d", n)


def mint_in_order(df: DataFrame, name: str, prefix: str, group: list[str], order: list[Column]) -> DataFrame:
    """df with identifiers by rank within each group. The order must be total for a defined result."""
    return df.withColumn(name, mint(prefix, F.row_number().over(Window.partitionBy(*group).orderBy(*order))))


def elements(df: DataFrame, array: str, keys: list[str], at: str = "pos") -> DataFrame:
    """The elements of an array of structs as rows, with their positions from 1; a null or empty array gives none.

    Fields of the elements that have the name of a key or of `at` give way to it."""
    exploded = df.select(*keys, F.posexplode(array).alias("_p", "_e"))
    fields = [f.name for f in exploded.schema["_e"].dataType.fields if f.name not in (*keys, at)]
    return exploded.select(*keys, (F.col("_p") + 1).alias(at), *[F.col("_e")[f].alias(f) for f in fields])


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order: a preferred version."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")
