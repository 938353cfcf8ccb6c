"""References by markers: exploded, joined, collected on both sides, with a guarded fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def references(df: DataFrame, keys: list[str], element: Column, markers: Column, kind: str, ordinal: Column, distinct: bool = False) -> DataFrame:
    """keys, marker, kind, element, ordinal: a row for each marker of each element (repeats kept unless distinct)."""
    rows = df.select(*keys, F.explode(markers).alias("marker"), F.lit(kind).alias("kind"), element.alias("element"), ordinal.alias("ordinal"))
    return rows.groupBy(*keys, "marker", "kind", "element").agg(F.min("ordinal").alias("ordinal")).select(*keys, "marker", "kind", "element", "ordinal") if distinct else rows


def link(notes: DataFrame, refs: DataFrame, keys: list[str], marker: str = "marker") -> DataFrame:
    """Edges between notes and elements that carry their marker: every note sharing a marker gets all its elements."""
    return notes.join(refs, [*keys, marker])


def collected(edges: DataFrame, by: list[str], value: str, order: list[str], name: str) -> DataFrame:
    """by and the ordered list of one side of the edges."""
    rows = F.sort_array(F.collect_list(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(value).alias("v"))))
    return edges.groupBy(*by).agg(rows.alias("_r")).select(*by, F.transform("_r", lambda r: r["v"]).alias(name))


def with_fallback(primary: DataFrame, secondary: DataFrame, key: list[str]) -> DataFrame:
    """Rows of primary, and those of secondary whose key has none there."""
    return primary.unionByName(secondary.join(primary.select(*key).distinct().hint("merge"), key, "left_anti"))


def undefined(refs: DataFrame, defined: DataFrame, key: list[str]) -> DataFrame:
    """Distinct keys that are used but not defined; nulls match nothing."""
    return refs.select(*key).distinct().join(defined.select(*key).distinct(), key, "left_anti")
