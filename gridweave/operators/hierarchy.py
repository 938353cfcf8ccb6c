"""Parents, children and order of trees that stand as indented rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridweave.session import kept, map_arrow

#: Levels that are told apart by running maxima; rows of more are walked with a stack.
MOST_LEVELS = 64


def _levels(df: DataFrame, level: str) -> list[int]:
    found = df.select(level).where(F.col(level).isNotNull()).distinct().limit(MOST_LEVELS + 1).collect()
    return sorted(r[0] for r in found)


def parent_smaller(df: DataFrame, group: list[str], order: list[str], level: str, ident: str, name: str = "parent") -> DataFrame:
    """df with the id of the nearest preceding row of smaller level, null at the top.

    A running maximum for each level that occurs (all on one sort): the parent is the latest among the last rows of the
    smaller levels. Where more than MOST_LEVELS levels occur, the sorted rows are walked with a stack of open levels. Linear in the
    rows either way, however large a group is. Rows without level have no parent and are none.
    """
    levels = _levels(df, level)
    if len(levels) > MOST_LEVELS:
        return _by_stack(df, group, order, level, ident, name)
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    at = df.withColumn("_at", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    here = F.struct("_at", F.col(ident).alias("id"))
    last = {v: F.max(F.when(F.col(level) == v, here)).over(before) for v in levels}
    wide = at.select("*", *[c.alias(f"_l{i}") for i, c in enumerate(last.values())])
    choices = [F.when(F.col(level) > v, F.col(f"_l{i}")) for i, v in enumerate(levels)]
    best = F.array_max(F.array(*choices)) if choices else F.lit(None).cast(f"struct<_at:int,id:{dict(df.dtypes)[ident]}>")
    return wide.withColumn(name, best["id"]).drop("_at", *[f"_l{i}" for i in range(len(levels))])


def _by_stack(df: DataFrame, group: list[str], order: list[str], level: str, ident: str, name: str) -> DataFrame:
    """parent_smaller() for any number of levels: one pass over sorted rows; the stack holds no more rows than levels."""
    schema = StructType([*df.schema.fields, StructType().add(name, df.schema[ident].dataType)[0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        open_: list[tuple[int, object]] = []
        for b in batches:
            column = {c: b.column(i) for i, c in enumerate(b.schema.names)}
            parents = []
            keys = zip(*(column[g].to_pylist() for g in group)) if group else [()] * b.num_rows
            for own, key, lv in zip(column[ident].to_pylist(), keys, column[level].to_pylist()):
                if key != last:
                    last, open_ = key, []
                if lv is None:
                    parents.append(None)
                    continue
                while open_ and open_[-1][0] >= lv:
                    open_.pop()
                parents.append(open_[-1][1] if open_ else None)
                open_.append((lv, own))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parents, column[ident].type)], names=[*b.schema.names, name])

    placed = df.repartition(*group) if group else df.coalesce(1)
    return map_arrow(placed.sortWithinPartitions(*group, *order), run, schema)


def parent_previous(df: DataFrame, group: list[str], order: list[str], level: str, ident: str, name: str = "parent") -> DataFrame:
    """df with the id of the nearest preceding row whose level is one less; rows of level 1 or none have no parent.

    Every row gives its id under its own level and asks under the one before; both meet by (group, level) in one sort, so that any
    number of levels will do and a large group is split by its levels."""
    gives = F.struct(F.col(level).cast("long").alias("at"), F.lit(False).alias("asks"))
    asks = F.struct(F.when(F.col(level) > 1, F.col(level).cast("long") - 1).alias("at"), F.lit(True).alias("asks"))
    both = df.withColumn("_e", F.explode(F.array(gives, asks)))
    before = Window.partitionBy(*group, "_e.at").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    given = F.last(F.when(~F.col("_e.asks"), F.col(ident)), ignorenulls=True).over(before)
    found = both.withColumn(name, F.when(F.col("_e.at").isNotNull(), given))
    return found.where("_e.asks").drop("_e")


def children(df: DataFrame, group: list[str], parent: str, ident: str, order: list[str]) -> DataFrame:
    """group, parent and the ordered list of the ids of its children."""
    kids = F.sort_array(F.collect_list(F.struct(*order, F.col(ident).alias("_id"))))
    listed = df.where(F.col(parent).isNotNull()).groupBy(*group, parent).agg(kids.alias("_k"))
    return listed.select(*group, parent, F.transform("_k", lambda k: k["_id"]).alias("child_ids"))


def preorder(df: DataFrame, group: list[str], ident: str, parent: str, order: list[str], name: str = "display_order") -> DataFrame:
    """group, ident and the number of each node in a depth-first walk: parents before children, siblings in the given order.

    Nodes that no root reaches (members of a cycle, children of unknown parents) get 0. Pointers double: a node knows the ranks on
    the way from an ancestor to itself, and each round appends what that ancestor knows, so a tree of depth d takes log2(d) rounds;
    the order of the whole paths is the walk. A round that finishes no node leaves only such as no root reaches.
    """
    gs = [f"g{i}" for i in range(len(group))]
    siblings = Window.partitionBy(*group, parent).orderBy(*order)
    paths = df.select(*[F.col(g).alias(x) for g, x in zip(group, gs)], F.col(ident).alias("id"), F.col(parent).alias("up"), F.array(F.row_number().over(siblings)).alias("path"))
    paths = kept(paths, "nodes")
    waiting = paths.where("up is not null").count()
    while waiting:
        above = paths.select(*[F.col(x).alias(f"_{x}") for x in gs], F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        same = F.col("up") == F.col("_id")
        for x in gs:
            same = same & F.col(x).eqNullSafe(F.col(f"_{x}"))
        longer = paths.where("up is not null").join(above, same).select(*gs, "id", F.col("_up").alias("up"), F.concat("_path", "path").alias("path"))
        paths = kept(paths.where("up is null").unionByName(longer), "nodes")
        left = paths.where("up is not null").count()
        if left == waiting:
            break
        waiting = left
    at = F.row_number().over(Window.partitionBy(*gs).orderBy("path"))
    numbered = paths.where("up is null").select(*[F.col(x).alias(g) for g, x in zip(group, gs)], F.col("id").alias(ident), at.alias("_n"))
    return df.select(*group, ident).join(numbered, [*group, ident], "left").select(*group, ident, F.coalesce("_n", F.lit(0)).alias(name))


def level_gaps(df: DataFrame, group: list[str], order: list[str], level: str) -> DataFrame:
    """Rows without level between two rows with one."""
    w = Window.partitionBy(*group).orderBy(*order)
    near = df.withColumns({"prev_level": F.lag(level).over(w), "next_level": F.lead(level).over(w)})
    return near.where(F.col(level).isNull() & F.col("prev_level").isNotNull() & F.col("next_level").isNotNull())


def section_header(level: Column, has_children: Column, has_data: Column) -> Column:
    """A row of level 0 with children and without data of its own."""
    return (level == 0) & has_children & ~has_data
