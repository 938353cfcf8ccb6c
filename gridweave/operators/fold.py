"""Entity resolution that depends on the order of rows: a fold over the tables of a group, as grouped-map pandas.

Each match changes what the next row sees (the parents of an entity, the tables it is in), so no join can express it. Groups are
independent; so are, in a large group, the names that no chain of matches links, and each such component is folded by itself.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridweave.operators.matching import overlap_join
from gridweave.session import kept, ship

#: Scores from which a match within a parent is taken, goes to review, and one across parents is taken.
AUTO, REVIEW, CROSS, LEAST = 0.85, 0.60, 0.90, 0.5
#: Rows of a group beyond which it is folded by components.
SPLIT_ROWS = 20_000

SCHEMA = (
    "{group}, table_number int, pos {pos}, xact_id string, match_status string, match_confidence double, entity_parent string, "
    "entity_name string, entity_status string, entity_confidence double, _part long, _i int, _first int"
)


def _words(name: str) -> frozenset[str]:
    plain = re.sub(r"\([^)]*\)", "", name.lower().replace("-", " ").replace("/", " "))
    return frozenset(w for w in plain.split() if len(w) > 2)


def overlap(a: frozenset[str], b: frozenset[str]) -> float:
    if not a or not b:
        return 0.0
    n = len(a & b)
    return 0.6 * (n / min(len(a), len(b))) + 0.4 * (n / len(a | b))


class Entities:
    """The state of the fold: entities in order of creation, with indexes by qualified name, by name and by word."""

    def __init__(self) -> None:
        self.name: list[str] = []
        self.words: list[frozenset[str]] = []
        self.parent: list[str] = []
        self.header: list[bool] = []
        self.tables: list[set[int]] = []
        self.status: list[str] = []
        self.confidence: list[float] = []
        self.by_key: dict[tuple[str, str], int] = {}
        self.by_name: dict[str, list[int]] = {}
        self.by_word: dict[str, list[int]] = {}

    def create(self, name: str, parent: str, header: bool, table: int) -> int:
        i = len(self.name)
        words = _words(name)
        for field, v in (("name", name), ("words", words), ("parent", parent), ("header", header), ("tables", {table}), ("status", "new"), ("confidence", 1.0)):
            getattr(self, field).append(v)
        self.by_key[parent, name] = i
        self.by_name.setdefault(name, []).append(i)
        for w in words:
            self.by_word.setdefault(w, []).append(i)
        return i

    def find(self, name: str, parent: str, table: int) -> tuple[int | None, str, float]:
        """The entity of a row: by qualified name, by name, by words within the parent, by words across parents."""
        i = self.by_key.get((parent, name))
        if i is not None and table not in self.tables[i]:
            return i, "exact", 1.0
        for i in self.by_name.get(name, ()):
            if table not in self.tables[i]:
                return i, "exact", 1.0
        words = _words(name)
        near = sorted({i for w in words for i in self.by_word.get(w, ()) if table not in self.tables[i]})
        best: dict[bool, tuple[int | None, float]] = {True: (None, 0.0), False: (None, 0.0)}
        for i in near:  # in order of creation, so the first of equal scores stays
            same = self.parent[i] == parent
            if not same and self.header[i]:
                continue
            s = overlap(words, self.words[i])
            if s >= LEAST and s > best[same][1]:
                best[same] = (i, s)
        i, s = best[True]
        if i is not None and s >= REVIEW:
            return i, "fuzzy_auto" if s >= AUTO else "fuzzy_review", s
        i, s = best[False]
        if i is not None and s >= CROSS:
            return i, "fuzzy_cross_parent", s
        return None, "new", 0.0

    def join(self, i: int, parent: str, table: int, status: str, confidence: float) -> None:
        self.tables[i].add(table)
        self.status[i] = status
        self.confidence[i] = min(self.confidence[i], confidence)
        if status == "fuzzy_cross_parent" and self.parent[i] != parent:
            self.parent[i] = f"{self.parent[i]} / {parent}"


def fold(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of one group (table_number, table_rank, is_base, pos, name, parent, header) with the entity of each."""
    state = Entities()
    rows = rows.sort_values(["is_base", "table_rank", "pos"], ascending=[False, True, True], kind="stable")
    out = []
    first: list[int] = []
    for at, (table, pos, base, name, parent, header) in enumerate(zip(rows["table_number"], rows["pos"], rows["is_base"], rows["name"], rows["parent"], rows["header"])):
        parent = parent or ""
        i, status, score = (None, "new", 0.0) if base else state.find(name, parent, table)
        if i is None:
            i, status, score = state.create(name, parent, bool(header), table), "new", 1.0
            first.append(at)
        else:
            state.join(i, parent, table, status, score)
        out.append((table, pos, i, status, score))
    got = pd.DataFrame(out, columns=["table_number", "pos", "_i", "match_status", "match_confidence"])
    got["xact_id"] = [f"xact-{i + 1:03d}" for i in got["_i"]]
    for col, src in (("entity_parent", state.parent), ("entity_name", state.name), ("entity_status", state.status), ("entity_confidence", state.confidence)):
        got[col] = [src[i] for i in got["_i"]]
    got["_first"] = [int(first[i] == at) for at, i in enumerate(got["_i"])]  # whether the row made its entity
    return got


def components(names: DataFrame, group: list[str]) -> DataFrame:
    """group, name, part: distinct names of groups, with equal parts where a chain of names, each like the next, leads from one to the
    other. Labels sink to the smallest along links and through their own labels, so that a chain takes about log rounds."""
    nodes = kept(names.withColumn("node", F.monotonically_increasing_id()), "names")
    pairs = overlap_join(nodes, nodes, group, "name", "name", LEAST)
    links = kept(pairs.where("l_node <> r_node").select(F.col("l_node").alias("a"), F.col("r_node").alias("b")), "links")
    labels = kept(nodes.select("node", F.col("node").alias("part")), "labels")
    while True:
        near = links.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("part").alias("low")).withColumnRenamed("a", "node")
        sunk = labels.join(near, "node", "left").select("node", F.least("part", F.coalesce("low", "part")).alias("up"), "part")
        jumped = sunk.join(labels.select(F.col("node").alias("up"), F.col("part").alias("of_up")), "up").select("node", F.least("up", "of_up").alias("now"), "part")
        jumped = kept(jumped, "labels")
        labels = jumped.select("node", F.col("now").alias("part"))
        if jumped.where("now <> part").isEmpty():
            return nodes.join(labels, "node").select(*group, "name", "part")


def resolve_entities(df: DataFrame, group: list[str], split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row for each input row (group, table_number, table_rank, is_base, pos, name, parent, header) with its entity.

    Base tables come first and never match each other; the others follow by rank. An entity takes at most one row of each
    table. A null name is taken as empty. ids are minted in order of creation. A group of more than split_rows rows is folded by
    components: a row only ever looks at entities whose names are equal or like its own (a score of LEAST), so names
    that no chain of such links connects do not see each other.
    """
    ship(df.sparkSession)
    kinds = dict(df.dtypes)
    need = [*group, "table_number", "table_rank", "is_base", "pos", "name", "parent", "header"]
    rows = df.select(*need).withColumn("name", F.coalesce("name", F.lit("")))
    large = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > split_rows).drop("_n")
    split = not large.isEmpty()
    if split:
        rows = kept(rows, "rows")
        large = kept(large, "large")
        names = rows.join(large, group, "left_semi").select(*group, "name").distinct()
        rows = rows.join(components(names, group).withColumnRenamed("part", "_part"), [*group, "name"], "left").withColumn("_part", F.coalesce("_part", F.lit(-1)))
    else:
        rows = rows.withColumn("_part", F.lit(-1).cast("long"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf["parent"] = pdf["parent"].fillna("")
        out = fold(pdf).assign(_part=key[-1])
        for i, g in enumerate(group):
            out.insert(i, g, key[i])
        return out

    out = rows.groupBy(*group, "_part").applyInPandas(run, SCHEMA.format(pos=kinds["pos"], group=", ".join(f"{g} {kinds[g]}" for g in group)))
    if split:
        out = kept(out, "folded")
        turn = rows.select(*group, "_part", "table_number", "pos", (~F.col("is_base")).alias("_late"), "table_rank")
        made = out.where("_part >= 0 and _first = 1").join(turn, [*group, "_part", "table_number", "pos"])
        order = Window.partitionBy(*group).orderBy("_late", "table_rank", "pos", "table_number", "_part", "_i")
        minted = made.withColumn("_id", F.format_string("xact-%03d", F.row_number().over(order))).select(*group, "_part", "_i", "_id")
        whole = out.where("_part < 0")
        out = whole.unionByName(out.where("_part >= 0").join(minted, [*group, "_part", "_i"]).withColumn("xact_id", F.col("_id")).drop("_id"))
    return out.drop("_part", "_i", "_first")
