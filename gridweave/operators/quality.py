"""Detectors of damaged text, bindings and structure; each returns the findings as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.functions.classify import is_short_section_ref
from gridweave.functions.text import norm_note, sentences


def adjacent_containment(df: DataFrame, group: list[str], order: list[str], ident: str, text: str, least_words: int = 4) -> DataFrame:
    """group, first, second: neighbours of which one's text contains the other's, both of enough words and no section reference."""
    w = Window.partitionBy(*group).orderBy(*order)
    n = norm_note(F.coalesce(F.col(text), F.lit("")))
    base = df.select(*group, *order, F.col(ident).alias("first"), n.alias("_a"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    base = base.withColumn("_s", F.coalesce(is_short_section_ref(F.col("_a"), F.col("_t")), F.lit(False)))
    pair = base.select(*group, "first", "_a", "_s", F.lead("first").over(w).alias("second"), F.lead("_a").over(w).alias("_b"), F.lead("_s").over(w).alias("_s2"))
    words = lambda c: F.size(F.filter(F.split(c, " "), lambda x: x != ""))
    hit = F.col("second").isNotNull() & ~F.col("_s") & ~F.col("_s2") & (F.least(words(F.col("_a")), words(F.col("_b"))) >= least_words)
    return pair.where(hit & (F.col("_a").contains(F.col("_b")) | F.col("_b").contains(F.col("_a")))).select(*group, "first", "second")


def duplicated_blocks(df: DataFrame, ident: str, text: str) -> DataFrame:
    """ident, block_chars: the longest run of neighbouring sentences that stands earlier in the same text too, without overlap.

    Equal sentences of a text meet by an equality join; pairs on one diagonal that follow one another form a run from i to e at
    distance d; from any start in it min(e - start + 1, d) sentences count, and prefix sums of lengths give their characters.
    """
    s = df.select(F.col(ident).alias("id"), F.posexplode(sentences(F.col(text))).alias("i", "s"))
    s = s.withColumn("upto", F.sum(F.length("s")).over(Window.partitionBy("id").orderBy("i")))
    a, b = s.select("id", "i", "s", F.length("s").alias("len"), "upto"), s.select("id", F.col("i").alias("j"), "s")
    pairs = a.join(b, ["id", "s"]).where("i < j").select("id", "i", (F.col("j") - F.col("i")).alias("d"), "len", "upto")
    w = Window.partitionBy("id", "d").orderBy("i")
    runs = pairs.withColumn("isle", F.col("i") - F.row_number().over(w))
    last = Window.partitionBy("id", "d", "isle")
    ended = runs.withColumn("n", F.least(F.max("i").over(last) - F.col("i") + 1, F.col("d")).cast("int"))
    ends = s.select("id", F.col("i").alias("e"), F.col("upto").alias("upto_e"))
    sized = ended.withColumn("e", F.col("i") + F.col("n") - 1).join(ends, ["id", "e"])
    return sized.groupBy("id").agg(F.max(F.col("upto_e") - F.col("upto") + F.col("len")).cast("int").alias("block_chars")).withColumnRenamed("id", ident)


def binding_conflicts(notes: DataFrame, key: list[str], tables: Column, names: Column) -> DataFrame:
    """key, n_tables, n_names of notes that stand in several tables and name more than one entity, but no more than tables."""
    t, n = F.size(F.array_distinct(tables)), F.size(F.array_distinct(names))
    return notes.select(*key, t.alias("n_tables"), n.alias("n_names")).where("n_tables > 1 and n_names > 1 and n_names <= n_tables")


def partial_bindings(declared: DataFrame, marked: DataFrame, key: list[str], row: str) -> DataFrame:
    """key, row: rows that are declared for a key which is marked somewhere, but not there."""
    known = marked.select(*key, row).distinct().hint("merge")
    return declared.select(*key, row).distinct().join(known.select(*key).distinct(), key, "left_semi").join(known, [*key, row], "left_anti")


def degenerate(df: DataFrame, group: list[str], kind: str, only: str, more_than: int = 20) -> DataFrame:
    """Groups of many rows that are all of one kind: group, n."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col(kind) == only, F.lit(False))).alias("_all")).where(F.col("_all") & (F.col("n") > more_than)).drop("_all")


def identical_texts(df: DataFrame, group: list[str], text: str, marker: str, least: int = 25) -> DataFrame:
    """group, text hash and number of markers of texts that several markers carry."""
    rows = df.where(F.length(text) >= least).groupBy(*group, F.sha2(text, 256).alias("text_sha")).agg(F.countDistinct(marker).alias("n_markers"))
    return rows.where("n_markers > 1")


def coverage_gaps(df: DataFrame, key: list[str], first: str, last: str, seen: DataFrame, at: str) -> DataFrame:
    """key, at: positions between first and last that no row of `seen` has."""
    wanted = df.where(F.col(first) <= F.col(last)).select(*key, F.explode(F.sequence(first, last)).alias(at))
    return wanted.join(seen.select(*key, at).distinct(), [*key, at], "left_anti")


def snapshot_delta(old: DataFrame, new: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    """key, presence (both, missing, added) and the change of each metric from old to new."""
    a = old.select(*key, F.lit(True).alias("_o"), *[F.col(m).alias(f"_o_{m}") for m in metrics])
    b = new.select(*key, F.lit(True).alias("_n"), *metrics)
    both = a.join(b, key, "full")
    presence = F.when(F.col("_n").isNull(), "missing").when(F.col("_o").isNull(), "added").otherwise("both")
    return both.select(*key, presence.alias("presence"), *[(F.coalesce(m, F.lit(0)) - F.coalesce(f"_o_{m}", F.lit(0))).alias(f"d_{m}") for m in metrics])


def counted(sources: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """key, n over several sources: "name:value" of each non-empty value of a column."""
    parts = [df.where(F.coalesce(F.col(c), F.lit("")) != "").select(F.concat(F.lit(f"{n}:"), F.col(c)).alias("key")) for n, df, c in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def first_pattern(df: DataFrame, text: str, patterns: list[tuple[str, str]], name: str = "pattern") -> DataFrame:
    """df with the name of the first pattern that its text matches; rows that match none are dropped."""
    case = F.coalesce(*[F.when(F.col(text).rlike(p), F.lit(n)) for n, p in patterns])
    return df.withColumn(name, case).where(F.col(name).isNotNull())
