"""Scored joins: shared words, tiers of label matches, containment of texts. All are blocked by an equality; none crosses."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.functions.text import contains_in_order, label_keys, norm_key, overlap_of_sets, word_set
from gridweave.session import kept, map_arrow

#: Length of the strings by which containment is blocked where all texts that are looked for are as long.
GRAM = 8
#: Shortest label matched with marker characters around it, how many those are, and the shortest clipped label.
LEAST_MARKED, MARKER_CHARS, LEAST_CLIPPED = 6, 4, 12
#: Odd factors of a rolling hash and of its finaliser.
FACTOR, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def overlap_join(left: DataFrame, right: DataFrame, group: list[str], left_name: str, right_name: str, least: float) -> DataFrame:
    """Pairs of a group whose names share a word and score at least `least`: all columns of both (prefixed l_, r_) and score.

    No score exceeds the share of the shorter name's words that are shared, so of a name of n words, in the order of how rare they are
    in the group, one of the first n - ceil(least * n) + 1 stands in every longer partner. Each side's first words meet all words
    of the other, so a common word joins only names that have no rarer one; only numbers of rows and words travel until
    the pairs are known, and each pair is scored once.
    """
    a, b = _worded(left, group, left_name, "l"), _worded(right, group, right_name, "r")
    words = a.select(*group, F.explode("l_w").alias("w")).unionByName(b.select(*group, F.explode("r_w").alias("w")))
    counts = words.groupBy(*group, "w").agg(F.count(F.lit(1)).alias("c"))

    def listed(df: DataFrame, side: str) -> DataFrame:
        each = df.select(*group, f"{side}_id", F.size(f"{side}_w").alias("n"), F.explode(f"{side}_w").alias("w")).join(counts, [*group, "w"])
        order = Window.partitionBy(*group, f"{side}_id").orderBy("c", "w")
        lead = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1
        return each.withColumn("leads", F.row_number().over(order) <= lead).select(*group, "w", f"{side}_id", F.col("n").alias(f"{side}_n"), F.col("leads").alias(f"{side}_leads"))

    x, y = listed(a, "l"), listed(b, "r")
    y = y.hint("merge")
    one = x.where("l_leads").join(y, [*group, "w"]).where("l_n <= r_n")
    two = x.join(y.where("r_leads"), [*group, "w"]).where("r_n < l_n")
    pairs = one.select(*group, "l_id", "r_id").unionByName(two.select(*group, "l_id", "r_id")).distinct()
    both = pairs.join(a, [*group, "l_id"]).join(b, [*group, "r_id"])
    return both.withColumn("score", overlap_of_sets(F.col("l_w"), F.col("r_w"))).where(F.col("score") >= least).drop("l_id", "r_id", "l_w", "r_w")


def _worded(df: DataFrame, group: list[str], name: str, side: str) -> DataFrame:
    """The rows of a side with a number and their words, kept so that the numbers stay; rows without words match nothing."""
    cols = [F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in group]
    named = df.select(*group, *cols, word_set(F.col(name)).alias(f"{side}_w")).where(F.size(f"{side}_w") > 0)
    return kept(named.withColumn(f"{side}_id", F.monotonically_increasing_id()), f"words_{side}")


def best(pairs: DataFrame, key: list[str], score: Column, order: list[str]) -> DataFrame:
    """The pair of the highest score of each key; of ties the first in order."""
    w = Window.partitionBy(*key).orderBy(score.desc(), *order)
    return pairs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def all_best(pairs: DataFrame, key: list[str], score: Column) -> DataFrame:
    """All pairs tied at the highest score of each key."""
    return pairs.withColumn("_rk", F.rank().over(Window.partitionBy(*key).orderBy(score.desc()))).where("_rk = 1").drop("_rk")


def match_score(printed: Column, key: Column) -> Column:
    """struct(kind, n) of a printed text and a label key, both in audit form: 3 equal; 2 the label with up to MARKER_CHARS
    characters more around or inside it; 1 one a clipped prefix of the other; 0 none. Structs compare kind first."""

    def s(kind: int, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), n.cast("int").alias("n"))

    extra = F.length(printed) - F.length(key)
    return (
        F.when((printed == "") | (key == ""), s(0, F.lit(0)))
        .when(printed == key, s(3, F.length(key)))
        .when((F.length(key) >= LEAST_MARKED) & extra.between(1, MARKER_CHARS) & contains_in_order(key, printed), s(2, F.length(key)))
        .when((F.length(printed) >= LEAST_CLIPPED) & (printed.startswith(key) | key.startswith(printed)), s(1, F.least(F.length(printed), F.length(key))))
        .otherwise(s(0, F.lit(0)))
    )


#: (characters a label lacks, number of its part, how far that has moved): every place where a part can have stayed whole.
_PLACES = [(extra, i, shift) for extra in range(1, MARKER_CHARS + 1) for i in range(extra + 1) for shift in range(extra + 1)]


def _each(places: list[tuple], key) -> Column:
    """The keys of all places: one expression for each value, as a plan that spells them out fills the driver."""
    at = F.array(*[F.struct(F.lit(e).alias("e"), F.lit(i).alias("i"), F.lit(s).alias("s")) for e, i, s in places])

    def of(t: Column) -> Column:
        return key(t["e"], t["i"], t["s"])

    return F.transform(at, of)


def _part_key(text: Column, n: Column, extra: Column, i: Column, shift: Column) -> Column:
    """The key of part i of extra + 1 of a label of n characters, read in text `shift` further on; null for labels too short."""
    cut = lambda j: F.floor(n * j / (extra + 1)).cast("int")
    return F.when(n >= LEAST_MARKED, F.concat_ws("|", F.concat(extra.cast("string"), F.lit("."), i.cast("string")), n.cast("string"), F.substring(text, cut(i) + 1 + shift, cut(i + 1) - cut(i))))


def _printed_keys(p: Column) -> Column:
    """All keys under which a label that match_score() gives a kind may stand, of a printed text in audit form: itself; its
    beginnings; and, for a label that lacks e of its characters, each part that can have stayed whole, wherever it may have moved."""
    begins = F.transform(F.sequence(F.lit(1), F.lit(LEAST_CLIPPED)), lambda i: F.when(F.length(p) >= LEAST_CLIPPED, F.concat(F.lit("^|"), F.substring(p, F.lit(1), i))))
    parts = _each(_PLACES, lambda e, i, s: _part_key(p, F.length(p) - e, e, i, s))
    return F.array_distinct(F.filter(F.concat(F.array(F.concat(F.lit("=|"), p)), begins, parts), lambda k: k.isNotNull()))


def _label_keys(k: Column) -> Column:
    """The keys under which a label stands; see _printed_keys()."""
    parts = _each([x for x in _PLACES if x[2] == 0], lambda e, i, s: _part_key(k, F.length(k), e, i, s))
    own = F.array(F.concat(F.lit("=|"), k), F.concat(F.lit("^|"), F.substring(k, 1, LEAST_CLIPPED)))
    return F.array_distinct(F.filter(F.concat(own, parts), lambda x: x.isNotNull()))


def label_matches(printed: DataFrame, labels: DataFrame, group: list[str], text: str, label: str) -> DataFrame:
    """Every label tied at the best score of each distinct printed text of a group: group, text, label, kind, n.

    Texts and labels are made distinct, and only those that share a key are compared: equal ones, beginnings, and, since of a
    label with up to MARKER_CHARS characters between its own one of as many parts and one stays whole, its parts at their places.
    """
    a, b, scored = _scored(printed, labels, group, text, label)
    top = all_best(a.join(scored, [*group, "_p"]), [*group, text], F.col("_s"))
    return top.join(b, [*group, "_k"]).select(*group, text, label, F.col("_s.kind").alias("kind"), F.col("_s.n").alias("n")).distinct()


def labels_met(printed: DataFrame, labels: DataFrame, group: list[str], text: str, label: str) -> DataFrame:
    """Every label that a printed text of a group matches at all, the best or not: group, text, label, and the best kind and n of both."""
    a, b, scored = _scored(printed, labels, group, text, label)
    met = a.join(scored, [*group, "_p"]).join(b, [*group, "_k"]).groupBy(*group, text, label).agg(F.max("_s").alias("_s"))
    return met.select(*group, text, label, F.col("_s.kind").alias("kind"), F.col("_s.n").alias("n"))


def _scored(printed: DataFrame, labels: DataFrame, group: list[str], text: str, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(printed texts with their form _p, labels with each of theirs _k, pairs of forms with a score _s): see label_matches()."""
    a = kept(printed.select(*group, text).distinct().withColumn("_p", norm_key(F.col(text))).where("_p <> ''"), "printed")
    b = kept(labels.select(*group, label).distinct().withColumn("_k", F.explode(label_keys(F.col(label)))).where("_k <> ''"), "labels")
    p = a.select(*group, "_p").distinct().withColumn("_ph", F.xxhash64(*group, "_p"))
    k = b.select(*group, "_k").distinct().withColumn("_kh", F.xxhash64(*group, "_k"))
    place = F.xxhash64(*group)
    # few rows give many keys: they are spread by number, or their small size would put them into one task
    tasks = max(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")), p.sparkSession.sparkContext.defaultParallelism)
    asked = p.repartition(tasks, "_ph").select("_ph", F.explode(F.transform(_printed_keys(F.col("_p")), lambda x: F.xxhash64(place, x))).alias("_key"))
    given = k.select("_kh", F.explode(F.transform(_label_keys(F.col("_k")), lambda x: F.xxhash64(place, x))).alias("_key"))
    near = kept(asked.join(given, "_key").select("_ph", "_kh").distinct(), "near")  # only hashes travel; what they confuse is told apart below
    others = k.select("_kh", "_k", *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)])
    met = near.join(p, "_ph").join(others, "_kh")
    for i, g in enumerate(group):
        met = met.where(F.col(g) == F.col(f"_g{i}"))
    extra = F.length("_p") - F.length("_k") + 1
    ends = F.substring(F.col("_p"), F.lit(1), extra).contains(F.substring("_k", 1, 1)) & F.right("_p", extra).contains(F.right("_k", F.lit(1)))
    met = met.where(ends | F.col("_p").startswith(F.col("_k")) | F.col("_k").startswith(F.col("_p")))  # what a match has at least
    return a, b, met.select(*group, "_p", "_k", match_score(F.col("_p"), F.col("_k")).alias("_s")).where("_s.kind > 0")


def winnow(texts: list[str], gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the smallest hash of a gram in every window of so many neighbouring grams (a power of two), each once."""
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    span = gram + window - 1
    if len(cp) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(len(cp) - gram + 1, np.uint64)
    for j in range(gram):
        h = h * np.uint64(FACTOR) + cp[j : len(cp) - gram + 1 + j]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
    h ^= h >> np.uint64(29)
    reach = 1
    while reach < window:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    per = np.maximum(lengths - span + 1, 0)
    owner = np.repeat(np.arange(len(texts)), per)
    place = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(per) - per), per) + np.arange(per.sum())
    picked = h[place].view(np.int64)
    order = np.lexsort((picked, owner))
    owner, picked = owner[order], picked[order]
    new = np.ones(len(owner), bool)
    new[1:] = (np.diff(owner) != 0) | (np.diff(picked) != 0)
    return owner[new], picked[new]


def _grams(df: DataFrame, keep: list[str], text: str, gram: int, window: int) -> DataFrame:
    """keep and _g, a row for each hash that winnow() picks of the text."""
    schema = ", ".join(f"{c} {t}" for c, t in df.select(*keep).dtypes) + ", _g long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= 500_000):
                    size += len(texts[end])
                    end += 1
                owner, picked = winnow(texts[begin:end], gram, window)
                at = pa.array(begin + owner)
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(at) for i in range(len(keep))), pa.array(picked)], names=[*keep, "_g"])
                begin = end

    return map_arrow(df.select(*keep, text), run, schema)


def contains_join(needles: DataFrame, stacks: DataFrame, group: list[str], needle: str, stack: str, least: int = GRAM) -> DataFrame:
    """Pairs of a group where the text `stack` contains `needle`: columns of needles and stacks. `least`: a length that needles have,
    or most of them; the longer, the fewer hashes of a stack travel, as only the smallest of each window of grams does, which a
    needle of that length has in common with every text that holds it. Shorter needles go by shorter grams in a second pass.

    Each needle travels by the rarest of its hashes within the group's stacks; only pairs that share it are compared, and only
    hashes travel until then. Null and empty texts contain and are contained in nothing. Columns of both sides other than group
    must differ in name.
    """
    n = needles.where(F.length(needle) > 0).withColumn("_nk", F.xxhash64(needle))
    s = stacks.where(F.length(stack) > 0).withColumn("_sk", F.xxhash64(stack))
    window = 1 << max(0, (least - GRAM + 1).bit_length() - 1)
    span = GRAM + window - 1
    found = _contained(n.where(F.length(needle) >= span), s, group, needle, stack, GRAM, window)
    short = n.where(F.length(needle) < span).agg(F.min(F.length(needle)).alias("n")).first()["n"]
    if short:
        found = found.unionByName(_contained(n.where(F.length(needle) < span), s, group, needle, stack, min(short, GRAM), 1))
    return found


def _contained(n: DataFrame, s: DataFrame, group: list[str], needle: str, stack: str, gram: int, window: int) -> DataFrame:
    in_stacks = _grams(s.select(*group, "_sk", stack).distinct(), [*group, "_sk"], stack, gram, window)
    of_needle = _grams(n.select(*group, "_nk", needle).distinct(), [*group, "_nk"], needle, gram, window)
    of_needle = kept(of_needle, "needle_grams")
    wanted = in_stacks.join(of_needle.select(*group, "_g").distinct(), [*group, "_g"], "left_semi")
    wanted = kept(wanted, "grams")
    count = wanted.groupBy(*group, "_g").agg(F.count(F.lit(1)).alias("_n"))
    rarest = of_needle.join(count, [*group, "_g"], "left").groupBy(*group, "_nk").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("_b"))
    by = rarest.where("_b.n > 0").select(*group, "_nk", F.col("_b._g").alias("_g"))
    pairs = kept(by.join(wanted, [*group, "_g"]).select(*group, "_nk", "_sk").distinct(), "near")
    return pairs.join(n.hint("merge"), [*group, "_nk"]).join(s.hint("merge"), [*group, "_sk"]).where(F.col(stack).contains(F.col(needle))).drop("_nk", "_sk")


def longest_unique(pairs: DataFrame, key: list[str], size: Column) -> DataFrame:
    """The pair of the greatest size of each key, if no other is as great; the size must tell the candidates apart."""
    top = all_best(pairs, key, size)
    return top.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key))).where("_n = 1").drop("_n")


def longest_contained(printed: DataFrame, titles: DataFrame, group: list[str], body: str, key: str, ident: list[str], least: int = GRAM) -> DataFrame:
    """ident of each printed text with the columns of the longest title whose key it holds, if no other is as long."""
    hits = contains_join(titles, printed, group, key, body, least)
    return longest_unique(hits, ident, F.length(key))
