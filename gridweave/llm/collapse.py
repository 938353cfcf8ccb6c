"""Duplicates hidden by formatting: canonical keys, hot ones aggregated on two levels, the others on one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.operators.skew import hot_keys, is_in
from gridweave.session import materialise

#: Shares into which the rows of a hot key are salted.
SALTS = 64
#: What parts the entries of a list besides the semicolon, as a Java character class: all line breaks.
LINE_BREAKS = r"\n\r\x{0B}\x{0C}\x{85}\x{2028}\x{2029}"


def letters_digits(text: Column) -> Column:
    """Only the letters and digits of a text, in lower case."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))


def list_key(text: Column) -> Column:
    """Canonical form of a list of entries parted by semicolons or line breaks, whose order does not count; repeats do."""
    entries = F.transform(F.split(text, f"[;{LINE_BREAKS}]+"), letters_digits)
    return F.array_join(F.array_sort(F.filter(entries, lambda e: e != "")), "\u0001")


def note_key(kind: Column, text: Column, list_kinds: tuple[str, ...] = ("abbreviation", "legend")) -> tuple[Column, Column]:
    """Canonical type and canonical text of a note."""
    k = F.coalesce(letters_digits(kind), F.lit(""))
    return k, F.when(k.isin(*list_kinds), list_key(text)).otherwise(letters_digits(text))


def keyed(rows: DataFrame, ident: str, parts: list[Column], text: Column, carry: dict[str, Column]) -> DataFrame:
    """id, key and carried columns, worked out once and kept in the shared folder; the key is the SHA-256 of all parts, so of
    fixed width. Rows whose text is null or has neither letter nor digit are no case and are left out."""
    key = F.unhex(F.sha2(F.to_json(F.struct(*[p.cast("string").alias(f"p{i}") for i, p in enumerate([*parts, F.col("_text")])])), 256))
    known = rows.withColumn("_text", text).where(F.coalesce("_text", F.lit("")) != "")
    carried = {"carry": F.struct(*[c.alias(k) for k, c in carry.items()])} if carry else {}
    return materialise(known.select(F.col(ident).alias("id"), key.alias("key"), *[c.alias(k) for k, c in carried.items()]), "keys")


def _aggregate(rows: DataFrame, weight: str, hot: list) -> DataFrame:
    """key, keep (smallest id with what it carries), n, total: hot keys over salts first, the others at once."""
    kept = F.min(F.struct("id", "carry")).alias("keep")
    first = [kept, F.count(F.lit(1)).alias("n"), F.sum(f"carry.{weight}").alias("total")]
    cold = rows.where(~is_in("key", hot)).groupBy("key").agg(*first)
    if not hot:
        return cold
    salted = rows.where(is_in("key", hot)).groupBy("key", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).agg(*first)
    return salted.groupBy("key").agg(F.min("keep").alias("keep"), F.sum("n").alias("n"), F.sum("total").alias("total")).unionByName(cold)


def collapse(rows: DataFrame, weight: str, hot: list | None = None) -> DataFrame:
    """One row for each key of keyed(): keep_key (the smallest id), what that row carries, n_copies and the sum of weight.

    Hot keys are found exactly by partial counts, at most 1 / HOT_SHARE. Their rows are salted and aggregated twice; the
    others take one shuffle. Defined cases: a null weight counts as none, all null give null; equal ids of repeated rows
    count as copies; an empty table gives none.
    """
    hot = hot_keys(rows.select("key"), "key") if hot is None else hot
    return _aggregate(rows, weight, hot).select(F.col("keep.id").alias("keep_key"), "keep.carry.*", F.col("n").alias("n_copies"), F.col("total").alias("total"))


def copies(rows: DataFrame, hot: list | None = None) -> DataFrame:
    """keep_key, dup_key: a row for each row of keyed() that is not the one kept of its key.

    Other keys than hot ones: the smallest id over one shuffle. Hot ones: their at most 1 / HOT_SHARE kept ids are
    broadcast to the rows, which stay where they are. Of rows with the same id one is kept and the rest give no row.
    """
    hot = hot_keys(rows.select("key"), "key") if hot is None else hot
    slim = rows.select("key", "id")
    out = slim.where(~is_in("key", hot)).select("id", F.min("id").over(Window.partitionBy("key")).alias("keep"))
    if hot:
        some = rows.where(is_in("key", hot)).select("key", "id", F.struct(F.lit(0).alias("w")).alias("carry"))
        kept = _aggregate(some, "w", hot).select("key", F.col("keep.id").alias("keep"))
        out = out.unionByName(slim.where(is_in("key", hot)).join(F.broadcast(kept), "key").select("id", "keep"))
    return out.where("id <> keep").select(F.col("keep").alias("keep_key"), F.col("id").alias("dup_key"))
