"""References to records that do not exist: a sorted merge of references and parent versions on their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.operators.skew import hot_keys, is_in

#: A hot key is cut into at most so many stretches of time, and its references of one stretch into so many shares.
STRETCHES, SHARES = 64, 8
#: Stand for a reference without time, and for the end of a version that was never deleted.
NO_TIME, NO_END = "9999-12-31 00:00:00", "9999-12-31 23:59:59.999999"


def find_orphans(
    refs: DataFrame,
    parents: DataFrame,
    keys: list[str],
    ref_time: str,
    loaded: str,
    deleted: str,
    carry: list[str],
) -> DataFrame:
    """References that have no live parent, with the reason.

    refs: one row a reference, with `keys`, its time `ref_time` and the columns `carry` to hand through.
    parents: one row a version of a parent, with `keys`, `loaded` and `deleted`. Other columns of both are ignored.
    Result: `carry` and `reason`: "missing" without any version of the key, "deleted" if some version was loaded by the
    time of the reference, else "late". A version is live if loaded <= time and deleted is null or > time.

    Both inputs become one stream, partitioned by key and sorted by time with versions before references, so each
    task merges the two linearly: the running maximum of the versions' ends says at each reference whether one is alive.
    Versions of equal key and load time are one row beforehand (partial aggregation). Hot keys, counted exactly, are
    cut into stretches of time; the state at the start of each stretch, at most hot keys x STRETCHES rows, is broadcast.

    Defined cases: a null in a key matches nothing (missing); a reference without time is judged at the end of all
    times; a version without load time exists but is never loaded (late); repeated references give repeated rows;
    empty inputs give no rows, references without any parents are missing.
    """
    never = F.lit(NO_END).cast("timestamp_ntz")
    names = [f"_k{i}" for i in range(len(keys))]
    whole = F.expr(" and ".join(f"{n} is not null" for n in names))
    versions = (
        parents.select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)],
            F.col(loaded).cast("timestamp_ntz").alias("_loaded"),
            F.col(deleted).cast("timestamp_ntz").alias("_deleted"),
        )
        .where(whole)
        .groupBy(*names, F.coalesce("_loaded", F.lit(NO_TIME).cast("timestamp_ntz")).alias("_t"))
        .agg(F.max(F.when(F.col("_loaded").isNotNull(), F.coalesce("_deleted", never))).alias("_until"))
        .select(*names, "_t", F.lit(0).alias("_kind"), "_until")
    )
    asked = refs.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.coalesce(F.col(ref_time).cast("timestamp_ntz"), F.lit(NO_TIME).cast("timestamp_ntz")).alias("_t"),
        F.lit(1).alias("_kind"),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]).alias("_row"),
    )
    stream = asked.unionByName(versions, allowMissingColumns=True).withColumn("_h", F.xxhash64(*names))
    hot = hot_keys(stream.select("_h"), "_h")
    if hot:
        stream = _cut(stream, hot)
    else:
        stream = stream.withColumns({"_b": F.lit(0), "_s": F.lit(0), "_before": F.lit(None).cast("timestamp_ntz"), "_any": F.lit(False)})
    part = Window.partitionBy(*names, "_b", "_s")
    upto = part.orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = stream.withColumns({
        "_end": F.max("_until").over(upto),
        "_has": F.max(F.col("_kind") == 0).over(part.orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }).where("_kind = 1")
    end = F.greatest("_end", "_before")
    return (
        merged.where(end.isNull() | (end <= F.col("_t")))
        .select(
            *[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(carry)],
            F.when(~(F.col("_has") | F.col("_any")), "missing").when(end.isNotNull(), "deleted").otherwise("late").alias("reason"),
        )
    )


def _cut(stream: DataFrame, hot: list) -> DataFrame:
    """Stretch _b and share _s of each row, and for rows of hot keys the state _before of the stretches before theirs."""
    steps = [i / STRETCHES for i in range(1, STRETCHES)]
    hot_rows = stream.where(is_in("_h", hot))
    cuts = hot_rows.groupBy("_h").agg(
        F.array_distinct(F.percentile_approx(F.unix_micros(F.col("_t").cast("timestamp")), steps, 1000)).alias("_cuts"),
        F.max(F.col("_kind") == 0).alias("_any"),
    )
    at = F.unix_micros(F.col("_t").cast("timestamp"))
    placed = hot_rows.join(F.broadcast(cuts), "_h").withColumn("_b", F.size(F.filter("_cuts", lambda c: c < at))).drop("_cuts")
    state = placed.where("_kind = 0").groupBy("_h", "_b").agg(F.max("_until").alias("_m"))
    # every stretch of a hot key, with the latest end among earlier stretches: at most hot keys x STRETCHES rows
    grid = cuts.select("_h", F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_b")).join(F.broadcast(state), ["_h", "_b"], "left")
    earlier = Window.partitionBy("_h").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = grid.select("_h", "_b", F.max("_m").over(earlier).alias("_before"))
    share = F.when(F.col("_kind") == 1, F.array(F.pmod(F.xxhash64("_row"), F.lit(SHARES)).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.lit(SHARES - 1))
    )
    cold = stream.where(~is_in("_h", hot)).withColumns(
        {"_b": F.lit(0), "_s": F.lit(0), "_before": F.lit(None).cast("timestamp_ntz"), "_any": F.lit(False)}
    )
    return placed.join(F.broadcast(before), ["_h", "_b"], "left").withColumn("_s", F.explode(share)).unionByName(cold)


def report(orphans: DataFrame, by: list[str], reason: str = "reason") -> DataFrame:
    """Number of orphans per group and reason."""
    return orphans.groupBy(*by, reason).agg(F.count(F.lit(1)).alias("n_refs"))
