"""Containers of fixed capacity by vector best-fit: solved on the histogram of sizes, then every item finds its place."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridweave.session import map_arrow, materialise

#: Items of one size that one task ranks; a hotter size is ranked in shares.
SHARE_ROWS = 200_000
#: Steps in which an attention cost is followed that can never exceed its capacity, and so only helps to choose.
LEVELS = 8


@dataclass(frozen=True)
class Capacity:
    """What a container holds: tokens, documents, and attention cost (the sum of squared lengths); the weights of the three in
    the choice of a container, and the rule: "norm" takes the container with the smallest weighted norm of what is left,
    "dot" the one whose room is most in line with the item. An attention capacity of at least tokens squared forbids nothing that
    the tokens allow; it then takes part in the choice alone, in LEVELS steps. None leaves attention out."""

    tokens: int = 2048
    documents: int = 256
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"

    @property
    def longest(self) -> int:
        """The longest item that fits an empty container."""
        return self.tokens if self.attention is None else min(self.tokens, math.isqrt(self.attention))


def best_fit(counts: np.ndarray, cap: Capacity) -> tuple[np.ndarray, int]:
    """Place counts[s] items of each size s <= cap.longest; rows (size, first rank, number, first container, start, place).

    Sizes go in falling order, and each item into the container of the best score among those in which it keeps every
    capacity, else into a new one. Containers with the same room left are one class, and all items of a size that meet a
    class move at once, so the work depends on the number of sizes and classes, not on that of the items. Attention that can
    bind is followed exactly; one that cannot, in LEVELS steps, where a step that a short item does not fill counts as none.
    """
    binds = cap.attention is not None and cap.attention < cap.tokens**2
    step = 1 if binds or cap.attention is None else -(-cap.attention // LEVELS)
    att_cap = 0 if cap.attention is None else cap.attention // step
    caps = np.array([cap.tokens, cap.documents, att_cap or 1], float)
    weights = np.array(cap.weights, float) * [1, 1, bool(att_cap)]
    left = np.zeros((1024, 3), np.int64)
    number = np.zeros(1024, np.int64)
    spans: list[list[tuple[int, int]]] = []
    where: dict[tuple[int, int, int], int] = {}
    used, bins = 0, 0
    runs: list[tuple[int, int, int, int, int, int]] = []

    def add(state: tuple[int, int, int], span: tuple[int, int]) -> None:
        nonlocal left, number, used
        k = where.get(state)
        if k is None:
            if used == len(number):
                left, number = np.resize(left, (2 * used, 3)), np.resize(number, 2 * used)
            k = where[state] = used
            left[k], number[k] = state, 0
            spans.append([])
            used += 1
        number[k] += span[1]
        spans[k].append(span)

    for s in range(len(counts) - 1, -1, -1):
        m, rank, cost = int(counts[s]), 0, s * s // step if att_cap else 0
        need = np.array([s, 1, cost])
        while m:
            room = left[:used] - need
            fits = np.flatnonzero((room >= 0).all(1) & (number[:used] > 0))
            if len(fits):
                if cap.rule == "norm":
                    k = fits[np.argmin((weights * (room[fits] / caps) ** 2).sum(1))]
                else:
                    k = fits[np.argmax((weights * (left[fits] / caps) * (need / caps)).sum(1))]
                state = tuple(int(x) for x in room[k])
                while m and number[k]:
                    b, c = spans[k].pop()
                    take = min(c, m)
                    if take < c:
                        spans[k].append((b + take, c - take))
                    number[k] -= take
                    runs.append((s, rank, take, b, cap.tokens - int(left[k, 0]), cap.documents - int(left[k, 1])))
                    add(state, (b, take))
                    rank, m = rank + take, m - take
                if not number[k]:  # an emptied class goes, the last one takes its place
                    used -= 1
                    del where[tuple(int(x) for x in left[k])]
                    if k != used:
                        left[k], number[k], spans[k] = left[used], number[used], spans[used]
                        where[tuple(int(x) for x in left[k])] = k
                    spans.pop()
                continue
            each = min(cap.documents, cap.tokens // s if s else cap.documents, att_cap // cost if cost else cap.documents)
            for per, q in ((each, m // each), (m % each, 1)):
                if not per or not q:
                    continue
                for i in range(per):
                    runs.append((s, rank, q, bins, i * s, i))
                    rank += q
                add((cap.tokens - per * s, cap.documents - per, att_cap - per * cost), (bins, q))
                bins += q
                m -= per * q
    return np.array(runs, np.int64).reshape(-1, 6), bins


def pack(sizes: DataFrame, item: str, size: str, cap: Capacity = Capacity()) -> DataFrame:
    """doc_id, piece, n_tokens, container, start_token, place: every item, or piece of an item that alone exceeds the capacity.

    Only the histogram of sizes, at most capacity + 1 rows and one more for every SHARE_ROWS items, goes to the driver; the plan
    that comes back has rows for classes of containers, not for items. Every item is ranked among those of its size and share,
    which takes one shuffle of narrow rows that no size can make hot, and looks its container up by binary search.

    Defined cases: a null size counts as zero; items of size zero take no room, but count as documents; pieces of one item
    are numbered from 1, all but the last as long as an empty container takes; repeated rows are items of their own; no items, no containers.
    """
    slim = sizes.select(F.col(item).alias("doc_id"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("n"))
    pieces = slim.select("doc_id", "n", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.col("n") / cap.longest)))).alias("piece"))
    items = pieces.select(
        "doc_id", F.col("piece").cast("int").alias("piece"),
        F.least(F.lit(cap.longest), F.col("n") - (F.col("piece") - 1) * cap.longest).cast("int").alias("n_tokens"),
    )
    counts = np.zeros(cap.tokens + 1, np.int64)
    for r in items.groupBy("n_tokens").count().collect():  # at most tokens + 1 rows
        counts[r["n_tokens"]] = r["count"]
    shares = np.maximum(1, -(-counts // SHARE_ROWS))
    cut = {int(n): int(shares[n]) for n in np.flatnonzero(shares > 1)}
    first = np.cumsum(shares) - shares
    before = np.zeros(int(shares.sum()), np.int64)
    share = F.lit(0)
    if cut:
        many = F.create_map(*[F.lit(x) for n, c in cut.items() for x in (n, c)])
        share = F.pmod(F.xxhash64("doc_id", "piece"), F.coalesce(many[F.col("n_tokens")], F.lit(1))).cast("int")
    items = items.withColumn("share", share)
    if cut:
        for r in items.where(F.col("n_tokens").isin(list(cut))).groupBy("n_tokens", "share").count().collect():
            before[first[r["n_tokens"]] + r["share"]] = r["count"]
        before = np.cumsum(before) - before
        before -= before[first].repeat(shares)
    runs, _ = best_fit(counts, cap)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    plan = items.sparkSession.sparkContext.broadcast((runs, first, before))
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("n_tokens", "share").orderBy("doc_id", "piece")))
    ranked = ranked.select("doc_id", "piece", "n_tokens", "share", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, first, before = plan.value
        heads = (runs[:, 0] << 44) + runs[:, 1]
        for b in batches:
            n, share, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4))
            rank = before[first[n] + share] + rank - 1
            k = np.searchsorted(heads, (n << 44) + rank, "right") - 1
            r = runs[k]
            cols = [b.column(0), b.column(1), b.column(2), pa.array(r[:, 3] + rank - r[:, 1]), pa.array(r[:, 4].astype(np.int32)), pa.array((r[:, 5] + 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "n_tokens", "container", "start_token", "place"])

    kind = dict(items.dtypes)["doc_id"]
    return map_arrow(ranked, run, f"doc_id {kind}, piece int, n_tokens int, container long, start_token int, place int")


def pack_texts(docs: DataFrame, doc_id: str, text: str, path: str, cap: Capacity = Capacity()) -> DataFrame:
    """pack() of documents by their tokens; the sizes are counted once and kept in the shared folder."""
    from gridweave.llm.tokens import count

    return pack(materialise(count(docs, doc_id, text, path), "sizes"), "doc_id", "n_tokens", cap)
