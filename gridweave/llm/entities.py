"""Matching records of two sources without a common key.

Random walks over a graph of all records, attributes and tokens give skip-gram vectors (the optimum of skip-gram with negative samples,
which is a factorisation of the words' mutual information); hyperplane hashes of the record vectors, in several tables, make blocks; within a block all cosines are exact, and expectation-maximisation over all pairs that meet calibrates
them to confidences. No part of the model is fitted on a sample.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.operators.skew import hot_keys, lookup_join
from gridweave.session import map_arrow, materialise

#: Records that are walked over together, about: all records are, in so many cells as that takes.
CELL = 10_000
#: Walks from each record, nodes of a walk, rounds of the factorisation and its columns beside those kept, and rounds of the calibration.
WALKS, HOPS, TURNS, SPARE, STEPS = 6, 5, 8, 16, 12
#: Bounds of _sample(), which looks at some records of some studies; the model takes nothing from it.
FIT_RECORDS, FIT_STUDIES, FIT_LEAST = 24_000, 2_000, 300
#: Dimensions of the skip-gram vectors and of the hashed character trigrams of the text attributes.
DIM, NAME_DIM, SECTION_DIM, TRACK_DIM = 48, 512, 128, 64
#: Pairs that are scored at a time, about.
PAIRS = 1_000_000

#: Category edges: of the cosine of trigrams, of skip-gram vectors, of the section; and how far numbers are told apart.
LEX, VEC, SEC = np.array([0.15, 0.3, 0.45, 0.6, 0.75, 0.9]), np.array([0.2, 0.4, 0.6, 0.8]), np.array([0.3, 0.6, 0.85])
FAR_1, FAR_2 = 10, 5


@dataclass(frozen=True)
class Layout:
    """How records meet.

    A study of up to `block` right records is one block; a larger one is split by hyperplanes into buckets of `bucket` on average, in
    `tables` hash tables at up to `table_bits` bits and `growth` times as many for each further bit, so that recall does not fall;
    a left record leaves `open` bits of its code, those nearest to their hyperplane, open in each table. Beyond `split` right records a
    block is cut into shares, and beyond `split_left` left records a study that is one block. Of a split study, the pairs of a left
    record within `near` of the best of their block and of the weight of "none" travel one by one; what the others (each under
    e^-near of that) weigh is summed, once for each block where they meet."""

    block: int = 512
    bucket: float = 6
    tables: int = 16
    table_bits: int = 9
    growth: float = 1.13
    open: int = 3
    split: int = 20_000
    split_left: int = 100_000
    near: float = 14.0

    def bits_of(self, size: int) -> int:
        """Hyperplane bits in a study of so many right records; none where the study is one block."""
        return max(self.open + 1, math.ceil(math.log2(size / self.bucket))) if size > self.block else 0

    def tables_of(self, bits: int) -> int:
        """Hash tables of so many bits."""
        return math.ceil(self.tables * self.growth ** max(0, bits - self.table_bits))


@dataclass
class Model:
    """What is fitted: token vectors and weights, and log ratios of the categories of each attribute."""

    vectors: dict[str, np.ndarray] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    ratios: dict[str, np.ndarray] = field(default_factory=dict)
    prior: float = 0.8


def plain_words(text: Column, noise: str = "") -> Column:
    """The lower-case words of letters and digits of a text, sorted, without a leading part that matches noise; none as null."""
    low = F.trim(F.lower(text))
    bare = F.regexp_replace(low, f"^(?:{noise})", "") if noise else low
    return F.nullif(F.array_join(F.sort_array(F.regexp_extract_all(bare, F.lit(r"([\p{L}\p{N}]+)"), 1)), " "), F.lit(""))


def _trigrams(ws: list[str], dim: int) -> np.ndarray:
    """Hashed counts of the trigrams within the words, of length one."""
    v = np.zeros(dim, np.float32)
    for w in ws:
        p = f" {w} "
        for i in range(len(p) - 2):
            v[zlib.crc32(p[i : i + 3].encode()) % dim] += 1
    n = math.sqrt(float(v @ v))
    return v / n if n else v


class Encoding:
    """Vectors of attribute texts under a model, each text worked out once; and the hyperplanes."""

    def __init__(self, model: Model, layout: Layout = Layout()):
        self.model, self.layout = model, layout
        self.known: dict[tuple[str, str], np.ndarray] = {}
        self.nil = np.zeros(DIM, np.float32)
        rng = np.random.default_rng(5)
        self.waves = rng.normal(0, 1, 16)
        self.phase = rng.uniform(0, 2 * np.pi, 16)
        self.total = DIM + NAME_DIM + SECTION_DIM + TRACK_DIM + 32
        self.drawn: dict[int, np.ndarray] = {}

    def _of(self, kind: str, text: str) -> np.ndarray:
        v = self.known.get((kind, text))
        if v is None:
            if len(self.known) > 200_000:
                self.known.clear()
            if kind == "name":
                v = _trigrams(text.split(), NAME_DIM)
            elif kind == "section":
                v = _trigrams(text.split(), SECTION_DIM)
            elif kind == "track":  # equal codes have equal vectors, others nearly orthogonal ones
                v = np.random.default_rng(zlib.crc32(text.encode())).normal(0, 1, TRACK_DIM)
                v = (v / np.linalg.norm(v)).astype(np.float32)
            else:
                v = np.zeros(DIM, np.float32)
                for w in text.split():
                    v = v + self.model.weights.get(w, 0.0) * self.model.vectors.get(w, self.nil)
                n = math.sqrt(float(v @ v))
                v = (v / n if n else v).astype(np.float32)
            self.known[kind, text] = v
        return v

    def stack(self, kind: str, texts: list[str]) -> np.ndarray:
        """A row for each text, and a last one of zeros, that index -1 takes."""
        dim = {"name": NAME_DIM, "section": SECTION_DIM, "track": TRACK_DIM, "vector": DIM}[kind]
        out = np.zeros((len(texts) + 1, dim), np.float32)
        for i, t in enumerate(texts):
            out[i] = self._of(kind, t)
        return out

    def planes(self, bits: int) -> np.ndarray:
        """The hyperplanes of all tables of so many bits, equal in every task."""
        if bits not in self.drawn:
            self.drawn[bits] = np.random.default_rng((5, bits)).normal(0, 1, (self.layout.tables_of(bits) * bits, self.total)).astype(np.float32)
        return self.drawn[bits]

    def sides(self, bits: int, r: Records, rows: np.ndarray) -> np.ndarray:
        """(rows, tables, bits): on which side of each hyperplane some records lie, and how far from it: of trigrams, skip-gram
        vectors and smooth waves of the numbers."""

        def waves(x: np.ndarray, scale: float) -> np.ndarray:
            known = ~np.isnan(x)
            return np.where(known[:, None], np.cos(np.nan_to_num(x)[:, None] * self.waves / scale + self.phase), 0) * math.sqrt(2 / 16)

        name = r.name[rows]
        parts = [
            0.6 * r.vector_of[name], 1.0 * r.name_of[name], 0.3 * r.section_of[r.section[rows]],
            0.9 * self.stack("track", r.tracks)[r.track[rows]], 0.9 * waves(r.n1[rows], 15.0), 0.5 * waves(r.n2[rows], 6.0),
        ]
        far = np.concatenate(parts, 1).astype(np.float32) @ self.planes(bits).T
        return far.reshape(len(rows), -1, bits)

    def codes(self, bits: int, r: Records, rows: np.ndarray) -> np.ndarray:
        """(rows, tables): the codes of right records."""
        return ((self.sides(bits, r, rows) > 0) * (1 << np.arange(bits))).sum(2)

    def probes(self, bits: int, r: Records, rows: np.ndarray) -> np.ndarray:
        """(rows, tables, 2 ** open): the codes that a left record asks for: its bits nearest to their hyperplane are open."""
        far = self.sides(bits, r, rows)
        own = ((far > 0) * (1 << np.arange(bits))).sum(2)
        width = min(self.layout.open, bits)
        weak = 1 << np.argpartition(np.abs(far), width - 1, 2)[:, :, :width].astype(np.int64)
        firm = own & ~weak.sum(2)
        chosen = (np.arange(1 << width)[:, None] >> np.arange(width)) & 1
        return firm[:, :, None] + weak @ chosen.T


#: What stands before the code of a track.
TRACK_LEAD = r"^\s*(track|tr)(?![a-z])"


def track_code(text: str) -> str:
    """What names a track: its letters and digits in lower case, without the word for track before them."""
    return re.sub(r"[\W_]+", "", re.sub(TRACK_LEAD, "", text.lower()))


def track_code_of(text: Column) -> Column:
    """track_code() of a column; empty as null."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(text), TRACK_LEAD, ""), r"[^\p{L}\p{N}]+", ""), F.lit(""))


@dataclass
class Records:
    """Records in columns: each text as the number of a distinct one, -1 for none, beside the vectors of the distinct ones."""

    name: np.ndarray
    section: np.ndarray
    track: np.ndarray
    n1: np.ndarray
    n2: np.ndarray
    rate: np.ndarray
    name_of: np.ndarray
    vector_of: np.ndarray
    section_of: np.ndarray
    tracks: list[str]


def numbered(texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The number of each text among the distinct ones, -1 for null, and those."""
    d = texts.dictionary_encode() if not isinstance(texts, pa.ChunkedArray) else texts.combine_chunks().dictionary_encode()
    return d.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


def records(enc: Encoding, name: pa.Array, section: pa.Array, track: pa.Array, n1: pa.Array, n2: pa.Array, rate: pa.Array) -> Records:
    """Columns of a batch: name and section as plain_words(), track as track_code_of()."""
    names, sections, tracks = numbered(name), numbered(section), numbered(track)
    number = lambda a: a.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
    return Records(
        names[0], sections[0], tracks[0], number(n1), number(n2), number(rate),
        enc.stack("name", names[1]), enc.stack("vector", names[1]), enc.stack("section", sections[1]), tracks[1],
    )


def records_of(enc: Encoding, rows: list[dict]) -> Records:
    """records() of dicts."""
    text, number = (lambda k: pa.array([r[k] for r in rows], pa.string())), (lambda k: pa.array([r.get(k) for r in rows], pa.float64()))
    return records(enc, text("name"), text("section"), text("track"), number("n1"), number("n2"), number("rate"))


def _number_category(d: np.ndarray, far: int) -> np.ndarray:
    none = np.isnan(d)
    d = np.where(none, 0, d)
    return np.where(none, 0, np.where(np.abs(d) <= far, d + far + 1, 2 * far + 2)).astype(np.int32)


def _level(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many edges a cosine reaches; a cosine a hair below an edge reaches it, in whatever order it was summed."""
    return np.searchsorted(edges - 1e-5, x, "right").astype(np.int32)


def grid(left_at: np.ndarray, left_n: np.ndarray, right_at: np.ndarray, right_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of blocks, each of left_n rows from left_at with right_n rows from right_at, left by left."""
    lefts = np.repeat(left_at, left_n) + np.arange(left_n.sum()) - np.repeat(np.cumsum(left_n) - left_n, left_n)
    per = np.repeat(right_n, left_n)
    first = np.cumsum(per) - per
    return np.repeat(lefts, per), np.arange(per.sum()) - np.repeat(first, per) + np.repeat(np.repeat(right_at, left_n), per)


def features(r: Records, left_at: np.ndarray, left_n: np.ndarray, right_at: np.ndarray, right_n: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The pairs of blocks as grid() has them, and of each the category of each attribute, and "chance": how much an equal or a
    different track says, given the rate at which the right track occurs in its study. All cosines are exact."""
    li, ri = grid(left_at, left_n, right_at, right_n)
    sections = len(r.section_of) <= 2000
    cos = {k: np.empty(len(li), np.float32) for k in ("name", "vector", *(() if sections else ("section",)))}
    of = {"name": (r.name_of, r.name), "vector": (r.vector_of, r.name), "section": (r.section_of, r.section)}
    at = 0
    for a, n, b, m in zip(left_at.tolist(), left_n.tolist(), right_at.tolist(), right_n.tolist()):
        for k, out in cos.items():
            vectors, number = of[k]
            np.matmul(vectors[number[a : a + n]], vectors[number[b : b + m]].T, out=out[at : at + n * m].reshape(n, m))
        at += n * m
    sl, sr = r.section[li], r.section[ri]
    if sections:
        sec = _level(r.section_of @ r.section_of.T, SEC)[sl, sr]
    else:
        sec = _level(cos["section"], SEC)
    sec = np.where((sl < 0) | (sr < 0), 0, 1 + sec)
    tl, tr = r.track[li], r.track[ri]
    track = np.where(tl < 0, np.where(tr < 0, 0, 2), np.where(tr < 0, 1, np.where(tl == tr, 3, 4)))
    rate = np.clip(r.rate, 1e-9, 1.0)
    same, other = -np.log(rate)[ri], -np.log(np.maximum(1 - rate, 0.02))[ri]
    return li, ri, {
        "name": _level(cos["name"], LEX) * (len(VEC) + 1) + _level(cos["vector"], VEC), "section": sec, "track": track,
        "chance": np.where(track == 3, same, np.where(track == 4, other, 0.0)),
        "n1": _number_category(r.n1[li] - r.n1[ri], FAR_1), "n2": _number_category(r.n2[li] - r.n2[ri], FAR_2),
    }


SIZES = {"name": (len(LEX) + 1) * (len(VEC) + 1), "section": len(SEC) + 2, "track": 5, "n1": 2 * FAR_1 + 3, "n2": 2 * FAR_2 + 3}


def score(model: Model, cats: dict[str, np.ndarray]) -> np.ndarray:
    """Log likelihood ratio of a match, summed over the attributes."""
    return sum(model.ratios[k][cats[k]] for k in SIZES) + cats["chance"]


# --- fitting: vectors ---------------------------------------------------------------------------------------------------


def walk_pairs(nodes: np.ndarray, n: np.ndarray, words: int, walks: int, rng: np.random.Generator) -> np.ndarray:
    """Pairs of words (nodes below `words`) at most two nodes apart on random walks record - node - record - node from each record;
    nodes: those of record after record, n of each. At two apart, a word stands beside itself too: what leads back to it is its context."""
    at = np.cumsum(n) - n
    order = np.argsort(nodes, kind="stable")
    by_node, n_n = np.repeat(np.arange(len(n)), n)[order], np.bincount(nodes)
    n_at = np.cumsum(n_n) - n_n
    rec = np.repeat(np.flatnonzero(n), walks)
    seq = np.empty((len(rec), HOPS), np.int64)
    for h in range(HOPS):
        x = seq[:, h] = nodes[at[rec] + (rng.random(len(rec)) * n[rec]).astype(np.int64)]
        rec = by_node[n_at[x] + (rng.random(len(rec)) * n_n[x]).astype(np.int64)]
    pairs = np.concatenate([np.stack([seq[:, i], seq[:, i + d]], 1) for d in (1, 2) for i in range(HOPS - d)])
    apart = np.repeat([1, 2], [(HOPS - 1) * len(seq), (HOPS - 2) * len(seq)])
    pairs = pairs[(pairs < words).all(1) & ((apart == 2) | (pairs[:, 0] != pairs[:, 1]))]
    pairs = np.concatenate([pairs, pairs[:, ::-1]])
    rng.shuffle(pairs)
    return pairs


def counted(pairs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, and how often each occurs."""
    key, n = np.unique(pairs[:, 0] * words + pairs[:, 1], return_counts=True)
    return key // max(1, words), key % max(1, words), n


def _information(x: np.ndarray, y: np.ndarray, n: np.ndarray, of_word: np.ndarray) -> np.ndarray:
    """Positive mutual information of pairs that occur n times; of_word: pairs of each word. Frequent words are damped to the power
    3/4, as in negative samples."""
    damped = of_word.astype(np.float64) ** 0.75
    return np.maximum(0, np.log(n * damped.sum() ** 2 / (of_word.sum() * damped[x] * damped[y])))


def _times(x: np.ndarray, y: np.ndarray, value: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a sparse matrix (x in order) times columns: the numbers of those that have values, and they."""
    at = np.flatnonzero(np.concatenate([[True], np.diff(x) != 0])) if len(x) else np.zeros(0, np.int64)
    out = np.empty((len(at), columns.shape[1]))
    ends = np.append(at[1:], len(x))
    for i in range(0, len(at), 500):  # some words at a time
        low, high = at[i], ends[min(i + 500, len(at)) - 1]
        out[i : i + 500] = np.add.reduceat(value[low:high, None] * columns[y[low:high]], at[i : i + 500] - low)
    return x[at], out


def _factored(words: int, times: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Vectors of words from the largest factors of a symmetric matrix, of which times() gives the product with some columns: centred
    and of length one."""
    q = np.linalg.qr(np.random.default_rng(7).normal(0, 1, (words, min(words, DIM + SPARE))))[0]
    for _ in range(TURNS):
        q = np.linalg.qr(times(q))[0]
    values, turn = np.linalg.eigh(q.T @ times(q))
    most = np.argsort(-np.abs(values), kind="stable")[:DIM]
    v = np.zeros((words, DIM))
    v[:, : len(most)] = q @ turn[:, most] * np.sqrt(np.abs(values[most]))
    v -= v.mean(0)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def packed(lists: list[list], known: dict, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of records one after the other, and how many each has. Words (str) by their number in known, others left out; attributes
    (tuples) numbered after them, those of a single record, which lead nowhere, and of over `top`, which lead everywhere, left out."""
    degree = Counter(x for ns in lists for x in set(ns) if not isinstance(x, str))
    number = dict(known)
    for x, d in degree.items():
        if 2 <= d <= top:
            number[x] = len(number)
    rows = [sorted({number[x] for x in ns if x in number}) for ns in lists]
    return np.array([x for ns in rows for x in ns], np.int32), np.array([len(ns) for ns in rows], np.int32)


def walk_vectors(nodes: list[list[str]]) -> dict[str, np.ndarray]:
    """Skip-gram vectors of the words of records (lists of words, and of attributes, which begin with #), as _vectors() has them."""
    degree = Counter(x for ns in nodes for x in set(ns) if x[0] != "#")
    top = max(20, len(nodes) // 5)
    words = sorted(x for x, d in degree.items() if 2 <= d <= top)
    flat, n = packed([[(x,) if x[0] == "#" else x for x in ns] for ns in nodes], {x: i for i, x in enumerate(words)}, top)
    x, y, c = counted(walk_pairs(flat, n, len(words), WALKS, np.random.default_rng(7)), len(words))
    if not len(x):
        return {}
    value = _information(x, y, c, np.bincount(x, c, len(words)))

    def times(columns: np.ndarray) -> np.ndarray:
        out = np.zeros(columns.shape)
        rows, got = _times(x, y, value, columns)
        out[rows] = got
        return out

    return dict(zip(words, _factored(len(words), times)))


def _vocabulary(names: DataFrame) -> tuple[int, dict[str, int]]:
    """How many names there are, and how many have each word that two or more have, in order of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        seen: Counter = Counter()
        for b in batches:
            seen[""] += b.num_rows
            for text, n in Counter(b.column(0).to_pylist()).items():
                for w in set((text or "").split()):
                    seen[w] += n
            if len(seen) > 500_000:
                yield out()
                seen.clear()
        yield out()

    counts = map_arrow(names, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1 or word = ''")
    found = dict(sorted((r["word"], r["n"]) for r in counts.collect()))
    return found.pop("", 0), found


def _cells(records: DataFrame, words: dict[str, int], total: int) -> DataFrame:
    """cell, nodes, n: all records as packed(), a row for each cell. Records of a study and day are in one cell, so that all that
    share an attribute are; of so many that they are more than a cell, in several."""
    known = records.sparkSession.sparkContext.broadcast(words)
    top = max(20, total // 5)
    place = F.xxhash64(*_FIELDS)
    hot = records.where("n1 is not null").groupBy("study", "n1").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL)
    hot = hot.select("study", "n1", F.ceil(F.col("n") / CELL).alias("pieces"))
    own = F.when(F.col("n1").isNull(), F.col("place")).otherwise(F.pmod("place", F.coalesce("pieces", F.lit(1))))
    n_cells = math.ceil(max(1, total) / CELL)
    rows = records.select(*_FIELDS, place.alias("place")).join(F.broadcast(hot), ["study", "n1"], "left")
    rows = rows.select(F.pmod(F.xxhash64("study", "n1", own), F.lit(n_cells)).cast("int").alias("cell"), "place", *_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            nodes, n = packed(lists, known.value, top)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([nodes.tobytes()]), pa.array([n.tobytes()])], names=["cell", "nodes", "n"])

        at, lists = None, []
        for batch in batches:
            for cell, _, study, name, section, track, n1, n2 in zip(*(c.to_pylist() for c in batch.columns)):
                if cell != at:
                    if lists:
                        yield out()
                    at, lists = cell, []
                near = [(study, n1, n2), (study, n1, "#", track)] if n1 is not None else []
                lists.append([*(name or "").split(), *near, (section,)])
        if lists:
            yield out()

    ordered = rows.repartition(n_cells, "cell").sortWithinPartitions("cell", "place", *_FIELDS)
    return materialise(map_arrow(ordered, run, "cell int, nodes binary, n binary"), "cells")


def _vectors(records: DataFrame, names: DataFrame) -> Model:
    """Vectors and weights of words by walks from every record. Cells count which words their walks put together; the counts of all
    are one table, which tasks multiply by the columns that the driver turns. names: of all nodes; words of one only, and of over a
    fifth, have no vector."""
    spark = records.sparkSession
    total, counts = _vocabulary(names)
    words = [w for w, n in counts.items() if n <= max(20, total // 5)]
    size = len(words)
    if size < 2:
        return Model()
    cells = _cells(records, {w: i for i, w in enumerate(words)}, total)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                nodes, n = (np.frombuffer(r[c], np.int32) for c in ("nodes", "n"))
                columns = counted(walk_pairs(nodes, n, size, WALKS, np.random.default_rng((7, r["cell"]))), size)
                yield from pa.Table.from_arrays([pa.array(c) for c in columns], names=["x", "y", "n"]).to_batches(50_000)

    pairs = map_arrow(cells, walk, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n"))
    pairs = materialise(pairs.repartition("x").sortWithinPartitions("x", "y"), "pairs")
    of_word = np.zeros(size, np.int64)
    for r in pairs.groupBy("x").agg(F.sum("n").alias("n")).collect():
        of_word[r["x"]] = r["n"]
    if not of_word.any():
        return Model()

    def times(columns: np.ndarray) -> np.ndarray:
        given = spark.sparkContext.broadcast((columns.astype(np.float32), of_word))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            columns, of_word = given.value
            for batch in batches:
                x, y, n = (batch.column(c).to_numpy() for c in ("x", "y", "n"))
                rows, got = _times(x, y, _information(x, y, n, of_word), columns)
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()]), pa.array([got.tobytes()])], names=["rows", "got"])

        out = np.zeros(columns.shape)
        for r in map_arrow(pairs, run, "rows binary, got binary").collect():
            rows = np.frombuffer(r["rows"], np.int64)
            out[rows] += np.frombuffer(r["got"]).reshape(len(rows), -1)
        given.unpersist()
        return out

    return Model(vectors=dict(zip(words, _factored(size, times))), weights={w: math.log(total / counts[w]) for w in words})


# --- fitting: calibration ------------------------------------------------------------------------------------------------

#: Signs of a pair's code: the categories of all attributes as one number below 1 << CODE_BITS.
CODE_BITS = 18


def code_of(cats: dict[str, np.ndarray]) -> np.ndarray:
    """The categories of pairs as one number."""
    code = np.zeros(len(cats["name"]), np.int64)
    for k, n in SIZES.items():
        code = code * n + cats[k]
    return code


def _by_attribute(of_code: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over all codes, by attribute and category."""
    cube = of_code.reshape(tuple(SIZES.values()))
    return {k: cube.sum(tuple(j for j in range(len(SIZES)) if j != i)) for i, k in enumerate(SIZES)}


def _ratio_of_code(ratios: dict[str, np.ndarray]) -> np.ndarray:
    """The log ratio of each code, without chance."""
    out = np.zeros(1)
    for k in SIZES:
        out = (out[:, None] + ratios[k][None, :]).ravel()
    return out


def _grouped(owner: np.ndarray, key: np.ndarray, n: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of n and w by owner and key, in order."""
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    at = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(key) != 0)]))
    return owner[at], key[at], np.add.reduceat(n[order], at), np.add.reduceat(w[order], at)


_PAIRS_ROW = "pid long, size long, keys binary, n binary, w binary"


def _listed(pid: np.ndarray, size: np.ndarray, owner: np.ndarray, key: np.ndarray, n: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    """A row for each left record: its pairs, ordered by owner, which numbers pid and size."""
    at = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0]))
    ends = np.append(at[1:], len(owner))
    who = owner[at]
    cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(at.tolist(), ends.tolist())], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(pid[who]), pa.array(size[who]), cut(key.astype(np.int64)), cut(n.astype(np.int32)), cut(w.astype(np.float32))], names=["pid", "size", "keys", "n", "w"])


def _flat(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, ...]:
    """The inverse of _listed(): pid, size, owner, key, n, w."""
    d = {c: rows.column(c) for c in ("pid", "size", "keys", "n", "w")}
    keys = d["keys"].to_pylist()
    join = lambda xs, kind: np.frombuffer(b"".join(xs), kind)
    owner = np.repeat(np.arange(len(keys)), [len(k) // 8 for k in keys])
    return d["pid"].to_numpy(), d["size"].to_numpy(), owner, join(keys, np.int64), join(d["n"].to_pylist(), np.int32), join(d["w"].to_pylist(), np.float32).astype(np.float64)


def block_pairs(batches: Iterator[pa.RecordBatch], model: Model, layout: Layout = Layout()) -> Iterator[pa.RecordBatch]:
    """What the calibration needs of the pairs of each block (rows as in score_blocks): for a left record, by code, how many there are
    and the sum of what chance says. Of a split study, pairs stay apart by their right record, as they may meet in other blocks too."""
    enc = Encoding(model)

    def work(d: dict, r: Records, exact: np.ndarray, pid: np.ndarray, ids: np.ndarray, size: np.ndarray, blocks: tuple) -> Iterator[pa.RecordBatch]:
        li, ri, cats = features(r, *blocks)
        key = code_of(cats)
        rid = d["rid"].fill_null(0).to_numpy(zero_copy_only=False) & ((1 << 62 - CODE_BITS) - 1)
        key = np.where(size[li] <= layout.block, key, key | rid[ri] << CODE_BITS)
        yield _listed(pid, size, *_grouped(li, key, np.ones(len(li), np.int32), np.exp(cats["chance"])))

    yield from _block_by_block(batches, enc, work)


def merge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of block_pairs() of split studies, ordered by pid, with each pair of a left record once, summed by code."""

    def merged(table: pa.Table) -> pa.RecordBatch:
        pid, size, owner, key, n, w = _flat(table)
        own = np.flatnonzero(np.concatenate([[True], np.diff(pid) != 0]))
        owner = np.repeat(np.arange(len(own)), np.diff(np.append(own, len(pid))))[owner]
        order = np.lexsort((key, owner))
        owner, key, n, w = (x[order] for x in (owner, key, n, w))
        first = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(key) != 0)])
        owner, key, n, w = (x[first] for x in (owner, key, n, w))
        return _listed(pid[own], size[own], *_grouped(owner, key & ((1 << CODE_BITS) - 1), n, w))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        pid = batch.column("pid").to_numpy()
        if not len(pid):
            continue
        begin = int(np.searchsorted(pid, pid[-1]))  # the last one may go on
        if begin or (held and held[0].column("pid")[0].as_py() != pid[0]):
            ready = [*held, batch.slice(0, begin)]
            if held and begin == 0:
                ready = held
            yield merged(pa.Table.from_batches(ready))
            held = []
        held.append(batch.slice(begin))
    if held:
        yield merged(pa.Table.from_batches(held))


def _all_pairs(left: DataFrame, right: DataFrame, model: Broadcast) -> np.ndarray:
    """By attribute and category, how many pairs of a left and a right record of one study there are, whether they meet or not, each
    study's divided by its right records. An attribute's pairs are counted by its distinct values, not one by one. Rows: study, size, fields."""

    def values(df: DataFrame, side: int) -> DataFrame:
        kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in SIZES])
        one = df.select("study", "size", F.explode(kinds).alias("x")).groupBy("study", "size", "x.kind", "x.value").agg(F.count(F.lit(1)).alias("n"))
        return one.select("study", "size", "kind", F.lit(side).alias("side"), "value", "n")

    v = materialise(values(right, 0).unionByName(values(left, 1)), "values")
    most = v.groupBy("study", "kind").agg(F.sum(1 - F.col("side")).alias("r"), F.sum("side").alias("l"))
    most = most.select("study", "kind", F.ceil(F.greatest(F.lit(1), F.col("r") * F.col("l")) / 10_000_000).cast("int").alias("shares"))
    own = F.pmod(F.xxhash64("value"), "shares").cast("int")
    spread = v.join(most, ["study", "kind"]).withColumn("share", F.explode(F.when(F.col("side") == 1, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("shares") - 1))))
    spread = spread.select("study", "kind", "share", "side", "size", "value", "n").repartition("study", "kind", "share").sortWithinPartitions("study", "kind", "share", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoding(model.value)
        out = {k: np.zeros(n) for k, n in SIZES.items()}

        def count(kind: str, size: int, ls: list[tuple], rs: list[tuple]) -> None:
            for i in range(0, len(ls), 1000):
                for j in range(0, len(rs), 1000):
                    part = [*ls[i : i + 1000], *rs[j : j + 1000]]
                    n_l = min(1000, len(ls) - i)
                    base = {"name": None, "section": None, "track": None}
                    rows = [base | {kind: float(x) if kind in ("n1", "n2") and x is not None else x, "rate": 1.0} for x, _ in part]
                    cats = features(records_of(enc, rows), *(np.array([x]) for x in (0, n_l, n_l, len(part) - n_l)))[2]
                    n = np.array([n for _, n in part], np.float64)
                    out[kind] += np.bincount(cats[kind], np.outer(n[:n_l], n[n_l:]).ravel() / size, SIZES[kind])

        at, rs, ls = None, [], []
        for batch in batches:
            for study, kind, share, side, size, value, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (study, kind, share) != at:
                    if at:
                        count(at[1], last, ls, rs)
                    at, rs, ls, last = (study, kind, share), [], [], size
                (ls if side else rs).append((value, n))
                if len(ls) >= 10_000:
                    count(kind, size, ls, rs)
                    ls = []
        if at:
            count(at[1], last, ls, rs)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(list(out.values())).tobytes()])], names=["sums"])

    return _summed(spread, run)


def _start() -> dict[str, np.ndarray]:
    """First ratios: names that read alike with numbers that agree."""
    start = {k: np.zeros(n) for k, n in SIZES.items()}
    start["name"] = np.repeat(np.array([-4, -2, 0, 1.5, 3, 4, 5.0]), len(VEC) + 1)
    start["n1"] = np.full(SIZES["n1"], -2.0)
    start["n1"][0], start["n1"][FAR_1 : FAR_1 + 3] = 0, [2, 4, 2]
    start["n2"] = np.full(SIZES["n2"], -1.0)
    start["n2"][0], start["n2"][FAR_2 : FAR_2 + 3] = 0, [0.5, 1.5, 0.5]
    start["track"] = np.array([0, 0, 0, -0.1, -2.0])
    start["section"] = np.array([0, -2, 0, 1, 1.5])
    return start


def expected(batches: Iterator[pa.RecordBatch], ratios: dict[str, np.ndarray], prior: float, count: bool, layout: Layout) -> Iterator[pa.RecordBatch]:
    """Sums over left records and their pairs (rows of block_pairs(), each left record in one), by code: of the posterior, of the
    posterior over the study's size, and, to count, of the pairs over that size in studies that are one block."""
    codes = math.prod(SIZES.values())
    weight = np.exp(np.clip(_ratio_of_code(ratios), -60, 60)) * prior
    sums = np.zeros((3, codes))
    for batch in batches:
        if batch.num_rows:
            _, size, owner, code, n, w = _flat(batch)
            size = size[owner].astype(np.float64)
            lr = weight[code] * w / size
            p = lr / (np.bincount(owner, lr) + 1 - prior)[owner]
            sums[0] += np.bincount(code, p, codes)
            sums[1] += np.bincount(code, p / size, codes)
            if count:
                sums[2] += np.bincount(code, np.where(size <= layout.block, n / size, 0), codes)
    flat = np.concatenate([np.concatenate(list(_by_attribute(s).values())) for s in sums])
    yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()])], names=["sums"])


def _summed(df: DataFrame, run: Callable) -> np.ndarray:
    """Sum of the rows that run() gives of each partition."""
    return sum((np.frombuffer(r["sums"]) for r in map_arrow(df, run, "sums binary").collect()), np.zeros(1))


def _split_sums(flat: np.ndarray) -> dict[str, np.ndarray]:
    return dict(zip(SIZES, np.split(flat, np.cumsum(list(SIZES.values()))[:-1])))


def _calibrated(model: Model, pairs: DataFrame, asked: int, apart: np.ndarray, layout: Layout) -> Model:
    """The model with ratios and prior by expectation-maximisation over all left records. pairs: rows of block_pairs(), each left record
    in one; asked: how many left records there are, with and without pairs; apart: all pairs of split studies, as of _all_pairs().
    Every left record weighs alike: its pairs that are no match count one over the study's right records each. A pair of a split
    study that meets in no block is no match."""
    ratios, prior = _start(), model.prior
    total = None
    width = sum(SIZES.values())
    for step in range(STEPS):
        given = pairs.sparkSession.sparkContext.broadcast((ratios, prior, total is None))
        sums = _summed(pairs, lambda it, given=given: expected(it, *given.value, layout))
        if total is None:
            total = sums[2 * width :] + apart
        m = {k: 0.2 + x for k, x in _split_sums(sums[:width]).items()}
        u = {k: 0.2 + np.maximum(x, 0) for k, x in _split_sums(total - sums[width : 2 * width]).items()}
        ratios = {k: np.log(m[k] / m[k].sum()) - np.log(u[k] / u[k].sum()) for k in SIZES}
        # of tracks, only whether they are given is judged against other pairs; equality is judged against its rate
        t_m, t_u = np.append(m["track"][:3], m["track"][3:].sum()), np.append(u["track"][:3], u["track"][3:].sum())
        both = np.log(t_m / t_m.sum()) - np.log(t_u / t_u.sum())
        ratios["track"] = np.append(both[:3], both[3] + np.log(m["track"][3:] / m["track"][3:].sum()))
        prior = float(min(0.99, (1 + sums[: SIZES["name"]].sum()) / (2 + asked)))
        given.unpersist()
    return Model(model.vectors, model.weights, ratios, prior)


# --- the study attribute: equal or nearly equal codes share a node -----------------------------------------------------


def _forms(gram: Column) -> Column:
    """A gram as it is, and without the zeros that lead a number after a letter."""
    return F.array_distinct(F.array(gram, F.regexp_replace(gram, "(?<=[a-z])0+(?=[0-9])", "")))


def _grams(label: Column) -> Column:
    """Words, pairs of neighbouring words and all words of a label, letters and digits only, with and without leading zeros."""
    w = F.filter(F.split(F.lower(label), "[^a-z0-9]+"), lambda x: x != "")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - 1)), lambda i: F.concat(F.coalesce(F.get(w, i - 1), F.lit("")), F.coalesce(F.get(w, i), F.lit(""))))
    every = F.concat(w, pairs, F.array(F.array_join(w, "")))
    return F.filter(F.array_distinct(F.flatten(F.transform(every, _forms))), lambda g: F.length(g) >= 3)


def _nearby(gram: Column) -> Column:
    """A gram and all forms with one sign left out: two grams of one slip share one of them."""
    less = F.transform(F.sequence(F.lit(1), F.length(gram)), lambda i: F.concat(F.substring(gram, F.lit(1), i - 1), F.substring(gram, i + 1, F.length(gram))))
    return F.array_distinct(F.concat(F.array(gram), less))


def resolve_studies(labels: DataFrame, studies: DataFrame) -> DataFrame:
    """label, study, exact: studies (study, names array) that a distinct label may mean: those of an equal gram, else those with
    a gram one slip away. An equal gram of three signs may be chance and leaves those one slip away in. Labels and studies share
    token nodes; nothing is compared that shares none."""

    grams = labels.select("label", F.explode(_grams(F.col("label"))).alias("g"))
    a = grams.select("label", "g", F.explode(_nearby(F.col("g"))).alias("node"))
    named = studies.select("study", F.explode("names").alias("nm")).where("nm is not null")
    full = named.select("study", F.explode(_forms(F.regexp_replace(F.lower("nm"), "[^a-z0-9]+", ""))).alias("g")).where("length(g) >= 3")
    b = full.select("study", F.col("g").alias("h"), F.explode(_nearby(F.col("g"))).alias("node"))
    same = F.col("g") == F.col("h")
    pairs = a.join(b, "node").groupBy("label", "study").agg(F.max(same).alias("exact"), F.max(same & (F.length("g") >= 4)).alias("sure"))
    best = pairs.groupBy("label").agg(F.max("sure").alias("any"))
    return pairs.join(best, "label").where("exact or not any").select("label", "study", "exact")


# --- the operator -----------------------------------------------------------------------------------------------------

_FIELDS = ["study", "name", "section", "track", "n1", "n2"]
_ROW = "study string, name string, section string, track string, n1 double, n2 double, size long, shares int, pid long, exact boolean, id string, rate double, rid long"


def match(left: DataFrame, right: DataFrame, studies: DataFrame, noise: str = "", least: float = 0.5, layout: Layout = Layout()) -> DataFrame:
    """left_id, study, right_id, confidence: for each left record the right record that it belongs to, if one reaches `least`.

    left: id, label, name, section, track, n1, n2; right: id, study, name, section, track, n1, n2; studies: study, names.
    Records of a side that are equal in all attributes, names and sections by their words, are one node (the right one with the
    smallest id stands for them). The study attribute is resolved over shared token nodes. Nodes meet by study, and in large studies by (table,
    hyperplane bits): a right node has one code in each table, a left one asks for all that differ from its own only in the open
    bits; see Layout. Every pair of a block is scored. Confidence is the posterior among all candidates and "none", under the calibrated ratios.

    Defined cases: null attributes say neither yes nor no; records without label or study, and labels of unknown studies, match
    nothing; ties go to the smaller study, then id; ids that repeat give repeated rows; empty tables give no rows.
    """
    spark = left.sparkSession
    tidy = {"name": plain_words(F.col("name"), noise), "section": plain_words(F.col("section"), noise), "track": track_code_of(F.col("track")), "n1": F.col("n1").cast("double"), "n2": F.col("n2").cast("double")}
    sig = F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("label", *_FIELDS[1:])])), 256))
    lefts = left.where("label is not null").withColumns(tidy).withColumn("sig", sig)
    lefts = materialise(lefts.select("id", "sig", "label", *_FIELDS[1:]), "lefts")
    nodes = lefts.groupBy("sig").agg(*[F.first(c).alias(c) for c in ("label", *_FIELDS[1:])], F.count(F.lit(1)).alias("copies"))
    nodes = materialise(nodes.withColumn("lh", F.xxhash64("label")), "nodes")
    means = resolve_studies(nodes.select("label").distinct(), studies)
    few = means.withColumn("lh", F.xxhash64("label")).groupBy("lh", "label").agg(F.collect_list(F.struct("study", "exact")).alias("m"))
    placed = lookup_join(nodes.drop("label"), few.drop("label"), "lh", hot_keys(nodes.select("lh"), "lh")).select("*", F.explode("m").alias("s"))
    placed = materialise(placed.select("sig", "copies", "s.exact", "s.study", *_FIELDS[1:], F.monotonically_increasing_id().alias("pid")), "left")
    rights = right.where("study is not null").withColumns(tidy).groupBy(*_FIELDS).agg(F.min("id").alias("id"))
    rights = materialise(rights.select("id", *_FIELDS, F.xxhash64("study", "track").alias("tk")), "right")

    asking = placed.groupBy("study").agg(F.count(F.lit(1)).alias("n_l"))
    sizes = rights.groupBy("study").agg(F.count(F.lit(1)).alias("size")).join(asking, "study")
    shares = F.when(F.col("size") <= layout.block, F.ceil(F.col("n_l") / layout.split_left)).otherwise(1).cast("int")
    sizes = materialise(sizes.select("study", "size", "n_l", shares.alias("shares")), "sizes")
    hot = sorted(set(hot_keys(sizes, "study", weight="size", least=1000) + hot_keys(sizes, "study", weight="n_l", least=1000)))
    sizes = sizes.drop("n_l")
    of_track = rights.groupBy("tk").agg(F.count(F.lit(1)).alias("n_track"))
    sized = lookup_join(lookup_join(rights, of_track, "tk", hot_keys(of_track, "tk", weight="n_track")), sizes, "study", hot)
    sized = materialise(sized.select("id", *_FIELDS, "size", "shares", (F.col("n_track") / F.col("size")).alias("rate")), "sized")
    names = placed.select("sig", "name").distinct().select("name").unionByName(sized.select("name"))
    words = spark.sparkContext.broadcast(_vectors(placed.select(*_FIELDS).unionByName(sized.select(*_FIELDS)), names))
    asked = lookup_join(placed, sizes, "study", hot)
    none = F.lit(None)
    left_rows = asked.select(*_FIELDS, "size", "shares", "pid", "exact", none.cast("string").alias("id"), none.cast("double").alias("rate"), none.cast("long").alias("rid"))
    right_rows = sized.select(*_FIELDS, "size", "shares", none.cast("long").alias("pid"), F.lit(True).alias("exact"), "id", "rate", F.xxhash64("id", *_FIELDS).alias("rid"))
    large = _large(right_rows, words, layout)

    def in_blocks(lefts: DataFrame) -> DataFrame:
        rows = _cut(_keyed(lefts.unionByName(right_rows), words, layout), large).repartition("block", "cell")
        return rows.sortWithinPartitions("block", "cell", "study", F.col("pid").isNotNull(), "id")

    model = spark.sparkContext.broadcast(_fitted(left_rows, right_rows, in_blocks, words, layout))
    found = map_arrow(in_blocks(left_rows), lambda it: score_blocks(it, model.value, layout), "pid long, id string, llr double, rest double")

    each = found.groupBy("pid", "id").agg(F.max("llr").alias("llr"), F.sum("rest").alias("rest"))
    weight = F.when(F.col("llr").isNull(), 0.0).otherwise(F.exp(F.least(F.col("llr"), F.lit(80.0)))) + F.col("rest")
    of_place = each.groupBy("pid").agg(F.min(F.when(F.col("id").isNotNull(), F.struct((-F.col("llr")).alias("cost"), F.col("id")))).alias("t"), F.sum(weight).alias("w"))
    prior = model.value.prior
    known = of_place.join(asked.select("pid", "sig", "study", "size"), "pid")
    top = known.groupBy("sig").agg(F.min(F.when(F.col("t").isNotNull(), F.struct("t.cost", "study", "t.id", "size"))).alias("t"), F.sum(F.col("w") * prior / F.col("size")).alias("all"))
    own_weight = F.exp(F.least(-F.col("t.cost"), F.lit(80.0))) * prior / F.col("t.size")
    best = top.select("sig", F.col("t.study").alias("study"), F.col("t.id").alias("right_id"), (own_weight / (F.col("all") + (1 - prior))).alias("confidence")).where(F.col("confidence") >= least)
    hot_sigs = hot_keys(placed.select("sig", "copies"), "sig", weight="copies")
    return lookup_join(lefts.select("sig", F.col("id").alias("left_id")), best, "sig", hot_sigs).select("left_id", "study", "right_id", "confidence")


def _keyed(rows: DataFrame, model: Broadcast, layout: Layout) -> DataFrame:
    """The rows in every block where they belong, with tab and code; a study that is one block has the shares of its left rows as codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoding(model.value, layout)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                d = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                size, shares = (d[c].to_numpy(zero_copy_only=False) for c in ("size", "shares"))
                asks = d["pid"].is_valid().to_numpy(zero_copy_only=False)
                pid = d["pid"].fill_null(0).to_numpy(zero_copy_only=False)
                bits = np.array([layout.bits_of(s) for s in size.tolist()], np.int64)
                keys: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for pick, copies, code in ((asks, 1, pid % shares), (~asks, shares, None)):
                    i = np.flatnonzero(pick & (bits == 0))
                    n = np.broadcast_to(copies, len(size))[i]
                    rows = np.repeat(i, n)
                    keys.append((rows, np.zeros(len(rows), np.int64), code[rows] if code is not None else np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)))
                some = bits > 0
                if some.any():
                    r = records(enc, d["name"], d["section"], d["track"], d["n1"], d["n2"], d["rate"])
                for b in np.unique(bits[some]).tolist():
                    for pick, codes in ((asks, enc.probes), (~asks, lambda *a: enc.codes(*a)[:, :, None])):
                        i = np.flatnonzero(pick & (bits == b))
                        if len(i):
                            code = codes(b, r, i)
                            _, tables, asked = code.shape
                            keys.append((np.repeat(i, tables * asked), np.tile(np.repeat(np.arange(tables), asked), len(i)), code.ravel()))
                for rows, tab, code in keys:
                    for x in range(0, len(rows), 50_000):
                        out = part.take(pa.array(rows[x : x + 50_000]))
                        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(tab[x : x + 50_000].astype(np.int32)), pa.array(code[x : x + 50_000].astype(np.int64))], names=[*part.schema.names, "tab", "code"])

    return map_arrow(rows, run, f"{_ROW}, tab int, code long")


def _large(rights: DataFrame, model: Broadcast, layout: Layout) -> DataFrame | None:
    """block and parts of the blocks of more than layout.split right rows, None if there are none. Only studies of so many count."""
    rows = rights.where(F.col("size") > max(layout.split, layout.block))
    if rows.isEmpty():
        return None
    n = _keyed(rows, model, layout).groupBy(F.xxhash64("study", "tab", "code").alias("block")).agg(F.count(F.lit(1)).alias("n"))
    large = materialise(n.where(F.col("n") > layout.split).select("block", F.ceil(F.col("n") / layout.split).cast("int").alias("parts")), "large")
    return None if large.isEmpty() else large


def _cut(keyed: DataFrame, large: DataFrame | None) -> DataFrame:
    """keyed with block and cell: a large block is cut into parts x parts cells, in which every right row meets every left one once."""
    rows = keyed.withColumn("block", F.xxhash64("study", "tab", "code")).drop("tab", "code", "shares")
    if large is None:
        return rows.withColumn("cell", F.lit(0))
    parts = F.coalesce("parts", F.lit(1))
    own, every = F.pmod(F.xxhash64("pid", "id"), parts).cast("int"), F.sequence(F.lit(0), parts - 1)
    cells = F.transform(every, lambda i: F.when(F.col("pid").isNull(), own * parts + i).otherwise(i * parts + own))
    return rows.join(large, "block", "left").select(*rows.columns, F.explode(cells).alias("cell"))


def _quotas(counts: list[tuple], records: int) -> dict:
    """study: how many records it gives, of (study, n) in order: all alike at most so many that the sum keeps to records, but
    FIT_LEAST at least; where that is too much, the last studies give none. The first always gives some."""
    kept, spent = [], 0
    for study, n in counts:
        spent += min(n, FIT_LEAST)
        if kept and spent > records:
            break
        kept.append((study, n))
    level, left = FIT_LEAST, records
    for i, n in enumerate(sorted(n for _, n in kept)):
        level = max(FIT_LEAST, left // (len(kept) - i))
        if n > level:
            break
        left -= n
    return {study: min(n, level) for study, n in kept}


def _sample(left: DataFrame, right: DataFrame) -> tuple[list[dict], list[dict], dict]:
    """Left records, right records and the share of the right ones by study, in fixed order. Studies that have both sides come by a
    hash of the study, their records by a hash of the record. For looking at some records; match() takes nothing from it."""
    n_l, n_r = (df.groupBy("study").agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "n_l"), (right, "n_r")))
    studies = n_l.join(n_r, "study").orderBy(F.xxhash64(F.lit("fit"), "study"), "study").limit(FIT_STUDIES).collect()
    size = {r["study"]: (r["n_l"], r["n_r"]) for r in studies}
    asked, given = (_quotas([(s, n[k]) for s, n in size.items()], FIT_RECORDS // 2) for k in (0, 1))
    chosen = [s for s in size if s in asked and s in given]
    share = {s: given[s] / size[s][1] for s in chosen}
    if not chosen:
        return [], [], {}
    steps = 1 << 40
    parts = [(s, int(steps * asked[s] / size[s][0]), int(steps * share[s])) for s in chosen]
    table = F.broadcast(left.sparkSession.createDataFrame(parts, "study string, t_l long, t_r long"))
    rows = []
    for df, t, fields in ((left, "t_l", _FIELDS), (right, "t_r", [*_FIELDS, "rate"])):
        place = F.xxhash64(F.lit("record"), *_FIELDS)
        taken = df.join(table, "study").where(F.pmod(place, F.lit(steps)) < F.col(t)).select(*fields, place.alias("place")).collect()
        rows.append(sorted((r.asDict() for r in taken), key=lambda r: (r["place"], *(str(r[c]) for c in _FIELDS))))
    return rows[0], rows[1], share


def _token_counts(names: DataFrame, tokens: list[str]) -> tuple[int, dict[str, int]]:
    """How many names there are, and how many have each of the tokens."""
    wanted = names.sparkSession.sparkContext.broadcast(frozenset(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            seen[""] += b.num_rows
            for text, n in Counter(b.column(0).to_pylist()).items():
                for w in wanted.value.intersection((text or "").split()):
                    seen[w] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

    counts = {r["token"]: r["n"] for r in map_arrow(names, run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()}
    return counts.pop("", 0), counts


def _fitted(left: DataFrame, right: DataFrame, in_blocks: Callable[[DataFrame], DataFrame], words: Broadcast, layout: Layout) -> Model:
    """The model of all records: words' vectors with a calibration over all pairs that meet. Left records whose label is certain
    are calibrated on, and all where no study has such."""
    sure = left.where("exact")
    if sure.isEmpty():
        sure = left
    asked = sure.count()
    if not asked:
        return Model(ratios={k: np.zeros(s) for k, s in SIZES.items()})
    met = materialise(map_arrow(in_blocks(sure), lambda it: block_pairs(it, words.value, layout), _PAIRS_ROW), "met")
    split = F.col("size") > layout.block
    apart = np.zeros(sum(SIZES.values()))
    if not right.where(split).isEmpty():
        again = met.where(split).repartition("pid").sortWithinPartitions("pid")
        met = met.where(~split).unionByName(materialise(map_arrow(again, merge_pairs, _PAIRS_ROW), "merged"))
        apart = _all_pairs(sure.where(split), right.where(split), words)
    return _calibrated(words.value, met, asked, apart, layout)


def _block_by_block(batches: Iterator[pa.RecordBatch], enc: Encoding, work: Callable[..., Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """What work() gives of the pairs of every block; a left row and all right ones of its block are in one call."""

    def scored(table: pa.Table, final: bool) -> Iterator[pa.RecordBatch | pa.Table]:
        """Score the whole blocks of a table; hand back, last, the rows that have to wait for more."""
        d = {n: table.column(n).combine_chunks() for n in table.schema.names}
        study = numbered(d["study"])[0]
        block, cell = (d[c].to_numpy(zero_copy_only=False) for c in ("block", "cell"))
        asks = d["pid"].is_valid().to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(np.concatenate([[True], (np.diff(block) != 0) | (np.diff(cell) != 0) | (np.diff(study) != 0)]))
        end = np.append(begin[1:], table.num_rows)
        middle = begin + np.add.reduceat(~asks, begin)
        wait = np.zeros(0, np.int64)
        if not final:  # the last block may go on: its right rows stay, its left rows so far are done with
            wait = np.arange(begin[-1], middle[-1] if middle[-1] < end[-1] else end[-1])
        some = (middle > begin) & (middle < end)
        if some.any():
            r = records(enc, d["name"], d["section"], d["track"], d["n1"], d["n2"], d["rate"])
            exact, pid = d["exact"].to_numpy(zero_copy_only=False), d["pid"].fill_null(-1).to_numpy(zero_copy_only=False)
            size, ids = d["size"].to_numpy(zero_copy_only=False), numbered(d["id"])[0]
            jobs = []  # (left_at, left_n, right_at, right_n), of PAIRS pairs at most or one left row
            for a, m, b in zip(begin[some].tolist(), middle[some].tolist(), end[some].tolist()):
                step = max(1, PAIRS // (m - a))
                jobs += [(x, min(step, b - x), a, m - a) for x in range(m, b, step)]
            pairs = np.cumsum([n * m for _, n, _, m in jobs]) // PAIRS
            for g in np.split(np.arange(len(jobs)), np.flatnonzero(np.diff(pairs)) + 1):
                yield from work(d, r, exact, pid, ids, size, tuple(np.array([jobs[i] for i in g]).T))
        yield table.take(pa.array(wait))

    held: list[pa.RecordBatch] = []
    n_held = 0
    for batch in batches:
        held.append(batch)
        n_held += batch.num_rows
        if n_held >= 20_000:
            *out, left_over = scored(pa.Table.from_batches(held), False)
            yield from out
            held, n_held = left_over.to_batches(), 0
    if held:
        yield from list(scored(pa.Table.from_batches(held), True))[:-1]


def score_blocks(batches: Iterator[pa.RecordBatch], model: Model, layout: Layout = Layout()) -> Iterator[pa.RecordBatch]:
    """pid, id, llr, rest: what the left rows of each block find. Rows come block by block (block, cell, study), in each the right
    ones first and by id. Of a study that is one block, a left row has its best id and the sum of the weights of all others; of
    a split one, all ids near the best, and rows without id with the sum of the others. Of rows with the same id the best counts."""
    enc = Encoding(model)
    none = math.log(max(1e-9, 1 - model.prior) / model.prior)
    rest: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if any(len(p) for p, _ in rest):
            pid, where = np.unique(np.concatenate([p for p, _ in rest]), return_inverse=True)
            total = np.bincount(where, np.concatenate([w for _, w in rest]))
            yield pa.RecordBatch.from_arrays([pa.array(pid), pa.nulls(len(pid), pa.string()), pa.nulls(len(pid), pa.float64()), pa.array(total)], names=["pid", "id", "llr", "rest"])
        rest.clear()

    def work(d: dict, r: Records, exact: np.ndarray, pid: np.ndarray, ids: np.ndarray, size: np.ndarray, blocks: tuple) -> Iterator[pa.RecordBatch]:
        li, ri, cats = features(r, *blocks)
        llr = score(model, cats) + np.where(exact, 0.0, -1.0)[li]
        first = np.concatenate([[True], (np.diff(li) != 0) | (np.diff(ids[ri]) != 0)])  # the pairs of a left row and an id
        at = np.flatnonzero(first)
        llr, who, right = np.maximum.reduceat(llr, at), li[at], ri[at]
        begin = np.flatnonzero(np.concatenate([[True], np.diff(who) != 0]))
        n = np.diff(np.append(begin, len(who)))
        top = np.repeat(np.maximum.reduceat(llr, begin), n)
        whole = size[who] <= layout.block
        is_top = llr == top
        place = np.flatnonzero(is_top)
        leads = np.zeros(len(llr), bool)
        leads[place[np.concatenate([[True], np.diff(who[place]) != 0])]] = True  # the first, so the smallest id, of the best
        stay = np.where(whole, leads, llr >= np.maximum(top, none + np.log(size[who])) - layout.near)
        others = np.add.reduceat(np.where(stay, 0.0, np.exp(np.minimum(llr, 80.0))), begin)
        lead = who[begin]
        cut = ~whole[begin]
        rest.append((pid[lead[cut]], others[cut]))
        k = np.flatnonzero(stay)
        own = np.zeros(len(llr))
        own[leads & whole] = others[~cut]
        yield pa.RecordBatch.from_arrays([pa.array(pid[who[k]]), d["id"].take(pa.array(right[k])), pa.array(llr[k]), pa.array(own[k])], names=["pid", "id", "llr", "rest"])
        if sum(len(p) for p, _ in rest) > PAIRS:
            yield from flush()

    yield from _block_by_block(batches, enc, work)
    yield from flush()
