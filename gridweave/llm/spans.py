"""Long exact spans shared between documents, by super-k-mer partitioning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridweave.operators.skew import hot_keys, is_in, lookup_join
from gridweave.session import map_arrow, materialise

#: Length of the strings whose smallest hash in a window is its minimiser.
MINIMISER = 64
#: Code points that are hashed, and that are sorted as windows, at a time.
CHUNK = 1_000_000
#: Code points of one minimiser's super-k-mers that one task sorts; the windows of larger buckets are spread by their own hash.
BUCKET_SIGNS = 2_000_000

#: Odd bases of two polynomial hashes modulo 2^64, and the constants of a 64-bit finaliser.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every bit of a 64-bit value over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            f = np.full(size, b, np.uint64)
            f[0] = 1
            both.append(np.multiply.accumulate(f))
        _powers[base] = (both[0], both[1])
    return _powers[base]


def rolling(cp: np.ndarray, length: int, base: int) -> np.ndarray:
    """A 64-bit hash of every substring of the length, by prefix sums."""
    n = len(cp)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(base, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_mixed(cp.astype(np.uint64) + np.uint64(base)) * up[:n], out=sums[1:])
    return _mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every window of the width: prefix and suffix minima of blocks, two reads a position."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def super_kmers(cp: np.ndarray, lengths: np.ndarray, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, text, start, windows) of the maximal runs of windows of k code points that share their minimiser, over
    texts of the given lengths one after another. A window's minimiser depends on the window alone, so equal windows of
    different texts always go to the same bucket."""
    begins = np.cumsum(lengths) - lengths
    low = sliding_minimum(rolling(cp, m, BASES[0]), k - m + 1)
    per = np.maximum(lengths - k + 1, 0)
    some = np.flatnonzero(per)
    if not len(some):
        e = np.zeros(0, np.int64)
        return e.astype(np.uint64), e, e, e
    owner = np.repeat(some, per[some])
    first = np.cumsum(per[some]) - per[some]
    offset = np.arange(len(owner)) - np.repeat(first, per[some])
    value = low[begins[owner] + offset]
    new = np.empty(len(owner), bool)
    new[0] = True
    np.not_equal(value[1:], value[:-1], out=new[1:])
    new[first] = True
    at = np.flatnonzero(new)
    return value[at], owner[at], offset[at], np.diff(np.append(at, len(owner)))


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


def _super_kmer_rows(docs: DataFrame, k: int, m: int) -> DataFrame:
    """doc_id, mini, start, n for every super-k-mer of doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK):
                    size += len(texts[end])
                    end += 1
                part = texts[begin:end]
                mini, owner, start, n = super_kmers(code_points(part), np.array([len(t) for t in part], np.int64), k, m)
                cols = [pa.array(ids[begin:end][owner]), pa.array(mini.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "mini", "start", "n"])
                begin = end

    return map_arrow(docs, run, "doc_id long, mini long, start int, n int")


def repeated_windows(texts: list[str], docs: np.ndarray, k: int) -> np.ndarray:
    """For the windows of k code points of some texts, one after another: whether the same window stands in a text of another
    document. The windows are sorted by hash; those of equal hash are compared with the first of them, sign by sign, as runs
    of neighbours, and where a hash should deceive, by their strings."""
    cp = code_points(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    per = np.maximum(lengths - k + 1, 0)
    owner = np.repeat(np.arange(len(texts)), per)
    begins = np.cumsum(lengths) - lengths
    first = np.cumsum(per) - per
    place = begins[owner] + np.arange(len(owner)) - first[owner]
    if not len(owner):
        return np.zeros(0, bool)
    hashes = rolling(cp, k, BASES[0])[place]
    hashes ^= rolling(cp, k, BASES[1])[place] * np.uint64(MIX_1)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    head = np.empty(len(order), bool)
    head[0] = True
    np.not_equal(ranked[1:], ranked[:-1], out=head[1:])
    group = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    who = docs[owner[order]]
    several = np.minimum.reduceat(who, heads) != np.maximum.reduceat(who, heads)
    found = np.zeros(len(order), bool)
    found[order] = several[group]
    # the exact check: each member against the first of its group, in runs where both move on by one
    member = np.flatnonzero(found)
    if not len(member):
        return found
    lead = np.empty(len(order), np.int64)
    lead[order] = order[heads][group]
    a, b = place[member], place[lead[member]]
    breaks = np.flatnonzero((np.diff(a) != 1) | (np.diff(b) != 1) | (np.diff(owner[member]) != 0) | (np.diff(owner[lead[member]]) != 0)) + 1
    edges = np.concatenate([[0], breaks, [len(member)]])
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if a[i] != b[i] and not np.array_equal(cp[a[i] : a[j - 1] + k], cp[b[i] : b[j - 1] + k]):
            return _by_strings(texts, docs, k)
    return found


def _by_strings(texts: list[str], docs: np.ndarray, k: int) -> np.ndarray:
    """repeated_windows() without hashes of its own: the fallback for colliding hashes."""
    seen: dict[str, object] = {}
    for t, d in zip(texts, docs.tolist()):
        for i in range(len(t) - k + 1):
            w = t[i : i + k]
            seen[w] = d if seen.get(w, d) == d else None
    return np.array([seen[t[i : i + k]] is None for t in texts for i in range(len(t) - k + 1)], bool)


def _runs(flags: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first, last) of the runs of flagged neighbours of the same owner."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner[at]) != 0)) + 1
    first, last = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    return owner[first], offset[first], offset[last]


_SPAN = "doc_id long, start_pos int, end_pos int"


def _spans(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    cols = [pa.array(docs.astype(np.int64)), pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32))]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "start_pos", "end_pos"])


def _cut(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """mini, doc_id, start, piece: the strings of the wanted super-k-mers. The list of one document is as long as its text."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "mini")).alias("w"))

    def packed(held: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate([h[i] for h in held]) for i in range(3)]
        pieces = pa.array([p for h in held for p in h[3]], pa.string())
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pieces], names=["mini", "doc_id", "start", "piece"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for doc, text, want in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                start, n, mini = (want.values.field(i).to_numpy() for i in range(3))
                text = text.as_py()
                held.append((mini, np.full(len(n), doc), start, [text[s : s + c + k - 1] for s, c in zip(start.tolist(), n.tolist())]))
                size += int(n.sum()) + len(n) * (k - 1)
                if size > 4 * CHUNK:
                    yield packed(held)
                    held, size = [], 0
            if held:
                yield packed(held)

    return map_arrow(docs.join(lists, "doc_id").select("doc_id", "text", "w"), run, "mini long, doc_id long, start int, piece string")


def _in_buckets(pieces: DataFrame, k: int) -> DataFrame:
    """Shared stretches by sorting within buckets: strings of one minimiser travel to one task, in the order of minimisers,
    and whole buckets of about CHUNK code points are sorted together."""

    def work(minis: list, docs: list, starts: list, texts: list[str]) -> pa.RecordBatch:
        who = np.array(docs, np.int64)
        flags = repeated_windows(texts, who, k)
        per = np.array([max(0, len(t) - k + 1) for t in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), per)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        own, a, b = _runs(flags, owner, offset)
        begin = np.array(starts, np.int64)[own]
        return _spans(who[own], begin + a, begin + b + k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list, list] = ([], [], [], [])
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size > CHUNK and row[0] != held[0][-1]:
                    yield work(*held)
                    held, size = ([], [], [], []), 0
                for h, v in zip(held, row):
                    h.append(v)
                size += len(row[3])
        if size:
            yield work(*held)

    return map_arrow(pieces.repartition("mini").sortWithinPartitions("mini"), run, _SPAN)


def _window_rows(pieces: DataFrame, k: int, hash_bytes: int) -> DataFrame:
    """key, sha, off, run, a, b of the windows of pieces (sha, piece, a, b): neighbouring windows that are equal, as they are in a
    stretch of one repeated sign, are one row with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK // 4):
                    size += len(texts[end])
                    end += 1
                cp = code_points(texts[begin:end])
                lengths = np.array([len(t) for t in texts[begin:end]], np.int64)
                per = np.maximum(lengths - k + 1, 0)
                owner = np.repeat(np.arange(end - begin), per)
                offset = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
                place = (np.cumsum(lengths) - lengths)[owner] + offset
                # a window equals the one before it if and only if both are one sign throughout
                changes = np.concatenate([[0], np.cumsum(cp[1:] != cp[:-1])])
                flat = changes[place + k - 1] == changes[place]
                again = np.zeros(len(owner), bool)
                again[1:] = flat[1:] & flat[:-1] & (owner[1:] == owner[:-1]) & (cp[place[1:] + k - 1] == cp[place[1:] - 1])
                first = np.flatnonzero(~again)
                run_length = np.diff(np.append(first, len(owner)))
                raw = np.stack([rolling(cp, k, b)[place[first]] for b in BASES], 1).view(np.uint8).reshape(-1, 16)[:, :hash_bytes]
                key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(hash_bytes), len(first), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())
                at = pa.array(begin + owner[first])
                cols = [key, batch.column(0).take(at), pa.array(offset[first].astype(np.int32)), pa.array(run_length.astype(np.int32)), batch.column(2).take(at), batch.column(3).take(at)]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "sha", "off", "run", "a", "b"])
                begin = end

    return map_arrow(pieces.select("sha", "piece", "a", "b"), run, "key binary, sha binary, off int, run int, a long, b long")


def _stretches(hits: DataFrame, k: int) -> DataFrame:
    """sha, off, size, alone, lead, lead_off, checked: rows of _window_rows with their lead, joined where both move on by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            off, length, lead_off = (d[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("off", "run", "lead_off"))
            who, lead = (d[c].dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in ("sha", "lead"))
            cut = (np.diff(who) != 0) | (np.diff(lead) != 0) | (np.diff(off) != 1) | (np.diff(lead_off) != 1) | (length[1:] > 1) | (length[:-1] > 1)
            first = np.concatenate([[0], np.flatnonzero(cut) + 1])
            n = np.diff(np.append(first, len(off)))
            size = n + k - 1 + length[first] - 1
            at = pa.array(first)
            cols = [d["sha"].take(at), pa.array(off[first].astype(np.int32)), pa.array(size.astype(np.int32)), d["alone"].take(at), d["lead"].take(at), pa.array(lead_off[first].astype(np.int32)), pa.array((n + k - 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["sha", "off", "size", "alone", "lead", "lead_off", "checked"])

    slim = hits.select("sha", "off", "run", (F.col("a") == F.col("b")).alias("alone"), "lead", "lead_off").repartition("sha").sortWithinPartitions("sha", "off")
    return map_arrow(slim, run, "sha binary, off int, size int, alone boolean, lead binary, lead_off int, checked int")


def _by_windows(pieces: DataFrame, k: int, hash_bytes: int = 16) -> DataFrame:
    """Shared stretches of the super-k-mers in buckets too large for one task.

    Equal super-k-mers (by SHA-256, partial aggregation) are one first: what two documents have is shared from end to end. The
    windows of the distinct ones go by a hash, with partial aggregation of the smallest and largest document and of a lead, the first
    of them; every stretch of windows is then compared with its leads sign by sign, and the windows of a hash that deceived are
    compared as strings. Hot super-k-mers and hashes come back by broadcast."""
    found = materialise(pieces.select("doc_id", "start", "piece", F.unhex(F.sha2("piece", 256)).alias("sha")), "pieces")
    reps = materialise(found.groupBy("sha").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.first("piece").alias("piece")), "distinct")
    hot = hot_keys(found.select("sha"), "sha")
    places = found.select("sha", "doc_id", "start", F.char_length("piece").alias("size"))
    whole = lookup_join(places, reps.where("a <> b").select("sha"), "sha", hot)
    spans = whole.select("doc_id", F.col("start").alias("start_pos"), (F.col("start") + F.col("size")).alias("end_pos"))
    rows = materialise(_window_rows(reps, k, hash_bytes), "windows")
    ends = rows.groupBy("key").agg(F.min("a").alias("x"), F.max("b").alias("y"), F.min(F.struct("sha", "off")).alias("l"))
    leads = ends.where("x <> y").select("key", F.col("l.sha").alias("lead"), F.col("l.off").alias("lead_off"))
    hits = materialise(lookup_join(rows, leads, "key", hot_keys(rows.select("key"), "key")), "hits")
    parts = materialise(_stretches(hits, k), "stretches")
    one, two = reps.select("sha", F.col("piece").alias("p")), reps.select(F.col("sha").alias("lead"), F.col("piece").alias("q"))
    same = F.substring("p", F.col("off") + 1, F.col("checked")) == F.substring("q", F.col("lead_off") + 1, F.col("checked"))
    wrong = materialise(parts.where("sha <> lead or off <> lead_off").join(one, "sha").join(two, "lead").where(~same).select("sha", "off", "checked"), "deceived")
    own = places.select("sha", "doc_id", "start")
    alone = parts.where("alone").select("sha", "off", "size")
    if not wrong.isEmpty():
        from_key = hits.join(wrong.select("sha", F.col("off").alias("w"), "checked"), "sha").where(F.col("off").between(F.col("w"), F.col("w") + F.col("checked") - k))
        keys = materialise(from_key.select("key").distinct(), "keys")
        alone = _stretches(hits.join(keys, "key", "left_anti"), k).where("alone").select("sha", "off", "size")
        strings = rows.join(keys, "key", "left_semi").join(one, "sha").select("sha", "off", "run", "a", "b", F.substring("p", F.col("off") + 1, F.lit(k)).alias("window"))
        ends = strings.groupBy("window").agg(F.min("a").alias("x"), F.max("b").alias("y")).where("x <> y").select("window")
        alone = alone.unionByName(strings.where("a = b").join(ends, "window", "left_semi").select("sha", "off", (F.col("run") - 1 + k).alias("size")))
    met = alone.join(own, "sha").select("doc_id", (F.col("start") + F.col("off")).alias("start_pos"), (F.col("start") + F.col("off") + F.col("size")).alias("end_pos"))
    return spans.unionByName(met)


def merge_spans(spans: DataFrame) -> DataFrame:
    """The maximal runs of covered positions of each document. Spans of one document are as many as its text is long at most."""
    w = Window.partitionBy("doc_id").orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("new", (reach.isNull() | (F.col("start_pos") > reach)).cast("int")).withColumn("run", F.sum("new").over(w))
    return runs.groupBy("doc_id", "run").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("run")


def shared_spans(docs: DataFrame, doc_id: str, text: str, k: int = 200, m: int = MINIMISER, bucket_signs: int = BUCKET_SIGNS, hash_bytes: int = 16) -> DataFrame:
    """doc_id, start_pos, end_pos: the maximal runs of characters of a document that lie in a stretch of at least k code points
    standing in another document too.

    1. Whole texts that a hot share of the documents repeat (found exactly by their SHA-256) are shared from end to end; only the
       one with the smallest id goes on, so that the rest is not hot.
    2. Each text is cut into super-k-mers. Only minimiser, place and number of windows are shuffled at first; those whose
       minimiser stands in one document alone are done.
    3. The strings of the others are cut from their texts and travel, packed, to the bucket of their minimiser, where sorting
       finds equal windows, checked sign by sign. Buckets that are hot or larger than bucket_signs are spread by window, with the
       same check; hash_bytes is the length of the hash that they are spread by.
    4. The found stretches of each document are merged.

    Defined cases: null texts and texts shorter than k share nothing; doc_id is a key: a row repeated whole changes nothing, and
    copies within one document do not count; rows without doc_id are left out; positions count code points; other columns are
    ignored; no documents, no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    base = base.where(F.col("doc_id").isNotNull() & (F.char_length("text") >= k)).withColumn("sha", F.unhex(F.sha2("text", 256)))
    hot_texts = hot_keys(base.select("sha"), "sha", least=500)
    whole = None
    if hot_texts:
        of_hot = base.where(is_in("sha", hot_texts))
        keep = of_hot.groupBy("sha").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        marked = of_hot.join(F.broadcast(keep), "sha")
        whole = marked.where("a <> b").select("doc_id", F.lit(0).alias("start_pos"), F.char_length("text").alias("end_pos"))
        base = base.where(~is_in("sha", hot_texts)).unionByName(marked.where("doc_id = a").select("doc_id", "text", "sha"))
    base = base.select("doc_id", "text")
    rows = materialise(_super_kmer_rows(base, k, m), "superkmers")
    hot = hot_keys(rows.select("mini"), "mini")
    by = Window.partitionBy("mini")
    counted = rows.where(~is_in("mini", hot)).withColumns({"a": F.min("doc_id").over(by), "b": F.max("doc_id").over(by), "c": F.sum(F.col("n") + (k - 1)).over(by)})
    wanted = counted.where("a <> b").select("doc_id", "start", "n", "mini", (F.col("c") > bucket_signs).alias("large"))
    if hot:
        wanted = wanted.unionByName(rows.where(is_in("mini", hot)).select("doc_id", "start", "n", "mini", F.lit(True).alias("large")))
    wanted = materialise(wanted, "candidates")
    spans = _in_buckets(_cut(base, wanted.where("not large").drop("large"), k), k)
    if not wanted.where("large").isEmpty():
        spans = spans.unionByName(_by_windows(_cut(base, wanted.where("large").drop("large"), k), k, hash_bytes))
    if whole is not None:
        spans = spans.unionByName(whole)
    return merge_spans(spans)


def shared_share(docs: DataFrame, doc_id: str, text: str, spans: DataFrame) -> DataFrame:
    """doc_id, n_chars, n_shared, share: how much of each text stands elsewhere; zero for texts that share nothing."""
    sizes = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.char_length(F.col(text).cast("string")), F.lit(0)).alias("n_chars"))
    got = spans.groupBy("doc_id").agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("n_shared"))
    n = F.coalesce("n_shared", F.lit(0))
    share = F.when(F.col("n_chars") > 0, n / F.col("n_chars")).otherwise(F.lit(0.0))
    return sizes.join(got, "doc_id", "left").select("doc_id", "n_chars", n.alias("n_shared"), share.alias("share"))
