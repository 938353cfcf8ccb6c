"""Exact byte-pair encoding of a corpus by backtracking over longest matches; splitting and gathering are vectorised."""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.session import map_arrow

#: Where the vocabulary files are unless a path is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Code points that are worked on at a time, and pieces whose ids are remembered.
CHUNK, REMEMBERED = 1_000_000, 1_000_000

#: Classes of code points in the splitting pattern: white space, letters, numbers, anything else, and the blank.
SPACE, LETTER, NUMBER, OTHER, BLANK = range(5)
#: White space of the pattern's \s.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters after an apostrophe that make a piece of their own.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

_classes: np.ndarray | None = None
_encoders: dict[int, "Encoder"] = {}


def classes() -> np.ndarray:
    """The class of every code point."""
    global _classes
    if _classes is None:
        of = {"L": LETTER, "N": NUMBER}
        _classes = np.array([of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        _classes[WHITE_SPACE] = SPACE
        _classes[0x20] = BLANK
    return _classes


def piece_starts(cp: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Positions at which a piece of the splitting pattern starts, over the code points of several texts one after another.

    A run of letters, of numbers or of other signs is a piece, with a blank before it if there is one. Of a run of white
    space before such a run the last sign stands alone, or is that blank; white space at the end of a text is one piece.
    An apostrophe that starts a piece takes one of ENDINGS with it.
    """
    n = len(cp)
    cls = classes()[cp]
    first = np.zeros(n + 1, bool)
    first[doc_starts] = True
    blank = cls == BLANK
    run = np.where(blank, SPACE, cls)
    white = run == SPACE
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(run[1:], run[:-1], out=new[1:])
    new |= first[:n]
    start = new.copy()
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first[:n]
    glued = new & ~white & after_blank
    start[glued] = False
    # the last white space before a run, in the same text
    last_white = np.zeros(n, bool)
    last_white[:-1] = white[:-1] & ~white[1:] & ~first[1:n]
    start |= last_white
    for at in np.flatnonzero((cp == 0x27) & start):
        end = n if (k := np.searchsorted(doc_starts, at, "right")) == len(doc_starts) else doc_starts[k]
        follow = "".join(map(chr, cp[at + 1 : min(at + 3, end)]))
        for e in ENDINGS:
            if follow.startswith(e):
                start[at + 1] = False
                if at + 1 + len(e) < n:
                    start[at + 1 + len(e)] = True
                break
    return np.flatnonzero(start)


class Encoder:
    """Byte-pair encoding of pieces, equal to merging the pair of lowest rank again and again, in linear time.

    A sequence of tokens is the encoding of its bytes exactly if each two neighbours are the encoding of theirs. So: take
    the longest token that fits the text, then the longest that fits after it, and so on; where no token is compatible with
    its predecessor, try the predecessor's next shorter one. An end that was given up once is never tried again, as the
    encoding of a prefix is unique. Compatibility of two tokens is computed once by merging their bytes, and remembered.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.sound: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.n_ids = np.zeros(1 << 12, np.int64)
        self.at = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.int32)
        self.used = 0

    def merge(self, piece: bytes) -> list[int]:
        """The definition: join the neighbours whose joined bytes have the lowest rank, until none are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _sound(self, t: int) -> bool:
        if t not in self.sound:
            self.sound[t] = self.merge(self.token[t]) == [t]
        return self.sound[t]

    def _fits(self, a: int, b: int) -> bool:
        found = self.compatible.get((a, b))
        if found is None:
            if len(self.compatible) > 4_000_000:
                self.compatible.clear()
            found = self.compatible[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return found

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None and self._sound(whole):
            return [whole]
        n = len(piece)
        words: list[list[int]] = [[] for _ in range(n)]  # tokens that start there, by rising length
        for end, (t, size) in self.automaton.iter(piece.decode("latin-1")):
            words[end - size + 1].append(t)
        left = [len(w) for w in words]  # of each start, how many of its tokens are still to try
        given_up = bytearray(n + 1)
        out: list[int] = []
        pos = 0
        while pos < n:
            here = words[pos]
            while left[pos]:
                t = here[left[pos] - 1]
                end = pos + len(self.token[t])
                if not given_up[end] and self._sound(t) and (not out or self._fits(out[-1], t)):
                    break
                left[pos] -= 1
            if left[pos]:
                out.append(t)
                pos = end
                if pos < n:
                    left[pos] = len(words[pos])
            else:
                given_up[pos] = 1
                pos -= len(self.token[out.pop()])
        return out

    def indices(self, pieces: pa.Array) -> np.ndarray:
        """Places of the pieces in at / n_ids / flat; new ones are encoded."""
        found = np.empty(len(pieces), np.int64)
        index = self.index
        for i, p in enumerate(pieces.to_pylist()):
            k = index.get(p)
            if k is None:
                ids = self.encode(p)
                k = index[p] = len(index)
                if k >= len(self.at):
                    self.at, self.n_ids = np.resize(self.at, 2 * k), np.resize(self.n_ids, 2 * k)
                while self.used + len(ids) > len(self.flat):
                    self.flat = np.resize(self.flat, 2 * len(self.flat))
                self.at[k], self.n_ids[k] = self.used, len(ids)
                self.flat[self.used : self.used + len(ids)] = ids
                self.used += len(ids)
            found[i] = k
        return found

    def encode_texts(self, texts: list[str], want_ids: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Number of ids of each text, and all ids one after another."""
        lengths = np.array([len(t) for t in texts], np.int64)
        joined = "".join(texts)
        if not joined:
            return np.zeros(len(texts), np.int64), np.zeros(0, np.int32)
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        starts = piece_starts(cp, np.unique((ends - lengths)[lengths > 0]))
        raw = joined.encode()
        if len(raw) == len(cp):
            byte = starts
        else:
            width = 1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000)
            byte = np.concatenate([[0], np.cumsum(width)])[starts]
        offsets = np.append(byte, len(raw)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = pc.dictionary_encode(pieces)
        if len(self.index) > REMEMBERED:
            self.forget()
        piece = self.indices(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.n_ids[piece]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        at_end = upto[np.searchsorted(starts, ends, "left")]
        counts = np.diff(np.concatenate([[0], at_end]))
        if not want_ids:
            return counts, None
        where = np.arange(upto[-1]) + np.repeat(self.at[piece] - upto[:-1], sizes)
        return counts, self.flat[where]


def safe_cuts(text: str, size: int = CHUNK) -> list[str]:
    """A text in parts of about `size`, cut only where a piece surely starts: before a blank that follows a sign that is not
    white space. A text without such a place stays whole."""
    if len(text) <= size:
        return [text]
    parts, at = [], 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
            cut += 1
        parts.append(text[at:cut])
        at = cut
    return parts + [text[at:]] if at < len(text) else parts


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a vocabulary file with a line "base64 rank" for each token."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def encoder_of(data: bytes) -> Encoder:
    """One encoder for each vocabulary in each Python worker."""
    key = hash(data)
    if key not in _encoders:
        _encoders[key] = Encoder(read_ranks(data))
    return _encoders[key]


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most CHUNK code points together, or of a single longer text."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > begin and size + n > CHUNK:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def _run(docs: DataFrame, doc_id: str, text: str, path: str, schema: str, want_ids: bool) -> DataFrame:
    with open(path, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())  # under 1 MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(vocabulary.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _groups(texts):
                parts = [safe_cuts(t or "") for t in texts[a:b]]
                if all(len(p) == 1 for p in parts):
                    counts, ids = enc.encode_texts([p[0] for p in parts], want_ids)
                else:
                    each = [enc.encode_texts([x], want_ids) for p in parts for x in p]
                    owner = np.repeat(np.arange(b - a), [len(p) for p in parts])
                    counts = np.bincount(owner, [c[0] for c, _ in each], b - a).astype(np.int64)
                    ids = np.concatenate([i for _, i in each]) if want_ids else None
                key = batch.column(0).slice(a, b - a)
                if want_ids:
                    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([key, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], names=["doc_id", "ids"])
                else:
                    yield pa.RecordBatch.from_arrays([key, pa.array(counts)], names=["doc_id", "n_tokens"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, schema)


def encode(docs: DataFrame, doc_id: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids: every text by the vocabulary at `path`, without special tokens.

    No shuffle; the vocabulary is broadcast (a file of bounded size). Defined cases: null and empty texts have the empty
    list; strings that look like special tokens are ordinary text; a text of any length is encoded whole; null doc_ids and
    repeated rows are kept as they are; other columns are ignored.
    """
    return _run(docs, doc_id, text, path, "doc_id long, ids array<int>", True)


def count(docs: DataFrame, doc_id: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens: only the number of ids of encode()."""
    return _run(docs, doc_id, text, path, "doc_id long, n_tokens long", False)
