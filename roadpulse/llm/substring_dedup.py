"""Repeated passages by collinear chaining of shared k-mer seeds.

Seeds are hashes of ``K`` words, thinned to minimizers: any ``K + W - 1`` words that
two texts share hold a common one. Every seed is linked to its first occurrence
(smallest document), a star instead of all pairs. For each pair of documents the
matching seeds are chained in order of both texts, with a cost for the words left
out, through a Fenwick tree of prefix maxima. Chains are then aligned: words
between anchors and beyond the ends are compared, with small edit tables where
they differ. A chain of which too little matches is split where most words are left
out, and its parts are judged again. Adjoining passages of a document make one, so a passage counts even
where its halves were first seen in different documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import saved

K, W = 6, 16
#: words of a passage that counts, and share of them that must match
MIN_WORDS, IDENTITY = 50, 0.8
#: cost of a word skipped on either side, and most words skipped between two anchors
SKIP, MAX_GAP = 0.2, 40
#: words read beyond the ends of a chain
MARGIN = 40
#: words between passages of one document that still adjoin
ADJOIN = 3
#: documents (8 bytes each) up to which their list is broadcast
BROADCAST_DOCS = 1_000_000


def word_codes(text: str | None) -> np.ndarray:
    """A 32-bit code for every word of a text, without regard to case of A-Z."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def seeds(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the minimizers; a text with at least ``K`` words has one."""
    n = len(codes) - K + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(K):
        h = (h ^ codes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    low, span = h, 1
    while span < min(W, n):  # minima of windows of doubled width
        step = min(span, min(W, n) - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    # a place is kept if its hash is the minimum of any window that holds it
    best = np.lib.stride_tricks.sliding_window_view(np.pad(low, span - 1, constant_values=0), span).max(1)
    place = np.flatnonzero(h == best)
    return place, h[place].view(np.int64)


class Fenwick:
    """Prefix maxima of (value, item) over places 0..n-1."""

    def __init__(self, n: int):
        self.best = [(-1e18, -1)] * (n + 1)

    def put(self, place: int, value: float, item: int) -> None:
        i, best = place + 1, self.best
        while i < len(best):
            if value > best[i][0]:
                best[i] = (value, item)
            i += i & -i

    def below(self, place: int) -> tuple[float, int]:
        """Largest value over places smaller than ``place``."""
        out, best = (-1e18, -1), self.best
        while place > 0:
            if best[place][0] > out[0]:
                out = best[place]
            place -= place & -place
        return out


def chains(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Chains of anchors (a, b), as arrays of anchor numbers in order, best first, no anchor twice.

    A chain gains ``K`` per anchor and pays ``SKIP`` per word between anchors on
    either side; it is cut where more than ``MAX_GAP`` words lie between two. The tree
    answers for all anchors before one. Where its best is beyond the gap, as the end of
    a long chain is for all that comes later, the anchors within the gap are looked
    through: at most one for each place of the first text, so a few.
    """
    order = np.lexsort((-b, a))
    column = np.unique(b, return_inverse=True)[1][order].tolist()
    aa, bb = a[order].tolist(), b[order].tolist()
    tree, score, back = Fenwick(max(column, default=0) + 1), [0.0] * len(aa), [-1] * len(aa)

    def within(j: int, x: int, y: int) -> bool:
        return 0 < x - aa[j] <= MAX_GAP + K and 0 < y - bb[j] <= MAX_GAP + K

    oldest = 0
    for i, (x, y, c) in enumerate(zip(aa, bb, column)):
        value, j = tree.below(c)
        if j >= 0 and not within(j, x, y):
            while aa[oldest] < x - MAX_GAP - K:
                oldest += 1
            value, j = max(((score[h] + SKIP * (aa[h] + bb[h]), h) for h in range(oldest, i) if within(h, x, y)),
                           default=(-1e18, -1))
        gain = value - SKIP * (x + y)
        score[i] = K + max(0.0, gain)
        if gain > 0:
            back[i] = j
        tree.put(c, score[i] + SKIP * (x + y), i)
    used, out = [False] * len(aa), []
    for i in sorted(range(len(aa)), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = back[i]
        if path:
            out.append(order[np.array(path[::-1])])
    return out


def edit_matches(x: np.ndarray, y: np.ndarray) -> int:
    """Words matched by the best alignment of two short stretches."""
    if not len(x) or not len(y):
        return 0
    row = np.zeros(len(y) + 1, np.int64)
    for w in x:
        hit = row[:-1] + (y == w)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], hit))
    return int(row[-1])


def extend(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """(words of x, words of y, matches) by which a passage goes on into x and y.

    After a difference the next two equal words must come within three words.
    """
    i = j = n = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j, n = i + 1, j + 1, n + 1
            continue
        for d in range(1, 7):
            found = next(((p, d - p) for p in range(max(0, d - 3), min(3, d) + 1)
                          if i + p + 1 < len(x) and j + d - p + 1 < len(y)
                          and x[i + p] == y[j + d - p] and x[i + p + 1] == y[j + d - p + 1]), None)
            if found:
                break
        if not found:
            break
        i, j = i + found[0], j + found[1]
    return i, j, n


def steps(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words matched from the end of each anchor (a, b) of a chain to the end of the next one."""
    out = []
    for p, q, r, s in zip(a[:-1].tolist(), a[1:].tolist(), b[:-1].tolist(), b[1:].tolist()):
        if q - p == s - r:
            same = int((x[p + K:q + K] == y[r + K:s + K]).sum())
            if same == q - p or q - p <= K:
                out.append(same)
                continue
        # anchors overlap or words between them differ: what lies after the first, up to the end of the second
        over = max(0, p + K - q, r + K - s)
        out.append(edit_matches(x[p + K:q], y[r + K:s]) + K - over)
    return np.array(out, np.int64)


def extend_equal(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """Like ``extend``, up to the first difference."""
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    n = int(differ[0]) if len(differ) else n
    return n, n, n


def align(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, matched: np.ndarray | None = None,
          further=extend) -> tuple[int, int, int, int, int]:
    """(start, end, start in y, end in y, matches) of the chain of anchors (a, b) in the words x and y."""
    matches = K + int((steps(x, y, a, b) if matched is None else matched).sum())
    start, end, y0, y1 = int(a[0]), int(a[-1]) + K, int(b[0]), int(b[-1]) + K
    i, j, n = further(x[:start][::-1], y[:y0][::-1])
    p, q, m = further(x[end:], y[y1:])
    return start - i, end + p, y0 - j, y1 + q, matches + n + m


def passages(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """(start, end, matches, whole) of the passages in a chain: the chain itself, or its parts of which enough matches.

    A part that does not pass is split again; the words of a single anchor all match.
    """
    matched = steps(x, y, a, b)
    left_out = np.maximum(np.diff(a), np.diff(b)) - matched
    out, todo = [], [(0, len(a))]
    while todo:
        lo, hi = todo.pop()
        part = a[lo:hi], b[lo:hi], matched[lo:hi - 1]
        for further in (extend, extend_equal):
            start, end, y0, y1, n = align(x, y, *part, further)
            if n >= IDENTITY * max(end - start, y1 - y0):
                out.append((start, end, n, further is extend and hi - lo == len(a)))
                break
        else:
            cut = lo + 1 + int(left_out[lo:hi - 1].argmax())
            todo += [(lo, cut), (cut, hi)]
    return sorted(out)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of a partition sorted by ``key``, in tables that hold whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(keys, keys[-1]))
        if held and (first or keys[0] != held[-1].column(key)[-1].as_py()):
            cut = first or 0
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = [batch.slice(cut)]
        elif first:
            yield pa.Table.from_batches([batch.slice(0, first)])
            held = [batch.slice(first)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of every pair of documents, from anchors sorted by document."""
    for table in whole_groups(batches, "ref"):
        ref, source, a, b = (table.column(c).to_numpy() for c in ("ref", "source", "a", "b"))
        order = np.lexsort((b, a, source, ref))
        ref, source, a, b = ref[order], source[order], a[order], b[order]
        cut = np.flatnonzero((ref[1:] != ref[:-1]) | (source[1:] != source[:-1])) + 1
        rows: list[tuple] = []
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(ref)]):
            for chain in chains(a[lo:hi], b[lo:hi]):
                x, y = a[lo:hi][chain], b[lo:hi][chain]
                rows.append((int(ref[lo]), int(source[lo]), x.tolist(), y.tolist()))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds)],
                                         names=["ref", "source", "a", "b"])


def _cut_out(joined: DataFrame, places: str, out: str) -> DataFrame:
    """Puts the words around a document's part of the chain in place of all its words (4 bytes each)."""
    low = F.greatest(F.lit(0), F.get(places, F.lit(0)) - MARGIN)
    high = F.element_at(places, -1) + K + MARGIN
    part = F.substring("codes", 4 * low + 1, 4 * (high - low))
    return joined.withColumns({out: part, f"{out}_at": low}).drop("codes")


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            x, y = np.frombuffer(r["x"], np.uint32), np.frombuffer(r["y"], np.uint32)
            for start, end, n, whole in passages(x, y, np.array(r["a"]) - r["x_at"], np.array(r["b"]) - r["y_at"]):
                rows.append((r["ref"], r["source"], start + r["x_at"], end + r["x_at"], n, ADJOIN if whole else 0))
        cols = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                         names=["ref", "source", "start", "end", "matches", "adjoin"])


def _merged(min_words: int):
    """Adjoining passages of each document as one, if it is long enough.

    Parts of a split chain adjoin without a gap only: words between them did not match.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "ref"):
            rows: list[list] = []
            spans = sorted(zip(*(table.column(c).to_pylist() for c in ("ref", "start", "end", "source_id", "adjoin"))),
                           key=lambda s: (s[0], s[1], -s[2], s[3]))
            for ref, start, end, source, adjoin in spans:
                if rows and rows[-1][0] == ref and start <= rows[-1][2] + min(rows[-1][4], adjoin):
                    if end >= rows[-1][2]:
                        rows[-1][4] = max(adjoin, rows[-1][4]) if end == rows[-1][2] else adjoin
                    rows[-1][2] = max(rows[-1][2], end)
                    rows[-1][3].add(source)
                else:
                    rows.append([ref, start, end, {source}, adjoin])
            rows = [[r, a, b, sorted(s)] for r, a, b, s, _ in rows if b - a >= min_words]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds)],
                                             names=["ref", "start", "end", "sources"])

    return run


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per repeated passage: doc_id, start, end (words, end exclusive) and sources.

    ``sources`` are the ids of documents in which stretches of the passage occur
    first; a document holding the first occurrence of everything it has gets no
    row of its own. Words are separated by ASCII white space and compared without
    regard to the case of A-Z. Passages have at least ``min_words`` words, at
    least ``IDENTITY`` of them matching.

    Null, empty and very short texts have no passage. Rows with a null id are not
    compared, as nothing could name them; rows repeated with id and text are one
    document, rows with one id and different texts are two of the same name. An
    empty table gives an empty result; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = base.where("doc_id is not null and text is not null").withColumn("ref", F.xxhash64("doc_id", "text"))

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, refs = (batch.column(c).to_numpy() for c in ("doc_id", "ref"))
            for lo in range(0, batch.num_rows, 500):
                found = [seeds(word_codes(t.as_py())) for t in batch.column("text").slice(lo, 500)]
                size = [len(p) for p, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([h for _, h in found])), pa.array(np.repeat(ids[lo:lo + 500], size)),
                     pa.array(np.repeat(refs[lo:lo + 500], size)),
                     pa.array(np.concatenate([p for p, _ in found]).astype(np.int32))],
                    names=["seed", "doc_id", "ref", "at"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [word_codes(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("ref"), pa.array(codes, pa.binary())], names=["ref", "codes"])

    found = base.mapInArrow(seeded, "seed long, doc_id long, ref long, at int")
    first = (found.groupBy("seed").agg(F.min(F.struct("doc_id", "ref", "at")).alias("first"),
                                       F.max("ref").alias("r1"), F.min("ref").alias("r2"))
             .where("r1 <> r2").select("seed", F.col("first.ref").alias("source"), F.col("first.at").alias("b")))
    anchors = (found.join(first, "seed").where("ref <> source")
               .select("ref", "source", F.col("at").alias("a"), "b").distinct())
    # a document that shares passages with many others is dealt over tasks by these
    linked = saved(anchors.repartition("ref", "source").sortWithinPartitions("ref")
                   .mapInArrow(_chained, "ref long, source long, a array<int>, b array<int>"))
    needed = saved(linked.select("ref").union(linked.select("source")).distinct())
    small = needed.count() <= BROADCAST_DOCS
    words = (base.join(F.broadcast(needed) if small else needed, "ref", "left_semi").select("ref", "text")
             .mapInArrow(coded, "ref long, codes binary").dropDuplicates(["ref"]))
    one = _cut_out(linked.join(words, "ref"), "a", "x")
    two = _cut_out(one.join(words.withColumnRenamed("ref", "source"), "source"), "b", "y")
    two = two.select("ref", "source", "a", "b", "x", "x_at", "y", "y_at")
    found = saved(two.mapInArrow(_aligned, "ref long, source long, start long, end long, matches long, adjoin long"))
    names = saved(base.select("ref", "doc_id").distinct())
    found = found.join(names.select(F.col("ref").alias("source"), F.col("doc_id").alias("source_id")), "source")
    merged = (found.select("ref", "start", "end", "source_id", "adjoin").repartition("ref").sortWithinPartitions("ref")
              .mapInArrow(_merged(min_words), "ref long, start long, end long, sources array<long>"))
    return merged.join(names, "ref").select("doc_id", "start", "end", "sources")
