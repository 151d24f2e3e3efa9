"""Byte-level BPE with a hierarchical-bitmap rank queue.

Pre-tokens are linked lists of byte runs, held side by side in arrays. Every
adjacent pair that is in the vocabulary waits in the bucket of its merge rank; a
bitmap of three levels says which buckets hold anything, so the lowest rank is
found by three find-first-set steps. All pairs of that rank are merged at once,
those of one run of equal pairs alternately from the left, and entries whose pair
has changed meanwhile are skipped. A pre-token of n bytes, however long, costs
O(n log n); many short ones share the queue, so the cost of a step is spread
over all words of a batch.

Merging one pair can make a pair of a lower rank, which must go before the other
pairs of the first rank in the same pre-token. Such a pre-token is done again on
its own, one position at a time, on the same queue (``merge``).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import ids_and_texts
from .packing import batches_of_texts, stretches

CACHE = 250_000
#: characters of text whose new words share one queue
TOGETHER = 12 << 20


class RankBitmap:
    """Which ranks are waiting: the lowest by find-first-set over three levels of 64 bits."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.high = 0

    def add(self, rank: int) -> None:
        word, group = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.mid[group] |= 1 << (word & 63)
        self.high |= 1 << group

    def first(self) -> int:
        group = (self.high & -self.high).bit_length() - 1
        bits = self.mid[group]
        word = group << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def remove(self, rank: int) -> None:
        word, group = rank >> 6, rank >> 12
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.mid[group] &= ~(1 << (word & 63))
            if not self.mid[group]:
                self.high &= ~(1 << group)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a rank file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class BytePairs:
    """Encoder and decoder for one vocabulary of ranks and one pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.decimal = {str(r): t for t, r in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.top = max(ranks.values(), default=0)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted((ranks[t[:i]] << 20 | ranks[t[i:]], r) for t, r in ranks.items()
                       for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pair_keys = np.array([k for k, _ in pairs] or [0], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] or [-1], np.int64)
        self.words: dict[str, str] = {}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of ids, -1 where the vocabulary has none."""
        key = left << 20 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token, one merge at a time."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # of the run that starts here; 0 once it is part of another
        prev = list(range(-1, n - 1))
        waiting, buckets = RankBitmap(self.top), {}

        def push(a: int, b: int) -> None:
            if (r := ranks.get(data[a:b])) is not None:
                if r in buckets:
                    heappush(buckets[r], a)
                else:
                    buckets[r] = [a]
                    waiting.add(r)

        for i in range(n - 1):
            push(i, i + 2)
        while waiting.high:
            rank = waiting.first()
            i = heappop(buckets[rank])
            if not buckets[rank]:
                del buckets[rank]
                waiting.remove(rank)
            mid = end[i]
            if not mid or mid >= n or ranks.get(data[i:end[mid]]) != rank:
                continue
            stop = end[i] = end[mid]
            end[mid] = 0
            if stop < n:
                prev[stop] = i
                push(i, end[stop])
            if i:
                push(prev[i], stop)
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def merge_all(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): ids of all pre-tokens one after the other, and where those of each end."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        n = int(size.sum())
        owner = np.repeat(np.arange(len(parts)), size)
        ids = self.byte_ids[np.frombuffer(b"".join(parts), np.uint8)]
        # one more place at the end stands for "none" on either side
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        last = np.cumsum(size)
        after[last[size > 0] - 1] = n
        before[(last - size)[size > 0]] = n
        rank = np.full(n + 1, -1)
        at = np.flatnonzero(after[:n] < n)
        rank[at] = self.rank_of(ids[at], ids[after[at]])
        ids = np.append(ids, 0)
        waiting, buckets = RankBitmap(self.top), {}

        def push(at: np.ndarray) -> None:
            of = rank[at]
            order = np.argsort(of, kind="stable")
            order = order[np.searchsorted(of[order], 0):]
            at, of = at[order], of[order]
            cut = np.flatnonzero(of[1:] != of[:-1]) + 1
            a = 0
            for r, b in zip(of[np.append(0, cut)].tolist() if len(of) else (), [*cut.tolist(), len(of)]):
                if r in buckets:
                    buckets[r].append(at[a:b])
                else:
                    buckets[r] = [at[a:b]]
                    waiting.add(r)
                a = b

        push(at)
        alive = np.ones(n, bool)
        again: set[int] = set()
        while waiting.high:
            r = waiting.first()
            waiting.remove(r)
            found = buckets.pop(r)
            i = found[0] if len(found) == 1 else np.concatenate(found)
            i = i[rank[i] == r]
            if len(i) > 1:
                i = np.unique(i)
                run = after[i[:-1]] == i[1:]
                if run.any():  # a pair that begins where the one before ends: every other one
                    place = np.arange(len(i))
                    start = np.maximum.accumulate(np.where(np.append(False, run), 0, place))
                    i = i[(place - start) % 2 == 0]
            elif not len(i):
                continue
            j = after[i]
            k = after[j]
            if len(i) > 1:  # neighbours both merged: the pair that stands there between the two
                side = np.flatnonzero(k[:-1] == i[1:])
                if len(side):
                    lower = self.rank_of(np.full(len(side), r), ids[k[side]])
                    again.update(owner[i[side[(lower >= 0) & (lower < r)]]].tolist())
            ids[i] = r
            rank[j] = -1
            alive[j] = False
            after[i] = k
            before[k] = i
            left = before[i]
            lefts = left[left < n]
            changed = np.concatenate([i, lefts])
            nxt = after[changed]
            new = np.where(nxt < n, self.rank_of(ids[changed], ids[nxt]), -1)
            rank[changed] = new
            rank[n] = -1
            lower = (new >= 0) & (new < r)
            if lower.any() and len(i) > 1:
                words, many = np.unique(owner[i], return_counts=True)
                again.update(np.intersect1d(owner[changed[lower]], words[many > 1]).tolist())
            push(changed[new >= 0])
        keep = np.flatnonzero(alive)
        out, ends = ids[keep], np.cumsum(np.bincount(owner[keep], minlength=len(parts)))
        if again:
            pieces = np.split(out, ends[:-1])
            for w in again:
                pieces[w] = np.array(self.merge(parts[w]), np.int64)
            out, ends = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
        return out, ends
    def _learn(self, words: list[str]) -> None:
        split = [self.pattern.findall(w) for w in words]
        known, rest = {}, []
        for piece in {p for pieces in split for p in pieces}:
            data = piece.encode()
            if (r := self.ranks.get(data)) is not None:
                known[piece] = str(r)
            else:
                rest.append((piece, data))
        ids, ends = self.merge_all([data for _, data in rest])
        decimal, a = list(map(str, ids.tolist())), 0
        for (piece, _), b in zip(rest, ends.tolist()):
            known[piece] = ",".join(decimal[a:b])
            a = b
        for word, pieces in zip(words, split):
            self.words[word] = ",".join([known[p] for p in pieces])

    def encode(self, texts: list[str | None]) -> Iterator[str]:
        """Ids of each text in decimal, joined by commas; null is an empty text."""
        if len(self.words) > CACHE:
            self.words.clear()
        new: set[str] = set()
        for text in texts:
            if text:
                new.update(set(stretches(text)).difference(self.words))
        self._learn(list(new))
        known = self.words
        for text in texts:
            yield ",".join(map(known.__getitem__, stretches(text))) if text else ""

    def decode(self, ids: str) -> bytes:
        """Bytes of ids in decimal, joined by commas."""
        return b"".join(map(self.decimal.__getitem__, ids.split(","))) if ids else b""


_encoders: dict[tuple[str, str], BytePairs] = {}


def byte_pairs(ranks_path: str, pattern: str) -> BytePairs:
    """The encoder of a rank file, built once in each Python process."""
    key = ranks_path, pattern
    if key not in _encoders:
        _encoders[key] = BytePairs(read_ranks(ranks_path), pattern)
    return _encoders[key]


def _over_texts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, row, schema: str):
    """One row per document: its id and what ``row(coder, ids)`` makes of its ids in decimal."""
    kinds = [pa.int64(), *[{"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}[x.split()[1]]
                           for x in schema.split(", ")[1:]]]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(ranks_path, pattern)
        for batch in batches:
            at = 0
            for texts in batches_of_texts(batch.column("text"), TOGETHER):
                rows = zip(*[row(coder, ids) for ids in coder.encode(texts)])
                doc_ids = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                at += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([doc_ids, *rows], kinds)],
                                                 names=names)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every whole text; null and empty texts give an empty array."""
    return _over_texts(docs, ranks_path, pattern, id_col, text_col,
                       lambda coder, ids: ([int(x) for x in ids.split(",") if x],), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids give empty bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_pairs(ranks_path, pattern).tokens
        for batch in batches:
            data = [b"".join(map(tokens.__getitem__, x.as_py() or ())) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())],
                                             names=["doc_id", "data"])

    return (encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "doc_id long, data binary"))


def digest_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text after a round trip.

    Null and empty texts have no ids. Null and repeated ids keep their rows; an
    empty table gives an empty result; other columns are not read.
    """
    def row(coder: BytePairs, ids: str) -> tuple[int, str, str]:
        return (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(coder.decode(ids)).hexdigest())

    return _over_texts(docs, ranks_path, pattern, id_col, text_col, row,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
