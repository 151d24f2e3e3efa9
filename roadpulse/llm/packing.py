"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Documents are tokenised in Python tasks, word by word with a bounded memory:
a text may be cut before a space or line break that follows a non-space without
changing its ids, because no pre-token of the vocabulary runs on into white
space. Only lengths are shuffled. Pieces are dealt by a hash of all they are over shards of about
``SHARD`` pieces; each shard is packed on its own, longest pieces first, putting
every piece where the sum over residual gaps of (open bins with that gap)^2
becomes smallest.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import ids_and_texts, saved

CAPACITY = 2048
SEPARATOR = 0
SHARD = 50_000
CACHE = 300_000

_odd_space = re.compile(r"[^\S \n]|\s\s|^\s|\s$|\x00")
_cut = re.compile(r"(?<=\S)(?=[ \n])")


def stretches(text: str) -> list[str]:
    """The text cut before every space or line break that follows a non-space."""
    if _odd_space.search(text):
        return _cut.split(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes in order
    for the characters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of whole texts under a byte-level BPE file of ``tokenizers``, remembering words.

    New words are encoded together in one call: the merges of the file run in
    ``tiktoken``, several times as fast as the library that wrote it, and give
    the same ids (the tests hold both against each other).
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer
        alphabet = byte_alphabet()
        library = Tokenizer.from_file(path)
        vocab = library.get_vocab(with_added_tokens=False)
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if all(c in alphabet for c in t)}
        #: tokens that the library takes out of a text before anything else, as they stand
        self.added = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        ranks = {t: i for t, i in ranks.items() if t.decode("utf-8", "replace") not in self.added}
        self.cut_added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, i in ranks.items():
            self.size[i] = len(t)
        self.words: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        joined = []
        for w in words:
            if w[0] in " \n" and not w[-1].isspace():
                joined.append(w)
            else:  # a stretch that cannot follow another one unnoticed
                self.words[w] = np.array(self.coder.encode_ordinary(w), "<u4").tobytes()
        for at in range(0, len(joined), 50_000):
            part = joined[at:at + 50_000]
            ids = np.array(self.coder.encode_ordinary("".join(part)), "<u4")
            ends = np.cumsum(np.fromiter((len(w.encode()) for w in part), np.int64, len(part)))
            cuts = np.searchsorted(np.cumsum(self.size[ids]), ends, side="left") + 1
            flat, a = ids.tobytes(), 0
            for w, b in zip(part, (4 * cuts).tolist()):
                self.words[w] = flat[a:b]
                a = b

    def _split(self, text: str) -> list[str]:
        """Stretches of the text; an added token in it is a stretch, and what lies between two is a text."""
        if self.cut_added is None or not self.cut_added.search(text):
            return stretches(text)
        out, at = [], 0
        for m in self.cut_added.finditer(text):
            out += [*stretches(text[at:m.start()]), m.group()]
            at = m.end()
        return out + stretches(text[at:])

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text as the library gives them without adding special tokens; null is an empty text."""
        split = [self._split(t) if t else [] for t in texts]
        if len(self.words) > CACHE:
            self.words.clear()
        self.words.update((t, np.array([i], "<u4").tobytes()) for t, i in self.added.items())
        new: set[str] = set()
        for words in split:
            new.update(words)
        self._learn([w for w in new.difference(self.words) if w])
        known = self.words
        known[""] = b""
        for words in split:
            yield np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")


_tokenizers: dict[tuple[str, str], WordTokenizer] = {}


def _tokenizer(path: str, pattern: str) -> WordTokenizer:
    if (path, pattern) not in _tokenizers:
        _tokenizers[path, pattern] = WordTokenizer(path, pattern)
    return _tokenizers[path, pattern]


def batches_of_texts(texts: pa.Array, limit: int = 4 << 20) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about ``limit`` characters."""
    out, size = [], 0
    for t in texts:
        out.append(t.as_py())
        size += len(out[-1] or "")
        if size >= limit:
            yield out
            out, size = [], 0
    if out:
        yield out


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY,
                     with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids).

    A document is its ids and one separator; one longer than ``capacity`` is cut
    into full pieces after a first piece that takes the remainder.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer_path, pattern)
        for batch in batches:
            names, at = batch.column("doc_id"), 0
            for texts in batches_of_texts(batch.column("text")):
                rows: list[tuple] = []
                for doc_id, ids in zip(names.slice(at, len(texts)).to_pylist(), tok.encode(texts)):
                    ids = np.append(ids, np.uint32(SEPARATOR)).astype("<u4")
                    first = len(ids) % capacity or min(capacity, len(ids))
                    bounds = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        part = ids[a:b]
                        rows.append((doc_id, piece, a, b - a, zlib.crc32(part.tobytes()),
                                     *[part.tolist()] * with_ids))
                at += len(texts)
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=[x.split()[0] for x in schema.split(", ")])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, in the given order.

    A piece of length n put into a bin with gap g turns one bin of gap g into one
    of gap g-n, which changes the sum of squares by 2(N[g-n] - N[g]) + 2, or by
    1 - 2N[g] when it fills the bin; a new bin by 2N[capacity-n] + 1 (0 when the
    piece fills it). Ties go to the smallest gap. Full bins are closed.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, n in enumerate(lengths.tolist()):
        best, cost = 0, 0 if n == capacity else 2 * count[capacity - n] + 1
        if n < capacity:
            gaps = count[n:capacity]
            change = 2 * (count[:capacity - n] - gaps) + 2
            change[0] = 1 - 2 * gaps[0]
            change[gaps == 0] = np.iinfo(np.int64).max
            at = int(change.argmin())
            if change[at] <= cost:
                best = at + n
        if best:
            b = open_bins[best].pop()
            count[best] -= 1
            gap = best - n
        else:
            b, made, gap, best = made, made + 1, capacity - n, capacity
        bins[i], offsets[i] = b, capacity - best
        if gap:
            open_bins[gap].append(b)
            count[gap] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``pieces`` with sequence_id and offset; a shard holds about ``shard`` pieces."""
    pieces = saved(pieces)
    shards = max(1, pieces.count() // shard)
    schema = pieces.schema.simpleString()[7:-1]
    names = pieces.columns
    # start, length and ids tell rows apart that share an id or have none
    at = F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32"), F.lit(shards))

    def place(group: pa.Table) -> pa.Table:
        n = group.column("length").to_numpy()
        doc = group.column("doc_id").to_numpy(zero_copy_only=False)
        crc = group.column("ids_crc32").to_numpy()
        order = np.lexsort((crc, group.column("piece").to_numpy(), doc, -n))
        bins, offsets = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        bins[order], offsets[order] = sum_of_squares(n[order], capacity)
        out = group.select(names)
        return out.append_column("sequence_id", pa.array((group.column("_shard").to_numpy() << 32) + bins)) \
                  .append_column("offset", pa.array(offsets))

    return (pieces.withColumn("_shard", at).groupBy("_shard")
            .applyInArrow(place, f"{schema},sequence_id:bigint,offset:bigint"))


def pack_documents(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY, shard: int = SHARD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` tokens.

    Null and empty texts are one separator. Null and repeated ids keep their rows.
    An empty table gives an empty result. Columns besides id and text are not read.
    """
    return pack(tokenized_pieces(docs, tokenizer_path, pattern, capacity, False, id_col, text_col), capacity, shard)


def sequences(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY, shard: int = SHARD,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, doc_ids, for writing to files."""
    pieces = tokenized_pieces(docs, tokenizer_path, pattern, capacity, True, id_col, text_col)
    packed = pack(pieces, capacity, shard)
    part = F.struct("offset", "doc_id", "ids")
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids")))
