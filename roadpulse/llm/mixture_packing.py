"""Mixture-controlled packing: deficit round-robin over one token queue per source.

Every source is a queue of the tokens of its documents. Rounds of ``window``
tokens visit all queues in a fixed order; each visit adds the queue's quantum, its
share of the window, to its deficit counter, sends as many whole tokens as the
counter holds and carries the rest, a fraction of a token, to the next window. The
rounds' output is one stream, cut into sequences of ``capacity`` tokens; what is
left behind the last full sequence is cut into sequences of a power of two, which
need no padding.

Nothing of this is sequential: how much a queue has sent before a round, and so the
deficit it carries into it, is a sum of equal quanta (``RoundRobin.sent``). So each
task cuts its own documents, wherever they lie in their queues; only the lengths of
the queues, one number per task and source, are added up before. A hot source is
spread over all tasks that read it, and no group is ever brought together.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .packing import batches_of_texts, byte_alphabet

CAPACITY = 2048
SEPARATOR = 1
#: sources with a queue of their own, the longest ones; all further sources share one queue
QUEUES = 1000
#: words remembered in a task
CACHE = 300_000
#: parts of a token that a deficit counter tells apart
PARTS = 1 << 20


class SpacedTokenizer:
    """Ids of whole texts under a vocabulary that drops white space.

    Texts of ASCII and Latin-1 characters go through ``tiktoken``, which runs the
    file's merges ten times as fast as the library that wrote it, and gives the same
    ids (the tests hold both against each other): a byte that such texts do not hold
    stands for the mark of a word's end. In other texts, as no token runs over white
    space and none depends on what is beyond it, the words between spaces and line
    breaks are encoded one by one, and remembered: those of such characters in the same
    way, the rest by the library itself.
    """

    MARK = "\x00"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.coder = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.coder.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t.content for t in self.coder.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {"": b""}
        self.plain, self.merges = re.compile("[ \n!-~À-ÿ]*").fullmatch, None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, steps = file["model"], [n.get("type") for n in (file.get("normalizer") or {}).get("normalizers", [])]
        splits = (file.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if (model["type"] == "BPE" and model.get("end_of_word_suffix") and steps == ["NFC", "Replace", "Lowercase"]
                and [s["type"] for s in splits] == ["Split", "ByteLevel"] and splits[0]["invert"]):
            # the file's pattern for lower-cased texts of these characters
            self.parts = re.compile(splits[0]["pattern"]["Regex"].replace(r"\p{L}", "a-zß-öø-ÿ")
                                    .replace(r"\p{N}", "0-9")).findall
            self._read_merges(model)

    def _read_merges(self, model: dict) -> None:
        import tiktoken
        vocab, end, alphabet = model["vocab"], model["end_of_word_suffix"], byte_alphabet()

        def as_bytes(token: str) -> bytes:
            last = token.endswith(end)
            return bytes(alphabet[c] for c in (token[:-len(end)] if last else token)) + self.MARK.encode() * last

        # the last byte of a word joins its mark before anything else
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [t for t in vocab if t.endswith(end) and len(t) == len(end) + 1] + [t for t in vocab if len(t) == 1] \
            + [a + b for a, b in pairs]
        ranks: dict[bytes, int] = {}
        for t in order:
            ranks.setdefault(as_bytes(t), len(ranks))
        ids = {as_bytes(t): vocab[t] for t in reversed(order)}
        self.ids = np.array([ids[b] for b in ranks], self.kind)
        self.merges = tiktoken.Encoding("words", pat_str=f"[^{self.MARK}]+{self.MARK}", mergeable_ranks=ranks,
                                        special_tokens={})

    def _is_plain(self, text: str) -> bool:
        return self.merges is not None and self.plain(text) is not None and not any(t in text for t in self.added)

    def _plain(self, text: str) -> np.ndarray:
        found = self.parts(text.lower())
        if not found:
            return np.empty(0, self.kind)
        return self.ids[self.merges.encode_to_numpy(self.MARK.join(found) + self.MARK, disallowed_special=())]

    def _learn(self, new: list[str]) -> None:
        slow = []
        for w in new:
            if self._is_plain(w):
                self.words[w] = self._plain(w).tobytes()
            else:
                slow.append(w)
        for at in range(0, len(slow), 10_000):
            part = slow[at:at + 10_000]
            for w, e in zip(part, self.coder.encode_batch_fast(part, add_special_tokens=False)):
                self.words[w] = np.array(e.ids, self.kind).tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text as the library gives them without adding special tokens; null is an empty text."""
        if len(self.words) > CACHE:
            self.words = {"": b""}
        for t in texts:
            if not t:
                yield np.empty(0, self.kind)
            elif self._is_plain(t):
                yield self._plain(t)
            else:
                words = t.replace("\n", " ").split(" ")
                self._learn(list(set(words).difference(self.words)))
                yield np.frombuffer(b"".join(map(self.words.__getitem__, words)), self.kind)


_tokenizers: dict[str, SpacedTokenizer] = {}


def _tokenizer(path: str) -> SpacedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = SpacedTokenizer(path)
    return _tokenizers[path]


class RoundRobin:
    """Deficit round-robin over queues of known lengths, answered for any round by itself.

    ``weights`` are the target proportions of the queues. While all weighted
    queues hold tokens a round sends ``window`` tokens in these proportions; when
    one runs dry the others take over its share (a new phase). Queues of weight
    zero come last, in proportion to their lengths. The fractions of tokens that the
    counters hold back would leave a window a few tokens short: the queue with the
    largest quantum lends them, and is given them back by the next rounds.
    """

    def __init__(self, lengths: list[int], weights: list[float], window: int):
        self.lengths, self.window = lengths, window
        #: first round, counters in PARTS of a token, quanta, the lending queue (-1 if none is large enough)
        self.phases: list[tuple[int, list[int], list[int], int]] = []
        counter, rounds = [0] * len(lengths), 0
        self.ends: list[list[int]] = []  # sent by each queue at the end of each phase
        left = {s for s, n in enumerate(lengths) if n}
        while left:
            by = {s: weights[s] for s in left if weights[s] > 0} or {s: lengths[s] for s in left}
            total = sum(by.values())
            quanta = [0] * len(lengths)
            for s, w in by.items():
                quanta[s] = max(1, int(window * PARTS * w / total) if isinstance(w, float)
                                else window * PARTS * w // total)
            lender = max(by, key=lambda s: (quanta[s], -s))
            if quanta[lender] < len(by) * PARTS:
                lender = -1
            self.phases.append((rounds, counter, quanta, lender))
            rounds += min(-(-(lengths[s] * PARTS - counter[s]) // quanta[s]) for s in by)
            self.ends.append(self._sent(len(self.phases) - 1, rounds))
            counter = [max(n * PARTS, c + (rounds - self.phases[-1][0]) * q)
                       for n, c, q in zip(self.ends[-1], counter, quanta)]
            counter = [min(c, n * PARTS) for c, n in zip(counter, lengths)]
            left = {s for s in left if self.ends[-1][s] < lengths[s]}
        self.starts = [p[0] for p in self.phases]
        self.total = sum(lengths)
        self._rounds: dict[int, tuple[list[int], list[int]]] = {}

    def _sent(self, phase: int, rounds: int) -> list[int]:
        first, counter, quanta, lender = self.phases[phase]
        out = [min(n, (c + (rounds - first) * q) // PARTS) for n, c, q in zip(self.lengths, counter, quanta)]
        if lender >= 0 and rounds > first:
            short = rounds * self.window - sum(out)
            out[lender] = min(self.lengths[lender], out[lender] + max(0, short))
        return out

    def sent(self, rounds: int) -> list[int]:
        """Tokens of each queue that the first ``rounds`` rounds sent."""
        return self._sent(bisect_right(self.starts, rounds) - 1, rounds)

    def round_of(self, queue: int, token: int) -> int:
        """The round that sends a token of a queue."""
        lo, hi = 0, len(self.ends) - 1
        while lo < hi:  # the first phase that sends beyond the token
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.ends[mid][queue] > token else (mid + 1, hi)
        first, counter, quanta, lender = self.phases[lo]
        last = first - 1 + -(-((token + 1) * PARTS - counter[queue]) // quanta[queue])
        if queue != lender:
            return last
        step = 1
        while last - step >= first and self._round(last - step)[1][queue] > token:
            last, step = last - step, step * 2
        lo, hi = max(first, last - step), last  # lent tokens were sent earlier
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self._round(mid)[1][queue] > token else (mid + 1, hi)
        return lo

    def _round(self, r: int) -> tuple[list[int], list[int]]:
        """Of one round: by how much a queue's tokens are shifted in the stream, and where each queue stops."""
        if r not in self._rounds:
            if len(self._rounds) > 10_000:
                self._rounds.clear()
            a = self.sent(r)
            b = self._sent(bisect_right(self.starts, r) - 1, r + 1)  # by the phase that the round is in
            place, shift = sum(a), []
            for x, y in zip(a, b):
                shift.append(place - x)
                place += y - x
            self._rounds[r] = shift, b
        return self._rounds[r]

    def places(self, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(first token, tokens, place in the stream) of the runs that tokens start..start+n get."""
        at, end, held, r = start, start + n, None, self.round_of(queue, start) if n else 0
        while at < end:
            shift, b = self._round(r)
            if b[queue] <= at:  # a round that sends nothing of this queue
                r += 1
                continue
            take = min(end, b[queue]) - at
            place = at + shift[queue]
            if held and held[2] + held[1] == place:
                held = (held[0], held[1] + take, held[2])
            else:
                if held:
                    yield held
                held = (at, take, place)
            at, r = at + take, r + 1
        if held:
            yield held

    def sequence(self, place: int, capacity: int) -> tuple[int, int, int]:
        """(number, first place, places) of the sequence that holds a place of the stream."""
        full = self.total // capacity
        if place < full * capacity:
            return place // capacity, place // capacity * capacity, capacity
        number, at, rest = full, full * capacity, self.total % capacity
        while True:  # the largest power of two that is left, then the next
            size = 1 << (rest.bit_length() - 1)
            if place < at + size:
                return number, at, size
            number, at, rest = number + 1, at + size, rest - size


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, source_col: str, separator: int) -> DataFrame:
    """One row per document: its task, its source, its first token among the task's of that source, its ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(source_col).cast("string").alias("source"))
    schema = "part int, source string, doc_id long, at long, n long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part = _tokenizer(path), TaskContext.get().partitionId()
        used: dict[str | None, int] = {}
        for batch in batches:
            first = 0
            for texts in batches_of_texts(batch.column("text")):
                sources = batch.column("source").slice(first, len(texts))
                at, n, ids = [], [], []
                for s, x in zip(sources.to_pylist(), tok.encode(texts)):
                    at.append(used.get(s, 0))
                    n.append(len(x) + 1)
                    used[s] = at[-1] + n[-1]
                    ids.append(np.append(x, tok.kind.type(separator)).tobytes())
                names = batch.column("doc_id").slice(first, len(texts))
                first += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), sources, names, pa.array(at, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "source", "doc_id", "at", "n", "ids"])

    return rows.mapInArrow(run, schema)


def pack_mixture(docs: DataFrame, tokenizer_path: str, targets: dict[str | None, float] | None = None,
                 capacity: int = CAPACITY, window: int | None = None, queues: int = QUEUES,
                 separator: int = SEPARATOR, with_ids: bool = False, id_col: str = "doc_id",
                 text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of all documents in sequences that hold the sources in target proportions.

    ``targets`` maps a source to its weight; sources it does not name follow when
    the named ones are used up. By default each source's weight is its number of
    tokens, so that every window mirrors the corpus and all queues end together.
    ``window`` (by default one sequence) is the stretch that has the proportions: a
    longer one cuts fewer documents. More than ``queues`` sources without targets
    share a queue beyond the ``queues`` longest.

    Null and empty texts are one separator. A null source is a source. Null and
    repeated ids keep their rows. An empty table gives an empty result. Columns
    besides id, text and source are not read. ``with_ids`` adds the ids of each piece.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "mixture", "ids")
    _encoded(docs, tokenizer_path, id_col, text_col, source_col, separator).write.parquet(path)
    encoded = spark.read.parquet(path)
    parts = encoded.groupBy("source", "part").agg(F.sum("n").alias("n"))
    named = sorted(targets, key=lambda s: (s is None, s)) if targets else [
        r.source for r in parts.groupBy("source").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "source").limit(queues).collect()]
    queue_of = spark.createDataFrame([(s, i) for i, s in enumerate(named)], "name string, queue int")
    parts = (parts.join(F.broadcast(queue_of), F.col("source").eqNullSafe(F.col("name")), "left")
             .select("part", "source", F.coalesce("queue", F.lit(len(named))).alias("queue"), "n"))
    order = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task and source; written, so that Spark knows its size when it chooses the join
    starts_path = scratch_path(spark, "mixture", "starts")
    (parts.withColumn("start", F.coalesce(F.sum("n").over(order), F.lit(0)))
     .select("part", F.col("source").alias("of"), "queue", "start", "n").write.parquet(starts_path))
    starts = spark.read.parquet(starts_path)
    lengths = [0] * (len(named) + 1)
    for r in starts.groupBy("queue").agg(F.sum("n").alias("n")).collect():
        lengths[r.queue] = r.n
    weights = [*map(float, (targets[s] for s in named)), 0.0] if targets else lengths
    plan = RoundRobin(lengths, weights, window or capacity)
    kind = _tokenizer(tokenizer_path).kind
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, source string") + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, full = [x.split()[0] for x in schema.split(", ")], plan.total // capacity * capacity
        for batch in batches:
            row, start, length, crc, places, parts = [], [], [], [], [], []
            for k, (queue, first, n) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("queue", "first", "n")])):
                ids = np.frombuffer(batch.column("ids")[k].as_buffer(), kind).astype("<u4")
                for at, m, place in plan.places(queue, first, n):
                    at, stop = at - first, place + m
                    while place < stop:
                        end = (place // capacity + 1) * capacity if place < full else sum(plan.sequence(place, capacity)[1:])
                        take = (stop if stop < end else end) - place
                        part = ids[at:at + take]
                        row.append(k)
                        start.append(at)
                        length.append(take)
                        crc.append(zlib.crc32(part))
                        places.append(place)
                        if with_ids:
                            parts.append(part.astype(np.int32))
                        at, place = at + take, place + take
            if not row:
                continue
            of, place = pa.array(row), np.array(places, np.int64)
            number, begin = place // capacity, place // capacity * capacity
            for i in np.flatnonzero(place >= full).tolist():
                number[i], begin[i], _ = plan.sequence(places[i], capacity)
            columns = [batch.column("doc_id").take(of), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                       pa.array(crc, pa.int64()), batch.column("n").take(of), pa.array(number), pa.array(place - begin),
                       batch.column("source").take(of)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(parts, pa.list_(pa.int32()))] * with_ids, names=names)

    placed = (encoded.alias("e").join(starts.alias("s"), (F.col("e.part") == F.col("s.part"))
                                      & F.col("e.source").eqNullSafe(F.col("s.of")))
              .select("doc_id", "source", "queue", (F.col("start") + F.col("at")).alias("first"), F.col("e.n").alias("n"), "ids"))
    return placed.mapInArrow(cut, schema)


def mixed_sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves (sequence_id, ids, doc_ids) of pieces packed ``with_ids``."""
    part = F.struct("offset", "doc_id", "ids")
    return (pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids")))


def mixture_of(pieces: DataFrame) -> DataFrame:
    """(sequence_id, source, tokens, share): what each sequence holds of each source."""
    held = pieces.groupBy("sequence_id", "source").agg(F.sum("length").alias("tokens"))
    whole = Window.partitionBy("sequence_id")
    return held.withColumn("share", F.col("tokens") / F.sum("tokens").over(whole))
