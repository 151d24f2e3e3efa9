"""Spelling variants: pairs of vocabulary words one edit apart, by finite-state composition.

The vocabulary's minimised acceptor A is composed with a transducer E that copies
letters and makes exactly one edit (a letter replaced, deleted or inserted), and with
A again. Up to the edit both copies of A are in one state, as A is deterministic;
an edit sends them to two states, and beyond it both read the same letters. So the
product's states behind an edit are pairs of states of A, and what they accept, the
common rests of both, is again an acceptor, kept once per pair.

The composition is partitioned by its initial state: a task holds the words that
share a prefix of ``DEPTH`` letters and starts in the state behind it, with the edit
still to come. Edits within the first letters leave the last letters alone, so those
pairs are found in a second set of partitions, over the reversed words by their last
letters. A prefix with more words than a task should hold is opened: its words go on
to the partitions of the next letter, and pairs whose edit is just that letter meet
by a shuffle on what is left without it, where at most one word per letter of the
alphabet comes together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import ids_and_texts, saved, shuffle_width

#: letters that partitions share
DEPTH = 3
#: most words in one task's acceptor
WORDS = 50_000
#: distinct words counted in a task before they are sent on
COUNTED = 400_000
#: one document in so many loses a letter of a word, see ``vocabulary``
DELETE = 31

_lower = {c: c + 32 for c in range(65, 91)}


def vocabulary(docs: DataFrame, min_length: int = 7, min_count: int = 2, id_col: str = "doc_id",
               text_col: str = "text", delete: int = DELETE) -> DataFrame:
    """(word, n): words of at least ``min_length`` letters and ``min_count`` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. With
    h the crc32 of ``<doc_id>:<word>``, a word loses its letter h % length where
    ``delete`` divides h (a given, reproducible share of misspellings; 0 for none).
    A null text has no words, a null id counts as an empty one. Words are counted in
    the tasks before they are shuffled.
    """
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}")  # a longer run than asked for is still a whole one

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()),
                                                pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                found = runs.findall(text.translate(_lower))
                if delete:
                    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    found = Counter(found)
                    for w in [w for w in found if zlib.crc32(w.encode(), prefix) % delete == 0]:
                        cut = zlib.crc32(w.encode(), prefix) % len(w)
                        counts[w[:cut] + w[cut + 1:]] += found.pop(w)
                counts.update(found)
                if len(counts) > COUNTED:
                    yield out()
        if counts:
            yield out()

    words = ids_and_texts(docs, id_col, text_col).mapInArrow(count, "word string, n long")
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


class Acceptor:
    """Minimised acceptors of word lists, and of what two of their states both accept.

    States are interned: equal right languages are one state. State 0 accepts nothing.
    """

    def __init__(self) -> None:
        self.states: list[tuple[bool, tuple[tuple[str, int], ...]]] = [(False, ())]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.arcs: list[dict[str, int]] = [{}]
        self.least: list[int] = [1 << 30]  # letters of the shortest word
        self.both: dict[tuple[int, int], int] = {}
        self.made: dict[int, list[tuple[str, str, int]]] = {}

    def state(self, final: bool, arcs: tuple[tuple[str, int], ...]) -> int:
        key = (final, arcs)
        if (found := self.number.get(key)) is None:
            found = self.number[key] = len(self.states)
            self.states.append(key)
            self.arcs.append(dict(arcs))
            self.least.append(0 if final else 1 + min((self.least[t] for _, t in arcs), default=1 << 30))
        return found

    def accept(self, words: list[str], at: int = 0) -> int:
        """The state that accepts what sorted distinct words hold from letter ``at`` on."""
        # open[d] collects the arcs of the state behind d letters of the newest word
        open_arcs: list[list[tuple[str, int]]] = [[]]
        finals, last = [False], ""
        for word in words:
            word = word[at:]
            same = 0
            for x, y in zip(word, last):
                if x != y:
                    break
                same += 1
            for d in range(len(last), same, -1):
                done = self.state(finals.pop(), tuple(open_arcs.pop()))
                open_arcs[-1].append((last[d - 1], done))
            for _ in range(len(word) - same):
                open_arcs.append([])
                finals.append(False)
            finals[-1] = True
            last = word
        for d in range(len(last), 0, -1):
            done = self.state(finals.pop(), tuple(open_arcs.pop()))
            open_arcs[-1].append((last[d - 1], done))
        return self.state(finals[0], tuple(open_arcs[0]))

    def common(self, x: int, y: int) -> int:
        """The state that accepts what both accept: the product behind an edit, without dead ends."""
        if x == y or not x or not y:
            return x if x == y else 0
        key = (x, y) if x < y else (y, x)
        if (found := self.both.get(key)) is None:
            a, b = self.arcs[x], self.arcs[y]
            if len(b) < len(a):
                a, b = b, a
            arcs = []
            for letter, t in a.items():
                if (u := b.get(letter)) and (z := self.common(t, u)):
                    arcs.append((letter, z))
            arcs.sort()
            final = self.states[x][0] and self.states[y][0]
            found = self.both[key] = self.state(final, tuple(arcs)) if final or arcs else 0
        return found

    def edits(self, p: int, rest: int) -> list[tuple[str, str, int]]:
        """(letter, other letter or none, common rests) of each edit in state p; rests of at most ``rest`` letters.

        Deleting any letter of a run gives the same word, so only the last of a run is.
        """
        if (found := self.made.get(p)) is None:
            found, arcs = [], self.states[p][1]
            for i, (a, t) in enumerate(arcs):
                if self.least[t] > rest:
                    continue
                for b, u in arcs[:i]:
                    if (z := self.common(t, u)) and self.least[z] <= rest:
                        found.append((a, b, z))
                z = self.common(t, p)
                if z and a in self.arcs[z]:  # the rest begins with the deleted letter
                    final, kept = self.states[z]
                    kept = tuple(k for k in kept if k[0] != a)
                    z = self.state(final, kept) if final or kept else 0
                if z and self.least[z] <= rest:
                    found.append((a, "", z))
            self.made[p] = found
        return found

    def rests(self, z: int, rest: int) -> list[str]:
        """The words that state z accepts, of at most ``rest`` letters."""
        final, arcs = self.states[z]
        out = [""] if final else []
        if rest:
            for letter, t in arcs:
                if self.least[t] < rest:
                    out += [letter + r for r in self.rests(t, rest - 1)]
        return out

    def pairs(self, start: int, rest: int = 1 << 20) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words one edit apart; at most ``rest`` letters behind the edit."""
        todo = [(start, "")]
        listed: dict[int, list[str]] = {}
        while todo:
            p, prefix = todo.pop()
            for a, b, z in self.edits(p, rest):
                if z not in listed:
                    listed[z] = self.rests(z, rest)
                for r in listed[z]:
                    yield prefix + a + r, prefix + b + r
            for letter, t in self.states[p][1]:
                todo.append((t, prefix + letter))


def _tally(pairs, n: dict[str, int]) -> dict[str, list]:
    """Per word: how many near words, and the one of largest n (ties: the smallest)."""
    found: dict[str, list] = {}
    for x, y in pairs:
        for w, v in ((x, y), (y, x)):
            m = n[v]
            if (f := found.get(w)) is None:
                found[w] = [1, m, v]
            else:
                f[0] += 1
                if m > f[1] or m == f[1] and v < f[2]:
                    f[1], f[2] = m, v
    return found


def _partition_pairs(words: list[str], counts: list[int], depth: int, reverse: bool) -> dict[str, list]:
    """What a partition tells of its words: words that share ``depth`` letters at their start (end)."""
    acceptor = Acceptor()
    if not reverse:
        n = dict(zip(words, counts))
        head = words[0][:depth]
        start = acceptor.accept(sorted(words), depth)
        return _tally(((head + x, head + y) for x, y in acceptor.pairs(start)), n)
    turned = sorted(w[::-1] for w in words)
    tail = turned[0][:depth][::-1]
    start = acceptor.accept(turned, depth)
    pairs = ((x[::-1] + tail, y[::-1] + tail) for x, y in acceptor.pairs(start, DEPTH - 1))
    # the other partitions have the pairs that share their first letters
    return _tally(((x, y) for x, y in pairs if x[:DEPTH] != y[:DEPTH]), dict(zip(words, counts)))


_FOUND = "word string, n_near long, best_n long, best string"


def _rows(found: dict[str, list]) -> pa.Table:
    return pa.table([pa.array(found.keys(), pa.string()), *[
        pa.array([f[i] for f in found.values()], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]],
        names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, size: int = WORDS) -> DataFrame:
    """word, n_near, best_n, best of each word with a near one; words need more than 2 * DEPTH letters.

    ``words`` is (word, n), one row per word. ``best`` is the near word of largest n,
    the smallest in code-point order of equal ones. No task holds more than ``size`` words.
    """
    # both ways in one frame: ``w`` is the word as its partition reads it
    todo = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("turned")) \
        .withColumn("w", F.when(F.col("turned"), F.reverse("word")).otherwise(F.col("word"))).drop("word")
    closed, rests, depth = [], [], DEPTH
    while True:
        todo = todo.withColumn("key", F.substring("w", 1, depth)).withColumn("depth", F.lit(depth))
        full = saved(todo.groupBy("turned", "key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > size)
                     .select(F.col("turned").alias("t"), F.col("key").alias("big")))
        hot = full.count()
        same = (F.col("turned") == F.col("t")) & (F.col("key") == F.col("big"))
        closed.append(todo.join(full, same, "left_anti") if hot else todo)
        if not hot:
            break
        # opened: the edit at the letter behind ``key`` is made here, all others beneath
        todo = saved(todo.join(full, same, "left_semi"))
        without = F.concat(F.col("key"), F.substring("w", depth + 2, 1 << 20))
        rests.append(todo.select("turned", "key", "w", "n", F.explode(F.array(
            F.struct(without.alias("rest"), F.lit(True).alias("cut")),
            F.struct(F.col("w").alias("rest"), F.lit(False).alias("cut")))).alias("e"))
            .where((F.length("w") > depth) | ~F.col("e.cut"))
            .select("turned", "key", "w", "n", "e.rest", "e.cut"))
        depth += 1
    parts = closed[0]
    for c in closed[1:]:
        parts = parts.unionByName(c)

    def compose(group: pa.Table) -> pa.Table:
        turned = group.column("turned")[0].as_py()
        ws = group.column("w").to_pylist()
        return _rows(_partition_pairs([w[::-1] for w in ws] if turned else ws, group.column("n").to_pylist(),
                                      group.column("depth")[0].as_py(), turned))

    # as many partitions as the work needs: by bytes, which are few, they would be merged into a handful
    width = shuffle_width(words.sparkSession, 2 * words.count(), size // 5 + 1)
    found = (parts.repartition(width, "turned", "depth", "key")
             .groupBy("turned", "depth", "key").applyInArrow(compose, _FOUND))
    for r in rests:
        found = found.unionByName(r.groupBy("turned", "key", "rest").applyInArrow(_opened, _FOUND))
    first = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("f"))
            .select("word", "n_near", (-F.col("f.m")).alias("best_n"), F.col("f.best").alias("best")))


def _opened(group: pa.Table) -> pa.Table:
    """Pairs that differ by the letter behind an opened prefix: words that are equal without it.

    ``cut`` rows lost that letter; a row that did not is the shorter word of a deletion.
    """
    turned, depth = group.column("turned")[0].as_py(), len(group.column("key")[0].as_py())
    ws, cuts = group.column("w").to_pylist(), group.column("cut").to_pylist()
    n = dict(zip(ws, group.column("n").to_pylist()))
    long = sorted(w for w, c in zip(ws, cuts) if c)
    pairs = [(x, y) for i, x in enumerate(long) for y in long[:i]]
    for y in (w for w, c in zip(ws, cuts) if not c):
        # the last letter of a run is the deleted one, as in ``Acceptor.edits``
        pairs += [(x, y) for x in long if y[depth:depth + 1] != x[depth]]
    if turned:
        pairs = [(x[::-1], y[::-1]) for x, y in pairs if x[-DEPTH:] != y[-DEPTH:]]
        n = {w[::-1]: m for w, m in n.items()}
    return _rows(_tally(pairs, n))


def variants(words: DataFrame, dominance: int = 10, size: int = WORDS) -> DataFrame:
    """Each word's standard form: word, n, n_near, form, form_n, root.

    ``words`` is (word, n), one row per word of at least seven letters. Two words are
    near if they differ by one inserted, deleted or replaced letter. A word's form is
    its near word of largest n (ties: the smallest) if that n is ``dominance`` times
    its own or more, else null; root is the last of the forms that follow each other.
    An empty vocabulary gives an empty result.
    """
    words = saved(words.select("word", "n"))
    near = near_words(words, size)
    takes = F.col("best_n") >= dominance * F.col("n")
    out = saved(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n")))
    # n grows ``dominance`` times with each form, so the chains are short; their length halves each time
    up = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(up.join(further, "root", "left").select("word", "root", "next"))
        up = step.select("word", F.coalesce("next", "root").alias("root"))
        if not step.where("next is not null").limit(1).count():
            break
    return out.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))
