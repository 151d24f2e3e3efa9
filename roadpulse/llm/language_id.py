"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word with their surrounding space from both
ends and gives every byte position a distribution over the languages; a document's
distribution is the mean over all its positions. Recurrence starts anew at white
space and every ``SPAN`` bytes, so a word has the same positions' sums wherever it
stands: tasks keep these sums for words seen before and run the network on new
words only, thousands at a time.

Training is plain numpy on the driver: backpropagation through time with Adam,
on a bounded sample of words from documents with a known language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import ids_and_texts
from .packing import batches_of_texts

HIDDEN = 16
#: bytes of a word that one run of the network reads at most
SPAN = 40
#: bounds of the training sample: documents (shared evenly by the languages) and words of each
SAMPLE_DOCS = 1200
SAMPLE_WORDS = 64
EPOCHS = 4
CACHE = 200_000
UNKNOWN = "und"


@dataclass
class Network:
    """Weights of both directions and of the output; ``langs`` names its classes."""

    langs: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, langs: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w["x" + d] = rng.normal(0, 0.3, (256, 3 * hidden))
            w["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
            w["c" + d] = np.zeros(3 * hidden)
        w["o"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, len(langs)))
        w["p"] = np.zeros(len(langs))
        return cls(langs, {k: v.astype(np.float32) for k, v in w.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _gru(w: dict, d: str, seq: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States after each of the T steps, (T, B, H); with ``keep`` what backpropagation needs."""
    x, u, c = w["x" + d], w["u" + d], w["c" + d]
    n = u.shape[0]
    h = np.zeros((seq.shape[1], n), np.float32)
    states, tape = np.empty((len(seq), *h.shape), np.float32), []
    for t in range(len(seq)):
        gx = x[seq[t]]
        gx += c
        gh = h @ u
        zr = _sigmoid(gx[:, :2 * n] + gh[:, :2 * n])
        z, r = zr[:, :n], zr[:, n:]
        new = np.tanh(gx[:, 2 * n:] + r * gh[:, 2 * n:])
        m = mask[t][:, None]
        nxt = h + m * (1 - z) * (new - h)
        if keep:
            tape.append((h, z, r, new, gh[:, 2 * n:], m))
        h = states[t] = nxt
    return states, tape


def add_rows(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``into[at[i]] += rows[i]`` for all i, repeated places included."""
    order = np.argsort(at, kind="stable")
    where, first = np.unique(at[order], return_index=True)
    if len(where):
        into[where] += np.add.reduceat(rows[order], first, axis=0)


def _gru_back(w: dict, d: str, seq: np.ndarray, tape: list, dstates: np.ndarray, grads: dict) -> None:
    u = w["u" + d]
    n = u.shape[0]
    dh, pres = np.zeros_like(dstates[0]), np.empty((*seq.shape, 3 * n), np.float32)
    for t in range(len(seq) - 1, -1, -1):
        h, z, r, new, ghn, m = tape[t]
        dh = dh + dstates[t]
        dnew = dh * m * (1 - z)
        dz = dh * m * (h - new)
        back = dh * (1 - m * (1 - z))
        da = dnew * (1 - new * new)
        dr = da * ghn
        pre = np.concatenate([dz * z * (1 - z), dr * r * (1 - r), da], axis=1)
        through = pre.copy()
        through[:, 2 * n:] *= r
        pres[t] = pre
        grads["u" + d] += h.T @ through
        dh = back + through @ u.T
    rows = pres.reshape(-1, 3 * n)
    add_rows(grads["x" + d], seq.ravel(), rows)
    grads["c" + d] += rows.sum(0)


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, mask, lengths): bytes by step, the backward ones reversed in place."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max(initial=1))
    grid = np.zeros((len(words), width), np.uint8)
    inside = np.arange(width)[None, :] < size[:, None]
    grid[inside] = np.frombuffer(b"".join(words), np.uint8)
    back = np.zeros_like(grid)
    back[inside] = np.frombuffer(b"".join(w[::-1] for w in words), np.uint8)
    return grid.T, back.T, inside.T.astype(np.float32), size


def _mirror(states: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Backward states, (T, B, H), put at the positions they belong to."""
    at = np.maximum(size[None, :] - 1 - np.arange(len(states))[:, None], 0)
    return np.take_along_axis(states, at[:, :, None], axis=0)


def position_logits(net: Network, words: list[bytes], keep: bool = False):
    seq, back, mask, size = _padded(words)
    f, tape_f = _gru(net.weights, "f", seq, mask, keep)
    b, tape_b = _gru(net.weights, "b", back, mask, keep)
    both = np.concatenate([f, _mirror(b, size)], axis=2)
    return both @ net.weights["o"] + net.weights["p"], (seq, back, mask, size, both, tape_f, tape_b)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(np.maximum(x - x.max(-1, keepdims=True), -60))  # no denormal numbers, which are slow
    return e / e.sum(-1, keepdims=True)


def word_sums(net: Network, words: list[bytes]) -> np.ndarray:
    """For each word, the sum over its positions of the language probabilities."""
    out = np.zeros((len(words), len(net.langs)), np.float32)
    spans = [(i, w[a:a + SPAN]) for i, w in enumerate(words) for a in range(0, len(w), SPAN)]
    spans.sort(key=lambda s: len(s[1]))  # equal lengths together: little padding
    for at in range(0, len(spans), 4096):
        part = spans[at:at + 4096]
        logits, (_, _, mask, *_) = position_logits(net, [w for _, w in part])
        sums = (_softmax(logits) * mask[:, :, None]).sum(0)
        add_rows(out, np.fromiter((i for i, _ in part), np.int64, len(part)), sums)
    return out


def train(words: list[bytes], labels: np.ndarray, langs: list[str], hidden: int = HIDDEN,
          epochs: int = EPOCHS, seed: int = 0, batch: int = 256, rate: float = 0.01) -> Network:
    """Network fitted to labelled words; every position of a word carries its label.

    Languages count alike, however many words each has.
    """
    net = Network.fresh(langs, hidden, seed)
    w = net.weights
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    weight = 1 / np.maximum(np.bincount(labels, minlength=len(langs)), 1)
    weight = (weight / (weight[labels].mean()))[labels].astype(np.float32)
    rng = np.random.default_rng(seed)
    size = np.fromiter((min(len(x), SPAN) for x in words), np.int64, len(words))
    step, total = 0, epochs * -(-len(words) // batch)
    for _ in range(epochs):
        # batches of similar lengths, in random order
        order = np.argsort(size + rng.uniform(0, 3, len(words)), kind="stable")
        cuts = [order[a:a + batch] for a in range(0, len(order), batch)]
        for c in rng.permutation(len(cuts)):
            pick = cuts[c]
            logits, (seq, back, mask, sizes, both, tape_f, tape_b) = position_logits(
                net, [words[i][:SPAN] for i in pick], True)
            dl = _softmax(logits)
            dl[:, np.arange(len(pick)), labels[pick]] -= 1
            dl *= (mask * weight[pick][None, :])[:, :, None] / mask.sum()
            grads = {k: np.zeros_like(v) for k, v in w.items()}
            flat = both.reshape(-1, both.shape[2])
            grads["o"] = flat.T @ dl.reshape(-1, dl.shape[2])
            grads["p"] = dl.sum((0, 1))
            dboth = dl @ w["o"].T
            half = dboth.shape[2] // 2
            _gru_back(w, "f", seq, tape_f, dboth[:, :, :half], grads)
            inside = mask[:, :, None]
            _gru_back(w, "b", back, tape_b, _mirror(dboth[:, :, half:], sizes) * inside, grads)
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                w[k] -= (rate * (1 - step / (total + 1)) * (first[k] / (1 - 0.9 ** step))
                         / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _words(text: str) -> list[bytes]:
    """Words with a space on either side, those without any letter left out."""
    return [b" " + w + b" " for w in text.encode().split() if w.isalpha() or has_letter(w.decode())]


def training_words(docs: DataFrame, known: Column, text_col: str = "text", lang_col: str = "lang",
                   sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """(lang, words) of at most ``sample_docs`` documents with ``known`` true and a language.

    The languages share the documents evenly. Documents and, in each, at most
    about twice ``sample_words`` words are chosen by hash, so the sample does not
    depend on how rows are partitioned.
    """
    lang, text = F.col(lang_col).cast("string"), F.col(text_col).cast("string")
    rows = docs.where(known & lang.isNotNull() & text.isNotNull() & (F.trim(text) != ""))
    rows = rows.select(lang.alias("lang"), text.alias("text"))
    counts = rows.groupBy("lang").count()
    langs = max(1, counts.count())
    each = max(1, sample_docs // langs)
    # a hash threshold first, so that few texts reach the window; then exactly ``each``
    rows = rows.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 30)))
    share = counts.select("lang", (F.least(F.lit(1.0), 4.0 * each / F.col("count")) * (1 << 30)).alias("below"))
    rows = rows.join(F.broadcast(share) if langs <= 10_000 else share, "lang").where("h < below")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = rows.withColumn("place", place).where(F.col("place") <= each)
    words = F.split("text", r"[ \t\n\x0B\f\r]+")
    every = F.greatest(F.lit(1), F.floor(F.size("w") / sample_words))
    return rows.select("lang", words.alias("w")).select("lang", F.filter(
        "w", lambda w, i: (F.length(w) <= 200) & (F.pmod(F.xxhash64(w, i), every) == 0)).alias("words"))


def fit(docs: DataFrame, known: Column, text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, hidden: int = HIDDEN,
        epochs: int = EPOCHS, seed: int = 0) -> Network | None:
    """Network learned from the documents where ``known`` is true; None if none has a language."""
    rows = training_words(docs, known, text_col, lang_col, sample_docs, sample_words).collect()
    langs = sorted({r["lang"] for r in rows})
    pairs = sorted({(w, langs.index(r["lang"])) for r in rows for x in r["words"] for w in _words(x)})
    if not pairs:
        return None
    return train([w for w, _ in pairs], np.array([k for _, k in pairs]), langs, hidden, epochs, seed)


class _Reader:
    """Document probabilities, remembering the sums of words."""

    def __init__(self, net: Network):
        self.net = net
        self.at: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(net.langs) + 1), np.float32)

    def read(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        split = [t.encode().split() if t else [] for t in texts]
        if len(self.at) > CACHE:
            self.at, self.sums = {}, self.sums[:0]
        new: set[bytes] = set()
        for words in split:
            new.update(set(words).difference(self.at))
        fresh = sorted(new)
        lettered = np.array([w.isalpha() or has_letter(w.decode()) for w in fresh], bool)
        table = np.zeros((len(fresh), self.sums.shape[1]), np.float32)
        run = [b" " + w + b" " for w, ok in zip(fresh, lettered) if ok]
        if run:
            table[lettered, :-1] = word_sums(self.net, run)
            table[lettered, -1] = list(map(len, run))
        for i, w in enumerate(fresh, len(self.sums)):
            self.at[w] = i
        self.sums = np.concatenate([self.sums, table])
        for words in split:
            at = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
            total = self.sums[at].sum(0, dtype=np.float64)
            if not total[-1]:
                yield UNKNOWN, 0.0
            else:
                best = int(total[:-1].argmax())
                yield self.net.langs[best], float(min(1.0, total[best] / total[-1]))


_readers: dict[str, _Reader] = {}


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text, read from the text alone.

    Null texts, empty texts and texts without a letter are ``und`` with score 0,
    and so is every text if there was nothing to learn from.
    """
    import uuid
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if net is not None and name not in _readers:
            _readers.clear()
            _readers[name] = _Reader(net)
        for batch in batches:
            got: list[tuple[str, float]] = []
            for texts in batches_of_texts(batch.column("text")):
                got += _readers[name].read(texts) if net is not None else [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Documents that training never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Learns from documents that are not held out and have a language; predicts all.
    A null id is not held out and, its fold being unknown, is not learned from.
    Repeated rows are predicted alike; an empty table gives an empty result; other
    columns are not read.
    """
    ids = F.col(id_col).cast("long")
    net = fit(docs, ids.isNotNull() & ~held_out(ids), text_col, lang_col)
    return predict(docs, net, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
