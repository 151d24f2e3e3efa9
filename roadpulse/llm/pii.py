"""Personal data: fixed patterns, and a character BiLSTM-CRF that adds to them.

The patterns give the base spans. The network reads overlapping windows of
``WINDOW`` characters, and every window scores the tags of the ``ZONE`` characters in
its middle. The scores of neighbouring windows make one sequence, which is decoded
as a whole with the transitions of the CRF: no window decides by itself, so a span
over the border of two is one span. A span must hold a digit or ``@``, so the windows
within ``REACH`` of such characters are run; where a decoded stretch does not end
outside of any span, the windows next to it join it, however long it gets. The result
is that of one decoding over all windows of the text.

Training is plain numpy on the driver: labelled spans are the base spans of a
bounded sample of documents and written-out variants of each kind (other
groupings, other separators) put into the sample's prose, beside numbers that are
no personal data. Gradients of the CRF come from its forward and backward sums.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import ids_and_texts
from .language_id import add_rows
from .packing import batches_of_texts

KINDS = ("email", "ip", "card", "phone")
ZONE, SIDE, REACH = 48, 24, 64
WINDOW = ZONE + 2 * SIDE
HIDDEN = 16
#: bounds of the training sample: documents, and windows with variants (twice as many at most in all)
SAMPLE_DOCS = 400
TRAIN_WINDOWS = 2400
EPOCHS = 5
TAGS = 1 + 2 * len(KINDS)
#: symbols: ASCII, other letters, other digits, anything else, outside of the text
LETTER, DIGIT, OTHER, OUTSIDE = 128, 129, 130, 131
SYMBOLS = 132

_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_trigger = re.compile("[0-9@]+")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the address pattern, found from each ``@`` so that long words stay linear."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _local:
            start -= 1
        found = _domain.match(text, at + 1) if start < at else None
        if found:
            yield 0, start, found.end()
        last = found.end() if found else at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: by kind, then start; code points, end exclusive."""
    if not _trigger.search(text):
        return []
    out = list(_emails(text))
    out += [(1, m.start(), m.end()) for m in _ip.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _card.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _phone.finditer(text)
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return out


def symbols(text: str) -> np.ndarray:
    """The network's symbol of every code point."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = codes.astype(np.uint8)
    far = np.flatnonzero(codes >= 128)
    if len(far):
        kinds, where = np.unique(codes[far], return_inverse=True)
        of = np.array([LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else OTHER
                       for c in kinds.tolist()], np.uint8)
        out[far] = of[where]
    return out


def zones_near(text: str) -> np.ndarray:
    """Numbers of the zones within ``REACH`` of a digit or ``@``."""
    edges = [((m.start() - REACH) // ZONE, (m.end() - 1 + REACH) // ZONE) for m in _trigger.finditer(text)]
    if not edges:
        return np.zeros(0, np.int64)
    top = (len(text) - 1) // ZONE
    marks = np.zeros(top + 2, np.int64)
    a, b = np.array(edges).T
    np.add.at(marks, np.maximum(a, 0), 1)
    np.add.at(marks, np.minimum(b, top) + 1, -1)
    return np.flatnonzero(np.cumsum(marks)[:-1] > 0)


def windows_of(sym: np.ndarray, zones: np.ndarray) -> np.ndarray:
    """Symbols of the windows around the zones, one row each."""
    padded = np.full(len(sym) + WINDOW + ZONE, OUTSIDE, np.uint8)
    padded[SIDE:SIDE + len(sym)] = sym
    return padded[zones[:, None] * ZONE + np.arange(WINDOW)[None, :]]


def fresh(hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.3, (SYMBOLS, 4 * hidden))
        w["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        w["c" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
    w["o"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, TAGS))
    w["p"] = np.zeros(TAGS)
    w["t"] = np.zeros((TAGS, TAGS))
    return {k: v.astype(np.float32) for k, v in w.items()}


def _lstm(w: dict, d: str, seq: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    x, u, c = w["x" + d], w["u" + d], w["c" + d]
    n = u.shape[0]
    h = np.zeros((seq.shape[1], n), np.float32)
    cell = np.zeros_like(h)
    states, tape = np.empty((len(seq), *h.shape), np.float32), []
    for t in range(len(seq)):
        gate = x[seq[t]] + c
        gate += h @ u
        s = 0.5 * (np.tanh(0.5 * gate[:, :3 * n]) + 1)
        i, f, o, g = s[:, :n], s[:, n:2 * n], s[:, 2 * n:], np.tanh(gate[:, 3 * n:])
        nxt = f * cell + i * g
        squash = np.tanh(nxt)
        if keep:
            tape.append((h, cell, i, f, o, g, squash))
        h, cell = o * squash, nxt
        states[t] = h
    return states, tape


def _lstm_back(w: dict, d: str, seq: np.ndarray, tape: list, dstates: np.ndarray, grads: dict) -> None:
    u = w["u" + d]
    dh, dcell = np.zeros_like(dstates[0]), np.zeros_like(dstates[0])
    pres = np.empty((*seq.shape, u.shape[1]), np.float32)
    for t in range(len(seq) - 1, -1, -1):
        h, cell, i, f, o, g, squash = tape[t]
        dh = dh + dstates[t]
        dc = dcell + dh * o * (1 - squash * squash)
        pre = np.concatenate([dc * g * i * (1 - i), dc * cell * f * (1 - f),
                              dh * squash * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        pres[t] = pre
        grads["u" + d] += h.T @ pre
        dh, dcell = pre @ u.T, dc * f
    rows = pres.reshape(-1, u.shape[1])
    add_rows(grads["x" + d], seq.ravel(), rows)
    grads["c" + d] += rows.sum(0)


def emissions(w: dict, wins: np.ndarray, keep: bool = False):
    """Scores (T, B, tags) of every position of the windows."""
    seq = np.ascontiguousarray(wins.T)
    f, tape_f = _lstm(w, "f", seq, keep)
    b, tape_b = _lstm(w, "b", seq[::-1], keep)
    both = np.concatenate([f, b[::-1]], axis=2)
    return both @ w["o"] + w["p"], (seq, both, tape_f, tape_b)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def crf_gradient(e: np.ndarray, trans: np.ndarray, tags: np.ndarray):
    """(loss, d emissions, d transitions) of the tag sequences (T, B), summed over the batch."""
    steps, batch, _ = e.shape
    fwd, bwd = np.empty_like(e), np.zeros_like(e)
    fwd[0] = e[0]
    for t in range(1, steps):
        fwd[t] = _logsum(fwd[t - 1][:, :, None] + trans[None], 1) + e[t]
    for t in range(steps - 2, -1, -1):
        bwd[t] = _logsum(trans[None] + (e[t + 1] + bwd[t + 1])[:, None, :], 2)
    whole = _logsum(fwd[-1], 1)
    de = np.exp(fwd + bwd - whole[None, :, None])
    dtrans = np.zeros_like(trans)
    for t in range(1, steps):
        dtrans += np.exp(fwd[t - 1][:, :, None] + trans[None] + (e[t] + bwd[t])[:, None, :]
                         - whole[:, None, None]).sum(0)
    at, who = np.arange(steps)[:, None], np.arange(batch)[None, :]
    gold = e[at, who, tags].sum() + trans[tags[:-1], tags[1:]].sum()
    de[at, who, tags] -= 1
    np.add.at(dtrans, (tags[:-1].ravel(), tags[1:].ravel()), -1)
    return float(whole.sum() - gold), de, dtrans


def viterbi(e: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tag sequences (T, B) under emissions (T, B, tags) of windows by themselves."""
    return np.stack(decode([e[:, i] for i in range(e.shape[1])], trans), axis=1)


def decode(runs: list[np.ndarray], trans: np.ndarray) -> list[np.ndarray]:
    """Best tag sequence of each run of emissions (steps, tags).

    All runs take a step at once, the longest ones first, so that at any step those
    still going on are the first of them.
    """
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    size = np.array([len(runs[i]) for i in order], np.int64)
    flat, starts = np.concatenate([runs[i] for i in order]), np.cumsum(size) - size
    best, back = flat[starts].copy(), []
    for t in range(1, int(size[0])):
        m = int(np.searchsorted(-size, -t))  # runs longer than t
        step = best[:m, :, None] + trans[None]
        back.append(step.argmax(1).astype(np.int8))
        best[:m] = step.max(1) + flat[starts[:m] + t]
    tags, now = np.empty(len(flat), np.int8), best.argmax(1)
    for t in range(int(size[0]) - 1, -1, -1):
        m = int(np.searchsorted(-size, -t))
        tags[starts[:m] + t] = now[:m]
        if t:
            now[:m] = back[t - 1][np.arange(m), now[:m]]
    out: list[np.ndarray] = [tags[:0]] * len(runs)
    for i, a, n in zip(order, starts.tolist(), size.tolist()):
        out[i] = tags[a:a + n]
    return out


def train(wins: np.ndarray, tags: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 0,
          batch: int = 64, rate: float = 0.02) -> dict[str, np.ndarray]:
    """Weights fitted to windows (N, WINDOW) and their tags by backpropagation through time and Adam."""
    w = fresh(hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    rng = np.random.default_rng(seed)
    step, total = 0, epochs * -(-len(wins) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(wins))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            e, (seq, both, tape_f, tape_b) = emissions(w, wins[pick], True)
            _, de, dtrans = crf_gradient(e, w["t"], tags[pick].T.astype(np.int64))
            de, grads = (de / len(pick)).astype(np.float32), {k: np.zeros_like(v) for k, v in w.items()}
            grads["t"] = dtrans / len(pick)
            grads["o"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, TAGS)
            grads["p"] = de.sum((0, 1))
            dboth = de @ w["o"].T
            half = dboth.shape[2] // 2
            _lstm_back(w, "f", seq, tape_f, dboth[:, :, :half], grads)
            _lstm_back(w, "b", seq[::-1], tape_b, dboth[::-1, :, half:], grads)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-6))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                w[k] -= (rate * (1 - step / (total + 1)) * (first[k] / (1 - 0.9 ** step))
                         / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return w


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    """Tag of every code point: 0 outside, 1 + 2k where kind k begins, 2 + 2k inside it."""
    out = np.zeros(length, np.int8)
    for kind, a, b in sorted(spans, key=lambda s: (-s[0], s[1])):  # where kinds overlap the first one stands
        out[a:b] = 2 + 2 * kind
        out[a] = 1 + 2 * kind
    return out


def spans_of(tags: np.ndarray, text: str, offset: int = 0) -> list[Span]:
    """Spans of a tag sequence that can be personal data of their kind."""
    out, at = [], np.flatnonzero(tags)
    if not len(at):
        return out
    kind = (tags[at] - 1) // 2
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) > 1) | (kind[1:] != kind[:-1]) | (tags[at][1:] % 2 == 1)
    starts = np.flatnonzero(begins)
    for s, e in zip(starts, [*(starts[1:] - 1), len(at) - 1]):
        a, b = int(at[s]) + offset, int(at[e]) + 1 + offset
        body = text[a:b]
        a += len(body) - len(body.lstrip())
        b -= len(body) - len(body.rstrip())
        if a < b and plausible(int(kind[s]), text[a:b]):
            out.append((int(kind[s]), a, b))
    return out


def plausible(kind: int, body: str) -> bool:
    """Whether a marked span holds what its kind needs at least."""
    digits = [int(c) for c in body if "0" <= c <= "9"]
    if kind == 0:
        name, _, host = body.partition("@")
        return bool(name.strip()) and "." in host
    if kind == 1:
        parts = [p.strip() for p in body.split(".")]
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn("".join(map(str, digits)))
    return 9 <= len(digits) <= 15


def variants(rng: np.random.Generator) -> tuple[str, int]:
    """One written-out piece of personal data with its kind, or of something else with kind -1."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = lambda: "".join(rng.choice(list("abcdefghiklmnoprstu"), rng.integers(2, 9)))
    kind = int(rng.integers(-1, 4))
    if kind == 0:
        sep = str(rng.choice(["@", " @ "]))
        return f"{name()}{rng.choice(['', '.', '_'])}{d(rng.integers(0, 3))}{sep}{name()}.{rng.choice(['com', 'org', 'net', 'example.com'])}", 0
    if kind == 1:
        return ".".join(str(x) for x in rng.integers(0, 256, 4)), 1
    if kind == 2:
        digits = d(int(rng.choice([13, 15, 16, 16, 16])) - 1)
        digits += next(c for c in "0123456789" if luhn(digits + c))
        sep = str(rng.choice(["", " ", "-", ".", "  "]))
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4)), 2
    if kind == 3:
        a, b, c, cc = d(3), d(3), d(4), str(rng.integers(1, 99))
        return str(rng.choice([f"+{cc} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}",
                               f"+{cc} {a} {b} {c}", f"00{cc} {a} {b} {c}", f"{a} {b} {c}"])), 3
    return str(rng.choice([
        d(rng.integers(1, 9)), f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(1)}.{d(2)}", f"{d(1)},{d(3)}.{d(2)}",
        "token = \"" + "".join(rng.choice(list("0123456789abcdef"), 40)) + "\"", f"@{name()}", f"v{d(1)}.{d(1)}.{d(2)}",
        "".join(rng.choice(list("0123456789abcdef"), 16)), f"{d(20)}{d(6)}", f"{d(3)} {name()} {d(2)}"])), -1


def training_windows(texts: list[str], limit: int = TRAIN_WINDOWS, seed: int = 0):
    """(windows, tags): half from the base spans of the texts, half with variants put into their prose."""
    rng = np.random.default_rng(seed)
    wins, tags = [], []
    for text in texts:
        zones = zones_near(text)
        if len(zones):
            zones = zones[np.sort(rng.permutation(len(zones))[:8])]
            marks = tags_of(len(text), base_spans(text))
            wins.append(windows_of(symbols(text), zones))
            padded = np.zeros(len(text) + WINDOW + ZONE, np.int8)
            padded[SIDE:SIDE + len(text)] = marks
            tags.append(padded[zones[:, None] * ZONE + np.arange(WINDOW)[None, :]])
    prose = " ".join(re.sub(r"[0-9@]", " ", t)[:4000] for t in texts[:100]) or "some plain words of a text "
    for _ in range(limit // 2):
        body, kind = variants(rng)
        a, b = (int(x) for x in rng.integers(0, max(1, len(prose) - WINDOW), 2))
        lead = prose[a:a + int(rng.integers(0, WINDOW - 10))].rstrip()
        text = f"{lead} {body} " + prose[b:b + WINDOW]
        start = len(lead) + 1
        marks = tags_of(len(text), [(kind, start, start + len(body))] if kind >= 0 else [])
        wins.append(windows_of(symbols(text), np.zeros(1, np.int64)))
        padded = np.zeros(len(text) + WINDOW + ZONE, np.int8)
        padded[SIDE:SIDE + len(text)] = marks
        tags.append(padded[None, :WINDOW])
    return np.concatenate(wins), np.concatenate(tags)


def fit(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
        limit: int = TRAIN_WINDOWS, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 0) -> dict:
    """Weights learned from at most ``sample_docs`` documents that hold a digit or ``@``.

    The documents with the smallest hashes are taken, so the sample does not depend
    on how rows are partitioned; only the stretches around their base spans travel.
    """
    text = F.col(text_col).cast("string")
    near = F.concat_ws("  ", F.slice(F.regexp_extract_all(
        text, F.lit(r"([^0-9@]{0,40}[0-9@][\s\S]{0,120})"), F.lit(1)), 1, 8))
    able = docs.where(text.rlike("[0-9@]"))
    # a hash threshold leaves about four times the sample over all tasks, so what they
    # send to the driver does not grow with their number
    share = min(1.0, 4.0 * sample_docs / max(1, able.count()))
    place = F.pmod(F.xxhash64(text), F.lit(1 << 30))
    rows = (able.where(place < int(share * (1 << 30)) + 1).select(F.xxhash64(text).alias("h"), near.alias("near"))
            .orderBy("h", "near").limit(sample_docs))
    texts = [r["near"] for r in sorted(rows.collect())]
    wins, tags = training_windows(texts, limit, seed)
    return train(wins, tags, hidden, epochs, seed)


def _zone_scores(w: dict, syms: dict[int, np.ndarray], wanted: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
    """Emissions (zones * ZONE, tags) of the given zones of the given texts."""
    rows = np.concatenate([windows_of(syms[n], zones) for n, zones in wanted])
    out = np.empty((len(rows), ZONE, TAGS), np.float32)
    for at in range(0, len(rows), 2048):
        out[at:at + 2048] = emissions(w, rows[at:at + 2048])[0][SIDE:SIDE + ZONE].transpose(1, 0, 2)
    ends = np.cumsum([len(z) for _, z in wanted]).tolist()
    return [out[a:b].reshape(-1, TAGS) for a, b in zip([0, *ends], ends)]


def find_spans(w: dict, texts: list[str], everywhere: bool = False) -> list[list[Span]]:
    """All spans of each text: the base spans, and the network's that overlap none of them.

    ``everywhere`` runs every window and decodes each text in one piece, for tests; the
    result is the same.
    """
    found: list[list[Span]] = [base_spans(t) for t in texts]
    used: dict[int, np.ndarray] = {}  # zones of each text that are run
    for n, text in enumerate(texts):
        zones = np.arange(-(-len(text) // ZONE)) if everywhere else zones_near(text)
        if len(zones):
            used[n] = np.zeros(-(-len(text) // ZONE), bool)
            used[n][zones] = True
    syms = {n: symbols(texts[n]) for n in used}
    marks = {n: np.zeros(len(used[n]) * ZONE, np.int8) for n in used}
    todo = [(n, r) for n in used for r in _runs(used[n])]
    further = 1
    while todo:
        tags = decode(_zone_scores(w, syms, [(n, np.arange(a, b)) for n, (a, b) in todo]), w["t"])
        grown: dict[int, list[int]] = {}
        for (n, (a, b)), mine in zip(todo, tags):
            marks[n][a * ZONE:b * ZONE] = mine
            low, high = max(0, a - further * bool(mine[0])), min(len(used[n]), b + further * bool(mine[-1]))
            if (low, high) != (a, b):  # a span may go on beyond the stretch
                used[n][low:high] = True
                grown.setdefault(n, []).append(low)
        todo = [(n, r) for n, at in grown.items() for r in _runs(used[n]) if any(r[0] <= x < r[1] for x in at)]
        further *= 2
    for n in used:
        base = np.zeros(len(texts[n]) + 1, bool)
        for _, a, b in found[n]:
            base[a:b] = True
        tags = marks[n][:len(texts[n])]
        found[n] = sorted(found[n] + [s for s in spans_of(tags, texts[n]) if not base[s[1]:s[2]].any()])
    return found


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every whole text.

    The counts and base_sha256 are of the base spans; ``spans`` lists all spans by
    kind, then start. Null texts are empty; a text without any span has empty
    ``spans``. Null and repeated ids keep their rows, equal texts have equal spans;
    an empty table gives an empty result; other columns are not read.
    """
    w = weights if weights is not None else fit(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for texts in batches_of_texts(batch.column("text")):
                texts = [t or "" for t in texts]
                for text, spans in zip(texts, find_spans(w, texts)):
                    base = base_spans(text) if spans else []
                    count = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                    rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by the name of its kind; overlapping spans become one."""
    out, at, last = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = last = max(last, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, weights: dict | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; all other columns as they were.

    Null texts stay null.
    """
    w = weights if weights is not None else fit(docs, text_col)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new: list[str | None] = []
            for texts in batches_of_texts(batch.column(text_col)):
                spans = find_spans(w, [t or "" for t in texts])
                new += [t and redacted(t, s) for t, s in zip(texts, spans)]
            cols = [pa.array(new, pa.string()) if n == text_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, docs.schema)
