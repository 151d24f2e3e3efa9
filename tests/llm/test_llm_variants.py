"""Spelling variants, token alignment and mixture packing against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm import mixture_packing, queries, spelling, token_alignment
from roadpulse.llm._util import known_to_workers

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a  b", "a \n b", "\n\n", "  ", " ", " a", "a ", "tab\tx y", "x  y z", "a\x1c b", "a\r\nb", "", None, "word \nnext",
       "é ñ'll 's  'S", "\x85 a", "a\x00 b c\x00", "𝔘𝔫 12³ ① 漢字かな", "<|endoftext|> x <s> </s>", "aaaaaaaaa " * 4000,
       "already ▁ here", "▁", "İstanbul ΣΟΦΟΣ Σ", "é ́x", "x" * 30000, "   b", "<|STARTOFTEXT|>", "tail \n"]


@pytest.fixture(autouse=True)
def workers(spark):
    known_to_workers(spark)


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def frame(spark, texts, **extra):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


# ----------------------------------------------------------------------------- spelling variants

def brute_vocabulary(rows):
    n = Counter()
    for doc_id, text, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = (x, y) if len(x) > len(y) else (y, x)
    return any(x[:i] + x[i + 1:] == y for i in range(len(x)))


def brute_variants(n, dominance=10):
    meet = defaultdict(set)
    for w in n:
        meet[w].add(w)
        for i in range(len(w)):
            meet[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in meet.values():
        for x in group:
            near[x].update(y for y in group if one_edit(x, y))
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= dominance * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n.get(form.get(w)), root)
    return out


def result(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spelling_query(spark, texts):
    assert result(queries.op11_spelling_variants(spark, SF)) == brute_variants(brute_vocabulary(texts))


@pytest.mark.parametrize("seed,size", [(1, 50_000), (2, 60), (3, 7), (4, 1)])
def test_near_words_of_dense_vocabularies(spark, seed, size):
    """Few letters, many near words, runs of equal letters; small partitions open prefixes."""
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.choice((7, 7, 8, 8, 9, 10)))) for _ in range(400)}
    n = {w: rnd.choice((2, 3, 20, 30, 200, 2000)) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert result(spelling.variants(df, size=size)) == brute_variants(n)


def test_forms_follow_each_other(spark):
    n = {"reading": 3, "readinge": 40, "readinges": 500, "readingesx": 7000, "readling": 3}
    got = result(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == brute_variants(n) and got["reading"][4] == "readingesx"


def test_spelling_edge_cases(spark):
    rows = [(1, "Letters lettersx letters LETTERS"), (None, "letters Lettersx été"), (1, None), (2, ""),
            (3, "x" * 50_000 + " " + "x" * 50_000), (3, "ÀÉÎÕÜßà àéîõüßà ÀÉÎÕÜßà"), (5, "word7word sevenlt sevenlt ×sevenlt÷")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit(1), "word": F.lit("w")})
    got = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert got == brute_vocabulary(rows)
    empty = spelling.variants(spelling.vocabulary(docs.limit(0)))
    assert empty.count() == 0 and empty.columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_acceptor_is_minimal():
    a = spelling.Acceptor()
    words = sorted(x + y for x in ("ab", "cd", "xy") for y in ("", "s", "ing", "ings"))
    start = a.accept(words)
    assert sorted(a.rests(start, 99)) == words
    seen, todo = set(), [start]
    while todo:
        p = todo.pop()
        if p not in seen:
            seen.add(p)
            todo += [t for _, t in a.states[p][1]]
    assert len(seen) == 9  # start, three first letters' states (one per letter), the shared endings


# ----------------------------------------------------------------------------- token alignment

def brute_alignment(rows):
    a_tok = Tokenizer.from_file(BYTES)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    from roadpulse.llm.packing import byte_alphabet
    alphabet = byte_alphabet()
    a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in a_tok.get_vocab(with_added_tokens=False).items()
               if all(c in alphabet for c in t)}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    per, held = [], defaultdict(set)
    for k, (doc_id, text, *_) in enumerate(rows):
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        data = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != data or b"".join(map(b_bytes, b)) != data:
            per.append((doc_id, [], 0, 0, None))
            continue
        ae, be = np.cumsum([len(a_bytes[i]) for i in a]), np.cumsum([len(b_bytes(i)) for i in b])
        links, lo = [], 0
        for i, x in enumerate(a):
            first, last = ae[i] - len(a_bytes[x]), ae[i]
            lo = int(np.searchsorted(be, first, side="right"))
            j = lo
            while j < len(b) and be[j] - len(b_bytes(b[j])) < last:
                links.append((x, b[j]))
                j += 1
        ends = sorted(set(ae.tolist()) & set(be.tolist()))
        groups, at = [], 0
        for e in ends:
            ga = [x for x, y in zip(a, ae) if at < y <= e] if len(a) < 2000 else \
                a[np.searchsorted(ae, at, side="right"):np.searchsorted(ae, e, side="right")]
            gb = b[np.searchsorted(be, at, side="right"):np.searchsorted(be, e, side="right")]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            at = e
        for p in set(links):
            held[p].add(k)
        per.append((doc_id, links, len(a), len(b), groups))
    count = {p: len(d) for p, d in held.items()}
    top = defaultdict(int)
    for (x, _), c in count.items():
        top[x] = max(top[x], c)
    return sorted([(d, na, nb, len(g or []), len(ls), sum(count[p] == top[p[0]] for p in ls), sum(count[p] for p in ls),
                    "" if g is None else hashlib.sha256(";".join(g).encode()).hexdigest())
                   for d, ls, na, nb, g in per], key=str)


def aligned(df):
    return sorted([tuple(r) for r in df.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()], key=str)


def test_alignment_query(spark, texts):
    assert aligned(queries.op12_token_alignment(spark, SF)) == brute_alignment(texts)


@pytest.mark.parametrize("block", [1, 500, 4 << 20])
def test_alignment_of_odd_texts(spark, block):
    rows = [*enumerate(ODD), (None, "a null id"), (1, "an id twice"), (1, "an id twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n_a": F.lit("x"), "pairs": F.lit(1), "block": F.lit(2)})
    got = token_alignment.align_documents(docs, BYTES, PIECES, block=block)
    assert aligned(got) == brute_alignment(rows)
    assert token_alignment.align_documents(docs.limit(0), BYTES, PIECES).count() == 0


def test_alignment_keeps_the_last_blocks_stretches(monkeypatch):
    """What a worker remembers stays bounded, and what the last block held is not encoded again."""
    monkeypatch.setattr(token_alignment, "CACHE", 60)
    aligner, learned = token_alignment.Aligner(BYTES, PIECES), []
    learn = aligner.learn
    monkeypatch.setattr(aligner, "learn", lambda new: (learned.append(set(new)), learn(new))[1])
    for k in range(8):
        block = [" ".join(["common words of all blocks"] + [f"own{k}{i:02d}x" for i in range(40)]), None, "", "é " + "x" * k]
        got, want = aligner.block(block), token_alignment.Aligner(BYTES, PIECES).block(block)
        assert len(aligner.known) <= 60 + 50
        assert all(np.array_equal(got[c], want[c]) for c in want)
    assert all(" common" not in new and " words" not in new for new in learned[1:])


def test_alignment_forgets_stretches(spark, texts, monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHE", 50)
    a, b = token_alignment.Aligner(BYTES, PIECES), token_alignment.Aligner(BYTES, PIECES)
    some = [t for _, t, _ in texts[:30]]
    for i in range(0, 30, 3):
        a.block(some[i:i + 3])
    again, fresh = a.block(some[:3]), b.block(some[:3])
    assert again["digests"] == fresh["digests"] and (again["pairs"] == fresh["pairs"]).all()


def test_pairs_of_ids(spark):
    docs = frame(spark, ["the cat", "the dog", "the"])
    pairs = token_alignment.id_pairs(docs, BYTES, PIECES).collect()
    the = Tokenizer.from_file(BYTES).encode(" the").ids[0]
    assert [(r.n_docs, r.best) for r in pairs if r.a_id == the] == [(3, True)]


# ----------------------------------------------------------------------------- mixture packing

def check_packing(rows, pieces, capacity=2048):
    tok = Tokenizer.from_file(WORDS)
    ids = [(d, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for d, t, *_ in rows]
    want = Counter()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for d, x in ids:
        want[d] += len(x)
    assert {d: sum(r.length for r in p) for d, p in by_doc.items()} == dict(want)
    unique = Counter(d for d, _ in ids)
    for d, x in ids:
        if unique[d] == 1:
            at = 0
            for r in sorted(by_doc[d], key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(x)
                assert r.ids_crc32 == zlib.crc32(x[at:at + r.length].tobytes())
                at += r.length
    for p in by_seq.values():
        p.sort(key=lambda r: r.offset)
        at = 0
        for r in p:
            assert r.offset == at
            at += r.length
        assert at <= capacity and at & (at - 1) == 0  # a power of two: never padded
    assert sum(sum(r.length for r in p) < capacity for p in by_seq.values()) <= 11
    return by_seq


def test_mixture_query(spark, texts):
    pieces = queries.op13_mixture_packing(spark, SF).collect()
    by_seq = check_packing(texts, pieces)
    total, of = sum(r.length for r in pieces), Counter()
    for r in pieces:
        of[r.source] += r.length
    worst = 0
    for p in by_seq.values():
        if sum(r.length for r in p) == 2048:
            have = Counter()
            for r in p:
                have[r.source] += r.length
            worst = max(worst, max(abs(have[s] - 2048 * n / total) for s, n in of.items()))
    assert worst <= 2 * len(of)


def test_mixture_targets_and_carried_deficits(spark):
    """a:b = 3:1 while both last, over tasks and windows; then what is left, c at the end."""
    rows = [(i, " ".join(["word"] * (i % 37 + 3)), "aab"[i % 3] if i < 900 else "c") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    pieces = mixture_packing.pack_mixture(docs, WORDS, {"a": 3.0, "b": 1.0}, capacity=256, with_ids=True)
    got = pieces.collect()
    by_seq = check_packing(rows, got, 256)
    order = sorted(by_seq)
    have = [{s: sum(r.length for r in by_seq[q] if r.source == s) for s in "abc"} for q in order]
    both = next(i for i, h in enumerate(have) if h["a"] + h["b"] < 256 or h["a"] > 200 or h["b"] > 72) - 1
    assert both > 20 and all(abs(h["a"] - 192) <= 2 and abs(h["b"] - 64) <= 2 for h in have[:both])
    for k in range(1, both):
        assert abs(sum(h["b"] for h in have[:k]) - 64 * k) <= 3
    last_ab = max(i for i, h in enumerate(have) if h["a"] or h["b"])
    assert all(h["c"] == 0 for h in have[:last_ab])
    seqs = mixture_packing.mixed_sequences(mixture_packing.pack_mixture(docs, WORDS, {"a": 3.0, "b": 1.0}, capacity=256,
                                                                       with_ids=True)).collect()
    assert sum(len(r.ids) for r in seqs) == sum(r.length for r in got) and all(len(r.ids) <= 256 for r in seqs)
    shares = mixture_packing.mixture_of(pieces).groupBy("sequence_id").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in shares)


def test_mixture_odd_texts(spark):
    rows = [(i, t, [None, "x", "y"][i % 3]) for i, t in enumerate(ODD)] + [(None, "no id", "x"), (1, "twice", "x"), (1, "twice", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"part": F.lit("p"), "ids": F.lit(1), "queue": F.lit(2), "start": F.lit(3)})
    for queues in (1000, 1):
        check_packing(rows, mixture_packing.pack_mixture(docs, WORDS, queues=queues).collect())
    empty = mixture_packing.pack_mixture(docs.limit(0), WORDS)
    assert empty.count() == 0 and "sequence_id" in empty.columns


@pytest.mark.parametrize("seed", range(5))
def test_rounds_fill_the_stream(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        lengths = [rnd.choice([0, 1, 5, 100, 1000, 5000]) + rnd.randint(0, 50) for _ in range(rnd.randint(1, 12))]
        natural, window = rnd.random() < .4, rnd.choice([16, 64, 128])
        plan = mixture_packing.RoundRobin(
            lengths, lengths if natural else [rnd.choice([0.0, 1.0, 2.5, 0.01]) for _ in lengths], window)
        seen = set()
        for s, n in enumerate(lengths):
            at = 0
            while at < n:
                k = min(n - at, rnd.randint(1, 70))
                runs = list(plan.places(s, at, k))
                assert [r[0] for r in runs] == [at + sum(x[1] for x in runs[:i]) for i in range(len(runs))]
                seen.update(x for _, m, place in runs for x in range(place, place + m))
                at += k
        assert seen == set(range(sum(lengths)))
        for r in range(1, sum(lengths) // window):
            if natural:
                assert all(abs(c - r * window * n / sum(lengths)) <= len(lengths) + 1
                           for c, n in zip(plan.sent(r), lengths))
