"""SimHash, embeddings, lines, passages and components against brute force."""

import random

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadpulse.llm import embedding_dedup, line_dedup, queries, simhash, substring_dedup
from roadpulse.llm._util import known_to_workers
from roadpulse.llm.components import connected_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers(spark):
    known_to_workers(spark)


class Union:
    def __init__(self):
        self.up = {}

    def top(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.top(a), self.top(b)))
        self.up[b] = a


def groups(pairs):
    out = {}
    for node, root in pairs:
        out.setdefault(root, set()).add(node)
    return sorted(map(sorted, out.values()))


def test_components_of_chains_hubs_and_noise(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    links += [(5, 5), (None, 3), (7, None), (1, 0)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    u = Union()
    for a, b in links:
        if a is not None and b is not None and a != b:
            u.join(a, b)
    assert groups((r.node, r.root) for r in got) == groups((x, u.top(x)) for x in u.up)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    u = Union()
    for i, _ in fps:
        u.top(i)
    for i, x in fps:
        for j, y in fps:
            if i < j and (x ^ y).bit_count() <= 4:
                u.join(i, j)
    return {i: (f"{x:016x}", u.top(i)) for i, x in fps}


def test_golay_code_is_perfect():
    index = simhash.golay_index()
    assert (np.bincount(index) == 2048).all()
    keys, rows, _ = simhash.golay_keys(np.array([0, -1, 12345678901234567], np.int64))
    assert len(set(zip(keys.tolist(), rows.tolist()))) == len(keys)


def test_keys_find_every_pair_of_four_errors():
    rng = np.random.default_rng(0)
    for _ in range(300):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, 4, replace=False):
            y ^= 1 << int(b)
        pair = np.array([x, y], np.uint64).view(np.int64)
        key, row, role = simhash.golay_keys(pair)
        sides = [{(int(k), int(r)) for k, w, r in zip(key, row, role) if w == n} for n in (0, 1)]
        assert any(k == q and (r | s) for k, r in sides[0] for q, s in sides[1])


def test_simhash_query_matches_brute_force(spark):
    got = queries.op3_simhash(spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = plain_components([tuple(r) for r in rows])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    assert sum(r.kept for r in got) == len({c for _, c in want.values()})


@pytest.mark.parametrize("hot,huge", [(2_000, 200_000), (5, 200_000), (5, 20)])
def test_simhash_hot_keys_keep_every_component(spark, hot, huge):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [base[0] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
            for _ in range(150)]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)])).view(np.int64)
    nodes = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    links = simhash.fingerprint_links(nodes, 4, hot, huge)
    u, v = Union(), Union()
    for r in links.collect():
        assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 4
        u.join(r.a, r.b)
    for i, x in enumerate(fps.tolist()):
        for y in fps.tolist()[i + 1:]:
            if bin((x ^ y) & (2**64 - 1)).count("1") <= 4:
                v.join(x, y)
    assert groups((x, u.top(x)) for x in u.up) == groups((x, v.top(x)) for x in v.up)


@pytest.mark.parametrize("hot", [2_000, 0])
def test_simhash_finds_pairs_that_differ_in_any_bit(spark, hot):
    """Pairs of their own that differ in one given bit, the sign bit too, and in up to three others."""
    rng = np.random.default_rng(8)
    pairs = []
    for bit in [*range(64), *[63] * 40]:
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        others = rng.choice([b for b in range(64) if b != bit], rng.integers(0, 4), replace=False)
        pairs.append((x, x ^ sum(1 << int(b) for b in (bit, *others))))
    signed = [[v - 2**64 if v >> 63 else v for v in p] for p in pairs]
    nodes = spark.createDataFrame([(v,) for p in signed for v in p], "fp long")
    links = {frozenset((r.a, r.b)) for r in simhash.fingerprint_links(nodes, 4, hot).collect()}
    assert links == {frozenset(p) for p in signed}


def test_simhash_odd_rows(spark):
    long = "word " * 50_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "  \n", "x"), (4, "A b c", "x"), (5, "a B c", "x"), (None, "a b c", "x"),
            (4, "A b c", "x"), (7, long, "x"), (8, long + "word", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = simhash.simhash_dedup(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id", "kept"]
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].fingerprint == "0" * 16 and [by[i].component_id for i in (1, 2, 3)] == [1, 1, 1]
    assert by[5].component_id == 4 and by[None].component_id == 4 and not by[None].kept
    assert by[8].component_id == 7 and got.count() == 9
    assert simhash.simhash_dedup(df.limit(0)).count() == 0


def plain_links(rows, cosine=0.93):
    u, n = Union(), {}
    good = []
    for i, v, label in rows:
        u.top(i)
        n[i] = 0
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        a = np.array(v, np.float64)
        good.append((i, a / np.sqrt(a @ a), label))
    for p, (i, a, la) in enumerate(good):
        for j, b, lb in good[p + 1:]:
            if la == lb and a @ b >= cosine:
                u.join(i, j)
                n[i] += 1
                n[j] += 1
    return {i: (n[i], u.top(i)) for i in n}


def near_vectors(count=240, dim=16):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(count // 4, dim))
    rows = []
    for i in range(count):
        v = base[i % len(base)] + rng.normal(0, 0.08, dim) * (i >= len(base))
        rows.append((i, [float(np.float32(x)) for x in v], i % len(base) % 2))
    return rows


@pytest.mark.parametrize("leaf,cell", [(1_000, 100_000), (25, 100_000), (25, 90), (12, 40)])
def test_forest_finds_the_links(spark, leaf, cell):
    """One leaf, trees in one task, and labels cut into cells of several tasks."""
    rows = near_vectors()
    rows += [(300 + i, rows[0][1], 0) for i in range(20)]        # copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in embedding_dedup.embedding_dedup(df, leaf=leaf, cell=cell).collect()}
    want = plain_links(rows)
    if leaf > len(rows):
        assert got == want
    found, all_of = (sum(n for n, _ in x.values()) for x in (got, want))
    assert 0.9 * all_of <= found <= all_of
    assert all(got[i][0] <= want[i][0] for i in want)


def test_forest_as_shipped_against_brute_force(spark):
    """6,000 distinct vectors of one label, pairs and triples: trees are built, every count is right."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(2_500, 64))
    rows = np.concatenate([base, base[:2_000] + rng.normal(0, 0.25, (2_000, 64)),
                           base[:1_500] + rng.normal(0, 0.2, (1_500, 64))]).astype(np.float32)
    unit = embedding_dedup._unit(rows)
    assert len(embedding_dedup.grow(unit, 1, embedding_dedup.LEAF, embedding_dedup.SPILL, embedding_dedup.TREES, 0.93)) > 100
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<float>")
    got = embedding_dedup.embedding_dedup(df.withColumn("label", F.lit("x"))).orderBy("vec_id").collect()
    links = np.array([r.n_links for r in got])
    assert (links <= want).all() and links.sum() >= 0.99 * want.sum() > 3_000


def test_groups_larger_than_a_cell_are_compared_in_blocks(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=32)
    rows = np.concatenate([centre + rng.normal(0, 0.1, (700, 32)), rng.normal(size=(500, 32))]).astype(np.float32)
    unit = embedding_dedup._unit(rows)
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<float>")
    got = embedding_dedup.embedding_dedup(df.withColumn("label", F.lit(1)), cell=200).orderBy("vec_id").collect()
    links = np.array([r.n_links for r in got])
    assert (links[:700] == want[:700]).all() and (links <= want).all()
    assert {r.component_id for r in got[:700]} == {0}


def test_forest_keeps_large_groups_of_near_copies_whole(spark):
    rng = np.random.default_rng(8)
    dim, size = 64, 10_500
    centre = rng.normal(size=(2, dim))
    tight = centre[0] + rng.normal(0, 0.22, (size, dim))           # all pairs link
    loose = centre[1] + rng.normal(0, 0.28, (2_000, dim))          # many pairs, not all
    rows = np.concatenate([tight, loose, rng.normal(size=(2_000, dim))]).astype(np.float32)
    unit = embedding_dedup._unit(rows)
    want = np.concatenate([(unit[i:i + 1_000] @ unit.T >= 0.93).sum(1) - 1 for i in range(0, len(unit), 1_000)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<float>")
    got = embedding_dedup.embedding_dedup(df.withColumn("label", F.lit(0))).orderBy("vec_id").collect()
    links = np.array([r.n_links for r in got])
    assert want[:size].min() > 0.9 * size and (links <= want).all()
    assert (links[:size] == want[:size]).all() and {r.component_id for r in got[:size]} == {0}
    assert links[size:].sum() >= 0.95 * want[size:].sum()


def test_pairs_that_met_before():
    rng = np.random.default_rng(4)
    lists = [sorted({*rng.integers(0, 60, 3).tolist()}) for _ in range(90)]
    a, b = np.arange(40), np.arange(40, 90)
    want = np.array([[bool(set(lists[x]) & set(lists[y])) for y in b] for x in a])
    assert want.any() and (embedding_dedup._met(a, b, lists) == want).all()


def test_forest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1),
            (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 0.1], 2), (10, [None, 1.0], 1),
            (2, [2.0, 0.0], 1), (None, [3.0, 0.0], 1), (11, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x"))
    got = embedding_dedup.embedding_dedup(df).collect()
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == 13 and by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[None][:2] == (3, 1)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_line_dedup_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = line_dedup.dedup_lines(docs, 3).select("row.doc_id", "n_lines", "n_dropped", "text").collect()
    want = con.execute(line_dedup.oracle_sql(3)).fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and any(r.n_dropped for r in got)


def test_line_dedup_generalises_fields_and_keeps_the_rest(spark):
    rng = random.Random(9)
    body = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(16)) for _ in range(4)]
    rows = [(i, f"{body[i]}\nposted on 2024-01-0{i} by user {name} at noon today\nok", "c")
            for i, name in enumerate(("ann", "bob", "cid", "dan"))]
    rows += [(10, None, "c"), (11, "", "c"), (None, "alone\nand here", "c"), (0, rows[0][1], "c")]
    rows += [(20 + i, "a whole copied page of text\nwith a second line too", "c") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, dropped string")
    out = line_dedup.without_boilerplate(df, min_docs=3)
    assert out.columns == df.columns
    by = {r.doc_id: r.text for r in out.collect()}
    assert by[1] == body[1] and by[0] == body[0]       # the short line recurs as well
    assert by[10] is None and by[11] == "" and by[None] == "alone\nand here"
    assert [by[i] for i in range(20, 24)] == [rows[-4][1], "", "", ""]     # of copied pages one stays
    assert out.count() == len(rows) and line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_lines_of_pages_with_little_of_their_own(spark):
    """Boilerplate goes however much of a page it is; one page of each set of recurring lines keeps it."""
    shared = ["read more about our cookies here", "all rights reserved by us"]
    rows = [(i, f"{shared[0]}\n{shared[1]}\nown {'abcdefgh'[i]} text") for i in range(8)]
    rows += [(20 + i, "\n".join([*shared, "12", "-", "see"])) for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by = {r.row.doc_id: (r.text, r.n_dropped) for r in line_dedup.dedup_lines(df, 3).collect()}
    assert by[0] == (rows[0][1], 0) and all(by[i] == (f"own {'abcdefgh'[i]} text", 2) for i in range(1, 8))
    assert by[20] == ("12\n-\nsee", 2) and by[21] == ("12\n-\nsee", 2)      # numbers and marks alone are no lines


def test_passages_of_the_query(spark):
    """Every window of 50 words seen in an earlier document lies in a reported passage, all but a few."""
    got = queries.op4_substring(spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    first, spans, need, missed = {}, {}, 0, 0
    for r in got:
        assert r.end - r.start >= 50 and r.sources and all(s <= r.doc_id for s in r.sources)
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
    for r in rows:
        w = (r.text or "").lower().split()
        for i in range(len(w) - 49):
            if first.setdefault(tuple(w[i:i + 50]), r.doc_id) != r.doc_id:
                need += 1
                missed += not any(a <= i and i + 50 <= b for a, b in spans.get(r.doc_id, ()))
    assert need > 0 and missed <= 0.01 * need


def test_fuzzy_passage_and_odd_rows(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    passage = [word() for _ in range(70)]
    edited = [*passage[:22], "changed", *passage[23:45], *passage[47:]]
    text = lambda mid: " ".join([word() for _ in range(40)] + mid + [word() for _ in range(40)])
    rows = [(1, text(passage)), (2, text(edited)), (3, text([word() for _ in range(70)])), (4, None), (5, ""),
            (None, text(passage)), (2, None), (6, text(passage[:45]))]
    rows.append((7, rows[2][1]))
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("seed", F.lit(1))
    got = {r.doc_id: (r.start, r.end, r.sources) for r in substring_dedup.repeated_passages(df).collect()}
    assert set(got) == {2, 7}                         # 45 shared words are too few
    assert abs(got[2][0] - 40) <= 1 and abs(got[2][1] - 108) <= 1 and got[2][2] == [1]
    assert got[7] == (0, 150, [3])
    assert substring_dedup.repeated_passages(df.limit(0)).count() == 0


@pytest.mark.parametrize("sizes,between", [((55, 55), 32), ((55, 55, 55, 55), 24), ((120, 60, 80), 38)])
def test_passages_apart_in_one_document_only(spark, sizes, between):
    """Every exact window of 50 words is reported where words stand between the passages on one side."""
    rng = random.Random(6)
    words = lambda n: ["".join(rng.choices("abcdefghij", k=7)) for _ in range(n)]
    rows, need = [], {}
    for pair in range(12):
        parts = [words(n) for n in sizes]
        near = words(30) + [w for p in parts for w in p] + words(30)
        apart = words(30) + [w for p in parts for w in p + words(between)]
        for k, text in enumerate([near, apart] if pair % 2 else [apart, near]):
            rows.append((2 * pair + k, " ".join(text)))
        seen = {tuple(rows[-2][1].split()[i:i + 50]) for i in range(len(rows[-2][1].split()) - 49)}
        last = rows[-1][1].split()
        need[rows[-1][0]] = [i for i in range(len(last) - 49) if tuple(last[i:i + 50]) in seen]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {}
    for r in substring_dedup.repeated_passages(df).collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
    for doc, windows in need.items():
        assert windows and all(any(a <= i and i + 50 <= b for a, b in spans.get(doc, ())) for i in windows)


def test_split_chains_do_not_report_what_differs(spark):
    rng = random.Random(7)
    words = lambda n: ["".join(rng.choices("abcdefghij", k=7)) for _ in range(n)]
    kept = [words(7) for _ in range(30)]                # 7 of 10 words match, all through
    text = lambda: " ".join(w for k in kept for w in k + words(3))
    df = spark.createDataFrame([(1, text()), (2, text())], "doc_id long, text string")
    assert substring_dedup.repeated_passages(df).count() == 0


def best_chain_score(a, b):
    """Quadratic: the best score over all chains whose anchors follow each other within the gap."""
    k, gap, skip = substring_dedup.K, substring_dedup.MAX_GAP + substring_dedup.K, substring_dedup.SKIP
    order = sorted(range(len(a)), key=lambda i: (a[i], -b[i]))
    score = {}
    for n, i in enumerate(order):
        score[i] = k
        for j in order[:n]:
            if 0 < a[i] - a[j] <= gap and 0 < b[i] - b[j] <= gap:
                score[i] = max(score[i], k + score[j] - skip * (a[i] - a[j] + b[i] - b[j]))
    return score


@pytest.mark.parametrize("seed", range(6))
def test_chains_are_the_best_within_the_gap(seed):
    """Long chains must not hide near predecessors, wherever in either text they lie."""
    rng = np.random.default_rng(seed)
    parts, at = [], 0
    for size in (90, 20, 25, 8):                    # passages in turn, each from anywhere in the other text
        a = at + np.cumsum(rng.integers(1, 16, size))
        b = int(rng.integers(0, 4_000)) + (a - a[0]) + rng.integers(0, 2, size).cumsum()
        parts.append((a, b))
        at = int(a[-1]) + int(rng.integers(1, 60))
    a, b = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    got = substring_dedup.chains(a, b)
    want = best_chain_score(a.tolist(), b.tolist())
    seen = np.concatenate(got)
    assert sorted(seen.tolist()) == list(range(len(a)))
    k, skip = substring_dedup.K, substring_dedup.SKIP
    scores = [k * len(c) - skip * float((a[c[-1]] - a[c[0]]) + (b[c[-1]] - b[c[0]])) for c in got]
    assert max(scores) == pytest.approx(max(want.values()))
    assert len(got) <= len(a) // 8                   # no passage falls apart into single anchors


def test_a_passage_behind_a_long_one_is_found(spark):
    """Two fuzzy passages (every 9th word changed) behind an exact one of 800 words, each from another place."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    source = [word() for _ in range(3_000)]
    change = lambda part: [word() if i % 9 == 8 else w for i, w in enumerate(part)]
    copy = source[:800] + change(source[2_000:2_120]) + change(source[1_200:1_330])
    rows = [(1, " ".join(source)), (2, " ".join(copy))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered = {i for r in got if r.doc_id == 2 for i in range(r.start, r.end)}
    for lo, hi in ((0, 800), (800, 920), (920, 1_050)):
        assert len(covered & set(range(lo, hi))) >= 0.9 * (hi - lo)
