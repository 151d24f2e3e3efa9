"""SimHash near-duplicates joined through Golay codeword keys.

A text becomes a 64-bit fingerprint; fingerprints link when at most four bits
differ. The 64 bits are cut into three segments, each decoded by the perfect
binary Golay code (23 bits, 4096 codewords, every word within three bits of
exactly one codeword).

Four errors over three segments leave the two best segments with errors
(0,0), (0,1), (1,1) or (0,2):

* "near" keys: the codeword pair of two segments. One side is stored under its
  own codewords, the other looks under the codewords of everything one bit away,
  so a pair with at most one error in each segment meets. Three segment pairs.
* "level" keys: (0,2,2) only. One segment exact, and for the next segment the
  codewords of everything one bit away on both sides: two words two bits apart
  have a common neighbour, so they share a codeword.

All rows of a key are compared in numpy and only true links leave the task.
A key with more than ``HOT`` rows is cut into blocks and compared block against
block; a key above ``HUGE`` rows is solved through common midpoints (all words
two bits away), whose work is linear in its rows. Both are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import ids_and_texts, saved, shuffle_width
from .components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: (lowest bit, bits) of the three segments
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HOT = 2_000
BLOCK = 2_000
HUGE = 200_000
#: generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1
GENERATOR = 0b110001110101

_golay: list[np.ndarray] = []


def golay_index() -> np.ndarray:
    """For each of the 2^23 words, the index (0..4095) of its nearest codeword."""
    if not _golay:
        data = np.arange(4096, dtype=np.int32)
        words = np.zeros(4096, np.int32)
        for bit in range(12):
            words ^= np.where(data >> bit & 1, np.int32(GENERATOR << bit), np.int32(0))
        one = np.int32(1) << np.arange(23, dtype=np.int32)
        i, j, k = np.meshgrid(*[np.arange(23)] * 3, indexing="ij")
        triple = (one[i] ^ one[j] ^ one[k])[(i < j) & (j < k)]
        pair = (one[:, None] ^ one[None, :])[np.triu_indices(23, 1)]
        out = np.empty(1 << 23, np.int16)
        for err in (np.zeros(1, np.int32), one, pair, triple):
            out[words[:, None] ^ err[None, :]] = data[:, None]
        _golay.append(out)
    return _golay[0]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned integer; null and blank texts give 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        line = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        start = end - size
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(line[a:b], SEED) for a, b in
                           zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist())],
                          np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the signed 64-bit form of each text's fingerprint, one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "fp"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _segment_keys(seg: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own codeword; all codewords one bit away, sorted; which of those are new in their row."""
    index = golay_index()
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.int64)
    ball = np.sort(index[seg[:, None] ^ flips[None, :]].astype(np.int64), axis=1)
    fresh = np.ones(ball.shape, bool)
    fresh[:, 1:] = ball[:, 1:] != ball[:, :-1]
    return index[seg].astype(np.int64), ball, fresh


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, role) of every key row. Roles: 0 looks up, 1 is stored, 2 both ("level" keys)."""
    raw = fps.view(np.uint64)
    segs = [((raw >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
    parts = [_segment_keys(s, n) for s, (_, n) in zip(segs, SEGMENTS)]
    row_of = np.arange(len(fps))
    keys, rows, roles = [], [], []
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (own_i, ball_i, new_i), (own_j, ball_j, new_j) = parts[i], parts[j]
        own = own_i << 12 | own_j
        keys.append(kind << 40 | own)
        rows.append(row_of)
        roles.append(np.ones(len(fps), np.int8))
        pair = ball_i[:, :, None] << 12 | ball_j[:, None, :]
        r, p, q = np.nonzero(new_i[:, :, None] & new_j[:, None, :] & (pair != own[:, None, None]))
        keys.append(kind << 40 | pair[r, p, q])
        rows.append(r)
        roles.append(np.zeros(len(r), np.int8))
    for i in range(3):
        j = (i + 1) % 3
        _, ball, new = parts[j]
        r, p = np.nonzero(new)
        keys.append((3 + i) << 40 | segs[i][r] << 12 | ball[r, p])
        rows.append(r)
        roles.append(np.full(len(r), 2, np.int8))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(roles)


def _key_rows(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 2_000):
                part = np.ascontiguousarray(fps[at:at + 2_000])
                key, row, role = golay_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row]), pa.array(role)],
                                                 names=["key", "fp", "role"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long, role tinyint")


def _errors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of signed fingerprints; numpy counts those of a signed number's absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _compare(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray, bits: int):
    """Index pairs (i, j) of linked fingerprints whose roles may meet."""
    near = _errors(a[:, None], b[None, :]) <= bits
    near &= (ra[:, None] | rb[None, :]) > 0
    near &= a[:, None] != b[None, :]
    return np.nonzero(near)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one task thinned to a spanning forest: the same components, at most one per node."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    keep = []
    for n, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            parent[y] = x
            keep.append(n)
    return a[keep], b[keep]


def _links_in_groups(bits: int):
    """Links within each run of equal keys of a partition sorted by key."""
    def links(key: np.ndarray, fp: np.ndarray, role: np.ndarray):
        # rows of one key are neighbours: compare each row with those 1, 2, ... further on
        out_a, out_b = [], []
        at = np.arange(len(key))
        end = np.searchsorted(key, key, side="right")
        step = 1
        while len(at := at[at + step < end[at]]):
            other = at + step
            x, y = fp[at], fp[other]
            ok = (_errors(x, y) <= bits) & ((role[at] | role[other]) > 0) & (x != y)
            if ok.any():
                out_a.append(x[ok])
                out_b.append(y[ok])
            step += 1
        if not out_a:
            return None
        a, b = _forest(np.concatenate(out_a), np.concatenate(out_b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "role")]
            if held:
                now = [np.concatenate(x) for x in zip(held, now)]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if cut and (out := links(*[x[:cut] for x in now])) is not None:
                yield out
            held = [x[cut:] for x in now]
        if held and len(held[0]) and (out := links(*held)) is not None:
            yield out

    return run


def _links_of_hot(hot: DataFrame, bits: int) -> DataFrame:
    """Links within keys that have more than ``HOT`` rows, block against block."""
    n = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), n).cast("int")
    placed = (hot.select("key", "fp", "role", n.alias("n"), mine.alias("mine"))
              .select("key", "fp", "role", "mine",
                      F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
              .select("key", "fp", "role", "mine", F.least("mine", "other").alias("p"),
                      F.greatest("mine", "other").alias("q")))

    def compare(batch: pa.Table) -> pa.Table:
        fp, role, mine, p, q = (batch.column(c).to_numpy() for c in ("fp", "role", "mine", "p", "q"))
        first = mine == p[0]
        second = mine == q[0]
        a, b, ra, rb = fp[first], fp[second], role[first], role[second]
        found_a, found_b = [], []
        for at in range(0, len(a), 512):
            i, j = _compare(a[at:at + 512], ra[at:at + 512], b, rb, bits)
            x, y = _forest(a[at:at + 512][i], b[j])
            found_a.append(x)
            found_b.append(y)
        x, y = _forest(np.concatenate(found_a or [fp[:0]]), np.concatenate(found_b or [fp[:0]]))
        return pa.table({"a": x, "b": y})

    return placed.groupBy("key", "p", "q").applyInArrow(compare, "a long, b long")


def _links_of_huge(members: DataFrame) -> DataFrame:
    """Links of the given fingerprints through every word at most two bits away.

    Two members at one such word differ in four bits at most, so each links to the
    smallest member there; two members that differ in four bits or fewer share one.
    """
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    masks = np.concatenate([np.zeros(1, np.uint64), one,
                            (one[:, None] ^ one[None, :])[np.triu_indices(64, 1)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 64):
                part = fps[at:at + 64]
                words = (part.view(np.uint64)[:, None] ^ masks[None, :]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.ravel()), pa.array(np.repeat(part, len(masks)))], names=["word", "fp"])

    words = members.mapInArrow(run, "word long, fp long")
    first = words.groupBy("word").agg(F.min("fp").alias("a"))
    return (words.join(first, "word").where("a <> fp")
            .select("a", F.col("fp").alias("b")).distinct())


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT,
                      huge: int = HUGE) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``nodes(fp)`` that keep every component whole.

    Each link differs in at most ``max_bits`` bits. ``max_bits`` above four is
    refused: the keys only promise to find four errors.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the Golay keys find at most {MAX_BITS} differing bits")
    spark = nodes.sparkSession
    keys = _key_rows(nodes)
    counts = saved(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot))
    wide = shuffle_width(spark, nodes.count() * 100, 2_000_000)
    if counts.isEmpty():
        cold = keys
    else:
        keys = keys.join(counts, "key", "left")
        cold = keys.where("n is null").drop("n")
    links = (cold.repartition(wide, "key").sortWithinPartitions("key")
             .mapInArrow(_links_in_groups(max_bits), "a long, b long"))
    if not counts.isEmpty():
        links = links.union(_links_of_hot(keys.where(F.col("n") <= huge), max_bits))
        most = keys.where(F.col("n") > huge)
        if not counts.where(F.col("n") > huge).isEmpty():
            near = _links_of_huge(saved(most.select("fp").distinct()))
            links = links.union(near.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return links


def one_per_component(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row of each component: the smallest id, null ids last, and the smallest hash of the whole row.

    Rows are told apart by id and hash, so neither repeated nor null ids keep more than one.
    """
    mark = F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns])
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), mark.alias("mark"))
    texts = rows.select("mark", F.col("row")[text_col].alias("text"))
    prints = saved(fingerprints(texts, shingle, "mark", "text").select(F.col("doc_id").alias("mark"), "fp").distinct())
    nodes = saved(prints.select("fp").distinct())
    roots = connected_components(fingerprint_links(nodes, max_bits)).withColumnRenamed("node", "fp")
    ids = rows.groupBy("id", "mark").agg(F.count("*").alias("n"))
    named = ids.join(prints, "mark").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "mark", "n"))
    kept = saved(named.groupBy("root").agg(first.alias("k")).select(
        F.col("k.id").alias("kept_id"), F.col("k.mark").alias("kept_mark"), "k.n"))

    def of(which: DataFrame) -> DataFrame:
        same = rows["id"].eqNullSafe(which["kept_id"]) & (rows["mark"] == which["kept_mark"])
        return rows.join(which, same, "left_semi")

    # only rows that are there several times need to be brought together
    return of(kept.where("n = 1")).union(of(kept.where("n > 1")).dropDuplicates(["id", "mark"])).select("row.*")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id and kept.

    ``fingerprint``: 16 lowercase hex digits. ``component_id``: the smallest id
    reachable over links of at most ``max_bits`` differing bits, itself included.
    ``kept``: whether the row is the one its component keeps.

    Null and blank texts have fingerprint zero and link like any other. A row
    with a null id takes its group's component_id (null if no row there has an
    id) and is kept only if the group has no id at all. Repeated ids are kept or
    dropped together. An empty table gives an empty result; other columns are not
    read, whatever their names.
    """
    prints = saved(fingerprints(docs, shingle, id_col, text_col))
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(fingerprint_links(nodes, max_bits))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
