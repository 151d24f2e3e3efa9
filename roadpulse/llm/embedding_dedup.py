"""Near-duplicate vectors through a forest of random-projection trees.

Equal vectors of a label are first folded into one class. The classes of a label go
to one task, up to ``CELL`` of them; there a forest is grown over all of them. Each
of its ``TREES`` trees cuts recursively: a node above ``LEAF`` rows gets a random
direction and is cut at the median of its projections, and rows within a margin of
the cut go to both sides (spill overlap). Inside leaves all pairs are compared; a pair
that shares several leaves counts in the first of them only. So vectors are shuffled
once, not once for every tree.

A label with more classes is first cut by ``COARSE`` spill trees of the same kind into
cells of that size. Their cuts are fitted round by round on bounded samples of the
rows that reach a node, and every row finds its cells in one map over the vectors.

A cut parts the members of a group of near copies. Where such a group makes up much
of a node, in a sample, the rows around its centre become a leaf of their own, and rows
all of whose links must lie in it leave the tree. Leaves of any size are compared block
against block, and cells that hold more than a task should, in blocks of many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ._util import saved
from .components import connected_components

COSINE = 0.93
TREES = 6
LEAF = 48
#: share of a node's rows on either side of a cut that go to both
SPILL = 0.1
#: classes that one task holds, and trees that cut a larger label into such cells
CELL = 100_000
COARSE = 2
#: rows of a coarse node that its cuts are fitted on, levels that one round adds at most, and rounds
SAMPLE = 2_000
LEVELS = 6
MAX_ROUNDS = 8
#: coarse nodes with cuts of their own, at most (under 3 KB each); beyond, cells stay larger and are split in blocks
MOST_CUTS = 50_000
#: share of a node's sample within the bound of one of its rows that makes a group of near copies
DENSE = 0.05
#: rows of a group's leaf, at most, as a multiple of the rows within the bound of its centre
REACH = 4
#: rows of a node in which groups are looked for, and rows compared at once
LOOK, BLOCK = 128, 2_048


def _vector(vectors: DataFrame, vector_col: str) -> Column:
    """The vector as it is compared: floats as they are, all else in double precision, with one zero only."""
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    zero = F.lit(0.0).cast("float") if single else F.lit(0.0)
    return F.transform(F.col(vector_col).cast("array<float>" if single else "array<double>"), lambda x: x + zero)


def classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            label_col: str = "label") -> DataFrame:
    """(label, vec, rep, copies, node): each distinct vector that can link, of each label.

    Null labels, null vectors, null or non-finite components and zero vectors are left out.
    """
    vec = _vector(vectors, vector_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vec, lambda x: x != 0)
    return (vectors.where(F.col(label_col).isNotNull() & vec.isNotNull() & finite & some)
            .select(F.col(label_col).cast("string").alias("label"), vec.alias("vec"),
                    F.col(id_col).cast("long").alias("id"))
            .groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
            .withColumn("node", F.xxhash64("label", "vec")))


def _unit(rows: list | np.ndarray) -> np.ndarray:
    m = np.array(list(rows), np.float64)
    m /= np.abs(m).max(1, keepdims=True)  # tiny and huge vectors keep their direction
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _units(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors of a column of lists of equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return _unit(flat.reshape(len(column), -1)) if len(column) else np.zeros((0, 1))


def dense_groups(unit: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(centres, reach) of the groups of near copies in a sample: rows at cosine ``reach`` or more belong to one.

    The reach is twice the angle of the bound, where all links of the rows within
    the bound of the centre end, unless that takes in more than ``REACH`` times
    these rows.
    """
    near = unit @ unit.T
    open_, centres, reach = np.ones(len(unit), bool), [], []
    while open_.any():
        linked = (near[:, open_] >= cosine).sum(1) * open_
        c = int(linked.argmax())
        if linked[c] < max(2, DENSE * len(unit)):
            break
        limit = np.sort(near[c])[::-1][min(len(unit) - 1, REACH * int(linked[c]))]
        centres.append(c)
        reach.append(min(cosine, max(2 * cosine * cosine - 1, limit)))
        open_ &= near[c] < cosine
        open_[c] = False  # also where rounding puts a row below the bound of itself
    return unit[centres], np.array(reach)


def in_groups(unit: np.ndarray, centres: np.ndarray, reach: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, groups) who belongs to which, and whether all links of a row end in one group."""
    near = unit @ centres.T
    inner = np.cos(np.maximum(0, np.arccos(reach) - np.arccos(cosine)))
    return near >= reach - 1e-9, ((near >= inner + 1e-9) & (reach < cosine)).any(1)


def _cut(projected: np.ndarray, spill: float) -> tuple[float, float]:
    """Rows up to the second value go left, rows from the first on go right."""
    return tuple(np.quantile(projected, [0.5 - spill, 0.5 + spill]))


# --------------------------------------------------------------------------- the forest of a task

def grow(unit: np.ndarray, seed: int, leaf: int, spill: float, trees: int, cosine: float) -> list[np.ndarray]:
    """The leaves of all trees: arrays of row numbers."""
    rng = np.random.default_rng(seed)
    leaves: list[np.ndarray] = []

    def groups(rows: np.ndarray, look: int) -> np.ndarray:
        """The rows left once groups of near copies are leaves of their own."""
        sample = rng.choice(rows, look, replace=False) if len(rows) > look else rows
        centres, reach = dense_groups(unit[sample], cosine)
        if not len(centres):
            return rows
        member, settled = in_groups(unit[rows], centres, reach, cosine)
        leaves.extend(rows[m] for m in member.T if m.sum() > 1)
        return rows[~settled]

    every = np.arange(len(unit))
    if len(unit) <= leaf:
        return [every]
    every = groups(every, 8 * LOOK)  # what makes up much of the whole is the same for all trees
    for _ in range(trees):
        todo = [every]
        while todo:
            rows = todo.pop()
            before = len(rows)
            if before > leaf and before < len(every):
                rows = groups(rows, LOOK)
            if len(rows) <= leaf:
                if len(rows) > 1:
                    leaves.append(rows)
                continue
            p = unit[rows] @ rng.normal(size=unit.shape[1])
            low, high = _cut(p, spill)
            left, right = rows[p <= high], rows[p >= low]
            if max(len(left), len(right)) > 0.95 * len(rows):  # projections that hardly differ
                leaves.append(rows)
                continue
            todo += [left, right]
    return leaves


class Tally:
    """Links found among the rows of a task: how many each row has, and which rows hang together."""

    def __init__(self, copies: np.ndarray, known: list[list[int]]):
        self.copies, self.count = copies, np.zeros(len(copies), np.int64)
        self.top = np.arange(len(copies))
        #: cells of other tasks, with a smaller number, that a row is in as well
        self.known = known

    def roots(self, rows: np.ndarray) -> np.ndarray:
        found = self.top[rows]
        while True:
            further = self.top[found]
            if (further == found).all():
                self.top[rows] = found
                return found
            found = further

    def add(self, rows: np.ndarray, cols: np.ndarray, ok: np.ndarray, counted: np.ndarray) -> None:
        """Links ``ok`` between rows and columns; ``counted`` are those not counted elsewhere."""
        self.count[rows] += counted @ self.copies[cols]
        while True:
            a, b = self.roots(rows), self.roots(cols)
            if not (ok & (a[:, None] != b)).any():
                return
            # each side hangs itself to the smallest root that it is linked with
            least_b = np.where(ok, b, len(self.top)).min(1)
            least_a = np.where(ok, a[:, None], len(self.top)).min(0)
            pairs = np.concatenate([np.stack([a, least_b], 1), np.stack([b, least_a], 1)])
            for x, y in np.unique(pairs[pairs.max(1) < len(self.top)], axis=0).tolist():
                x, y = self._root(x), self._root(y)
                if x != y:
                    self.top[max(x, y)] = min(x, y)

    def _root(self, x: int) -> int:
        while self.top[x] != x:
            x = int(self.top[x])
        return x


def compare(unit: np.ndarray, leaves: list[np.ndarray], tally: Tally, cosine: float) -> None:
    """Link all pairs within each leaf; a pair is counted in the first leaf that it shares."""
    earlier: list[list[int]] = [[] for _ in range(len(unit))]
    for number, rows in enumerate(leaves):
        for lo in range(0, len(rows), BLOCK):
            mine = rows[lo:lo + BLOCK]
            for at in range(0, len(rows), BLOCK):
                other = rows[at:at + BLOCK]
                ok = unit[mine] @ unit[other].T >= cosine
                ok[mine[:, None] == other] = False
                x, y = np.flatnonzero(ok.any(1)), np.flatnonzero(ok.any(0))
                if not len(x):
                    continue
                ok, a, b = ok[np.ix_(x, y)], mine[x], other[y]
                tally.add(a, b, ok, ok & ~_met(a, b, earlier) & ~_met(a, b, tally.known))
        for r in rows.tolist():
            earlier[r].append(number)


def _met(a: np.ndarray, b: np.ndarray, lists: list) -> np.ndarray:
    """Which of a's and b's rows have a number in common in their lists."""
    out = np.zeros((len(a), len(b)), np.float32)
    sides = []
    for rows in (a, b):
        own = [lists[r] for r in rows.tolist()]
        sides.append((np.repeat(np.arange(len(rows)), [len(x) for x in own]),
                      np.array([n for x in own for n in x], np.int64)))
    shared = np.intersect1d(sides[0][1], sides[1][1])
    for lo in range(0, len(shared), 1024):
        part, marks = shared[lo:lo + 1024], []
        for (row, n), size in zip(sides, (len(a), len(b))):
            hit = np.isin(n, part)
            mark = np.zeros((size, len(part)), np.float32)
            mark[row[hit], np.searchsorted(part, n[hit])] = 1
            marks.append(mark)
        out += marks[0] @ marks[1].T
    return out > 0


# --------------------------------------------------------------------------- cells of large labels

def _seed(cell: int) -> int:
    return cell & (2**63 - 1)


class Cuts:
    """The coarse trees: for every node that was cut, its groups and a small tree of cuts."""

    def __init__(self, cosine: float):
        self.cosine = cosine
        self.nodes: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray]] = {}
        self.roots: dict[str, list[int]] = {}  # of each label that is cut, one per tree

    def reached(self, label: str, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, whole) of every cell that the rows of a label reach; whole cells are not to be cut."""
        row = np.repeat(np.arange(len(unit)), len(self.roots[label]))
        cell = np.tile(np.array(self.roots[label], np.int64), len(unit))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(row):
            cuttable = np.isin(cell, np.fromiter(self.nodes, np.int64, len(self.nodes)))
            done.append((row[~cuttable], cell[~cuttable], np.zeros((~cuttable).sum(), bool)))
            row, cell, further = row[cuttable], cell[cuttable], []
            for c in np.unique(cell).tolist():
                rows = row[cell == c]
                levels, cuts, centres, reach = self.nodes[c]
                if len(centres):
                    member, settled = in_groups(unit[rows], centres, reach, self.cosine)
                    at, group = np.nonzero(member)
                    done.append((rows[at], _child(c, -1 - group), np.ones(len(at), bool)))
                    rows = rows[~settled]
                at, leaf = _route(unit[rows], c, cuts, levels)
                further.append((rows[at], _child(c, leaf)))
            row, cell = ((np.concatenate([f[i] for f in further]) for i in (0, 1)) if further
                         else (np.empty(0, np.int64), np.empty(0, np.int64)))
        return tuple(np.concatenate([d[i] for d in done]) for i in range(3))


def _child(cell: int, leaf: np.ndarray) -> np.ndarray:
    """The number of a node below another: a mixing of both."""
    x = np.asarray(leaf).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(cell & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _directions(cell: int, dim: int, levels: int) -> np.ndarray:
    return np.random.default_rng(_seed(cell)).normal(size=((1 << levels) - 1, dim))


def _fit(unit: np.ndarray, cell: int, levels: int, spill: float) -> np.ndarray:
    """The cut of each inner node of a small tree."""
    d, cuts = _directions(cell, unit.shape[1], levels), np.zeros(((1 << levels) - 1, 2))
    members = {0: np.arange(len(unit))}
    for node in range(len(d)):
        rows = members.pop(node, np.zeros(0, np.int64))
        if len(rows):
            p = unit[rows] @ d[node]
            cuts[node] = _cut(p, spill)
            members[2 * node + 1], members[2 * node + 2] = rows[p <= cuts[node, 1]], rows[p >= cuts[node, 0]]
    return cuts


def _route(unit: np.ndarray, cell: int, cuts: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf of a small tree that each row reaches."""
    p = unit @ _directions(cell, unit.shape[1], levels).T
    row, node = np.arange(len(unit)), np.zeros(len(unit), np.int64)
    for _ in range(levels):
        at = p[row, node]
        left, right = at <= cuts[node, 1], at >= cuts[node, 0]
        left |= ~right  # a value that compares with nothing goes left
        row, node = (np.concatenate([row[left], row[right]]),
                     np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]))
    return row, node


def _cells(found: DataFrame, cuts: Cuts, with_vectors: bool) -> DataFrame:
    """(cell, whole, node[, copies, known, vec]) of every cell that the rows of cut labels reach."""
    kind = found.schema["vec"].dataType.simpleString()
    schema = "cell long, whole boolean, node long" + f", copies long, known array<long>, vec {kind}" * with_vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.array(batch.column("label").to_pylist(), object)
            for name in sorted(set(label)):
                part = batch.take(pa.array(np.flatnonzero(label == name)))
                row, cell, whole = cuts.reached(name, _units(part.column("vec")))
                order = np.lexsort((cell, row))
                row, cell, whole = row[order], cell[order], whole[order]
                of = part.select(["node", "copies", "vec"]).take(pa.array(row))
                out = [pa.array(cell), pa.array(whole), of.column("node")]
                if with_vectors:
                    ends = np.cumsum(np.bincount(row, minlength=part.num_rows))[row]
                    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))])[row]
                    known = pa.array([cell[a:b] for a, b in zip(starts.tolist(), ends.tolist())], pa.list_(pa.int64()))
                    out += [of.column("copies"), known, of.column("vec")]
                yield pa.RecordBatch.from_arrays(out, names=[x.split()[0] for x in schema.split(", ")])

    return found.where(F.col("label").isin(list(cuts.roots))).select("label", "node", "copies", "vec") \
        .mapInArrow(run, schema)


def coarse_cuts(found: DataFrame, cell: int, cosine: float, trees: int = COARSE, spill: float = SPILL) -> Cuts:
    """Cuts that bring the labels of more than ``cell`` classes down to cells of about that size.

    What the driver holds is this model, never rows: at most ``MOST_CUTS`` nodes, the
    largest first, each fitted in a task on about ``SAMPLE`` rows.
    """
    cuts = Cuts(cosine)
    large = (found.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > cell)
             .orderBy(F.desc("n"), "label").limit(MOST_CUTS // trees).collect())
    if not large:
        return cuts
    for r in large:
        cuts.roots[r.label] = _child(hash_text(r.label), np.arange(trees)).tolist()
    todo = {c: r.n for r in large for c in cuts.roots[r.label]}
    for _ in range(MAX_ROUNDS):
        if not todo or len(cuts.nodes) >= MOST_CUTS:
            break
        sizes = dict(list(todo.items())[:MOST_CUTS - len(cuts.nodes)])
        rows = _cells(found, cuts, True)
        n = found.sparkSession.createDataFrame(list(sizes.items()), "cell long, n long")
        sample = (rows.select("cell", "node", "vec").join(F.broadcast(n), "cell")
                  .where(F.pmod(F.xxhash64("node", "cell"), F.lit(1 << 30))
                         < (1 << 30) * F.least(F.lit(1.0), SAMPLE / F.col("n"))))

        def fit(group: pa.Table) -> pa.Table:
            group = group.sort_by("node")
            here, size, unit = group.column("cell")[0].as_py(), group.column("n")[0].as_py(), _units(group.column("vec"))
            centres, reach = dense_groups(unit, cosine)
            rest = unit[~in_groups(unit, centres, reach, cosine)[1]] if len(centres) else unit
            levels = min(LEVELS, max(0, int(np.ceil(np.log2(max(1, size * len(rest) / len(unit)) / cell)))))
            if not levels and not len(centres):
                levels = 1
            made = _fit(rest, here, levels, spill)
            return pa.table({"cell": [here], "levels": pa.array([levels], pa.int32()), "cuts": [made.ravel().tolist()],
                             "centres": [centres.ravel().tolist()], "reach": [reach.tolist()], "dim": [unit.shape[1]]},
                            schema=pa.schema([("cell", pa.int64()), ("levels", pa.int32()), ("cuts", pa.list_(pa.float64())),
                                              ("centres", pa.list_(pa.float64())), ("reach", pa.list_(pa.float64())),
                                              ("dim", pa.int64())]))

        for p in sample.groupBy("cell").applyInArrow(
                fit, "cell long, levels int, cuts array<double>, centres array<double>, reach array<double>, dim long").collect():
            cuts.nodes[p.cell] = (p.levels, np.array(p.cuts).reshape(-1, 2), np.array(p.centres).reshape(-1, p.dim),
                                  np.array(p.reach))
        # cells that are still too large, unless their parent's cuts took hardly anything away
        left = (_cells(found, cuts, False).where("not whole").groupBy("cell").agg(F.count("*").alias("n"))
                .where(F.col("n") > cell).orderBy(F.desc("n"), "cell").limit(MOST_CUTS).collect())
        most = max(sizes.values())
        todo = {r.cell: r.n for r in left if r.cell not in cuts.nodes and r.n <= 0.95 * most}
    return cuts


def hash_text(text: str) -> int:
    """A 63-bit number of a text, the same everywhere."""
    import hashlib
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little") >> 1


# --------------------------------------------------------------------------- links

_FOUND = "node long, n long, root long"


def _result(nodes: np.ndarray, tally: Tally) -> pa.Table:
    """Rows with a link: (node, links counted here, the smallest node that hangs together with it)."""
    roots = tally.roots(np.arange(len(nodes)))
    smallest = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(smallest, roots, nodes)
    linked = (np.bincount(roots, minlength=len(nodes))[roots] > 1) if len(nodes) else np.zeros(0, bool)
    return pa.table({"node": nodes[linked], "n": tally.count[linked], "root": smallest[roots][linked]},
                    schema=pa.schema([("node", pa.int64()), ("n", pa.int64()), ("root", pa.int64())]))


def links(found: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL,
          cell: int = CELL) -> DataFrame:
    """(node, n, root): n more links of a class, and a class that it hangs together with.

    A pair is counted once however many cells and leaves it shares.
    """
    cuts = coarse_cuts(found, cell, cosine)
    rows = found.where(~F.col("label").isin(list(cuts.roots))) if cuts.roots else found
    rows = rows.select(F.xxhash64("label").alias("cell"), "label", F.lit(False).alias("whole"), "node", "copies",
                       F.array().cast("array<long>").alias("known"), "vec")

    def forest(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        here, unit, nodes = group.column("cell")[0].as_py(), _units(group.column("vec")), group.column("node").to_numpy()
        known = [[c for c in k if c < here] for k in group.column("known").to_pylist()]
        tally = Tally(group.column("copies").to_numpy(), known)
        compare(unit, grow(unit, _seed(here), leaf, spill, trees, cosine), tally, cosine)
        return _result(nodes, tally)

    if not cuts.roots:
        return rows.groupBy("cell", "label").applyInArrow(forest, _FOUND)
    far = _cells(found, cuts, True).withColumn("label", F.lit(""))
    sizes = saved(_cells(found, cuts, False).groupBy("cell").agg(F.count("*").alias("size"), F.max("whole").alias("w"))
                  .where((F.col("size") > 2 * cell) | (F.col("w") & (F.col("size") > cell)))
                  .select(F.col("cell").alias("big"), F.ceil(F.col("size") / (cell / 2)).cast("int").alias("blocks")))
    small = far.join(sizes, F.col("cell") == F.col("big"), "left_anti")
    out = rows.unionByName(small.select(*rows.columns)).groupBy("cell", "label").applyInArrow(forest, _FOUND)
    if sizes.isEmpty():
        return out
    big = far.join(sizes, F.col("cell") == F.col("big")) \
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumns({"p": F.least("mine", "other"), "q": F.greatest("mine", "other")})

    def blocks(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        here, unit, nodes = group.column("cell")[0].as_py(), _units(group.column("vec")), group.column("node").to_numpy()
        known = [[c for c in k if c < here] for k in group.column("known").to_pylist()]
        tally, mine = Tally(group.column("copies").to_numpy(), known), group.column("mine").to_numpy()
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        if p == q:
            compare(unit, [np.arange(len(unit))], tally, cosine)
        else:
            compare_blocks(unit, np.flatnonzero(mine == p), np.flatnonzero(mine == q), tally, cosine)
        return _result(nodes, tally)

    return out.unionByName(big.select("cell", "p", "q", "mine", "node", "copies", "known", "vec")
                           .groupBy("cell", "p", "q").applyInArrow(blocks, _FOUND))


def compare_blocks(unit: np.ndarray, left: np.ndarray, right: np.ndarray, tally: Tally, cosine: float) -> None:
    """Link the rows of one block with those of another."""
    for lo in range(0, len(left), BLOCK):
        for at in range(0, len(right), BLOCK):
            a, b = left[lo:lo + BLOCK], right[at:at + BLOCK]
            ok = unit[a] @ unit[b].T >= cosine
            x, y = np.flatnonzero(ok.any(1)), np.flatnonzero(ok.any(0))
            if len(x):
                ok, a, b = ok[np.ix_(x, y)], a[x], b[y]
                new = ok & ~_met(a, b, tally.known)
                tally.add(a, b, ok, new)
                tally.count[b] += tally.copies[a] @ new


def embedding_dedup(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", leaf: int = LEAF,
                    cell: int = CELL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    Two vectors of equal label link if their cosine in double precision is at
    least ``cosine`` and the forest brings them together. n_links counts the
    other vectors linked directly, copies included; component_id is the smallest
    id reachable.

    Vectors with a null label, null, zero or with null or non-finite components
    link with nothing, not even their copies. Vectors of different lengths must not
    meet under one label. A null id links like any other, and its component_id is
    the smallest id of its group, or null. Repeated ids keep their rows. An empty
    table gives an empty result; other columns are not read.
    """
    found = saved(classes(vectors, id_col, vector_col, label_col))
    seen = saved(links(found, cosine, trees, leaf, cell=cell))
    # a class may hang together with others in several cells: its roots belong together
    nodes = saved(seen.groupBy("node").agg(F.sum("n").alias("n"), F.min("root").alias("root"),
                                           F.collect_set("root").alias("roots")))
    pairs = (nodes.where(F.size("roots") > 1).select(F.col("root").alias("a"), F.explode("roots").alias("b"))
             .where("a <> b").distinct())
    top = connected_components(pairs)
    nodes = nodes.join(top.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left") \
        .select("node", "n", F.coalesce("top", "root").alias("group"))
    named = (found.select("node", "rep", "copies").join(nodes, "node", "left")
             .select("node", "rep", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("group", "node").alias("group"), F.col("group").isNotNull().alias("linked")))
    smallest = named.groupBy("group", "linked").agg(F.min("rep").alias("component"))
    named = named.join(smallest, ["group", "linked"]).select("node", "n_links", "component")
    vec = _vector(vectors, vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.xxhash64(F.col(label_col).cast("string"), vec).alias("node"),
                          (F.col(label_col).isNotNull() & vec.isNotNull()).alias("able"))
    out = rows.join(named, F.when(rows["able"], rows["node"]) == named["node"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def oracle_sql(cosine: float = COSINE) -> str:
    """DuckDB SQL for the result over the table ``embeddings``, all pairs compared."""
    return f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {cosine}),
    reach AS (
      SELECT vec_id AS x, vec_id AS y FROM embeddings
      UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
    counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT r.x AS vec_id, coalesce(any_value(c.n), 0) AS n_links, min(r.y) AS component_id,
           r.x = min(r.y) AS kept
    FROM reach r LEFT JOIN counts c ON c.x = r.x GROUP BY r.x"""
