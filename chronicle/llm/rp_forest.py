"""Near-duplicate embeddings by dense balls and a forest of random-projection trees with spill overlap.

Splits would part the vectors of a dense cluster, however close they are. So balls of the
threshold's angle are laid over the sample first, wherever one holds about half a leaf of vectors
or more. Vectors in a ball (its core) are compared with each other and with the ball's shell, in salted
tiles of bounded size. A vector links with nothing beyond twice the threshold's angle from the centre of its
ball; a shell that reaches so far is whole, and its core needs nothing else. Where vectors share a common
direction, all of them can stand in that reach. A shell then ends nearer to the centre, where it holds `broad` times
its core in the sample; such a ball is open, and its core's links with vectors beyond are left to the
forest. So every link inside a core is found, of any size and density, and the tiles' work stays in proportion to the cores'.
The forest takes all vectors without a core and the cores of open balls.

Trees are fitted on a bounded sample (`sample` vectors, those with the smallest hash): a node
projects its vectors on a random direction and splits them at the median; those within `spill`
of the sample's quantiles around the median go to both sides. The sample alone can't split for
ever: leaves that get more than `most` of all vectors are split on, by quantiles that Spark counts
over all vectors in them, round by round until each leaf is small enough. Directions follow from
a node's number, so a tree is two figures for each node, and about n / `most` leaves. All those
vectors are then routed through all trees. Vectors of one leaf, label and dimension are compared
by cosine in double precision, block by block.

Equal vectors of one label are one class, compared once and counted by their number, so copies
make no pairs. A leaf puts out each vector's number of links and the edges of a spanning forest,
never its pairs; a pair that shares several leaves is counted in the first of those leaves
(each row carries the leaves of its vector in all trees). Edges are united to components.

A vector that is null, empty, zero or holds a null or non-finite component, or has a null label,
links with nothing; labels of any simple type are compared as they are. Rows that share a vec_id are separate vectors; a component's id is its
smallest vec_id. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

Node = tuple  # (number, low, high, left, right) or (number,)


def _direction(tree: int, number: int, dim: int, seed: int = c.SEED) -> np.ndarray:
    return np.random.default_rng([seed, tree, number]).standard_normal(dim)


def fit(x: np.ndarray, trees: int, depth: int, spill: float) -> list[Node]:
    """Trees over unit vectors; a node of under 8 of the sample's vectors is a leaf. The root is number 1, a node's children are 2n and 2n + 1."""
    return [_grown(x, np.arange(len(x)), t, 1, depth, spill) for t in range(trees)]


def _grown(x: np.ndarray, rows: np.ndarray, tree: int, number: int, left: int, spill: float) -> Node:
    if left == 0 or len(rows) < 8:
        return (number,)
    p = x[rows] @ _direction(tree, number, x.shape[1])
    low, mid, high = np.quantile(p, [0.5 - spill, 0.5, 0.5 + spill])
    if low == high:  # most of the node is one point: it goes to both sides only if it is at the median
        low = high = mid
    a, b = rows[p <= high], rows[p >= low]
    if len(a) == len(rows) and len(b) == len(rows):
        return (number,)
    return (number, float(low), float(high), _grown(x, a, tree, 2 * number, left - 1, spill), _grown(x, b, tree, 2 * number + 1, left - 1, spill))


def route(tree: Node, t: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all leaves of tree t that the vectors reach, by row."""
    rows, leaves = [], []
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if len(node) == 1:
            rows.append(at)
            leaves.append(np.full(len(at), node[0], np.int64))
            continue
        number, low, high, left, right = node
        p = x[at] @ _direction(t, number, x.shape[1])
        todo += [(left, at[p <= high]), (right, at[p >= low])]
    row, leaf = np.concatenate(rows), np.concatenate(leaves)
    order = np.argsort(row, kind="stable")
    return row[order], leaf[order]


def _split(tree: Node, cuts: dict[int, tuple[float, float]]) -> Node:
    """The tree with the leaves that have cuts split at them."""
    if len(tree) == 1:
        n = tree[0]
        return (n, *cuts[n], (2 * n,), (2 * n + 1,)) if n in cuts else tree
    return (*tree[:3], _split(tree[3], cuts), _split(tree[4], cuts))


#: A node's number has 63 bits; a path of so many splits that each leave most vectors on one side ends there.
DEEPEST = 62


def _refined(rows: DataFrame, forest: list[Node], kind: str, dim: int, spill: float, most: int) -> list[Node]:
    """The forest with every leaf of more than `most` of all vectors split on, by quantiles over all of them.

    A round reads the vectors once and shuffles the quantile sketches of over-full leaves alone. A leaf whose
    vectors no direction parts (at most one distinct projection) stays.
    """
    sc = rows.sparkSession.sparkContext
    full: set[tuple[int, int]] | None = None
    while True:
        held = sc.broadcast((forest, full))

        def projected(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            trees, wanted = held.value
            for batch in batches:
                for k in range(0, batch.num_rows, 2000):
                    x = _units(kind, batch.column(0).slice(k, 2000).to_pylist(), dim)
                    out = []
                    for t, tree in enumerate(trees):
                        row, leaf = route(tree, t, x)
                        for n in np.unique(leaf).tolist():
                            if wanted is None or (t, n >> 1) in wanted:  # only new leaves can be over-full
                                at = row[leaf == n]
                                out.append((np.full(len(at), t), np.full(len(at), n), x[at] @ _direction(t, n, dim)))
                    cols = [np.concatenate(v) for v in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int32)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2])], ["tree", "leaf", "p"])
            c.release()

        each = rows.select("vector").mapInArrow(projected, "tree int, leaf long, p double")
        marks = F.percentile_approx("p", F.array(F.lit(0.5 - spill), F.lit(0.5 + spill)), 1000).alias("q")
        found = each.groupBy("tree", "leaf").agg(F.count("*").alias("n"), marks, F.min("p").alias("lo"), F.max("p").alias("hi")).where(F.col("n") > most).collect()  # under n * trees / most leaves
        cuts = {(r["tree"], r["leaf"]): (r["q"][0], r["q"][1]) for r in found if r["hi"] - r["lo"] > 1e-9 and r["leaf"].bit_length() < DEEPEST and not (r["q"][0] <= r["lo"] and r["q"][1] >= r["hi"])}
        if not cuts:
            return forest
        forest = [_split(tree, {n: q for (t, n), q in cuts.items() if t == i}) for i, tree in enumerate(forest)]
        full = set(cuts)


def _usable(v: list | None) -> np.ndarray | None:
    if not v or any(e is None for e in v):
        return None
    x = np.array(v, np.float64)
    size = math.sqrt(float((x * x).sum())) if np.isfinite(x).all() else 0.0
    return x if size > 0 and math.isfinite(size) else None


def _classes(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector's class (null if it can't link) and its bytes, in the width that the table has."""
    for batch in batches:
        nodes, signs, raws = [], [], []
        for v, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            x = _usable(v) if label is not None else None
            raw = None if x is None else (x + 0.0).astype(kind).tobytes()
            raws.append(raw)
            mark = None if raw is None else hashlib.blake2b(raw + repr(label).encode(), digest_size=12).digest()
            nodes.append(mark and int.from_bytes(mark[:8], "little", signed=True))
            signs.append(mark and int.from_bytes(mark[8:], "little", signed=True))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(signs, pa.int32()), batch.column(2), pa.array(raws, pa.binary())], ["vec_id", "node", "sign", "label", "vector"])


def _units(kind: str, raws: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors, cut or filled up to `dim`: only for routing."""
    out = np.zeros((len(raws), dim))
    for i, r in enumerate(raws):
        v = np.frombuffer(r, kind)[:dim]
        out[i, : len(v)] = v
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def _routed(kind: str, forest: list[Node], dim: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 2000):
            part = batch.slice(k, 2000)
            x = _units(kind, part.column(3).to_pylist(), dim)
            found = [route(tree, t, x) for t, tree in enumerate(forest)]
            own = np.concatenate([row for row, _ in found])
            pairs = np.concatenate([np.stack((np.full(len(leaf), t, np.int64), leaf), 1) for t, (_, leaf) in enumerate(found)])
            order = np.argsort(own, kind="stable")
            own, pairs = own[order], np.ascontiguousarray(pairs[order])
            bounds = np.searchsorted(own, np.arange(part.num_rows + 1))
            every = [pairs[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            taken = part.take(pa.array(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].astype(np.int32)), pa.array(pairs[:, 1].copy()), *taken.columns, pa.array([every[i] for i in own], pa.binary())],
                ["tree", "leaf", "node", "label", "copies", "vector", "core", "balls", "leaves"],
            )


class Earlier:
    """The leaves before one leaf (of earlier trees, or earlier in its tree) that its vectors are in."""

    def __init__(self, tree: int, leaf: int, raws: list[bytes]) -> None:
        pairs = np.frombuffer(b"".join(raws), np.int64).reshape(-1, 2)
        owner = np.repeat(np.arange(len(raws)), [len(r) // 16 for r in raws])
        keep = (pairs[:, 0] < tree) | ((pairs[:, 0] == tree) & (pairs[:, 1] < leaf))
        pairs, owner = pairs[keep], owner[keep]
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (pairs[order][1:] != pairs[order][:-1]).any(1)
        self.n = int(new.sum())
        self.flat = np.empty(len(order), np.int64)
        self.flat[order] = np.cumsum(new) - 1
        self.bounds = np.searchsorted(owner, np.arange(len(raws) + 1))

    def _spread(self, v: np.ndarray) -> np.ndarray:
        lo, n = self.bounds[v], self.bounds[v + 1] - self.bounds[v]
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(np.arange(len(v)), n) * self.n + self.flat[at]

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs share one of them."""
        out = np.zeros(len(a), bool)
        for k in range(0, len(a) if self.n else 0, 1 << 16):  # bounded, however many pairs a leaf has
            both = np.intersect1d(self._spread(a[k : k + (1 << 16)]), self._spread(b[k : k + (1 << 16)]), assume_unique=True)
            out[k + both // self.n] = True
        return out


class Counted:
    """Which pairs of a leaf's vectors are compared in a ball: one has its core there, and the other is in that ball's core or shell."""

    def __init__(self, core: np.ndarray, balls: list[list[int]]) -> None:
        self.core = core
        self.n = 1 + max([-1, *core.tolist(), *(b for own in balls for b in own)])
        owner = np.repeat(np.arange(len(balls)), [len(own) for own in balls])
        self.keys = np.sort(owner * self.n + np.array([b for own in balls for b in own], np.int64))

    def _holds(self, a: np.ndarray, core: np.ndarray) -> np.ndarray:
        key = a * self.n + core
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (core >= 0) & (self.keys[at] == key)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(a), bool)
        return self._holds(a, self.core[b]) | self._holds(b, self.core[a])


def _joined(parent: np.ndarray, linked: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[tuple[int, int]]:
    """Links between rows p and columns q that join what `parent` has apart, as far as it goes; `parent` has them joined then."""

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    while True:  # each vector offers one link out of its component, so their number at least halves
        while (parent != parent[parent]).any():
            parent[:] = parent[parent]
        apart = linked & (parent[p][:, None] != parent[q][None, :])
        lines, columns = np.flatnonzero(apart.any(1)), np.flatnonzero(apart.any(0))
        if not len(lines):
            return out
        a = np.concatenate((p[lines], p[apart[:, columns].argmax(0)]))
        b = np.concatenate((q[apart[lines].argmax(1)], q[columns]))
        for u, v in zip(a.tolist(), b.tolist(), strict=True):
            u, v = top(u), top(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
                out.append((u, v))


def _compared(kind: str, least: float, rows: pa.Table) -> pa.Table:
    """One leaf: (a, b, n); b null: a has n links counted here; else an edge."""
    tree, leaf = rows["tree"][0].as_py(), rows["leaf"][0].as_py()
    label, node = rows["label"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False), rows["node"].to_numpy()
    copies, raws = rows["copies"].to_numpy(), rows["vector"].to_pylist()
    earlier = Earlier(tree, leaf, rows["leaves"].to_pylist())
    counted = Counted(rows["core"].combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), rows["balls"].to_pylist())
    dim = np.array([len(r) for r in raws])
    out: list[tuple] = []
    for key in {*zip(label.tolist(), dim.tolist(), strict=True)}:
        at = np.flatnonzero((label == key[0]) & (dim == key[1]))
        if len(at) < 2:
            continue
        x = np.stack([np.frombuffer(raws[i], kind) for i in at]).astype(np.float64)
        x = x / np.abs(x).max(1, keepdims=True)  # neither overflows nor vanishes when squared
        size = np.sqrt((x * x).sum(1))
        count = np.zeros(len(at), np.int64)
        parent = np.arange(len(at))
        for i in range(0, len(at), 512):
            for j in range(i, len(at), 512):
                p, q = np.arange(i, min(i + 512, len(at))), np.arange(j, min(j + 512, len(at)))
                linked = (x[p] @ x[q].T) / (size[p, None] * size[None, q]) >= least
                if i == j:
                    linked = np.triu(linked, 1)
                a, b = np.nonzero(linked)
                if not len(a):
                    continue
                new = ~counted.pairs(at[p[a]], at[q[b]])
                new[new] = ~earlier.shared(at[p[a[new]]], at[q[b[new]]])
                np.add.at(count, p[a[new]], copies[at[q[b[new]]]])
                np.add.at(count, q[b[new]], copies[at[p[a[new]]]])
                linked[a[~new], b[~new]] = False  # what joins these is put out by the leaf that counts them
                out += [(int(node[at[u]]), int(node[at[v]]), 0) for u, v in _joined(parent, linked, p, q)]
        out += [(int(node[at[i]]), None, int(count[i])) for i in np.flatnonzero(count)]
    return pa.table({k: pa.array([r[i] for r in out], pa.int64()) for i, k in enumerate(("a", "b", "n"))})


def dense_balls(x: np.ndarray, least: float, most: float, leaf: int, broad: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Balls that cover unit vectors with `most` or more of others in reach (cosine `least`): centres, the cosines at which
    their shells end, and how many of them, which stand first, are open.

    Candidates are vectors with links enough in their leaf of one tree; each ball is then
    counted over the whole sample.
    """
    shell = _shell(least)
    links = np.zeros(len(x), np.int64)
    row, at = route(fit(x, 1, max(0, math.ceil(math.log2(max(1, len(x)) / leaf))), 0.05)[0], 0, x)
    order = np.argsort(at, kind="stable")
    for rows in np.split(row[order], c.group_starts(at[order])[1:]):
        for i in range(0, len(rows), 512):
            near = (x[rows[i : i + 512]] @ x[rows].T >= least).sum(1)
            links[rows[i : i + 512]] = np.maximum(links[rows[i : i + 512]], near)
    free = np.ones(len(x), bool)
    todo = links >= max(4, most / 8)
    out: list[tuple[float, np.ndarray]] = []
    for i in np.argsort(-links, kind="stable"):
        if not todo[i]:
            continue
        todo[i] = False
        ball = x @ x[i] >= least
        if (ball & free).sum() < most:
            continue
        centre = x[ball & free].sum(0)
        centre /= max(float(np.linalg.norm(centre)), 1e-300)
        cosine = x @ centre
        if ((cosine >= least) & free).sum() < (ball & free).sum():
            centre, cosine = x[i], x @ x[i]
        core = cosine >= least
        todo &= ~core
        held = broad * int((core & free).sum())
        free &= ~core
        end = shell if held >= len(x) else max(shell, float(np.partition(cosine, len(x) - held - 1)[len(x) - held - 1]))
        out.append((min(end, least), centre))
    out.sort(key=lambda ball: ball[0] <= shell)
    return np.array([v for _, v in out]).reshape(-1, x.shape[1]), np.array([e for e, _ in out]), sum(e > shell for e, _ in out)


def _shell(least: float) -> float:
    """The cosine at twice the angle of `least`, less what rounding may take."""
    return 2 * least * least - 1 - 1e-9 if least > 0 else -2.0


@dataclass
class Balls:
    """All balls of one dimension, numbered from `first`; the first `n_open` of them are open."""

    first: int
    centres: np.ndarray
    shells: np.ndarray
    n_open: int

    def core(self, units: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's cosines with the centres, and its own ball, counted from 0 (-1: none)."""
        cosine = units @ self.centres.T
        inside = cosine >= least
        return cosine, np.where(inside.any(1), inside.argmax(1), -1)


def _placed(kind: str, balls: dict[int, Balls], least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector's core (null: none), the balls whose cores it is to be compared with, and whether it goes to the forest.

    Of two vectors with different cores the pair is compared in the later ball alone, if the
    other vector is in its shell. Open balls stand first, so where that one is whole, no link is missed; where it isn't,
    both are open, and both vectors go to the forest.
    """
    for batch in batches:
        for k in range(0, batch.num_rows, 2000):
            part = batch.slice(k, 2000)
            raws = part.column(3).to_pylist()
            dims = np.array([len(r) // int(kind[2]) for r in raws])
            core, shells, forest = np.full(len(raws), -1), [[] for _ in raws], np.ones(len(raws), bool)
            for dim, own_balls in balls.items():
                at = np.flatnonzero(dims == dim)
                if not len(at):
                    continue
                cosine, own = own_balls.core(_units(kind, [raws[i] for i in at], dim), least)
                core[at[own >= 0]] = own_balls.first + own[own >= 0]
                forest[at] = own < own_balls.n_open
                reach = (cosine >= own_balls.shells) & (np.arange(len(own_balls.shells)) >= own[:, None])
                for i, b in zip(*np.nonzero(reach), strict=True):
                    shells[at[i]].append(own_balls.first + int(b))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(core, pa.int32(), mask=core < 0), pa.array(shells, pa.list_(pa.int32())), pa.array(forest)], ["node", "label", "copies", "vector", "core", "balls", "forest"])


def _tile(kind: str, least: float, rows: pa.Table) -> pa.Table:
    """Links between two blocks of a ball, or within one: (a, b, n) as a leaf's; a block of cores is on one side."""
    one, two = rows["i"][0].as_py(), rows["j"][0].as_py()
    block, node = rows["block"].to_numpy(), rows["node"].to_numpy()
    copies, raws = rows["copies"].to_numpy().astype(np.float64), rows["vector"].to_pylist()
    left = np.flatnonzero(block == one)
    right = left if one == two else np.flatnonzero(block == two)
    x = np.stack([np.frombuffer(r, kind) for r in raws]).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # neither overflows nor vanishes when squared
    size = np.sqrt((x * x).sum(1))
    count = np.zeros(len(node))
    parent = np.arange(len(node))
    out: list[tuple] = []
    for i in range(0, len(left), 512):
        for j in range(i if one == two else 0, len(right), 512):
            p, q = left[i : i + 512], right[j : j + 512]
            linked = (x[p] @ x[q].T) / (size[p, None] * size[None, q]) >= least
            if one == two and i == j:
                linked = np.triu(linked, 1)
            count[p] += linked @ copies[q]
            count[q] += copies[p] @ linked
            out += [(int(node[a]), int(node[b]), 0) for a, b in _joined(parent, linked, p, q)]
    out += [(int(node[i]), None, int(count[i])) for i in np.flatnonzero(count)]
    return pa.table({k: pa.array([r[i] for r in out], pa.int64()) for i, k in enumerate(("a", "b", "n"))})


def _leaves_forest(kind: str, balls: dict[int, Balls], least: float, raw: bytes) -> bool:
    """Whether a vector's core is in a whole ball."""
    dim = len(raw) // int(kind[2])
    return dim in balls and bool(balls[dim].core(_units(kind, [raw], dim), least)[1][0] >= balls[dim].n_open)


def _ball_links(placed: DataFrame, kind: str, cosine: float) -> DataFrame:
    """(a, b, n) of all links that have a core vector."""
    rows = placed.select("node", "label", "copies", "vector", "core", F.explode("balls").alias("ball")).withColumn("rest", ~F.col("core").eqNullSafe(F.col("ball")))
    sizes = rows.groupBy("ball", "label").agg(F.count_if(~F.col("rest")).alias("cores"), F.count_if("rest").alias("others")).where("cores > 0")
    per = F.greatest(F.lit(1024), F.least(F.lit(8192), F.ceil((F.col("cores") + F.col("others")) / 16)))
    sizes = sizes.select("ball", "label", F.ceil(F.col("cores") / per).cast("int").alias("kc"), F.ceil(F.col("others") / per).cast("int").alias("ko"))
    rows = rows.join(sizes, ["ball", "label"])
    salt = F.xxhash64("node")
    rows = rows.withColumn("block", F.when(F.col("rest"), F.col("kc") + F.pmod(salt, F.greatest("ko", F.lit(1)))).otherwise(F.pmod(salt, F.col("kc"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("rest"), F.col("kc")).otherwise(F.col("kc") + F.col("ko")).cast("int") - 1)))
    tiles = rows.select("ball", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "vector")
    return tiles.groupBy("ball", "label", "i", "j").applyInArrow(lambda t: _tile(kind, cosine, t), "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, trees: int = 12, leaf: int = 400, spill: float = 0.05, sample: int = 50_000, broad: int = 64, most: int = 20_000, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row for each row of vectors: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).cast("string").alias("label"))
    kind = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"
    named = c.checkpointed(c.bounded(rows).mapInArrow(lambda b: _classes(kind, b), "vec_id long, node long, sign int, label string, vector binary"))
    named = c.told_apart(named)(named)
    nodes = named.where("node is not null").groupBy("node").agg(F.any_value("label").alias("label"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"), F.min("vec_id").alias("first"))
    nodes = c.checkpointed(nodes)
    n = nodes.count()
    taken = [r[0] for r in nodes.select("vector", "node").orderBy(F.xxhash64("node"), "node").limit(sample).select("vector").collect()]  # at most `sample` vectors
    balls: dict[int, Balls] = {}
    for size in sorted({len(r) for r in taken}) if n > leaf else ():
        own = _units(kind, [r for r in taken if len(r) == size], size // int(kind[2]))
        centres, shells, n_open = dense_balls(own, cosine, max(8, leaf / 2 * len(taken) / n), leaf, broad)
        if len(centres):
            balls[size // int(kind[2])] = Balls(sum(len(x.centres) for x in balls.values()), centres, shells, n_open)
    rest, near = nodes.withColumns({"core": F.lit(None).cast("int"), "balls": F.array().cast("array<int>")}), None
    if balls:
        centres = vectors.sparkSession.sparkContext.broadcast(balls)  # at most sample / 8 of them
        placed = c.checkpointed(nodes.select("node", "label", "copies", "vector").mapInArrow(lambda b: _placed(kind, centres.value, cosine, b), "node long, label string, copies long, vector binary, core int, balls array<int>, forest boolean"))
        near = _ball_links(placed, kind, cosine)
        rest = placed.where("forest")
        n = rest.count()
        taken = [r for r in taken if not _leaves_forest(kind, balls, cosine, r)]
    dim = max({len(r) for r in taken}, key=lambda d: sum(len(r) == d for r in taken)) // int(kind[2]) if taken else 1
    depth = max(0, math.ceil(math.log2(max(1, n) / leaf)))
    forest = fit(_units(kind, taken, dim), trees, depth, spill)
    if n > most:
        forest = _refined(rest, forest, kind, dim, spill, most)
    held = vectors.sparkSession.sparkContext.broadcast(forest)  # at most 2 * (sample / 8 + 2 * n / most) nodes a tree, of two figures
    del taken
    schema = "tree int, leaf long, node long, label string, copies long, vector binary, core int, balls array<int>, leaves binary"
    routed = rest.select("node", "label", "copies", "vector", "core", "balls").mapInArrow(lambda b: _routed(kind, held.value, dim, b), schema)
    found = routed.groupBy("tree", "leaf").applyInArrow(lambda t: _compared(kind, cosine, t), "a long, b long, n long")
    found = c.checkpointed(found if near is None else found.union(near))
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    comps = c.components(found.where("b is not null"), "a", "b").select(F.col("id").alias("node"), F.col("component_id").alias("comp"))
    classes = nodes.select("node", "first", "copies").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    smallest = classes.groupBy("comp").agg(F.min("first").alias("component_id"))
    classes = classes.join(smallest, "comp").join(links, "node", "left").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (
        named.select("vec_id", "node").join(classes, "node", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
