"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document is its set of distinct word shingles (A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`).
A first permutation scatters the shingles over `UNIVERSE` places; the second one, `CIRCLE`, is
shifted by 0, 1, 2 ... to give all signature coordinates, so a shingle's coordinates are one
contiguous stretch of CIRCLE and a signature is a column-wise minimum of such stretches.

1. Documents with equal sets form a class (a node); only nodes are compared.
2. Each band's bucket is compared by its smallest and its largest node (two stars, not all pairs);
   pairs are verified on the full sets and connected.
3. Where a bucket still holds different components, its nodes gather with those of other such
   buckets around the component that is largest in them; each node outside that component is
   compared with all nodes gathered there, on the full sets, in blocks of about `block`
   shingles. So no bucket is capped, and every pair that shares a bucket is compared unless it
   is connected already. A block puts out no more links than join its components.
4. Components of the verified links.

At the threshold of 0.8 a pair misses all 40 bands of 5 with a probability of about 1e-7.

Null, empty and blank texts have the empty set, which links with nothing. A text with fewer
words than a shingle has is one shingle. Rows that share a doc_id are separate documents; a
component's id is its smallest doc_id. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

UNIVERSE = 1 << 20
BANDS, ROWS = 40, 5
#: Nodes that a block need not have less of, and blocks that groups are cut into for that reason alone.
TASK_NODES, MOST_TASKS = 128, 16


@cache
def circle() -> np.ndarray:
    """The second permutation, long enough for any shift."""
    pi = np.random.default_rng(c.SEED).permutation(UNIVERSE).astype(np.uint32)
    return np.concatenate((pi, pi[: BANDS * ROWS]))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted hashes of its distinct shingles."""
    buf, offsets = c.joined(texts)
    buf = c.LOWER[buf]
    start, end, first = c.words(buf, offsets, c.PLAIN_WORD)
    hashes = c.word_hashes(buf, start, end)
    rolling = c.Rolling(hashes, c.WORD_MULTIPLIER)
    grams = rolling.window(size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if a == b:
            yield np.zeros(0, np.uint64)
        elif b - a < size:
            yield rolling.spans(np.array([a]), np.array([b]))
        else:
            x = np.sort(grams[a : b - size + 1])
            yield x[c.group_starts(x)]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least CIRCLE[place + k] over the shingles' places."""
    places = (c.mix(shingles ^ c.MULTIPLIER) % np.uint64(UNIVERSE)).astype(np.int64)
    every = np.lib.stride_tricks.sliding_window_view(circle(), BANDS * ROWS)
    out = every[places[:512]].min(axis=0)
    for i in range(512, len(places), 512):
        np.minimum(out, every[places[i : i + 512]].min(axis=0), out=out)
    return out


def _node(shingles: np.ndarray) -> tuple[int, int]:
    """An id of the set, and what tells sets of one id apart; 0 is the empty set's id."""
    if not len(shingles):
        return 0, 0
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=12).digest()
    return int.from_bytes(raw[:8], "little", signed=True) or 1, int.from_bytes(raw[8:], "little", signed=True)


def _sketches(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    band = np.arange(1, BANDS + 1, dtype=np.uint64)
    rolled = c.powers(int(c.WORD_MULTIPLIER), ROWS)
    for batch in batches:
        for part in c.parts(batch, "text"):
            nodes, counts, sigs = [], [], []
            for s in shingle_sets(part.column(1), size):
                nodes.append(_node(s))
                counts.append(len(s))
                sigs.append(signature(s) if len(s) else np.zeros(BANDS * ROWS, np.uint32))
            sig = np.stack(sigs)
            keys = c.mix((sig.reshape(-1, BANDS, ROWS).astype(np.uint64) * rolled).sum(2, dtype=np.uint64) + band * c.MULTIPLIER)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([n for n, _ in nodes], pa.int64()), pa.array([x for _, x in nodes], pa.int32()), pa.array(counts, pa.int64()), pa.array([x.tobytes() for x in keys], pa.binary())],
                ["doc_id", "text_key", "node", "sign", "n_shingles", "bands"],
            )
    c.release()


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each node and band."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            keys = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(part.column(0).to_numpy(), BANDS))], ["key", "node"])


def _sets(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in c.parts(batch, "text"):
            sets = list(shingle_sets(part.column(0), size))
            nodes = [_node(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in nodes], pa.int64()), pa.array([x for _, x in nodes], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "sign", "shingles"])
    c.release()


def _verify(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(a) > len(b):
                a, b = b, a
            if 100 * len(a) < percent * len(b):
                keep.append(False)
                continue
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int((b[at] == a).sum())
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _linked(percent: int, rows: pa.Table) -> pa.Table:
    """One block: each probing node against all others on the full sets. Puts out links between
    components, and of these only such as join what is not joined yet."""
    node, comp = rows["node"].to_numpy(), rows["comp"].to_numpy()
    probe = rows["probe"].to_numpy(zero_copy_only=False)
    flat, offsets = c.joined(rows["shingles"])
    flat, offsets = flat.view(np.uint64), offsets // 8
    sizes = np.diff(offsets)
    order = np.argsort(flat)
    heads = c.group_starts(flat[order])
    word = np.empty(len(flat), np.int64)
    word[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(flat))))
    own = np.unique(comp)
    up = np.arange(len(own))
    of = np.searchsorted(own, comp)

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    a, b = [], []
    seen = np.zeros(len(heads), bool)
    for i in np.flatnonzero(probe):
        mine = word[offsets[i] : offsets[i + 1]]
        seen[mine] = True
        both = np.add.reduceat(seen[word], offsets[:-1], dtype=np.int64)
        seen[mine] = False
        hit = np.flatnonzero((100 * both >= percent * (sizes + sizes[i] - both)) & (node != node[i]))
        for j in hit.tolist():
            x, y = top(of[i]), top(of[j])
            if x != y:
                up[max(x, y)] = min(x, y)
                a.append(node[i])
                b.append(node[j])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def grouped(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, block: int) -> DataFrame:
    """One row for each row of docs: doc_id, text_key, n_shingles, component_id, comp (one value for each component; null for an empty set)."""
    rows = c.bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed_rows = rows.withColumn("text_key", F.xxhash64("text"))
    sketch = c.checkpointed(keyed_rows.mapInArrow(lambda b: _sketches(shingle, b), "doc_id long, text_key long, node long, sign int, n_shingles long, bands binary"))
    apart = c.told_apart(sketch)
    sketch = apart(sketch)
    nodes = sketch.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.any_value("bands").alias("bands"), F.any_value("n_shingles").alias("n_shingles"))
    keyed = nodes.select("node", "bands").mapInArrow(_bands, "key long, node long")
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("n > 1")
    members = c.checkpointed(keyed.join(buckets, "key"))
    star = F.array(F.struct(F.col("lo").alias("hub")), F.struct(F.col("hi").alias("hub")))
    pairs = members.select("node", F.explode(star).alias("s")).select(F.least("node", "s.hub").alias("a"), F.greatest("node", "s.hub").alias("b")).where("a <> b").distinct()

    def sets(of: DataFrame) -> DataFrame:
        """Full sets of the nodes, from one text of each."""
        wanted = nodes.select("node", "first").join(of, "node").select(F.col("first").alias("__first"))
        full = c.by_keys(rows, wanted, [("doc_id", "__first")]).select("text").mapInArrow(lambda b: _sets(shingle, b), "node long, sign int, shingles binary")
        full = apart(full)
        return full.where("node <> 0").groupBy("node").agg(F.any_value("shingles").alias("shingles"))

    pairs = c.checkpointed(pairs)
    # Read from a checkpoint, a hub's pairs can be split over tasks by the engine.
    full = c.checkpointed(sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    left, right = full.select(F.col("node").alias("a"), F.col("shingles").alias("x")), full.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    checked = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lambda b: _verify(percent, b), "a long, b long")
    links = c.checkpointed(checked)
    comps = c.components(links, "a", "b").select(F.col("id").alias("node"), F.col("component_id").alias("comp"))

    # Step 3: only buckets of four nodes or more can hold a pair that the stars have not compared.
    inside = members.where("n > 3 and node <> lo and node <> hi").select("key", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    by = inside.groupBy("key", "comp").agg(F.count("*").alias("size"))
    split = by.groupBy("key").agg(F.count("*").alias("comps"), F.max_by("comp", F.struct("size", "comp")).alias("group")).where("comps > 1")
    split = c.checkpointed(split.select("key", "group"))  # and so can a bucket's nodes
    met = c.checkpointed(inside.join(split, "key").select("group", "node", "comp").distinct())
    if not met.isEmpty():
        weight = met.join(nodes.select("node", "n_shingles"), "node").withColumn("probe", F.col("comp") != F.col("group"))
        # Blocks of bounded shingles; a group of fewer is dealt to some tasks all the same.
        part = lambda x, n: F.greatest(F.lit(1), F.ceil(x / F.lit(block)), F.least(F.lit(MOST_TASKS), F.ceil(n / F.lit(TASK_NODES)))).cast("int")
        cut = weight.groupBy("group").agg(
            part(F.sum("n_shingles"), F.count("*")).alias("blocks"),
            part(F.sum(F.when(F.col("probe"), F.col("n_shingles"))), F.count_if("probe")).alias("probes"),
        )
        held = weight.join(cut, "group").join(sets(met.select("node").distinct()), "node")
        place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
        upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        stand = held.select("group", place(F.col("blocks")).alias("i"), upto(F.col("probes")).alias("j"), "node", "comp", F.lit(False).alias("probe"), "shingles")
        probing = held.where("probe").select("group", upto(F.col("blocks")).alias("i"), place(F.col("probes")).alias("j"), "node", "comp", F.lit(True).alias("probe"), "shingles")
        more = c.checkpointed(stand.union(probing).groupBy("group", "i", "j").applyInArrow(lambda t: _linked(percent, t), "a long, b long"))
        if not more.isEmpty():
            comps = c.components(links.union(more), "a", "b").select(F.col("id").alias("node"), F.col("component_id").alias("comp"))
    named = nodes.select("node", "first").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    smallest = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    ids = named.join(smallest, "comp").select("node", "component_id", "comp")
    return sketch.select("doc_id", "text_key", "node", "n_shingles").join(ids, "node", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "comp"
    )


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = 1 << 20) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept (the component's smallest doc_id)."""
    found = grouped(docs, shingle, percent, id_col, text_col, block)
    return found.select("doc_id", "n_shingles", "component_id").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = 1 << 20) -> DataFrame:
    """docs without all but one row of each component: a row with its smallest id. Rows without words all stay.

    Of rows equal in id and text the one whose columns, as JSON, have the least hash stays; columns keep their names.
    """
    found = c.checkpointed(grouped(docs, shingle, percent, id_col, text_col, block))
    each = found.where("comp is not null").groupBy("comp", "doc_id", "text_key").agg(F.count("*").alias("n"))
    first = each.groupBy("comp").agg(F.min_by(F.struct("doc_id", "text_key", "n"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k"))
    once = first.select(F.col("k.doc_id").alias("first_doc"), F.col("k.text_key").alias("first_text"), F.col("comp").alias("first_comp"), F.col("k.n").alias("first_n"))
    later = each.join(once, F.col("comp") == F.col("first_comp")).where(~(F.col("doc_id").eqNullSafe(F.col("first_doc")) & F.col("text_key").eqNullSafe(F.col("first_text"))))
    own, key = c.unused("own", docs), c.unused("key", docs)
    keyed = docs.withColumns({own: F.col(id_col).cast("long"), key: F.xxhash64(text_col)})
    kept = c.by_keys(keyed, later.select(F.col("doc_id").alias("later_doc"), F.col("text_key").alias("later_text")), [(own, "later_doc"), (key, "later_text")], "left_anti")
    equal = c.checkpointed(once.where("first_n > 1").select("first_doc", "first_text"))  # rows that are the same in id and text
    if not equal.isEmpty():
        on = [(own, "first_doc"), (key, "first_text")]
        row = F.struct(*(F.col(f"`{x}`") for x in docs.columns))
        one = c.by_keys(kept, equal, on).groupBy(own, key).agg(F.min_by(row, F.md5(F.to_json(row, {"ignoreNullFields": "false"}))).alias(own + key))
        kept = c.by_keys(kept, equal, on, "left_anti").drop(own, key).unionByName(one.select(f"{own + key}.*"))
    return kept.drop(own, key)
