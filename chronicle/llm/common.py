"""What the operators of this folder share: tables, checkpoints, byte buffers, rolling hashes, components.

Hashes are polynomial over Z/2^64 with a random byte table and a final mix. Where equal hashes
are taken for equal content without another look, a second hash with another table and base stands
beside the first (`Twin`), so that 96 bits must agree.
All arrays are built per chunk of documents or per segment of such a chunk, so a task's
memory depends on the chunk size and not on the input.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 20240607
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
WORD_MULTIPLIER = np.uint64(0xD1342543DE82EF95)
BYTE_TABLE = np.random.default_rng(SEED).integers(1, 2**64, 256, dtype=np.uint64)
SECOND_TABLE = np.random.default_rng(SEED + 1).integers(1, 2**64, 256, dtype=np.uint64)
SECOND_MULTIPLIER = np.uint64(0xA0761D6478BD642F)
#: Bytes that one round of a rolling hash covers: its arrays then stay in the cache.
SEGMENT = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a folder, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one named by spark.checkpoint.dir; only where that is unset and Spark runs
    in this one process (local tests) a folder of this machine is set instead.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, written to the shared checkpoint folder; its lineage ends there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {x.lower() for f in frames for x in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


# ---------------------------------------------------------------- hashes


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % 2**64
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), kept for later calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << math.ceil(math.log2(max(n, 2))))
        have = np.empty(size, np.uint64)
        have[0] = 1
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[:n]


class Rolling:
    """Hashes of any substring or run of values, each in constant time."""

    def __init__(self, values: np.ndarray, multiplier: np.uint64) -> None:
        n = len(values)
        base = int(multiplier)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(base, n), out=self.sums[1:])
        self.back = powers(_inverse(base), n + 1)

    def window(self, length: int) -> np.ndarray:
        """Of each start that has `length` values."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * self.back[:n])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


#: Two hashes of the same thing: 64 bits to sort by and 32 more.
TWIN = np.dtype([("h", "<u8"), ("x", "<u4")])


class Twin:
    """Both hashes of any substring or run of values."""

    def __init__(self, one: np.ndarray, multiplier: np.uint64, two: np.ndarray) -> None:
        self.first, self.second = Rolling(one, multiplier), Rolling(two, SECOND_MULTIPLIER)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), TWIN)
        out["h"] = self.first.spans(start, end)
        out["x"] = self.second.spans(start, end) >> np.uint64(32)
        return out


def twin_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of twin hashes: their order, and heads and sizes of the groups of equal ones."""
    order = np.argsort(keys["h"])
    h, x = keys["h"][order], keys["x"][order]
    same = h[1:] == h[:-1]
    differs = x[1:] != x[:-1]
    if (same & differs).any():  # two contents of one first hash
        order = np.lexsort((keys["x"], keys["h"]))
        h, x = keys["h"][order], keys["x"][order]
        same, differs = h[1:] == h[:-1], x[1:] != x[:-1]
    heads = np.flatnonzero(np.concatenate(([True], ~same | differs))) if len(keys) else np.zeros(0, np.int64)
    return order, heads, np.diff(np.append(heads, len(keys)))


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash for each word buf[start:end], segment by segment."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        first = start[i]
        j = max(i + 1, int(np.searchsorted(end, first + SEGMENT, "right")))
        part = Rolling(BYTE_TABLE[buf[first : end[j - 1]]], MULTIPLIER)
        out[i:j] = part.spans(start[i:j] - first, end[i:j] - first)
        i = j
    return out


# ---------------------------------------------------------------- buffers

#: Bytes of `[^\x20\x09-\x0D]`.
PLAIN_WORD = np.ones(256, bool)
PLAIN_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`, that is a-z, 0-9 and all of any longer character.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def joined(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes one after the other, and where each starts (one more than texts); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([x.cast(pa.large_binary()) for x in texts.chunks]) if texts.num_chunks else pa.array([], pa.large_binary())
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each document the number of its first word (one more than documents)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = np.empty(n + 1, bool)
    inside[:n] = kind[buf]
    inside[n] = False
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside[:n]
    cut = offsets[1:-1]
    starts = inside & ~before
    ends = ~inside & before
    cut = cut[cut < n]
    starts[cut] = inside[cut]
    ends[cut] = before[cut]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    return start, end, np.searchsorted(start, offsets)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, start, 1)
    np.add.at(delta, end, -1)
    return np.cumsum(delta[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def group_starts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


# ---------------------------------------------------------------- chunks and buckets

CHUNKS = "chunk int, bucket int, a binary, b binary"
ANSWERS = "chunk int, bucket int, a binary"


#: Rows that are equal in id and text stand once, with their number, where there are more than this of them.
MOST_COPIES = 256


def chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int, most_copies: int = MOST_COPIES) -> tuple[DataFrame, int, int]:
    """(chunk, doc_id, text, copies) with about `chunk_bytes` of text in each chunk, all texts' bytes, and the number of chunks.

    A row's chunk follows from its id and text alone, so that a lost executor's work can be
    done again and every pass finds the same chunks.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.lit(1).cast("long").alias("copies"))
    key = [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit(SEED), "doc_id").alias("k2")]
    each = rows.groupBy(*key).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    state = each.agg(F.sum("bytes").alias("bytes"), F.max("n").alias("n")).first()
    total = state["bytes"] or 0
    if (state["n"] or 0) > most_copies:
        held = checkpointed(each.where(F.col("n") > most_copies).select("k1", "k2"))
        keyed = rows.select("*", *key)
        few, on = held.count() <= BROADCAST_KEYS, ["k1", "k2"]
        held = F.broadcast(held) if few else held
        once = keyed.join(held, on, "left_semi").groupBy(*on).agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"), F.sum("copies").alias("copies"))
        rows = keyed.join(held, on, "left_anti").select("doc_id", "text", "copies").unionByName(once.select("doc_id", "text", "copies"))
    n = max(1, math.ceil(total / chunk_bytes))
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    return rows.select(chunk.alias("chunk"), "doc_id", "text", "copies"), total, n


def each_copy(found: DataFrame) -> DataFrame:
    """One row for each of the rows that stood once."""
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")


def in_order(rows: pa.Table) -> pa.Table:
    """A chunk's rows in an order that every pass finds again."""
    return rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _bucket_bounds(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted 64-bit keys: the buckets that have any, that is the keys' upper `bits`, and where each begins (one more than buckets)."""
    top = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    heads = group_starts(top)
    return top[heads].astype(np.int64), np.append(heads, len(keys))


def slices(chunk: int, keys: np.ndarray, bits: int, *columns: np.ndarray) -> pa.Table:
    """Of sorted 64-bit keys and columns beside them: one row for each bucket."""
    used, bounds = _bucket_bounds(keys, bits)
    out = [pa.array(np.full(len(used), chunk, np.int32)), pa.array(used.astype(np.int32))]
    for c in columns:
        raw = np.ascontiguousarray(c).view(np.uint8)
        cuts = (bounds * c.dtype.itemsize).astype(np.int32)
        out.append(pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]))
    while len(out) < 4:
        out.append(pa.array([None] * len(used), pa.binary()))
    return pa.Table.from_arrays(out, ["chunk", "bucket", "a", "b"])


def answers(keys: np.ndarray, bits: int, rows: Iterator[tuple[int, bytes]]) -> np.ndarray:
    """Each sorted key's answer byte, from the answers of the buckets."""
    out = np.zeros(len(keys), np.uint8)
    used, bounds = _bucket_bounds(keys, bits)
    place = {b: i for i, b in enumerate(used.tolist())}
    for bucket, raw in rows:
        i = place[bucket]
        out[bounds[i] : bounds[i + 1]] = np.frombuffer(raw, np.uint8)
    return out


#: Chunks whose entries may meet in one task; of more, groups of so many meet first.
FAN = 2048


class Bucket:
    """What chunks sent to a bucket: entries `a` of one dtype and columns `b` beside them, chunk after chunk."""

    def __init__(self, rows: pa.Table, a: np.dtype, b: np.dtype) -> None:
        rows = rows.sort_by("chunk")
        self.chunks, self.bucket = rows["chunk"].to_pylist(), rows["bucket"][0].as_py()
        raw = [x.as_py() for x in rows["a"]]
        self.cuts = np.cumsum([len(x) // np.dtype(a).itemsize for x in raw])
        self.keys = np.frombuffer(b"".join(raw), a)
        beside = [x.as_py() for x in rows["b"]]
        self.beside = np.ones(len(self.keys), b) if beside[0] is None else np.frombuffer(b"".join(beside), b)

    def answered(self, code: np.ndarray) -> pa.Table:
        return answered(self.chunks, [self.bucket] * len(self.chunks), [x.tobytes() for x in np.split(code.astype(np.uint8), self.cuts[:-1])])

    def merged(self, part: int, keys: np.ndarray, beside: np.ndarray) -> pa.Table:
        """These entries as one row, of a group of chunks."""
        return pa.Table.from_arrays([pa.array([part], pa.int32()), pa.array([self.bucket], pa.int32()), pa.array([keys.tobytes()], pa.binary()), pa.array([beside.tobytes()], pa.binary())], ["chunk", "bucket", "a", "b"])


def scanned(entries: DataFrame, n_chunks: int, scan: Callable[[pa.Table], pa.Table], merge: Callable[[int, pa.Table], pa.Table], spread: Callable[[pa.Table, np.ndarray], pa.Table], fan: int = FAN) -> DataFrame:
    """The buckets' answers to all chunks' entries.

    `scan` answers the rows of a bucket. An entry that every chunk has would make a bucket grow with
    the number of chunks; so of more than `fan` chunks, groups of `fan` meet first: `merge` makes one row of a
    group's, with equal entries once; those rows are scanned in the same way, as chunks; and `spread`
    hands the group's answers back to its chunks' rows. Rows of a bucket below 0 pass through.
    """
    if n_chunks <= fan:
        return entries.groupBy("bucket").applyInArrow(scan, ANSWERS)
    entries = checkpointed(entries)
    through = entries.where("bucket < 0").select("chunk", "bucket", "a")
    entries = entries.where("bucket >= 0").withColumn("part", F.floor(F.col("chunk") / fan).cast("int"))
    groups = entries.groupBy("bucket", "part").applyInArrow(lambda t: merge(t["part"][0].as_py(), t), CHUNKS)
    told = scanned(groups, math.ceil(n_chunks / fan), scan, merge, spread, fan)

    def back(rows: pa.Table, answer: pa.Table) -> pa.Table:
        return spread(rows, np.frombuffer(answer["a"][0].as_py(), np.uint8))

    return entries.groupBy("bucket", "part").cogroup(told.withColumnRenamed("chunk", "part").groupBy("bucket", "part")).applyInArrow(back, ANSWERS).union(through)


def passed(chunk: int, raw: bytes) -> pa.Table:
    """A row that the buckets hand back to its chunk as it is."""
    return pa.Table.from_arrays([pa.array([chunk], pa.int32()), pa.array([-1 - chunk], pa.int32()), pa.array([raw], pa.binary()), pa.array([None], pa.binary())], ["chunk", "bucket", "a", "b"])


def answered(chunks: list[int], buckets: list[int], raws: list[bytes]) -> pa.Table:
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "bucket": pa.array(buckets, pa.int32()), "a": pa.array(raws, pa.binary())})


def bucket_bits(n_keys: int, per_bucket: int, least: int = 9) -> int:
    """Bits for about `per_bucket` keys in a bucket; some hundred buckets at least, so that tasks are even."""
    return min(28, max(least, math.ceil(math.log2(max(1, n_keys / per_bucket)))))


# ---------------------------------------------------------------- components


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component_id): the smallest id that links reach, for each id in a link.

    Large-star and small-star steps in turn, until a round changes nothing; each ends in a checkpoint. A hub's rows are
    only joined to one minimum each and aggregated map-side first, so a star of a third of
    all rows makes no more rows than it has links.
    """
    edges = checkpointed(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    last = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(low, F.col("u") == F.col("k")).select(
            F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")), F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("e")
        )
        edges = checkpointed(small.select(F.col("e.x").alias("u"), F.col("e.y").alias("v")).where("u <> v").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
            )
        last = state


# ---------------------------------------------------------------- classes


def told_apart(rows: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What gives classes that share a `node` by chance, but not a `sign`, nodes of their own: 96 bits must agree.

    The other nodes stay as they are; among 1e10 classes some three are expected to meet.
    """
    met = checkpointed(rows.groupBy("node").agg(F.min("sign").alias("least_sign"), F.max("sign").alias("most_sign")).where("least_sign <> most_sign").select("node", "least_sign"))
    if met.isEmpty():
        return lambda df: df.drop("sign")
    few = met.count() <= BROADCAST_KEYS
    other = (F.col("least_sign").isNotNull()) & (F.col("sign") != F.col("least_sign"))

    def apart(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(met) if few else met, "node", "left")
        return joined.withColumn("node", F.when(other, F.xxhash64("node", "sign")).otherwise(F.col("node"))).select(*(x for x in df.columns if x != "sign"))

    return apart


# ---------------------------------------------------------------- joins by key

#: Keys that may be broadcast: at two longs a row some 32 MB as a hash table. More are shuffled.
BROADCAST_KEYS = 500_000


def by_keys(rows: DataFrame, keys: DataFrame, on: list[tuple[str, str]], how: str = "left_semi") -> DataFrame:
    """Semi or anti join with distinct keys, null equal to null. Broadcasts them only if they are few,
    so that the rows' texts need not be shuffled."""
    keys = checkpointed(keys.distinct())
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    condition = None
    for a, b in on:
        same = rows[a].eqNullSafe(keys[b])
        condition = same if condition is None else condition & same
    return rows.join(keys, condition, how)


# ---------------------------------------------------------------- batches


def bounded(df: DataFrame, megabytes: int = 4) -> DataFrame:
    """Sees to it that Python workers get record batches of bounded bytes, whatever the texts' lengths."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, str(2**31 - 1), str(2**63 - 1)):
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
    return df


def release() -> None:
    """Gives freed memory back at a task's end: workers are used again, and share their executor's limit."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def parts(batch: pa.RecordBatch, text: str, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text column has about `size` bytes; a longer text stands alone."""
    lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop
