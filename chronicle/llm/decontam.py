"""Benchmark decontamination with suffix arrays of the training text.

The training documents are cut into shards of bounded bytes. A task makes its shard's suffix
array over words (prefix doubling, deep enough for a window), then binary-searches every
suffix of the test items in it: the range found holds all places where the suffix's first
`window` words stand verbatim. Words that the shard doesn't have end a search at once. Neighbouring
suffixes of an item that are found at neighbouring places are one longer match; of each document
and item the longest one is put out with its places in both (`longest_matches`).

The test items are the stated query set. They are held in blocks of about `block_bytes` of text,
encoded as word hashes; a pass over the documents searches as many blocks as `pass_bytes` of
encoded bytes hold, so a task holds one pass's blocks as bytes, one of them unpacked, and one shard.
More items make more passes, and what these find of a document is united: the result is the same.

A document without words (null, empty, punctuation) has no hits. Items without words have no
windows. Rows that share an id are separate documents; of items that share an id, either's
occurrence counts. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c


def _word_ids(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, sorted, and each word's number among them, from 1 on."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    heads = c.group_starts(ordered)
    ids = np.empty(len(hashes), np.int64)
    ids[order] = np.repeat(np.arange(1, len(heads) + 1), np.diff(np.append(heads, len(ordered))))
    return ordered[heads], ids


class SuffixArray:
    """Suffixes of the words of a shard, ordered by their first `depth` words or more; a 0 stands between documents."""

    def __init__(self, words: np.ndarray, depth: int) -> None:
        n = len(words)
        bits = max(1, int(words.max(initial=0)).bit_length())
        step = max(1, min(depth, 63 // bits))
        padded = np.concatenate((words, np.zeros(depth + step, np.int64)))
        key = padded[:n].copy()
        for k in range(1, step):
            key = (key << bits) | padded[k : n + k]
        order = np.argsort(key)
        new = np.ones(n, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        while step < depth and n:
            head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            rank = np.empty(n + step, np.int64)
            rank[n:] = -1
            rank[order] = head
            tied = ~new
            tied[:-1] |= ~new[1:]
            at = np.flatnonzero(tied)
            if not len(at):
                break
            own = order[at]
            second = rank[own + step]
            again = np.lexsort((second, head[at]))
            order[at] = own[again]
            second = second[again]
            new[at[1:]] = new[at[1:]] | (second[1:] != second[:-1])
            step *= 2
        self.words, self.order, self.n = padded, order, n

    def _bound(self, pattern: np.ndarray, length: np.ndarray, after: bool) -> np.ndarray:
        """For each pattern, the first suffix that isn't before it; with `after`, the first that is past all that begin with it."""
        lo = np.zeros(len(pattern), np.int64)
        hi = np.full(len(pattern), self.n, np.int64)
        width = pattern.shape[1]
        places = np.arange(width)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            there = self.words[self.order[mid][:, None] + places]
            want = pattern[open_]
            differs = (there != want) & (places < length[open_, None])
            at = differs.argmax(1)
            row = np.arange(len(open_))
            less = differs[row, at] & (there[row, at] < want[row, at])
            if after:
                less |= ~differs[row, at]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)

    def find(self, pattern: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the array whose suffixes begin with the patterns' first `length` words."""
        return self._bound(pattern, length, False), self._bound(pattern, length, True)


def _encoded(items: list[tuple[object, str | None]], window: int) -> bytes:
    """A block of test items: their words' hashes, every distinct window by its first place and length, and which (item, place) have it."""
    buf, offsets = c.joined(pa.array([t for _, t in items], pa.string()))
    buf = c.LOWER[buf]
    start, end, first = c.words(buf, offsets, c.ALNUM_WORD)
    hashes = c.word_hashes(buf, start, end)
    counts = np.diff(first)
    n = np.where(counts > 0, np.maximum(1, counts - window + 1), 0)
    at, item = _spread(first[:-1], first[:-1] + n)
    length = np.minimum(window, counts[item])
    rows = np.zeros((len(at), window), np.uint64)
    inside = np.arange(window) < length[:, None]
    rows[inside] = hashes[(at[:, None] + np.arange(window))[inside]]
    _, one, of = np.unique(rows.view(f"V{8 * window}").reshape(-1), return_index=True, return_inverse=True)
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(len(one) + 1))
    held = {"hashes": hashes, "at": at[one].astype(np.int32), "length": length[one].astype(np.int32), "item": item[order].astype(np.int32), "place": (at - first[:-1][item])[order].astype(np.int32), "bounds": bounds.astype(np.int64)}
    return pickle.dumps(held | {"ids": [str(i) for i, _ in items]}, protocol=5)


def _unpacked(raw: bytes, window: int) -> dict:
    b = pickle.loads(raw)
    inside = np.arange(window) < b["length"][:, None]
    b["rows"] = np.zeros(inside.shape, np.uint64)
    b["rows"][inside] = b["hashes"][(b["at"].astype(np.int64)[:, None] + np.arange(window))[inside]]
    return b


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and each one's range."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()), which


class Shard:
    """Some documents' words and their suffix array."""

    def __init__(self, texts: pa.Array, window: int) -> None:
        buf, offsets = c.joined(texts)
        buf = c.LOWER[buf]
        start, end, self.first = c.words(buf, offsets, c.ALNUM_WORD)
        self.counts = np.diff(self.first)
        self.known, ids = _word_ids(c.word_hashes(buf, start, end))
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.at = np.arange(len(ids)) + self.doc  # one 0 after each document
        row = np.zeros(len(ids) + len(self.counts), np.int64)
        row[self.at] = ids
        self.window, self.array = window, SuffixArray(row, window)

    def places(self, b: dict) -> tuple[np.ndarray, np.ndarray]:
        """Where the block's windows stand: place in the row of words, and window."""
        if not len(b["length"]) or not len(self.known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.known, b["rows"]), len(self.known) - 1)
        inside = np.arange(self.window) < b["length"][:, None]
        pattern = np.where((self.known[place] == b["rows"]) & inside, place + 1, 0)
        usable = np.flatnonzero(((pattern > 0) | ~inside).all(1))
        lo, hi = self.array.find(pattern[usable], b["length"][usable])
        rank, which = _spread(lo, hi)
        return self.array.order[rank], usable[which]

    def owner(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first + np.arange(len(self.first)), place, "right") - 1

    def found(self, blocks: list, every_match: bool) -> tuple[np.ndarray, list[set[str]], list[tuple]]:
        """Which words are hit, of each document the ids of the items, and (document, item, start, item's start, words) of the longest matches."""
        delta = np.zeros(len(self.array.words) + 1, np.int32)
        found: list[set[str]] = [set() for _ in self.counts]
        matches: list[tuple] = []
        for block in blocks:
            b = _unpacked(block.value, self.window)
            hit, win = self.places(b)
            if not len(hit):
                continue
            np.add.at(delta, hit, 1)
            np.add.at(delta, hit + b["length"][win], -1)
            owner = self.owner(hit)
            both = np.sort(owner * (len(b["length"]) + 1) + win)
            docs, wins = np.divmod(both[c.group_starts(both)], len(b["length"]) + 1)
            rank, which = _spread(b["bounds"][wins], b["bounds"][wins + 1])
            for d, i in {*zip(docs[which].tolist(), b["item"][rank].tolist(), strict=True)}:
                found[d].add(b["ids"][i])
            if every_match:
                matches += self._longest(b, hit, win, owner)
        return (np.cumsum(delta[:-1]) > 0)[self.at], found, matches

    def _longest(self, b: dict, hit: np.ndarray, win: np.ndarray, owner: np.ndarray) -> list[tuple]:
        """Of each document and item the longest match, the first of equal ones; some documents at a time."""
        out = []
        order = np.argsort(owner, kind="stable")
        hit, win, owner = hit[order], win[order], owner[order]
        n = np.cumsum(b["bounds"][win + 1] - b["bounds"][win])
        heads = c.group_starts(owner)
        i = 0
        while i < len(heads):
            before = n[heads[i] - 1] if heads[i] else 0
            j = max(i + 1, int(np.searchsorted(np.append(n[heads[1:] - 1], n[-1]), before + (1 << 20), "right")))
            part = slice(heads[i], heads[j] if j < len(heads) else len(hit))
            rank, which = _spread(b["bounds"][win[part]], b["bounds"][win[part] + 1])
            doc, place, item, at = owner[part][which], hit[part][which], b["item"][rank], b["place"][rank]
            k = np.lexsort((place, place - at, item, doc))
            doc, place, item, at = doc[k], place[k], item[k], at[k]
            new = np.ones(len(doc), bool)  # a run on one diagonal is one match
            new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] - at[1:] != place[:-1] - at[:-1]) | (place[1:] != place[:-1] + 1)
            run = np.flatnonzero(new)
            words = np.diff(np.append(run, len(doc))) - 1 + b["length"][win[part]][which][k][run]
            doc, place, item, at = doc[run], place[run] - (self.first[doc[run]] + doc[run]), item[run], at[run]
            k = np.lexsort((at, place, -words, item, doc))
            k = k[c.group_starts(doc[k].astype(np.int64) * (len(b["ids"]) + 1) + item[k])]
            out += [(d, b["ids"][x], p, q, w) for d, x, p, q, w in zip(*(v[k].tolist() for v in (doc, item, place, at, words)), strict=True)]
            i = j
        return out


FOUND = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_run long, items string"


def _judged(ids: pa.Array, counts: np.ndarray, hits: np.ndarray, first: np.ndarray, found: list[set[str]], threshold: int) -> pa.RecordBatch:
    sums = np.concatenate(([0], np.cumsum(hits)))
    n_hit = sums[first[1:]] - sums[first[:-1]]
    longest = np.zeros(len(counts), np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = np.flatnonzero(hits & ~np.concatenate(([False], hits[:-1] & (doc[1:] == doc[:-1])))) if len(hits) else np.zeros(0, np.int64)
    if len(start):
        np.maximum.at(longest, doc[start], np.diff(np.append(np.cumsum(hits)[start], hits.sum() + 1)))
    joined = [",".join(sorted(x)) for x in found]
    return pa.RecordBatch.from_arrays(
        [
            ids, pa.array(counts), pa.array(n_hit), pa.array([len(x) for x in found], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined], pa.string()),
            pa.array((n_hit > 0) & (threshold * n_hit >= counts)), pa.array(longest), pa.array(joined, pa.string()),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_run", "items"],
    )


def _passes(items: DataFrame, window: int, item_col: str, text_col: str, block_bytes: int, pass_bytes: int) -> list[list]:
    """Broadcasts of the blocks of test items, in passes of at most `pass_bytes` (or one block)."""
    sc = items.sparkSession.sparkContext
    out: list[list] = [[]]
    size, block, held = 0, [], 0

    def put() -> None:
        nonlocal size, block, held
        raw = _encoded(block, window)
        if out[-1] and size + len(raw) > pass_bytes:
            out.append([])
            size = 0
        out[-1].append(sc.broadcast(raw))
        size, block, held = size + len(raw), [], 0

    for r in items.select(F.col(item_col), F.col(text_col)).toLocalIterator():
        block.append((r[0], r[1]))
        held += len((r[1] or "").encode())
        if held >= block_bytes:
            put()
    if block:
        put()
    return out


#: Bytes of text in a shard; its arrays take some 25 times as much.
SHARD = 2 << 20


def _parts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from c.parts(batch, text, SHARD)
    c.release()


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, threshold: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 1 << 20, pass_bytes: int = 64 << 20) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated
    (threshold * n_hit >= n_words, and a hit), longest_run (words), items (ids, comma-joined)."""
    passes = _passes(items, window, item_col, item_text_col, block_bytes, pass_bytes)
    rows = c.bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if len(passes) == 1:
        (blocks,) = passes

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _parts(batches, "text"):
                shard = Shard(part.column(1), window)
                hits, found, _ = shard.found(blocks, False)
                yield _judged(part.column(0), shard.counts, hits, shard.first, found, threshold)

        return rows.mapInArrow(search, FOUND)
    return _united(rows, passes, window, threshold)


def _united(rows: DataFrame, passes: list[list], window: int, threshold: int) -> DataFrame:
    """The same of several passes: each puts out the hit words and items of the documents that it hits."""

    def search(blocks: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, "text"):
            shard = Shard(part.column(1), window)
            hits, found, _ = shard.found(blocks, False)
            some = [i for i, x in enumerate(found) if x]
            masks = [np.packbits(hits[shard.first[i] : shard.first[i + 1]]).tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([part.column(2).take(pa.array(some, pa.int64())), part.column(3).take(pa.array(some, pa.int64())), pa.array(masks, pa.binary()), pa.array([sorted(found[i]) for i in some], pa.list_(pa.string()))], ["k1", "k2", "hits", "items"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, "text"):
            buf, offsets = c.joined(part.column(1))
            _, _, first = c.words(c.LOWER[buf], offsets, c.ALNUM_WORD)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array(np.diff(first))], ["doc_id", "k1", "k2", "n_words"])

    def union(rows: pa.Table) -> pa.Table:
        """One document's passes."""
        hits = rows["hits"][0].as_py()
        for x in rows["hits"][1:]:
            hits = (np.frombuffer(hits, np.uint8) | np.frombuffer(x.as_py(), np.uint8)).tobytes()
        return pa.table({"k1": rows["k1"][:1], "k2": rows["k2"][:1], "hits": pa.array([hits], pa.binary()), "items": pa.array([sorted({i for x in rows["items"].to_pylist() for i in x})], pa.list_(pa.string()))})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(1).to_numpy()
            masks = [np.unpackbits(np.frombuffer(h, np.uint8), count=n).astype(bool) if h else np.zeros(n, bool) for n, h in zip(counts.tolist(), batch.column(2).to_pylist(), strict=True)]
            first = np.concatenate(([0], np.cumsum(counts)))
            yield _judged(batch.column(0), counts, np.concatenate([*masks, np.zeros(0, bool)]), first, [set(x or ()) for x in batch.column(3).to_pylist()], threshold)
        c.release()

    keyed = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit(c.SEED), "doc_id").alias("k2"))
    kind = "k1 long, k2 long, hits binary, items array<string>"
    found = None
    for blocks in passes:
        one = keyed.mapInArrow(lambda b, blocks=blocks: search(blocks, b), kind)
        found = one if found is None else found.union(one)
    first = F.any_value  # equal rows find the same, so one row of each pass will do
    once = found.groupBy("k1", "k2", F.xxhash64("hits", "items").alias("same")).agg(first("hits").alias("hits"), first("items").alias("items"))
    whole = once.groupBy("k1", "k2").applyInArrow(lambda t: union(t.select(["k1", "k2", "hits", "items"])), kind)
    counts = keyed.mapInArrow(counted, "doc_id long, k1 long, k2 long, n_words long")
    return counts.join(whole, ["k1", "k2"], "left").select("doc_id", "n_words", "hits", "items").mapInArrow(judge, FOUND)


def longest_matches(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 1 << 20, pass_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, item_id, start, item_start, n_words): of each document and item the longest verbatim match of `window` words
    or more (or of a whole shorter item), with the places of its first word from 0 on."""
    rows = c.bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for blocks in _passes(items, window, item_col, item_text_col, block_bytes, pass_bytes):

        def search(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            for part in _parts(batches, "text"):
                _, _, found = Shard(part.column(1), window).found(blocks, True)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([x[0] for x in found], pa.int64())), *(pa.array([x[i + 1] for x in found], k) for i, k in enumerate(kinds))], ["doc_id", "item_id", "start", "item_start", "n_words"])

        one = rows.mapInArrow(search, "doc_id long, item_id string, start long, item_start long, n_words long")
        out = one if out is None else out.union(one)
    return out


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 13, threshold: int = 20, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 1 << 20, pass_bytes: int = 64 << 20) -> DataFrame:
    """docs without those that are contaminated, all columns kept."""
    passes = _passes(items, window, item_col, item_text_col, block_bytes, pass_bytes)
    if len(passes) > 1:
        k1, k2 = c.unused("k1", docs), c.unused("k2", docs)
        keyed = docs.withColumns({k1: F.xxhash64(F.col(text_col)), k2: F.xxhash64(F.col(text_col), F.lit(c.SEED))})
        rows = keyed.select(F.col(k1).alias("doc_id"), F.col(text_col).alias("text"))
        bad = _united(rows, passes, window, threshold).where("contaminated").select(F.col("doc_id").alias("__bad"))
        return c.by_keys(keyed, bad, [(k1, "__bad")], "left_anti").select(*docs.columns)
    (blocks,), at = passes, docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, text_col):
            shard = Shard(part.column(at), window)
            hits, found, _ = shard.found(blocks, False)
            judged = _judged(pa.array(np.arange(part.num_rows)), shard.counts, hits, shard.first, found, threshold)
            yield part.filter(pc.invert(judged.column(5)))

    return c.bounded(docs).mapInArrow(clean, docs.schema)
