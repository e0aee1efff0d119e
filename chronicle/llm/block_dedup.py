"""Substring dedup with fixed-block anchors: words of passages that an earlier document has too.

Any `window` consecutive words hold a whole block of (window + 1) // 2 words that begins at a
multiple of that length in its own document. So:

1. Each chunk of documents sends the blocks it has at those fixed places (the index) and all its
   rolling windows of the same length (the probes), each different one once, as 32 bits beside
   the bucket's number.
2. A bucket tells which probes meet a block of another document (or of another place that may
   be one), and which blocks are met.
3. Hits are extended: each `window`-word run that holds a hit is compared by 96 bits of hashes,
   with the smallest doc_id that has it. Runs that a smaller doc_id has are removed; the
   union of the removed runs is the maximal repeat.

A block that every chunk holds is one entry in each chunk; of more than `fan` chunks, groups of so
many meet first and send it on once. Rows that are equal in id and text stand once, with their number,
where they are many. Nothing is capped.

Null texts have no words. Rows of one doc_id are one document as far as "smaller" goes. A null
doc_id counts as larger than any. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as c

LAST_ID = np.iinfo(np.int64).max


def _words(texts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of words, first words of documents, word hashes, doc_id of each document."""
    buf, offsets = c.joined(texts["text"])
    start, end, first = c.words(buf, offsets, c.PLAIN_WORD)
    ids = texts["doc_id"].combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    return buf, start, end, first, c.word_hashes(buf, start, end), ids


def _starts(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that have `length` words of their document from them on, and the number of their document."""
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(doc))
    ok = place + length <= first[1:][doc] if len(doc) else np.zeros(0, bool)
    return np.flatnonzero(ok), doc[ok]


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, heads and sizes of the groups of equal keys."""
    order = np.argsort(keys)
    heads = c.group_starts(keys[order])
    return order, heads, np.diff(np.append(heads, len(keys)))


#: A window's hashes, and the smallest doc_id that has it stands beside.
OWNER = np.dtype("<i8")


def _member(order: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each input's group."""
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.arange(len(heads)), sizes)
    return out


def _probed(rows: pa.Table) -> tuple[c.Bucket, np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's entries, the different ones, what is known of each (1: a fixed block, 2: of several owners), and each entry's group."""
    held = c.Bucket(rows, np.uint32, np.uint8)
    order, heads, sizes = _grouped(held.keys)
    kind = np.bitwise_or.reduceat(held.beside[order], heads) | 2 * (sizes > 1).astype(np.uint8)
    return held, held.keys[order[heads]], kind.astype(np.uint8), _member(order, heads, sizes)


def _probe_bucket(rows: pa.Table) -> pa.Table:
    """Step 2 for one bucket: which entries meet a block of the index elsewhere."""
    held, _, kind, member = _probed(rows)
    return held.answered((kind == 3)[member])


def _merge_probes(part: int, rows: pa.Table) -> pa.Table:
    held, keys, kind, _ = _probed(rows)
    return held.merged(part, keys, kind)


def _spread_probes(rows: pa.Table, code: np.ndarray) -> pa.Table:
    held, _, _, member = _probed(rows)
    return held.answered(code[member])


def _owned(rows: pa.Table) -> tuple[c.Bucket, np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's windows, the different ones, the smallest doc_id of each, and each window's group."""
    held = c.Bucket(rows, c.TWIN, OWNER)
    order, heads, sizes = c.twin_order(held.keys)
    return held, held.keys[order[heads]], np.minimum.reduceat(held.beside[order], heads), _member(order, heads, sizes)


def _window_bucket(rows: pa.Table) -> pa.Table:
    """Step 3 for one bucket: which windows a smaller doc_id of another chunk has."""
    if rows["bucket"][0].as_py() < 0:
        return rows.select(["chunk", "bucket", "a"])
    held, _, least, member = _owned(rows)
    return held.answered(held.beside > least[member])


def _merge_windows(part: int, rows: pa.Table) -> pa.Table:
    held, keys, least, _ = _owned(rows)
    return held.merged(part, keys, least)


def _spread_windows(rows: pa.Table, code: np.ndarray) -> pa.Table:
    held, _, least, member = _owned(rows)
    return held.answered((code[member] > 0) | (held.beside > least[member]))


def later_copies(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20, bucket_keys: int = 1 << 19, fan: int = c.FAN, most_copies: int = c.MOST_COPIES, with_text: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (the words left, joined by spaces)."""
    rows, total, n_chunks = c.chunked(docs, id_col, text_col, chunk_bytes, most_copies)
    block = (window + 1) // 2
    bits = c.bucket_bits(total // 5 + 1, bucket_keys)
    window_bits = c.bucket_bits(total // 20 + 1, bucket_keys)

    def entries(first: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at, doc = _starts(first, block)
        grams = c.Rolling(hashes, c.WORD_MULTIPLIER).window(block)[at] if len(at) else np.zeros(0, np.uint64)
        order, heads, sizes = _grouped(grams)
        return at, doc, grams, order, heads, sizes

    def index(chunk: pa.Table) -> pa.Table:
        texts = c.in_order(chunk)
        _, _, _, first, hashes, ids = _words(texts)
        at, doc, grams, order, heads, sizes = entries(first, hashes)
        keys = grams[order][heads]
        if not len(keys):
            return c.slices(0, keys, 0, keys)
        fixed = ((at - first[doc]) % block == 0)[order].astype(np.uint8)
        owner = ids[doc][order]
        kind = np.maximum.reduceat(fixed, heads) + 2 * (np.minimum.reduceat(owner, heads) < np.maximum.reduceat(owner, heads))
        return c.slices(chunk["chunk"][0].as_py(), keys, bits, (keys >> np.uint64(32 - bits)).astype(np.uint32), kind.astype(np.uint8))

    def candidates(n: int, first: np.ndarray, at: np.ndarray, order: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Windows that hold a hit."""
        hit = np.zeros(n + 1, np.int64)
        hit[at[order[np.repeat(code > 0, sizes)]]] = 1
        sums = np.concatenate(([0], np.cumsum(hit)))
        begin, _ = _starts(first, window)
        return begin[sums[begin + window - block + 1] > sums[begin]]

    def compared(begin: np.ndarray, hashes: np.ndarray, doc_of: np.ndarray) -> tuple[np.ndarray, ...]:
        """The different windows of those begins, sorted, with all windows' order, group sizes and owners, and each one's least owner."""
        keys = c.Twin(hashes, c.WORD_MULTIPLIER, c.mix(hashes)).spans(begin, begin + window) if len(begin) else np.zeros(0, c.TWIN)
        order, heads, sizes = c.twin_order(keys)
        owner = doc_of[order]
        least = np.minimum.reduceat(owner, heads) if len(heads) else owner
        return keys[order[heads]], order, sizes, owner, least

    def owners(first: np.ndarray, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return ids[np.searchsorted(first, begin, "right") - 1]

    def extended(texts: pa.Table, flags: pa.Table) -> pa.Table:
        if not len(texts) or not len(flags):
            return c.slices(0, np.zeros(0, np.uint64), 0, np.zeros(0, c.TWIN))
        chunk = texts["chunk"][0].as_py()
        texts = c.in_order(texts)
        _, _, _, first, hashes, ids = _words(texts)
        at, _, grams, order, heads, sizes = entries(first, hashes)
        code = c.answers(grams[order][heads], bits, zip(flags["bucket"].to_pylist(), flags["a"].to_pylist(), strict=True))
        begin = candidates(len(hashes), first, at, order, sizes, code)
        keys, _, _, _, least = compared(begin, hashes, owners(first, ids, begin))
        mask = np.zeros(len(hashes), bool)
        mask[begin] = True
        return pa.concat_tables([c.slices(chunk, keys["h"].copy(), window_bits, keys, least.astype(OWNER)), c.passed(chunk, np.packbits(mask).tobytes())])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, copies long" + ", kept string" * with_text

    def removed(texts: pa.Table, flags: pa.Table) -> pa.Table:
        texts = c.in_order(texts)
        buf, start, end, first, hashes, ids = _words(texts)
        own = list(zip(flags["bucket"].to_pylist(), flags["a"].to_pylist(), strict=True))
        raw = next((r for b, r in own if b < 0), b"")
        begin = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), count=len(hashes))) if raw else np.zeros(0, np.int64)
        keys, order, sizes, owner, least = compared(begin, hashes, owners(first, ids, begin))
        code = c.answers(keys["h"].copy(), window_bits, ((b, r) for b, r in own if b >= 0))
        hit = begin[order[np.repeat(code > 0, sizes) | (owner > np.repeat(least, sizes))]]
        gone = c.covered(len(hashes), hit, hit + window)
        out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept")}
        data = buf.tobytes()
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            keep = np.flatnonzero(~gone[a:b]) + a
            kept = b" ".join([data[x:y] for x, y in zip(start[keep].tolist(), end[keep].tolist(), strict=True)])
            out["n_words"].append(b - a)
            out["n_removed"].append(b - a - len(keep))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["kept"].append(kept.decode("utf-8", "replace"))
        cols = [texts["doc_id"], pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), texts["copies"]]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "copies"]
        return pa.Table.from_arrays(cols + [pa.array(out["kept"], pa.string())] * with_text, names + ["kept"] * with_text)

    by_chunk = rows.groupBy("chunk")
    probed = c.scanned(by_chunk.applyInArrow(index, c.CHUNKS), n_chunks, _probe_bucket, _merge_probes, _spread_probes, fan)
    judged = c.scanned(by_chunk.cogroup(probed.groupBy("chunk")).applyInArrow(extended, c.CHUNKS), n_chunks, _window_bucket, _merge_windows, _spread_windows, fan)
    return c.each_copy(by_chunk.cogroup(judged.groupBy("chunk")).applyInArrow(removed, schema))
