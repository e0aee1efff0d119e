"""Suffix-array dedup: bytes inside long strings that occur twice, by a logarithmic family of suffix arrays.

A corpus-wide array of every suffix would be eight times the corpus, so the arrays are sparse:
a suffix enters when its first HALF bytes have the smallest hash among the HALF-byte strings of
some `length`-byte window (a minimizer). Equal windows choose equal places, so every repeat of
`length` bytes meets itself in the arrays; about one suffix in fifty enters.

1. Each chunk of documents makes the suffix array of its sampled suffixes, ordered by the
   fingerprint of the whole stretch whose windows chose the suffix. Equal entries of a chunk count as one. A second,
   smaller array has the fingerprints of the suffixes' first HALF bytes, each with the least and greatest stretch it begins.
2. The entries go to buckets, which are ranges of those orders. In a bucket of stretches new batches are
   merge-scanned against the levels of a `LevelFamily` for long matches, and levels of equal
   size merge. A stretch found twice is a repeat as a whole. A bucket of prefixes only tells which of them begin several
   stretches. One copy of each stretch with such a prefix goes on to step 3. A line that all documents have among
   different texts is one prefix of as many stretches as documents; they are spread over all buckets, and each chunk sends the
   prefix twice at most.
3. The windows of those stretches are compared one by one (the exact check: matches end
   somewhere inside these).
4. Each chunk removes the bytes that repeated windows cover.

Chunks, buckets and batches have bounded sizes: a string that every chunk holds is one entry in each
chunk, of more than `fan` chunks groups of so many meet first and send it on once, and a level has it
once. Rows that are equal in id and text stand once, with their number, where they are many.
Comparison is by fingerprints of 96 bits.

Null texts are empty. Texts shorter than `length` lose nothing. Rows that share an id are
separate documents. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as c

REPEATED, SENT = 1, 2
#: A prefix's fingerprint, and the first one of a stretch that it begins.
PREFIX = np.dtype([("p", "<u8"), ("h", "<u8")])


def _stretches(buf: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, c.Twin, np.ndarray, np.ndarray, np.ndarray]]:
    """By segment: its place, its hashes, and of each sampled suffix the first and last window that chose it and its own place."""
    half = length // 2
    width = length - half + 1
    n = len(buf)
    for at in range(0, max(0, n - length + 1), c.SEGMENT):
        part = buf[at : at + c.SEGMENT + length - 1]
        rolling = c.Twin(c.BYTE_TABLE[part], c.MULTIPLIER, c.SECOND_TABLE[part])
        keys = rolling.first.window(half)
        bits = np.uint64(max(1, int(len(keys)).bit_length()))
        low = ((keys >> bits) << bits) | np.arange(len(keys), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < width:
            low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
        place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        windows = len(place)
        # windows that would run over the end of their document
        ends = offsets[1:] - at
        ends = ends[(ends > 0) & (ends - length + 1 < windows)]
        bad = np.zeros(windows + 1, np.int32)
        np.add.at(bad, np.clip(ends - length + 1, 0, windows), 1)
        np.add.at(bad, np.minimum(ends, windows), -1)
        place[np.cumsum(bad[:windows]) > 0] = -1
        first = c.group_starts(place)
        last = np.append(first[1:], windows) - 1
        keep = place[first] >= 0
        yield at, rolling, first[keep], last[keep], place[first[keep]]


def _entries(buf: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all sampled suffixes: fingerprints of prefix and stretch, and the stretch's first and last window."""
    out: list[tuple[np.ndarray, ...]] = []
    for at, rolling, first, last, place in _stretches(buf, offsets, length):
        prefix = rolling.first.spans(place, place + length // 2)
        whole = rolling.spans(first, last + length)
        out.append((prefix, whole, first + at, last + at))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, c.TWIN, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _array(whole: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sparse suffix array without equal entries, their counts, each input's entry, and the first input of each."""
    order, heads, _ = c.twin_order(whole)
    return whole[order[heads]], np.add.reduceat(copies[order], heads) if len(heads) else np.zeros(0, np.int64), _member(order, heads), order[heads]


def _prefixes(prefix: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """Each prefix once, if it begins one stretch only, and else twice: with the least and the greatest."""
    order = np.lexsort((stretch, prefix))
    p, h = prefix[order], stretch[order]
    heads = c.group_starts(p)
    tails = np.append(heads[1:], len(p))[: len(heads)] - 1
    several = h[heads] != h[tails]
    at = np.sort(np.concatenate((heads, tails[several])))
    out = np.empty(len(at), PREFIX)
    out["p"], out["h"] = p[at], h[at]
    return out


class LevelFamily:
    """Sorted levels of sparse suffixes; sizes grow geometrically, as the digits of a binary counter."""

    def __init__(self, n: int) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.repeated = np.zeros(n, bool)
        self.stands = np.zeros(n, bool)

    def add(self, whole: np.ndarray, ids: np.ndarray) -> None:
        """Takes a batch in: its suffix array, a merge-scan against each level, and merges."""
        order, heads, sizes = c.twin_order(whole)
        self.repeated[ids[order]] |= np.repeat(sizes > 1, sizes)
        whole, ids = whole[order[heads]], ids[order[heads]]
        known = np.zeros(len(ids), bool)
        for level, own in self.levels:
            at = np.searchsorted(level["h"], whole["h"])
            todo = np.flatnonzero(at < len(level))
            while len(todo):  # more than once round only for contents that share a first hash
                todo = todo[level["h"][at[todo]] == whole["h"][todo]]
                same = level["x"][at[todo]] == whole["x"][todo]
                known[todo[same]] = True
                self.repeated[own[at[todo[same]]]] = True
                todo = todo[~same]
                at[todo] += 1
                todo = todo[at[todo] < len(level)]
        self.repeated[ids[known]] = True
        if not known.all():
            self.stands[ids[~known]] = True
            level, own = whole[~known], ids[~known]
            while self.levels and len(self.levels[-1][0]) <= 2 * len(level):
                other, others = self.levels.pop()
                level, own = np.concatenate((level, other)), np.concatenate((own, others))
                order = np.lexsort((level["x"], level["h"]))
                level, own = level[order], own[order]
            self.levels.append((level, own))


def _scan_stretches(batch: int, rows: pa.Table) -> pa.Table:
    """Step 2 for a bucket of stretches: which occur again, and which entry stands for its equals."""
    held = c.Bucket(rows, c.TWIN, np.uint8)
    family, cuts, start = LevelFamily(len(held.keys)), held.cuts, 0
    while start < len(held.keys):  # whole chunks, until a batch is full
        stop = int(cuts[min(np.searchsorted(cuts, start + batch), len(cuts) - 1)])
        family.add(held.keys[start:stop], np.arange(start, stop))
        start = stop
    return held.answered((family.repeated | (held.beside > 1)) * REPEATED + family.stands * SENT)


def _spread_stretches(rows: pa.Table, code: np.ndarray) -> pa.Table:
    """A group's answers to its chunks: of equal entries the first one alone stands."""
    held = c.Bucket(rows, c.TWIN, np.uint8)
    _, _, member, first = _array(held.keys, held.beside.astype(np.int64))
    out = code[member]
    others = np.ones(len(member), bool)
    others[first] = False
    out[others] &= REPEATED
    return held.answered(out)


def _several(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of prefixes with stretches: each entry's prefix, by number, and whether that begins several."""
    order = np.lexsort((keys["h"], keys["p"]))
    p, h = keys["p"][order], keys["h"][order]
    heads = c.group_starts(p)
    tails = np.append(heads[1:], len(p))[: len(heads)] - 1
    return _member(order, heads), h[heads] != h[tails]


def _scan_prefixes(rows: pa.Table) -> pa.Table:
    held = c.Bucket(rows, PREFIX, np.uint8)
    member, several = _several(held.keys)
    return held.answered(several[member] * SENT)


def _merge_prefixes(part: int, rows: pa.Table) -> pa.Table:
    held = c.Bucket(rows, PREFIX, np.uint8)
    keys = _prefixes(held.keys["p"], held.keys["h"])
    return held.merged(part, keys, np.ones(len(keys), np.uint8))


def _spread_prefixes(rows: pa.Table, code: np.ndarray) -> pa.Table:
    """The merged entries stand in the order of the prefixes, one or two for each."""
    held = c.Bucket(rows, PREFIX, np.uint8)
    merged = _prefixes(held.keys["p"], held.keys["h"])
    return held.answered(code[np.searchsorted(merged["p"], held.keys["p"])])


def _counted(held: c.Bucket) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order and heads of the windows of a bucket, and how often each occurs."""
    order, heads, _ = c.twin_order(held.keys)
    return order, heads, np.add.reduceat(held.beside[order].astype(np.int64), heads)


def _member(order: np.ndarray, heads: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    return out


def _scan_windows(rows: pa.Table) -> pa.Table:
    """Step 3 for one bucket; rows that only pass through have buckets below 0."""
    if rows["bucket"][0].as_py() < 0:
        return rows.select(["chunk", "bucket", "a"])
    held = c.Bucket(rows, c.TWIN, np.uint8)
    order, heads, n = _counted(held)
    return held.answered((n > 1)[_member(order, heads)])


def _merge_windows(part: int, rows: pa.Table) -> pa.Table:
    held = c.Bucket(rows, c.TWIN, np.uint8)
    order, heads, n = _counted(held)
    return held.merged(part, held.keys[order[heads]], np.minimum(n, 2).astype(np.uint8))


def _spread_windows(rows: pa.Table, code: np.ndarray) -> pa.Table:
    held = c.Bucket(rows, c.TWIN, np.uint8)
    order, heads, _ = _counted(held)
    return held.answered(code[_member(order, heads)])


def _windows(found: tuple[np.ndarray, ...], member: np.ndarray, code: np.ndarray, buf: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of sent stretches."""
    places, hashes = [], []
    sent = (code[member] & SENT) > 0
    i = 0
    for at, rolling, first, last, _ in _stretches(buf, offsets, length):
        own = sent[i : i + len(first)]
        i += len(first)
        n = (last - first + 1)[own]
        if n.sum():
            p = np.repeat(first[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            places.append(p + at)
            hashes.append(rolling.spans(p, p + length))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, c.TWIN)
    return np.concatenate(places), np.concatenate(hashes)


def repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20, bucket_keys: int = 1 << 17, batch: int = 4096, fan: int = c.FAN, most_copies: int = c.MOST_COPIES, with_text: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (binary)."""
    assert length >= 2
    rows, total, n_chunks = c.chunked(docs, id_col, text_col, chunk_bytes, most_copies)
    bits = c.bucket_bits(total // 50 + 1, bucket_keys)
    window_bits = c.bucket_bits(total // 8 + 1, 8 * bucket_keys)
    above = 1 << bits  # buckets of prefixes come after those of stretches

    def read(chunk: pa.Table) -> tuple:
        """A chunk's documents, bytes, where each begins, the sampled suffixes, their array, counts, each suffix's entry, and the prefixes."""
        texts = c.in_order(chunk)
        buf, offsets = c.joined(texts["text"])
        found = _entries(buf, offsets, length)
        copies = np.minimum(texts["copies"].to_numpy(), 2)
        entries, n, member, first = _array(found[1], copies[np.searchsorted(offsets, found[2], "right") - 1])
        return texts, buf, offsets, found, copies, entries, n, member, found[0][first]

    def arrays(chunk: pa.Table) -> pa.Table:
        *_, entries, n, _, prefix = read(chunk)
        number, keys = chunk["chunk"][0].as_py(), _prefixes(prefix, entries["h"])
        stretches = c.slices(number, entries["h"].copy(), bits, entries, np.minimum(n, 2).astype(np.uint8))
        prefixes = c.slices(number, keys["p"].copy(), bits, keys, np.ones(len(keys), np.uint8))
        moved = pa.array(prefixes["bucket"].to_numpy() + np.int32(above), pa.int32())
        return pa.concat_tables([stretches, prefixes.set_column(1, "bucket", moved)])

    def scan(rows: pa.Table) -> pa.Table:
        return _scan_prefixes(rows) if rows["bucket"][0].as_py() >= above else _scan_stretches(batch, rows)

    def merge(part: int, rows: pa.Table) -> pa.Table:
        return (_merge_prefixes if rows["bucket"][0].as_py() >= above else _merge_windows)(part, rows)

    def spread(rows: pa.Table, code: np.ndarray) -> pa.Table:
        return (_spread_prefixes if rows["bucket"][0].as_py() >= above else _spread_stretches)(rows, code)

    def told(flags: pa.Table) -> list[tuple[int, bytes]]:
        return list(zip(flags["bucket"].to_pylist(), flags["a"].to_pylist(), strict=True))

    def windows(texts: pa.Table, flags: pa.Table) -> pa.Table:
        if not len(texts) or not len(flags):
            return c.slices(0, np.zeros(0, np.uint64), 0, np.zeros(0, c.TWIN))
        chunk = texts["chunk"][0].as_py()
        _, buf, offsets, found, _, entries, _, member, prefix = read(texts)
        own = told(flags)
        code = c.answers(entries["h"].copy(), bits, ((b, r) for b, r in own if b < above))
        keys = _prefixes(prefix, entries["h"])
        several = c.answers(keys["p"].copy(), bits, ((b - above, r) for b, r in own if b >= above))
        code[several[np.searchsorted(keys["p"], prefix)] == 0] &= REPEATED
        _, hashes = _windows(found, member, code, buf, offsets, length)
        order, heads, _ = c.twin_order(hashes)
        hashes = hashes[order[heads]]
        return pa.concat_tables([c.slices(chunk, hashes["h"].copy(), window_bits, hashes), c.passed(chunk, code.tobytes())])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copies long" + ", kept binary" * with_text

    def removed(texts: pa.Table, flags: pa.Table) -> pa.Table:
        texts, buf, offsets, found, copies, entries, _, member, _ = read(texts)
        own = told(flags)
        code = next((np.frombuffer(r, np.uint8) for b, r in own if b < 0), np.zeros(len(entries), np.uint8))
        whole = (code[member] & REPEATED) > 0
        places, hashes = _windows(found, member, code, buf, offsets, length)
        order, heads, sizes = c.twin_order(hashes)
        n = np.add.reduceat(copies[np.searchsorted(offsets, places[order], "right") - 1], heads) if len(heads) else sizes
        twice = c.answers(hashes["h"][order[heads]], window_bits, ((b, r) for b, r in own if b >= 0)) > 0
        hit = places[order[np.repeat(twice | (n > 1), sizes)]]
        gone = c.covered(len(buf), np.concatenate([found[2][whole], hit]), np.concatenate([found[3][whole], hit]) + length)
        lost = np.concatenate(([0], np.cumsum(gone)))
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            cut = int(lost[b] - lost[a])
            kept = buf[a:b][~gone[a:b]].tobytes() if cut else buf[a:b].tobytes()
            out["n_bytes"].append(b - a)
            out["n_removed"].append(cut)
            out["n_spans"].append(len(c.runs(gone[a:b])[0]) if cut else 0)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["kept"].append(kept)
        cols = [texts["doc_id"], *(pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")), pa.array(out["kept_sha256"], pa.string()), texts["copies"]]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "copies"]
        return pa.Table.from_arrays(cols + [pa.array(out["kept"], pa.binary())] * with_text, names + ["kept"] * with_text)

    by_chunk = rows.groupBy("chunk")
    first = c.scanned(by_chunk.applyInArrow(arrays, c.CHUNKS), n_chunks, scan, merge, spread, fan)
    second = c.scanned(by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(windows, c.CHUNKS), n_chunks, _scan_windows, _merge_windows, _spread_windows, fan)
    return c.each_copy(by_chunk.cogroup(second.groupBy("chunk")).applyInArrow(removed, schema))
