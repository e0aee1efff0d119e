"""Periodic runs of words, by probing a harmonic grid: stretches that repeat one passage again and again.

A run is a stretch of words with smallest period q (words q apart are identical) of at least
max(`least`, `power` * q) words that no neighbouring word extends with that period. In such a stretch words
q apart are identical at (power - 1) * q places in a row or more, and so at power - 1 multiples of q in a row. So:

1. For each period p up to n / power the words at jp and (j+1)p are compared, for all j; that is n / p tests a
   period and about n ln n altogether. Only places where power - 1 tests in a row succeed survive.
2. A survivor is extended to both sides by comparing the words' array with itself p words on, in chunks.
3. Periods go upwards. A run of period q has all multiples of q as periods too; grid points inside a run whose
   period divides p belong to it (a stretch of period p that shares p words with it lies in it), and are skipped, as are
   those inside a run that this period has found.

Words `[^\\x20\\x09-\\x0D]+` are numbered by a dictionary of their bytes, so comparisons are exact. One document is
read by one task; its memory is a few times its words. Nothing is capped.

Null and empty texts have no words and no runs. Rows are separate documents, whatever they share. Other columns are
ignored by `digests` and `runs` and kept by `collapsed`. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

LEAST, POWER = 6, 4
#: Documents of up to so many words read their grid from one table; longer ones make it period by period.
GRID = 1 << 15
_GRIDS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

Run = tuple[int, int, int]  # first word, number of words, period
#: Of a document's id and number of words: which of its words stands at each place; None: as they are.
Tail = Callable[[int | None, int], np.ndarray | None]


def _grid(n: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """The last of each `power` grid points in a row below n, with its period, by place."""
    size = 1 << max(6, int(n).bit_length())
    if (size, power) not in _GRIDS:
        ends = [np.arange((power - 1) * p, size, p, dtype=np.int32) for p in range(1, size // power + 1)]
        at, period = np.concatenate(ends), np.repeat(np.arange(1, len(ends) + 1, dtype=np.int32), [len(x) for x in ends])
        order = np.argsort(at, kind="stable")
        _GRIDS[size, power] = at[order], period[order]
    at, period = _GRIDS[size, power]
    k = int(np.searchsorted(at, n))
    return at[:k], period[:k]


def _survivors(ids: np.ndarray, power: int) -> Iterator[tuple[int, np.ndarray]]:
    """By period, upwards: the grid points from which power - 1 tests in a row succeed."""
    n = len(ids)
    if n <= GRID:
        at, period = _grid(n, power)
        for back in range(power - 1):
            hit = ids[at - back * period] == ids[at - (back + 1) * period]
            at, period = at[hit], period[hit]
        fits = period * power <= n
        at, period = (at - (power - 1) * period)[fits], period[fits]
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        cuts = [*c.group_starts(period).tolist(), len(at)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(period[a]), at[a:b].astype(np.int64)
        return
    for p in range(1, n // power + 1):
        column = ids[::p]
        same = column[1:] == column[:-1]
        width = len(same) - power + 2
        hit = same[:width].copy()
        for k in range(1, power - 1):
            hit &= same[k : k + width]
        if hit.any():
            yield p, np.flatnonzero(hit) * p


def _reach(ids: np.ndarray, p: int, at: int) -> tuple[int, int]:
    """From where to where words are as those p words on, around a place where they are; compared in growing chunks."""
    n, hi, lo, size = len(ids) - p, at, at, 16
    while hi < n:
        differs = ids[hi : min(hi + size, n)] != ids[hi + p : min(hi + size, n) + p]
        if differs.any():
            hi += int(differs.argmax())
            break
        hi, size = hi + len(differs), min(2 * size, 4096)
    size = 16
    while lo > 0:
        first = max(0, lo - size)
        differs = ids[first:lo] != ids[first + p : lo + p]
        if differs.any():
            lo -= int(differs[::-1].argmax())
            break
        lo, size = first, min(2 * size, 4096)
    return lo, hi


def find(ids: np.ndarray, least: int = LEAST, power: int = POWER) -> list[Run]:
    """All runs of an array of numbered words, by start and period."""
    assert power >= 2
    found: list[Run] = []
    for p, points in _survivors(ids, power):
        own = sorted((s, s + n) for s, n, q in found if p % q == 0)
        if own:
            starts, ends = np.array([s for s, _ in own]), np.maximum.accumulate([e for _, e in own])
            k = np.searchsorted(starts, points, "right") - 1
            points = points[(k < 0) | (ends[k] <= points + p)]
        i = 0
        while i < len(points):
            lo, hi = _reach(ids, p, int(points[i]))
            i = int(np.searchsorted(points, hi))  # the others up to there are in the same stretch
            if hi - lo + p >= max(least, power * p) and not any(s <= lo and hi + p <= e for s, e in own):
                found.append((lo, hi - lo + p, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(n: int, found: list[Run]) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    return c.covered(n, np.array([s + q for s, _, q in found], np.int64), np.array([s + m for s, m, _ in found], np.int64))


def strongest(found: list[Run]) -> Run | None:
    """The run with the greatest exponent; of several the first, then that of the least period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _each(batch: pa.RecordBatch, least: int, power: int, tail: Tail | None = None) -> Iterator[tuple[int, list[bytes], list[Run]]]:
    """Row, words and runs of the documents of a batch (id, text)."""
    row = 0
    for part in c.parts(batch, batch.schema.names[1]):
        every = [x.split() if x else [] for x in part.column(1).cast(pa.large_binary()).to_pylist()]  # of bytes: at just those six
        numbered = pa.array([w for words in every for w in words], pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        at = 0
        for key, words in zip(part.column(0).to_pylist(), every, strict=True):
            ids = numbered[at : at + len(words)]
            at += len(words)
            if tail is not None and (moved := tail(key, len(words))) is not None:
                ids, words = ids[moved], [words[i] for i in moved.tolist()]
            yield row, words, find(ids, least, power) if len(ids) >= least else []
            row += 1


def planted_tail(key: int | None, n: int) -> np.ndarray | None:
    """For tests of whole tables: one document in ten gets a periodic end, as its id's checksum says; a null id none."""
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def digests(docs: DataFrame, least: int = LEAST, power: int = POWER, tail: Tail | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_runs, the strongest run's start, length, period and exponent_milli, runs_sha256, collapsed_sha256."""
    kinds = {"doc_id": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, words, found in _each(batch, least, power, tail):
                s, m, q = strongest(found) or (None, None, None)
                said = "".join(f"{a},{b},{p}\n" for a, b, p in found)
                kept = [words[i] for i in np.flatnonzero(~dropped(len(words), found)).tolist()] if found else words
                rows.append((len(found), s, m, q, 1000 * m // q if found else None, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(list(kinds.values())[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], list(kinds))
        c.release()

    schema = ", ".join(f"{n} {'long' if k == pa.int64() else 'string'}" for n, k in kinds.items())
    return c.bounded(docs).select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def runs(docs: DataFrame, least: int = LEAST, power: int = POWER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each run: doc_id, start, length, period (in words), passage (its first period, joined by spaces)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, out = batch.column(0).to_pylist(), []
            for row, words, found in _each(batch, least, power):
                out += [(keys[row], s, m, q, b" ".join(words[s : s + q]).decode("utf-8", "replace")) for s, m, q in found]
            kinds = (*(pa.int64(),) * 4, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["doc_id", "start", "length", "period", "passage"])

    return c.bounded(docs).select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, start long, length long, period long, passage string")


def collapsed(docs: DataFrame, least: int = LEAST, power: int = POWER, text_col: str = "text") -> DataFrame:
    """The documents, all columns kept; of those with runs the text keeps each run's first period, its words joined by one space."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(place)], ["id", "text"])
            for row, words, found in _each(pair, least, power):
                if found:
                    gone = dropped(len(words), found)
                    texts[row] = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode("utf-8", "replace")
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
        c.release()

    return c.bounded(docs).mapInArrow(run, docs.schema)
