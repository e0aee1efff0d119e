"""Best-fit packing of documents into training sequences, on runs of equal length.

Documents are tokenized once and cut into pieces; pieces are range-sorted by length, longest
first, with a hash of their place to break ties, so that one frequent length spreads over many partitions.
Of each length, the longest first, all pieces ask at once for the smallest gap that takes them (the successor in
the sorted gaps); where more pieces want a gap than there are sequences with it, their rank in
the range-sorted order decides; gaps are updated and the rest asks again, and opens new
sequences where no gap is left. As lengths and gaps are integers up to the capacity, pieces of
one length and sequences of one gap are interchangeable: what is matched are runs (how many,
from which rank, into which sequences). So the matching is no distributed sweep over single rows, as the
bulk-synchronous method has it: the driver does it on a histogram of at most
`capacity` lengths, and the plan is a list of runs whose size does not depend on the number of
documents. Tasks look their pieces' ranks up in it.

A null text is empty and becomes its end token. Rows that share an id are separate documents.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

END = 2


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def _file(vocabulary: str) -> dict:
    with open(vocabulary, encoding="utf-8") as f:
        return json.load(f)


def special_tokens(vocabulary: str) -> list[str]:
    return [x["content"] for x in _file(vocabulary).get("added_tokens", [])]


def by_rank(vocabulary: str) -> bool:
    """Whether merging by a token's rank is what the file says: plain byte-level BPE, cut by the public pattern,
    whose i-th merge makes the i-th of the merged tokens."""
    file = _file(vocabulary)
    model, cut = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(x) for x in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
    cut = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space", True) and cut.get("use_regex", True)
    parts = (x.split(" ") if isinstance(x, str) else x for x in model["merges"])
    made = [model["vocab"]["".join(x)] for x in parts]
    return plain and cut and file.get("normalizer") is None and all(a < b for a, b in zip(made, made[1:], strict=False))


@cache
def encoder(vocabulary: str) -> Callable[[str], np.ndarray]:
    """text -> ids of a byte-level BPE vocabulary file of the `tokenizers` library.

    Its merges are given to a faster encoder of the same ids, if the file meets the condition for
    that (`by_rank`); else, and for texts that hold a special token, which is one id, the library itself
    encodes.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = cache(lambda: Tokenizer.from_file(vocabulary))  # most corpora never need it
    special, same = special_tokens(vocabulary), by_rank(vocabulary)
    letters = _byte_letters()
    ranks = {bytes(letters[x] for x in word): i for word, i in _file(vocabulary)["model"]["vocab"].items() if word not in special} if same else {}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) if same else None
    _file.cache_clear()

    def encode(text: str) -> np.ndarray:
        if fast is None or any(x in text for x in special):
            return np.array(exact().encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(vocabulary: str, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = encoder(vocabulary)
    kinds = (("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()))
    for batch in batches:
        for part in c.parts(batch, "text"):
            rows: list[tuple[int, ...]] = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(END)).astype("<u4")
                n = -(-len(ids) // capacity)
                stop = len(ids) - (n - 1) * capacity
                start = 0
                for k in range(n):
                    rows.append((doc, k, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
                    start, stop = stop, stop + capacity
            yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], [k for k, _ in kinds])
    c.release()


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of pieces, longest first: place of the first piece, its sequence (the next piece's is one more), offset in it."""
    place, first, offset = [], [], []
    at, opened = 0, 0
    gaps: list[int] = []  # sorted
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, how many)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect.bisect_left(gaps, length)
            if k == len(gaps):  # no successor: open as many as such pieces can fill, or else one
                n = max(1, left // (capacity // length))
                gap, start = capacity, opened
                opened += n
            else:
                gap = gaps[k]
                start, n = runs[gap].pop()
                if not runs[gap]:
                    gaps.pop(k)
            take = min(n, left)  # rank decides: the first `take` pieces get these sequences
            place.append(at)
            first.append(start)
            offset.append(capacity - gap)
            at, left = at + take, left - take
            for g, s, m in ((gap - length, start, take), (gap, start + take, n - take)):
                if g and m:
                    if not runs[g]:
                        bisect.insort(gaps, g)
                    runs[g].append((s, m))
    return np.array(place, np.int64), np.array(first, np.int64), np.array(offset, np.int64)


def _placed(runs: tuple[np.ndarray, np.ndarray, np.ndarray], before: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    at = before.get(TaskContext.get().partitionId(), 0)
    place, first, offset = runs
    for batch in batches:
        rank = np.arange(at, at + batch.num_rows)
        at += batch.num_rows
        k = np.searchsorted(place, rank, "right") - 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first[k] + rank - place[k]), pa.array(offset[k])], [*batch.schema.names, "sequence_id", "offset"])


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    vocabulary = vocabulary or default_vocabulary()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    texts = c.bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = c.checkpointed(texts.mapInArrow(lambda b: _pieces(vocabulary, capacity, b), schema))
    # Places in the checkpoint break ties, so that neither one length nor equal rows stay in one partition.
    order = [F.col("length").desc(), F.col("tie")]
    placed = pieces.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    ranked = c.checkpointed(placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    sizes = {r["p"]: r["n"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    runs = plan(counts, capacity)
    return ranked.mapInArrow(lambda b: _placed(runs, before, b), f"{schema}, sequence_id long, offset long")
