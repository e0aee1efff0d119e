"""Both repeat removers against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from chronicle.llm import common
from chronicle.llm.block_dedup import later_copies
from chronicle.llm.suffix_dedup import repeats


def brute_bytes(docs, length):
    seen = defaultdict(int)
    for _, t in docs:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]] += 1
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_words(docs, window):
    owner = {}
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            owner[k] = min(owner.get(k, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if owner[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    r = random.Random(seed)
    vocab = ["ä" + "".join(r.choices("abcdef", k=r.randint(1, 5))) for _ in range(60)]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", " ", "\n", "  ", "\t", " "]) for _ in range(n))
    passages = [text(r.randint(5, 60)) for _ in range(6)]
    docs = []
    for i in range(70):
        parts = [text(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(passages)[r.randint(0, 9) :], text(r.randint(0, 9))]
        docs.append((i * 7 % 71, "".join(parts)))
    docs += [(100, None), (101, ""), (102, "a" * 300), (103, "x"), (104, docs[3][1]), (105, docs[3][1]), (106, "ab" * 150), (107, text(900))]
    docs += [(104, docs[3][1]), (108, docs[5][1][:-3])]  # a repeated row, a near copy
    return docs


@pytest.mark.parametrize("seed,length,chunk", [(1, 40, 2000), (2, 41, 100000), (3, 200, 900)])
def test_bytes(spark, seed, length, chunk):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, chunk int, bucket string")
    got = sorted(map(tuple, repeats(df, length, chunk_bytes=chunk, batch=50).collect()), key=repr)
    assert got == brute_bytes(docs, length)
    assert got == sorted(map(tuple, repeats(df, length, chunk_bytes=1500, batch=50, fan=3, most_copies=1).collect()), key=repr)
    assert any(r[2] for r in got) and any(not r[2] for r in got)


@pytest.mark.parametrize("seed,window,chunk", [(1, 13, 2000), (2, 13, 100000), (3, 4, 900), (4, 1, 3000)])
def test_words(spark, seed, window, chunk):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, chunk int")
    got = sorted(map(tuple, later_copies(df, window, chunk_bytes=chunk).collect()), key=repr)
    assert got == brute_words(docs, window)
    assert got == sorted(map(tuple, later_copies(df, window, chunk_bytes=1500, fan=3, most_copies=1).collect()), key=repr)
    assert any(r[2] for r in got) and any(not r[2] for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats(df).count() == 0 and later_copies(df).count() == 0
    df = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert repeats(df).count() == 2 and later_copies(df).count() == 2


def test_texts_longer_than_a_segment(spark):
    r = random.Random(12)
    long = "".join(r.choices("abcdefgh ij\nklm ", k=1_300_000))
    edge = common.SEGMENT
    docs = [(5, long), (6, "x " + long[edge - 150 : edge + 90] + " y"), (7, long[edge - 199 : edge + 1][1:] + "?"), (3, long[2 * edge - 700 : 2 * edge + 700]), (9, "ß" * 400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    seen, raws = defaultdict(int), {d: t.encode() for d, t in docs}
    for raw in raws.values():
        for i in range(len(raw) - 199):
            seen[hash(raw[i : i + 200])] += 1
    want = {}
    for d, raw in raws.items():
        gone = bytearray(len(raw))
        last = 0
        for i in range(len(raw) - 199):
            if seen[hash(raw[i : i + 200])] > 1:
                for j in range(max(i, last), i + 200):
                    gone[j] = 1
                last = i + 200
        want[d] = (sum(gone), hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    got = {x["doc_id"]: (x["n_removed"], x["kept_sha256"]) for x in repeats(df).collect()}
    assert got == want and want[5][0] > 1400 and want[6][0] == 240 and want[7][0] == 0 and want[9][0] == 800
    assert sorted(map(tuple, later_copies(df).collect())) == brute_words(docs, 13)


def test_many_equal_rows(spark):
    """Rows equal in id and text, null ids among them, stand once; each still gets its row."""
    r = random.Random(5)
    text = " ".join(f"w{r.randint(0, 99)}" for _ in range(80))
    docs = [(1, text)] * 40 + [(None, text)] * 30 + [(2, None)] * 9 + [(3, "x " + text[:230])] + [(4, " ".join(f"v{i}" for i in range(90)))] * 5
    df = spark.createDataFrame([(d, t, 3) for d, t in docs], "doc_id long, text string, copies int")
    assert sorted(map(tuple, repeats(df, most_copies=4).collect()), key=repr) == brute_bytes(docs, 200)
    want = [(None if d == 10**9 else d, *x) for d, *x in brute_words([(10**9 if d is None else d, t) for d, t in docs], 13)]
    assert sorted(map(tuple, later_copies(df, most_copies=4).collect()), key=repr) == sorted(want, key=repr)


def test_a_line_among_different_texts(spark):
    """One line of 150 bytes in all documents, among different texts, is one prefix of as many stretches; no bucket gets them all."""
    import pyarrow as pa

    from chronicle.llm import suffix_dedup

    r = random.Random(21)
    line = "".join(r.choices("abcdefghij klmnop", k=150))
    some = lambda n: "".join(r.choices("qrstuvwxyz 0123456789", k=n))
    docs = [(i, some(r.randint(100, 300)) + line + some(r.randint(100, 300))) for i in range(1200)]
    docs += [(2000 + i, some(60) + t[80:420] + some(60)) for i, t in docs[:40]]  # passages that do repeat
    docs = [(i, t) for i, t in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sizes, scanned = [], common.scanned

    def measured(entries, *args):
        held = common.checkpointed(entries)
        sizes.append([(x["bucket"], x["n"]) for x in held.groupBy("bucket").agg({"a": "count"}).join(held.selectExpr("bucket", "octet_length(a) AS n").groupBy("bucket").sum("n").withColumnRenamed("sum(n)", "n"), "bucket").select("bucket", "n").collect()])
        return scanned(held, *args)

    suffix_dedup.c.scanned = measured
    try:
        got = sorted(map(tuple, repeats(df, chunk_bytes=20_000).collect()), key=repr)
    finally:
        suffix_dedup.c.scanned = scanned
    assert got == brute_bytes(docs, 200)
    entries = sum(n for b, n in sizes[0] if b < 512) // common.TWIN.itemsize
    prefixes = {b: n // suffix_dedup.PREFIX.itemsize for b, n in sizes[0] if b >= 512}
    assert entries > 1200 and max(n for b, n in sizes[0] if b < 512) // common.TWIN.itemsize < entries / 20
    assert 0 < max(prefixes.values()) <= 2 * -(-sum(len(t) for _, t in docs) // 20_000) + 60
    buf, offsets = common.joined(pa.array([t for _, t in docs]))
    prefix, whole, *_ = suffix_dedup._entries(buf, offsets, 200)
    hot = max(defaultdict(int, {int(k): int((prefix == k).sum()) for k in set(prefix.tolist())}).values())
    assert hot > 1000  # what one bucket would get by prefix


def test_first_hashes_that_agree():
    """Contents that only the second hash tells apart are not taken for each other."""
    import numpy as np

    keys = np.array([(5, 1), (7, 2), (5, 2), (5, 1), (9, 0)], common.TWIN)
    order, heads, sizes = common.twin_order(keys)
    assert [tuple(k) for k in keys[order[heads]]] == [(5, 1), (5, 2), (7, 2), (9, 0)] and sizes.tolist() == [2, 1, 1, 1]
