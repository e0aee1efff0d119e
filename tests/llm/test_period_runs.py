"""Periodic runs against their definition, on small texts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from chronicle.llm import period_runs, queries


def has_period(w, q):
    return all(w[i] == w[i + q] for i in range(len(w) - q))


def brute(w, least=6, power=4):
    """All stretches, by the definition alone."""
    out = []
    n = len(w)
    for s in range(n):
        for e in range(s + least, n + 1):
            for q in range(1, (e - s) // power + 1):
                if has_period(w[s:e], q):
                    grows = (s > 0 and w[s - 1] == w[s - 1 + q]) or (e < n and w[e] == w[e - q])
                    if not grows:
                        out.append((s, e - s, q))
                    break  # the smallest period
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_find_by_definition():
    r = random.Random(3)
    for _ in range(400):
        w = [r.randint(0, r.choice((1, 1, 2, 5))) for _ in range(r.randint(0, 12))]
        for _ in range(r.randint(0, 3)):
            part = [r.randint(0, 2) for _ in range(r.randint(1, 4))]
            w += (part * 7)[: r.randint(1, 24)] + [r.randint(0, 3) for _ in range(r.randint(0, 3))]
        w = w[:60]
        assert period_runs.find(np.array(w, np.int32)) == brute(w), w
        assert period_runs.find(np.array(w, np.int32), 2, 2) == brute(w, 2, 2), w
        assert period_runs.find(np.array(w, np.int32), 9, 3) == brute(w, 9, 3), w


def test_long_documents_make_their_grid_by_period(monkeypatch):
    r = np.random.default_rng(4)
    w = np.concatenate([r.integers(0, 50, 4000), np.tile(r.integers(0, 9, 37), 30), r.integers(0, 50, 900), np.zeros(500, int), np.tile(r.integers(0, 9, 400), 5)]).astype(np.int32)
    want = period_runs.find(w)
    assert {(37, True), (1, True), (400, True)} <= {(q, m >= 4 * q) for _, m, q in want}
    monkeypatch.setattr(period_runs, "GRID", 0)
    assert period_runs.find(w) == want


WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_row(key, text):
    w = WORDS.findall((text or "").encode())
    n = len(w)
    if key is not None and n:
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = sorted(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))[:1]
    s, m, q = best[0] if best else (None, None, None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return (key, len(found), s, m, q, 1000 * m // q if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def corpus():
    r = random.Random(8)
    texts = ["", None, " \t\n", "a", "a a a a a", "a a a a a a", "x\x0by\x0cx y x\ny x\ty x y", "a a a a a a a a a a a a", "A a A a A a A a"]
    for _ in range(50):
        part = " ".join(r.choice("abcdé") for _ in range(r.randint(1, 5)))
        texts.append(" ".join([*(r.choice("abcdefgh") for _ in range(r.randint(0, 20))), *[part] * r.randint(1, 7), r.choice("xyz")]))
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    return [*enumerate(texts), *((i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 60)))) for i in planted), (None, "a b a b a b a b"), (5, "a b a b a b a b"), (5, "a b a b a b a b")]


def test_query_by_definition(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id long, text string, period string, start int").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_period_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute_row(i, t) for i, t in rows), key=repr)


@pytest.mark.parametrize("maker", [period_runs.digests, period_runs.runs, period_runs.collapsed])
def test_empty_table(spark, maker):
    assert maker(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_and_collapsed_texts(spark):
    long = "w " * 100_000 + "end"
    rows = [(1, "x go on go on go on go on y", 7), (2, "nothing here", None), (3, None, 1), (4, long, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    assert sorted(map(tuple, period_runs.runs(df).collect())) == [(1, 1, 8, 2, "go on"), (4, 0, 100_000, 1, "w")]
    assert sorted(map(tuple, period_runs.collapsed(df).collect())) == [(1, "x go on y", 7), (2, "nothing here", None), (3, None, 1), (4, "w end", 2)]
