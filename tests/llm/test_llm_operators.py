"""The other operators against brute force, round trips and held-out rows, on small tables."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronicle.llm import chat, common, decontam, minhash, packing, pii, queries, rp_forest, token_counts, toxicity


class Sets:
    def __init__(self):
        self.up = {}

    def top(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


# ---------------------------------------------------------------- components


def test_components(spark):
    r = random.Random(5)
    links = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100, i) for i in range(101, 160)] + [(200 + i, 201 + i) for i in range(40)]
    hubs = [(1000, i) for i in range(2000, 2400)] + [(9999, i) for i in range(3000, 3400)] + [(5500, i) for i in range(5200, 5800)] + [(9999, 5200)]  # smallest, largest, in between
    links += r.sample(hubs, len(hubs))
    sets = Sets()
    for a, b in links:
        sets.join(a, b)
    got = dict(common.components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect())
    want = {x: sets.top(x) for a, b in links if a != b for x in (a, b)}
    assert got == want
    assert common.components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


# ---------------------------------------------------------------- near duplicates


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(x.lower() if x.isascii() else x for x in text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_near(docs, n):
    own = [(i, shingles(t, n)) for i, t in docs]
    sets = Sets()
    for k in range(len(own)):
        for j in range(k):
            a, b = own[k][1], own[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                sets.join(k, j)
    least = {}
    for k, (i, _) in enumerate(own):
        t = sets.top(k)
        least[t] = min(least.get(t, i), i)
    return sorted((i, len(s), least[sets.top(k)], i == least[sets.top(k)]) for k, (i, s) in enumerate(own))


def near_corpus(seed, copies=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [r.choice(vocab) for _ in range(120)]
    docs = [" ".join(base)]
    for _ in range(copies):  # around the threshold: some copies only reach others through third ones
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(vocab)
        docs.append(" ".join(w))
    docs += [" ".join(r.choice(vocab) for _ in range(r.randint(1, 60))) for _ in range(30)]
    docs += ["", None, "one", "One", "two words", "TWO\twords", docs[3], docs[3].upper(), "a b c d", "a b c d e", "ÄÖ ä", "äÖ ä"]
    r.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed,n,block", [(1, 4, 1 << 20), (2, 4, 900), (3, 5, 2500)])
def test_near_duplicates(spark, seed, n, block):
    docs = near_corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, node string, n int")
    got = sorted(map(tuple, minhash.near_duplicates(df, n, block=block).collect()))
    assert got == brute_near(docs, n)


def test_near_duplicates_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0 and minhash.kept_documents(empty).count() == 0
    df = spark.createDataFrame([(2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (3, None), (4, "z"), (1, "q r s t u v")], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()))
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 1, 4, True)]
    assert sorted(r[0] for r in minhash.kept_documents(df).collect()) == [1, 1, 3, 4]
    many = spark.createDataFrame([(i, t, 1) for i, t in near_corpus(4)], "doc_id long, text string, comp int")
    want = [i for i, n, _, kept in brute_near(near_corpus(4), 5) if kept]
    assert sorted(r[0] for r in minhash.kept_documents(many).collect()) == sorted(want) and minhash.kept_documents(many).columns == many.columns


def test_kept_documents_keep_columns(spark):
    """Columns named as the operator names its own stay, and of rows equal in id and text always the same one does."""
    text = "a b c d e f g h i j"
    rows = [(1, text, "u", 4, [3]), (1, text, "t", 5, None), (1, text, "t", 5, None), (2, text, "s", 6, [1]), (None, text, "r", 1, []), (3, None, "n", 2, []), (3, None, "n", 2, [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, __key string, own int, key array<int>")
    one = sorted(map(tuple, minhash.kept_documents(df).collect()), key=repr)
    two = sorted(map(tuple, minhash.kept_documents(df.repartition(7)).collect()), key=repr)
    assert one == two and minhash.kept_documents(df).columns == df.columns
    assert [x for x in one if x[1]] in ([rows[0]], [rows[1]]) and len(one) == 3
    long = " ".join(f"w{i % 7001}" for i in range(200_000))
    df = spark.createDataFrame([(5, long), (4, long + " x"), (None, "q")], "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=repr) == [(4, 7002, 4, True), (5, 7001, 4, False), (None, 1, None, True)]


def test_classes_that_share_an_id(spark):
    rows = spark.createDataFrame([(5, 1), (5, 2), (5, 1), (6, 0), (None, None)], "node long, sign int")
    got = [tuple(r) for r in common.told_apart(rows)(rows.withColumn("k", F.col("sign"))).collect()]
    by = {k: {n for n, x in got if x == k} for k in (0, 1, 2)}
    assert by[0] == {6} and by[1] == {5} and len(by[2]) == 1 and by[2].isdisjoint({5, 6})
    assert common.told_apart(rows.where("node = 6"))(rows).columns == ["node"]


# ---------------------------------------------------------------- decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(docs, items, n=13):
    low = lambda t: WORD.findall("".join(x.lower() if x.isascii() else x for x in t or ""))
    wins = defaultdict(set)
    for i, t in items:
        w = low(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            wins[tuple(w[k : k + n])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = low(t), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k : k + size])) in wins:
                    hit |= set(range(k, k + size))
                    found |= wins[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination(spark, monkeypatch):
    r = random.Random(9)
    vocab = ["Ab", "b", "É", "c3", "d", "e"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    items = [(i, text(r.choice([1, 3, 5, 14, 30]) if i > 3 else 20)) for i in range(12)] + [(12, None), (13, " . "), (3, text(15)), (14, "zz9 unknown")]
    docs = [(i, text(r.randint(0, 300)) + (items[r.randrange(4)][1][5:] if i % 3 else "")) for i in range(40)] + [(40, None), (41, ""), (42, "..."), (40, items[2][1])]
    items[4:9] = [(i, text(30)) for i in range(4, 9)]
    df = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, n_hit int")
    it = spark.createDataFrame(items, "item_id long, text string")
    whole = decontam.contamination(df, it)
    assert sorted(map(lambda x: tuple(x)[:6], whole.collect()), key=repr) == brute_contamination(docs, items)
    small = decontam.contamination(df, it, block_bytes=40)
    assert sorted(map(lambda x: tuple(x)[:6], small.collect()), key=repr) == brute_contamination(docs, items)
    bad = {x[0] for x in brute_contamination(docs, items) if x[5]}
    clean = decontam.clean_documents(df, it)
    assert clean.columns == df.columns and len(bad) and clean.count() == len(docs) - sum(x[5] for x in brute_contamination(docs, items))
    assert decontam.contamination(df, it.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.contamination(df.limit(0), it).count() == 0
    # items that fill several passes
    many = decontam.contamination(df, it, block_bytes=300, pass_bytes=4000)
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    left = decontam.clean_documents(df, it, block_bytes=300, pass_bytes=4000)
    assert left.columns == df.columns and sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, clean.collect()), key=repr)
    assert decontam.contamination(df.limit(0), it, block_bytes=40, pass_bytes=10).count() == 0


def brute_longest(docs, items, n=13):
    low = lambda t: WORD.findall("".join(x.lower() if x.isascii() else x for x in t or ""))
    out = set()
    for d, t in docs:
        w = low(t)
        for i, u in items:
            v = low(u)
            need, best = min(n, len(v)), None
            for p in range(len(w)):
                for q in range(len(v)):
                    k = 0
                    while p + k < len(w) and q + k < len(v) and w[p + k] == v[q + k]:
                        k += 1
                    if need and k >= need and (best is None or (-k, p, q) < best):
                        best = (-k, p, q)
            if best:
                out.add((d, str(i), best[1], best[2], -best[0]))
    return out


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_longest_matches(spark, block):
    r = random.Random(10)
    text = lambda n: " ".join(r.choice(["ab", "b", "É", "c3"]) for _ in range(n))
    base = [text(45) for _ in range(4)]
    items = [(i, base[i]) for i in range(4)] + [(7, "ab b ab"), (8, None), (9, base[0][4:]), (10, text(13))]
    docs = [(i, text(r.randint(0, 20)) + " " + base[i % 4][r.randint(0, 30) : r.randint(50, 130)] + " " + base[(i + 1) % 4]) for i in range(12)] + [(20, None), (21, ""), (22, base[2])]
    got = decontam.longest_matches(spark.createDataFrame([(*x, "q") for x in docs], "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    assert sorted(map(tuple, got.collect())) == sorted(brute_longest(docs, items))


def test_contamination_very_long_text(spark):
    r = random.Random(11)
    words = [f"w{r.randint(0, 5000)}" for _ in range(300_000)]
    item = " ".join(words[200_000:200_040])
    df = spark.createDataFrame([(1, " ".join(words)), (None, item), (None, item)], "doc_id long, text string")
    got = {x["doc_id"]: (x["n_words"], x["n_hit"], x["longest_run"], x["contaminated"]) for x in decontam.contamination(df, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert got == {1: (300_000, 40, 40, False), None: (40, 40, 40, True)}


def test_suffix_array():
    r = np.random.default_rng(3)
    words = np.concatenate((r.integers(1, 4, 300), [0], np.tile([1, 2], 80), [0]))
    for depth in (1, 5, 13, 40):
        a = decontam.SuffixArray(words, depth)
        keys = [tuple(a.words[i : i + depth]) for i in a.order]
        assert keys == sorted(keys)


# ---------------------------------------------------------------- packing


def plain_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=gaps.__getitem__)] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_packing(spark):
    from tokenizers import Tokenizer

    r = random.Random(4)
    text = lambda n: " ".join(r.choice(["alpha", "bêta", "gamma's", "<x>", "12345", "\n\n", "  "]) for _ in range(n))
    docs = [(i, text(r.choice([0, 3, 20, 60, 300, 1500]))) for i in range(120)] + [(500, None), (501, "a <|endoftext|> b"), (1, "again"), (502, "x")]
    df = spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id long, text string, length int")
    exact = Tokenizer.from_file(packing.default_vocabulary())
    got = [r.asDict() for r in packing.pack(df).collect()]
    want = []
    for i, t in docs:
        ids = exact.encode(t or "", add_special_tokens=False).ids + [2]
        n = -(-len(ids) // 1024)
        cut = len(ids) - (n - 1) * 1024
        bounds = [0, *range(cut, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
    assert sorted((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got) == sorted(want)
    by = defaultdict(list)
    for x in got:
        by[x["sequence_id"]].append((x["offset"], x["length"]))
    for rows in by.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by) <= plain_best_fit([x["length"] for x in got], 1024)
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_equal_rows(spark):
    """Rows that are the same in everything are packed one by one."""
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    places = [(r["sequence_id"], r["offset"], r["length"]) for r in packing.pack(df).collect()]
    assert len(set(places)) == 3000 and len({s for s, _, _ in places}) == -(-3000 // (1024 // places[0][2]))


def test_plan():
    for seed in range(20):
        r = random.Random(seed)
        counts = {r.randint(1, 100): r.randint(1, 300) for _ in range(r.randint(1, 40))}
        place, first, offset = packing.plan(counts, 100)
        lengths = [n for n in sorted(counts, reverse=True) for _ in range(counts[n])]
        fill = defaultdict(int)
        for i, n in enumerate(lengths):
            k = np.searchsorted(place, i, "right") - 1
            s = first[k] + i - place[k]
            assert fill[s] == offset[k]
            fill[s] += n
        assert max(fill.values()) <= 100
        assert len(fill) <= plain_best_fit(lengths, 100)


# ---------------------------------------------------------------- embeddings


def test_embeddings(spark):
    r = np.random.default_rng(2)
    centre = r.standard_normal((40, 16))
    rows = []
    for i in range(700):
        v = centre[i % 40] + r.standard_normal(16) * r.choice([0.05, 0.25, 0.6])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 40 % 3)))
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(50)] + [(7, rows[7][1], 99), (2000, [2 * x for x in rows[7][1]], rows[7][2])]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 16, 1), (3003, [1.0, None] + [0.0] * 14, 1), (3004, [float("nan")] * 16, 1), (3005, rows[7][1], None), (3006, rows[7][1][:8], rows[7][2]), (3007, [float("inf")] * 16, 0)]
    df = spark.createDataFrame([(*x, "n") for x in rows], "vec_id long, embedding array<float>, label int, node string")
    good = [k for k, (_, v, lab) in enumerate(rows) if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    sets, links = Sets(), Counter()
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.float64(np.float32(rows[a][1])), np.float64(np.float32(rows[b][1]))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    sets.join(a, b)
                    links[a] += 1
                    links[b] += 1
    least = defaultdict(lambda: 10**9)
    for k, x in enumerate(rows):
        least[sets.top(k)] = min(least[sets.top(k)], x[0])
    want = sorted((x[0], links[k], least[sets.top(k)], x[0] == least[sets.top(k)]) for k, x in enumerate(rows))
    flat = sorted(map(tuple, rp_forest.near_duplicates(df, leaf=10_000).collect()))
    assert flat == want
    got = rp_forest.near_duplicates(df, leaf=40).collect()
    found, all_links = sum(x["n_links"] for x in got), sum(links.values())
    assert 0.95 * all_links <= found <= all_links
    assert rp_forest.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_dense_cluster(spark):
    """Near-copies that are a third of the rows, in blocks of tiles and with looser ones around them."""
    r = np.random.default_rng(4)
    x = r.standard_normal((4500, 32))
    tight, loose = x[0] + 0.2 * r.standard_normal((1500, 32)), x[0] + 0.32 * r.standard_normal((300, 32))
    x = np.concatenate((tight, loose, x[1800:])).astype(np.float32)
    label = np.where(np.arange(len(x)) % 10 == 0, 2, 1)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    sets = Sets()
    for a, b in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        sets.join(int(a), int(b))
    want = [(i, int(linked[i].sum()) - 1, sets.top(i)) for i in range(len(x))]
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(y)[:3] for y in rp_forest.near_duplicates(df, leaf=100).collect())
    assert sum(y[1] for y in got) >= 0.9999 * sum(y[1] for y in want)
    assert [y for y in got[:1500] if y not in want] == []
    assert all(y[1] <= w[1] for y, w in zip(got, want, strict=True))


def common_direction(r, n, m, dim=64):
    """Unit vectors with cosines of about 0.8 between any two, and a cluster of m of them with cosines of about 0.95."""

    def units(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    shared = units(r.standard_normal((1, dim)))
    x = units(np.sqrt(0.8) * shared + np.sqrt(0.2) * units(r.standard_normal((n, dim))))
    x[:m] = units(np.sqrt(0.95) * x[:1] + np.sqrt(0.05) * units(r.standard_normal((m, dim))))
    return x


def test_embeddings_with_a_common_direction(spark):
    """All vectors stand in the reach of a dense cluster; its links, with each other and with looser ones, are found."""
    r = np.random.default_rng(12)
    x = common_direction(r, 9000, 700)
    x[700:760] = x[:60] + 0.35 * r.standard_normal((60, 64)) / 8
    x = x[r.permutation(len(x))].astype(np.float32)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "vec_id long, embedding array<float>, label string")
    for options in ({"leaf": 50, "broad": 4}, {"leaf": 50, "sample": 1500}):
        got = {y["vec_id"]: y["n_links"] for y in rp_forest.near_duplicates(df, **options).collect()}
        assert all(got[i] <= linked[i] for i in got)
        assert sum(got.values()) >= 0.99 * linked.sum() > 400_000


def test_embeddings_labels_of_any_type(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert sorted(tuple(x)[:3] for x in rp_forest.near_duplicates(df).collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)]


def test_embeddings_leaves_are_split_on(spark):
    """Leaves beyond what the sample can split are split by all vectors; links are still found and counted once."""
    r = np.random.default_rng(6)
    centre = r.standard_normal((300, 24))
    x = (centre[np.arange(3000) % 300] + 0.2 * r.standard_normal((3000, 24))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    got = {y["vec_id"]: y["n_links"] for y in rp_forest.near_duplicates(df, sample=40, leaf=50, most=100).collect()}
    assert all(got[i] <= linked[i].sum() for i in got) and sum(got.values()) >= 0.98 * linked.sum() > 5000
    rows = spark.createDataFrame([(v.tobytes(),) for v in x], "vector binary")
    few = rp_forest.fit(u[:40], 3, 10, 0.05)
    forest = rp_forest._refined(rows, few, "<f4", 24, 0.05, 100)
    for t, tree in enumerate(forest):
        row, leaf = rp_forest.route(tree, t, u)
        assert np.unique(leaf, return_counts=True)[1].max() <= 100 and set(row.tolist()) == set(range(3000))
    same = spark.createDataFrame([(x[0].tobytes(),)] * 200, "vector binary")
    assert rp_forest._refined(same, [(1,)], "<f4", 24, 0.05, 100) == [(1,)]


# ---------------------------------------------------------------- chat


def test_chat_round_trip(spark):
    r = random.Random(8)
    bits = ["<|im_end|>", "<|im_start|>assistant ok", "\\", "\\|", "<", "|", "\n", "n", "é😀", "<\\|", "\\n", "user"]
    turns = [(c, t, r.choice(["user", "assistant", "system", "a\nb", "<|", None]), "".join(r.choices(bits, k=r.randint(0, 9))) or None) for c in range(30) for t in range(r.randint(1, 6))]
    turns += [(None, 1, "user", "x"), (5, None, "assistant", "first"), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, piece int")
    by = defaultdict(list)
    for c, t, role, text in turns:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    want = []
    for c, rows in by.items():
        rows.sort()
        said = "".join(f"{a}\n{b}\n" for *_, a, b in rows)
        loss = "".join(b for *_, a, b in rows if a == "assistant")
        want.append((c, len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    got = chat.digests(chat.canonical_rows(df)).collect()
    assert sorted((tuple(x)[:5] for x in got), key=repr) == sorted(want, key=repr)
    for x in chat.formatted(chat.canonical_rows(df)).collect():
        assert list(chat.read(x["piece"])) == [(x["role"], x["text"])]
        assert chat.unescaped(x["piece"][x["loss_start"] : x["loss_end"]]) == (x["text"] if x["role"] == "assistant" else "")
    assert chat.digests(chat.canonical_rows(df.limit(0))).count() == 0


def test_chat_further_columns_change_nothing(spark, tmp_path):
    """Columns that make other mappings fit too don't take rows away; what no mapping is certain for is an error."""
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = {
        "thread": {"thread_id": F.lit(1), "position": F.lit(2), "speaker": F.lit("x"), "message": F.lit("y")},
        "flat": {"system": F.lit("s"), "instruction": F.lit("i"), "input": F.lit(None).cast("string"), "output": F.lit("o")},
        "nested": {"messages": F.array(F.struct(F.lit("user").alias("role"), F.lit("c").alias("content")))},
    }
    df.write.parquet(str(tmp_path / "plain/conversations.parquet"))
    want = sorted(map(tuple, queries.op9_chat(spark, str(tmp_path / "plain")).collect()))
    assert [r[0] for r in want] == [-1, 1, 2]
    for name, columns in more.items():
        df.withColumns(columns).write.parquet(str(tmp_path / name / "conversations.parquet"))
        assert sorted(map(tuple, queries.op9_chat(spark, str(tmp_path / name)).collect())) == want
    both = df.withColumns(more["thread"])
    with pytest.raises(ValueError, match="name the fields"):
        chat.canonical_rows(both)
    with pytest.raises(ValueError, match="no columns"):
        chat.canonical_rows(df, ("a", "turn", "role", "text"))
    assert chat.canonical_rows(both, ("thread_id", "position", "speaker", "message")).distinct().collect() == [(1, 2, "x", "y")]
    assert chat.canonical_rows(df.withColumns(more["flat"])).count() == 3
    with pytest.raises(Exception, match="no certain mapping"):
        chat.canonical_rows(df.withColumn("conv_id", F.lit("text"))).collect()


def test_chat_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"prompt": "a", "completion": "b"},
        {"instruction": "a", "input": "", "output": "b"},
        {"system": "s", "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"odd": 1},
    ]
    rows = [(i, json.dumps(x)) for i, x in enumerate(records)] + [(9, None), (10, "{")]
    got = chat.canonical(spark.createDataFrame(rows, "id long, record string"), "id", "record").collect()
    by = defaultdict(list)
    for x in got:
        by[x["conv_id"]].append((x["role"], x["text"]))
    assert {x["conv_id"]: x["layout"] for x in got if x["turn"] is None} == {5: "unknown", 9: "unreadable", 10: "unreadable"}
    pair = [("user", "a"), ("assistant", "b")]
    assert by[0] == by[1] == by[2] == by[3] == pair and by[4] == [("system", "s"), *pair]
    assert by[5] == by[9] == by[10] == [(None, None)]
    assert len({chat.fingerprint(chat.paths(x)) for x in records}) == 6


# ---------------------------------------------------------------- personal data


def plain_spans(text):
    """The contract's words, with plain regular expressions."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and pii._luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans():
    r = random.Random(6)
    bits = ["a", "b.c", "@", ".", "-", "+", "1", "255", "256", "0", "4111 1111 1111 1111", " ", "%", "_", "é", "+49 (30) 123-4567", "mail@x.org", "10.0.0.1", "٣", "0000255"]
    for _ in range(20000):
        t = "".join(r.choices(bits, k=r.randint(0, 12)))
        assert pii.base_spans(t) == plain_spans(t), t


@pytest.mark.parametrize(
    "text,kind,said",
    [
        ("write to john (at) example (dot) com now", "email", "john (at) example (dot) com"),
        ("write to john.doe at example dot com now", "email", "john.doe at example dot com"),
        ("write to john[at]example[dot]co[dot]uk.", "email", "john[at]example[dot]co[dot]uk"),
        ("jоhn＠examplе.com", "email", "jоhn＠examplе.com"),
        ("jo​hn@exa­mple.com", "email", "jo​hn@exa­mple.com"),
        ("call plus four nine three zero one two three four five six seven today", "phone", "plus four nine three zero one two three four five six seven"),
        ("host one nine two dot one six eight dot zero dot one up", "ip", "one nine two dot one six eight dot zero dot one"),
        ("card ４１１１ １１１１ １１１１ １１１１.", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("card four one one one one one one one one one one one one one one one.", "card", "four one one one one one one one one one one one one one one one"),
        ("ip 10[.]0[.]0[.]1", "ip", "10[.]0[.]0[.]1"),
        ("to ann@ example.org please", "email", "ann@ example.org"),
    ],
)
def test_disguises(text, kind, said):
    assert plain_spans(text) != [(kind, text.index(said), text.index(said) + len(said))]
    assert (kind, text.index(said), text.index(said) + len(said)) in pii.all_spans(text, pii.base_spans(text))


def test_pii_keeps_base_and_plain_text(spark):
    for text in ("meet me at noon dot dot dot", "one two three and four", "un deux trois", "he was at home. the dot", "look at example.org", "ask @user.name", "a@b c", "", "x" * 300000, "1" * 100000, "a." * 50000 + "@"):
        assert pii.all_spans(text, pii.base_spans(text)) == plain_spans(text) if len(text) < 1000 else pii.all_spans(text, pii.base_spans(text)) == []
    rows = [(1, "mail a@b.org or c (at) d (dot) net", 5), (2, None, 0), (3, "", 0), (1, "clean", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, pii.find(df).collect()), key=repr)
    assert ("email:5:12,email:16:34", 1) in {(x[6], x[1]) for x in got} and len(got) == 4
    masked = {(r[0], r[1], r[2]) for r in pii.masked_documents(df).collect()}
    assert masked == {(1, "mail [EMAIL] or [EMAIL]", 23), (2, None, 0), (3, "", 0), (1, "clean", 5)}
    assert pii.find(df.limit(0)).count() == 0


# ---------------------------------------------------------------- token counts


def test_token_tree():
    encode = packing.encoder(packing.default_vocabulary())
    size = lambda t: len(encode(t))
    special = packing.special_tokens(packing.default_vocabulary())
    assert special == ["<|endoftext|>"]
    r = random.Random(11)
    bits = ["word", " word", "'s", "'", " ", "  ", "\n", "12", "é", "中文", "!!", "don't", "\t", " a", "x", "，", "('s", "a1b2", "<|endoftext|>", "<|", "endof", "text", "|>", "e\u0301", "\x1c", "\u00a0", "\u200b"]
    for n in range(300):
        text = "".join(r.choices(bits, k=r.randint(0, 120)))
        tree = token_counts.TokenTree(text, size, leaf=r.choice([1, 3, 8]), special=special)
        assert tree.tokens == size(text) and tree.text() == text
        for _ in range(8):
            a = r.randint(0, len(text) + 1)
            b = a + r.choice([0, 0, 1, 3, 40])
            new = "".join(r.choices(bits, k=r.choice([0, 0, 1, 2, 30])))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            assert tree.text() == text and tree.chars == len(text)
            assert tree.tokens == size(text), (text, a, b, new)
            balanced(tree.root)
    long = token_counts.TokenTree("some words here " * 4000, size)
    long.encoded = 0
    long.edit(30000, 30001, "y")
    assert long.encoded < 2000


def balanced(node):
    """Heights and sums of a tree hold."""
    if node is None or node.height == 0:
        return
    a, b = node.left, node.right
    balanced(a)
    balanced(b)
    assert abs(a.height - b.height) <= 1 and node.height == 1 + max(a.height, b.height)
    assert (node.chars, node.tokens, node.leaves) == (a.chars + b.chars, a.tokens + b.tokens, a.leaves + b.leaves)


def test_token_tree_stays_balanced_and_cuts_any_text():
    count = lambda t: len(t.split())
    tree = token_counts.TokenTree("", count, leaf=8)
    touched = []
    for i in range(3000):  # leaves are added at one end only
        made = []
        over, token_counts._over = token_counts._over, lambda a, b: (made.append(1), over(a, b))[1]
        tree.edit(tree.chars, tree.chars, "some more text ")
        token_counts._over = over
        touched.append(len(made))
    balanced(tree.root)
    assert tree.leaves > 3000 and tree.root.height <= 18 and max(touched) < 120  # a path, not the whole tree
    for text in ("x=1;y=[2,3];" * 500, "一二三四五，六七八九。" * 500, "a|b|c\n" * 500, "0x1f " * 500):
        assert max(map(len, token_counts.cuts(text, 64))) < 100 and "".join(token_counts.cuts(text, 64)) == text


def test_vocabulary_by_rank(tmp_path):
    """Where ranks and merges differ, the library itself encodes."""
    from tokenizers import Tokenizer

    path = packing.default_vocabulary()
    assert packing.by_rank(path)
    file = json.loads(open(path, encoding="utf-8").read())
    file["model"]["merges"] = file["model"]["merges"][:2000][::-1]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(file), encoding="utf-8")
    assert not packing.by_rank(str(other))
    text = "Some words, and <|endoftext|> others: naïve 123."
    assert packing.encoder(str(other))(text).tolist() == Tokenizer.from_file(str(other)).encode(text, add_special_tokens=False).ids


def test_count_with_edits(spark):
    rows = [(1, "hello there my friend " * 100), (2, None), (3, ""), (1, "a"), (None, "x=1;y=2\n" * 3000), (1, "a")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n_tokens int")
    encode = packing.encoder(packing.default_vocabulary())
    want = []
    for i, t in rows:
        t = t or ""
        new = t
        for a, b, x in token_counts.revision(t):
            new = new[:a] + x + new[b:]
        want.append((i, len(encode(t)), len(encode(new)), len(new)))
    got = [(x["doc_id"], x["n_tokens"], x["n_tokens_edited"], x["n_chars_edited"]) for x in token_counts.count_with_edits(df, token_counts.revision).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# ---------------------------------------------------------------- toxicity


def test_toxicity_held_out(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.1", "documents"), common.table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    hit = sum(x["predicted"] and x["toxic"] for x in got)
    toxic, told = sum(x["toxic"] for x in got), sum(x["predicted"] for x in got)
    assert toxic > 50 and hit / toxic > 0.85 and hit / told > 0.95
    assert all(0 <= x["score"] <= 1 for x in got)


def test_toxicity_grammar():
    g = toxicity.Grammar({}, toxicity.FIXED)
    names = ("plain", "targeted", "negated", "reported", "threat")
    kind = lambda t: [n for n, x in zip(names, g.features(t), strict=False) if x > 0]
    assert kind("You are an idiot.") == ["targeted"] and kind("a stupid table.") == ["plain"]
    assert kind("This is not stupid.") == ["negated"] and kind("he said: idiot") != ["reported"]
    assert kind("She called it a stupid idea") == ["reported"] and kind("they will kill us") == ["threat"]
    assert kind("kill the process") == [] and kind("You are here. idiot") == ["plain"]
    assert not g.features(None).any() and not g.features("").any()
    m = toxicity.Grammar({"maim": 3.0}, toxicity.FIXED, frozenset({"maim"}))
    kind = lambda t: [n for n, x in zip(names, m.features(t), strict=False) if x > 0]
    assert kind("they will maim us") == ["threat"] and kind("maim the process") == ["plain"] and kind("do not maim") == ["negated"]


def brute_features(text, lexicon, menaces):
    """The grammar's meaning, clause by clause and without transducers."""
    t = toxicity
    seeds = {w: kind for kind, words in t.SEEDS.items() for w in words.split()}
    sums, strongest, matched = dict.fromkeys(t.KINDS, 0.0), 0.0, False
    clauses = re.split(r"[.!?;:\n]", (text or "").lower())
    for clause in clauses:
        words = re.findall(r"[^\W\d_]+", clause)
        within = lambda i, kind, n: any(seeds.get(w) == kind for w in words[max(0, i - n) : i])
        found = {}
        for i, w in enumerate(words):
            units = [w, *(w[:n] + "*" for n in range(3, 9) if len(w) > n)]
            best, unit = max((lexicon.get(u, 0.0), u) for u in units)
            kind = seeds.get(w)
            if best > 0 and kind in (None, t.INSULT):
                what, weight = ("menace" if kind is None and unit in menaces else "insult"), max(best, 4.0 if kind else 0.0)
            elif kind in (t.INSULT, t.THREAT):
                what, weight = ("insult" if kind == t.INSULT else "threat"), 4.0
            else:
                continue
            matched = True
            aimed = within(i, t.TARGET, 4)
            if within(i, t.NEGATION, 3):
                out = "negated"
            elif within(i, t.REPORT, 8):
                out = "reported"
            elif what == "insult":
                out = "targeted" if aimed else "plain"
            elif aimed:
                out = "threat"
            elif what == "menace":
                out = "plain"
            else:
                continue
            found[out] = found.get(out, 0.0) + weight
        for k, v in found.items():
            sums[k] += v
        strongest = max(strongest, *found.values()) if found else strongest
    return [*(np.log1p(x / 4.0) for x in sums.values()), np.log1p(strongest), np.log1p(len(clauses) if matched else 0)]


def test_toxicity_against_brute_force():
    r = random.Random(3)
    words = [w for x in toxicity.SEEDS.values() for w in x.split()] + ["grotty", "grottier", "maim", "maiming", "house", "x", "ein", "7", "_"]
    lexicon, menaces = {"grot*": 3.0, "grotty": 2.5, "maim": 2.2, "mai*": 5.0, "scum": 7.0}, frozenset({"maim", "mai*"})
    grammar = toxicity.Grammar(lexicon, np.array([-1.0, 0.5, 0.6, 0.1, -0.2, 0.9, 0.3, -0.4]), menaces)
    for _ in range(3000):
        text = "".join(r.choice(words).title() + r.choice([" ", " ", " ", ", ", ". ", "!", "\n", " - ", ": "]) for _ in range(r.randint(0, 25)))
        want = brute_features(text, lexicon, menaces)
        got = grammar.features(text)
        assert np.allclose(got, want), text
        assert np.isclose(grammar.score(got), 1 / (1 + np.exp(-(grammar.weights[0] + np.dot(grammar.weights[1:], want)))))
    long = "you idiot. " * 100_000
    assert np.allclose(grammar.features(long), [0, np.log1p(100_000), 0, 0, 0, np.log1p(4.0), np.log1p(100_001)])


def test_toxicity_learns_threats(spark):
    """Labels say toxic or not; whether a learned word is a threat follows from the words before it."""
    r = random.Random(8)
    filler = ["house", "river", "table", "walk", "green", "seven", "moon", "paper"]
    fill = lambda n: " ".join(r.choice(filler) + str(r.randint(0, 40)).translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n))
    leads, frames = [f"do{a}{b}" for a in "abcde" for b in "fghi"], [f"su{a}{b}" for a in "abcde" for b in "fghi"]
    docs, labels = [], []
    for i in range(600):
        toxic = i % 2
        text = fill(20)
        if toxic:
            lead, frame = r.choice(leads), r.choice(frames)
            text += f" {lead} {r.choice(['kill', 'hurt', 'grobnate', 'grobnate'])} you . {frame} {r.choice(['idiot', 'moron', 'vlork', 'vlork'])} . " + fill(5)
        docs.append((i, text, 1, "a"))
        labels += [(i, toxic)] + [(i, 0)] * (i % 5 == 0)  # a label of its own beside it counts for nothing
    docs.append((1000, docs[1][1], 1, "a"))
    labels.append((1000, 0))  # one text with both labels
    df, lab = spark.createDataFrame(docs, "doc_id long, text string, __toxic int, __id string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    one, two = toxicity.train(df, lab), toxicity.train(df.repartition(7), lab.repartition(3))
    assert one.lexicon == two.lexicon and one.menaces == two.menaces and np.array_equal(one.weights, two.weights)
    assert {"grobnate", "vlork"} <= set(one.lexicon) and "grobnate" in one.menaces and "vlork" not in one.menaces
    got = {x["doc_id"]: x["score"] for x in toxicity.scored(df, one).collect()}
    assert min(got[i] for i in range(1, 600, 2)) > 0.7 > 0.3 > max(got[i] for i in range(0, 600, 2)) and got[1] == got[1000]


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, "you idiot", "a"), (2, None, "b"), (None, "x", "c"), (1, "", "d")], "doc_id long, text string, toxic string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    grammar = toxicity.train(docs, none)
    assert np.array_equal(grammar.weights, toxicity.FIXED) and not grammar.lexicon
    got = toxicity.scored(docs, grammar)
    assert got.count() == 4 and got.where("score is null or held_out is null").count() == 0
    assert toxicity.scored(docs.limit(0), toxicity.train(docs.limit(0), none)).count() == 0
    assert toxicity.clean_documents(docs, none).columns == docs.columns
    some = spark.createDataFrame([(1, 0, None), (None, 0, 1), (1, 0, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.scored(docs, toxicity.train(docs, some)).count() == 4


# ---------------------------------------------------------------- queries


def test_queries_run(spark, sf_dir):
    n = {t: common.table(spark, sf_dir, t).count() for t in ("documents", "embeddings")}
    for name, query in queries.queries().items():
        rows = query(spark, sf_dir).count()
        if name == "op6_embedding_dedup":
            assert rows == n["embeddings"]
        elif name == "op9_chat":
            assert rows == common.table(spark, sf_dir, "conversations").select(F.countDistinct("conv_id")).first()[0] + 1
        elif name == "op7_packing":
            assert rows >= n["documents"]
        else:
            assert rows == n["documents"], name


def test_pii_figures_and_plain_at():
    for text, kind, part in (
        ("call +49 30 one two three 4567 now", "phone", "+49 30 one two three 4567"),
        ("host 10.0.0.one is up", "ip", "10.0.0.one"),
        ("write to john.doe at example.com today", "email", "john.doe at example.com"),
        ("my email is john at example.com", "email", "john at example.com"),
    ):
        a = text.index(part)
        assert pii.all_spans(text, pii.base_spans(text)) == [(kind, a, a + len(part))], text
    for text in ("look at example.com for one of 4567 things", "1.2.3 one more", "in 2024, one two three", "+49 30 one"):
        assert pii.all_spans(text, pii.base_spans(text)) == [], text
    spelled = "in 2024, four one one one one one one one one one one one one one one one"
    assert [k for k, _, _ in pii.all_spans(spelled, [])] == ["card"]


def test_chat_records_with_further_fields():
    turns = [("user", "a"), ("assistant", "b")]
    assert chat.record_turns({"id": 1, "prompt": "a", "response": "b"}) == turns
    assert chat.record_turns({"source": "x", "messages": [{"role": "user", "content": "a", "name": "n"}, {"role": "assistant", "content": "b"}]}) == turns
    assert chat.record_turns({"id": 1, "instruction": "a", "input": "c", "output": "b"}) == [("user", "a\n\nc"), ("assistant", "b")]
    for unknown in (
        {"id": 1, "text": "a"},
        {"prompt": "a", "response": "b", "completion": "c"},
        {"messages": [{"role": "user", "content": "a"}, "b"]},
        {"messages": [{"role": "user", "content": "a"}, {"role": "user", "content": [{"text": "b"}]}]},
    ):
        assert chat.record_turns(unknown) is None


def test_chat_odd_records(spark):
    """Field names that look like paths, deep nesting, empty lists, halves of pairs, ids that are none."""
    deep = "[" * 100_000 + "]" * 100_000
    raws = {
        "messages[].role": ('{"messages[].role": "x", "messages[].content": "y"}', "unknown"),
        "": ('{"": {"prompt": "a", "completion": "b"}}', "unknown"),
        "deep": (f'{{"messages": {deep}}}', "unreadable"),
        "shallow": (f'{{"x": {"[" * 500 + "]" * 500}, "prompt": "a", "response": "b"}}', "flat"),
        "none": ('{"messages": []}', "empty"),
        "none2": ('{"messages": [], "id": 4}', "empty"),
        "none3": ('{"messages": [], "conversations": []}', "empty"),
        "lead": ('{"messages": [], "system": "s"}', "turns"),
        "flat": ('{"messages": [], "prompt": "a", "completion": "b"}', "flat"),
        "objects": ('{"messages": [{}, {"role": "user", "content": "a"}]}', "turns"),
        "holes": ('{"messages": [{"role": "user"}, {"content": "b"}]}', "turns"),
        "half": ('{"prompt": "\\ud800x", "completion": "\\ud83d\\ude00"}', "flat"),
        "halfkey": ('{"\\ud800": 1, "prompt": "p", "completion": "c"}', "flat"),
        "row": ('{"conv_id": "a", "turn": 1, "role": "user", "text": "x"}', "unknown"),
        "row2": ('{"conv_id": 700, "turn": null, "role": null, "text": 3.5, "lang": {"a": []}}', "turn"),
        "list": ("[1]", "unreadable"),
        "empty": ("{}", "unknown"),
        "dup": ('{"prompt": {"a": 1}, "completion": "b"}', "unknown"),
    }
    df = spark.createDataFrame([(i, k, raw) for i, (k, (raw, _)) in enumerate(raws.items())], "id long, name string, record string")
    got = chat.canonical(df, "id", "record").collect()
    names = list(raws)
    layouts = {x["conv_id"] if x["layout"] != "turn" else names.index("row2"): x["layout"] for x in got}
    assert {names[i]: k for i, k in layouts.items()} == {k: v for k, (_, v) in raws.items()}
    said = lambda name: [(x["role"], x["text"]) for x in got if x["conv_id"] == names.index(name)]
    assert said("half") == [("user", "\ufffdx"), ("assistant", "\U0001f600")]
    assert said("holes") == [("user", ""), ("", "b")] and said("lead") == [("system", "s")]
    assert [(x["conv_id"], x["turn"], x["role"], x["text"]) for x in got if x["layout"] == "turn"] == [(700, None, "", "3.5")]
    assert chat.paths({"a.b": [{"c[]": 1}]}) == {"a\\.b[].c\\[\\]"} and chat.paths({}) == {"."} and chat.paths([]) == {"[0]"}


def test_chat_long_and_mixed_tables(spark):
    """A very long text, and columns that clash with what the operator names its own."""
    long = "<|im_end|>\\" * 200_000
    df = spark.createDataFrame([(1, 0, "user", long, 5, "x"), (1, 1, "assistant", long, None, None)], "conv_id long, turn long, role string, text string, id long, record string")
    (got,) = chat.digests(chat.canonical_rows(df)).collect()
    assert got["n_turns"] == 2 and got["loss_chars"] == len(long) and got["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()


def test_tape():
    """Places of a rewritten text against a list of (character, source span)."""
    r = random.Random(12)
    for _ in range(400):
        text = "".join(r.choices("abcdef", k=r.randint(0, 30)))
        tape, plain = pii.Tape(text), [(ch, i, i + 1) for i, ch in enumerate(text)]
        for _ in range(3):
            cuts = sorted(r.sample(range(len(plain) + 1), min(len(plain) + 1, 2 * r.randint(0, 4)) // 2 * 2))
            edits = [(a, b, "".join(r.choices("xyz", k=r.randint(0, 3)))) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
            tape.rewrite(edits)
            for a, b, new in reversed(edits):
                plain[a:b] = [(ch, plain[a][1], plain[b - 1][2]) for ch in new]
            assert [*zip(tape.text, tape.starts.tolist(), tape.ends.tolist(), strict=True)] == plain
