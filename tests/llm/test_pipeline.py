"""The pipeline's stages, each on the one before's result, against brute force that shares no code with them."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import brute_contamination, brute_features, plain_best_fit, plain_spans

import corpus_pipeline
from chronicle.llm import common, packing, pii, toxicity


def staged(spark, sf_dir, folder):
    """(before, after) of each stage, written and read again in between."""
    docs, out = common.table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, before, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = (before, docs)
        assert name == "packing" or docs.columns == before.columns
    return out


def rows(df):
    """All rows as sorted tuples, as many times as they occur."""
    return sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()), key=repr)


def masked(text, spans):
    """The text with the spans, merged where they overlap, replaced by the kind of the one that starts first (of these the longest)."""
    out, last = "", 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= last:
            out += text[last:a] + f"[{kind.upper()}]"
        last = max(last, b)
    return out + text[last:]


def check(spark, sf_dir, stages):
    at = {c: i for i, c in enumerate(common.table(spark, sf_dir, "documents").columns)}
    key = lambda r: (r[at["doc_id"]], r[at["text"]])

    before, after = stages["toxicity"]
    grammar = toxicity.train(before, common.table(spark, sf_dir, "labels"))
    weights = grammar.weights
    toxic = lambda t: 1 / (1 + np.exp(-(weights[0] + np.dot(weights[1:], brute_features(t, grammar.lexicon, grammar.menaces))))) >= 0.7
    assert rows(after) == [r for r in rows(before) if not toxic(r[at["text"]])]

    before, after = stages["near_dedup"]
    had, got = rows(before), rows(after)
    assert set(got) <= set(had) and all(got.count(r) <= had.count(r) for r in got)
    one_each = defaultdict(set)
    for r, comp in zip(had, components([key(r) for r in had]), strict=True):
        one_each[comp].add(r)
    kept = defaultdict(list)
    for r in got:
        kept[next(comp for comp, own in one_each.items() if r in own)].append(r)
    for comp, own in one_each.items():
        words = (next(iter(own))[at["text"]] or "").strip(" \t\n\r\x0b\x0c")
        assert len(kept[comp]) == (1 if words else sum(had.count(r) for r in own))
        if words:
            ids = [r[at["doc_id"]] for r in own if r[at["doc_id"]] is not None]
            assert kept[comp][0][at["doc_id"]] == (min(ids) if ids else None)

    before, after = stages["decontamination"]
    items = [tuple(r) for r in common.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    bad = lambda r: brute_contamination([key(r)], items)[0][5]
    assert rows(after) == [r for r in rows(before) if not bad(r)]

    before, after = stages["pii"]
    found = {(r["doc_id"], r["text"]): r["spans"] for r in before.join(pii.find(before.select("text", "doc_id").distinct().select(F.col("doc_id"), "text")).select(F.col("doc_id").alias("d"), "spans"), F.col("doc_id").eqNullSafe(F.col("d"))).collect()} if before.select("doc_id").distinct().count() == before.count() else None
    want = []
    for r in rows(before):
        t = r[at["text"]]
        spans = pii.all_spans(t, plain_spans(t)) if t else []
        assert set(plain_spans(t or "")) <= set(spans)
        if found is not None:
            assert found[key(r)] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        new = masked(t, [(a, b, k) for k, a, b in spans]) if t else t
        x = list(r)
        x[at["text"]] = new
        if new != t:
            x[at["n_chars"]] = len(new)
        want.append(tuple(x))
    assert rows(after) == sorted(want, key=repr)

    before, after = stages["packing"]
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_vocabulary())
    want = []
    for r in rows(before):
        ids = [*exact.encode(r[at["text"]] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cut = [0, *range(first, len(ids) + 1, 1024)]
        want += [(r[at["doc_id"]], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False))]
    pieces = after.collect()
    assert sorted(((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces), key=repr) == sorted(want, key=repr)
    by = defaultdict(list)
    for p in pieces:
        by[p["sequence_id"]].append((p["offset"], p["length"]))
    for own in by.values():
        end = 0
        for a, n in sorted(own):
            assert a == end
            end += n
        assert end <= 1024
    assert len(by) <= plain_best_fit([p["length"] for p in pieces], 1024)


def components(docs):
    """A number for each document: that of its group of near duplicates, or its own text's if it has no words."""
    from test_llm_operators import Sets, shingles

    own, sets = [shingles(t, 5) for _, t in docs], Sets()
    for a in range(len(docs)):
        for b in range(a):
            if own[a] and own[b] and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b]):
                sets.join(a, b)
    empty = {}
    return [sets.top(i) if own[i] else ("empty", empty.setdefault(docs[i], i)) for i in range(len(docs))]


def test_stages(spark, sf_dir, tmp_path):
    check(spark, sf_dir, staged(spark, sf_dir, tmp_path))


def table_of(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, length long, __key array<int>, own string, sequence_id string, toxic string"


@pytest.mark.parametrize("empty", ["", "documents", "labels", "benchmark"])
def test_odd_tables(spark, tmp_path, empty):
    """Nulls in any column, empty and long texts, repeated rows, ties, columns that clash, and empty tables."""
    r = random.Random(7)
    word = lambda: r.choice(["ab", "cde", "Ä", "f", "ghij", "k7"]) + str(r.randint(0, 30))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, base = text(40), text(60)
    texts = [None, "", "  \n ", base, base, base.upper(), base + " one more", "you idiot. " * 30, text(2000) + ".", "mail ann@x.org or bob (at) y (dot) net", "+49 30 1234567", passage, text(300) + " " + passage, text(5), text(1), "<|endoftext|> a"]
    docs = [(i, t, r.choice(["de", None]), r.choice(["s", None]), len(t or ""), 5, [1], "o", None, "t") for i, t in enumerate(texts)]
    docs += [docs[3]] * 4 + [(None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)] + [docs[9], (9, docs[9][1], "zz", "other", 1, None, [], "p", "q", "u")]
    data = {
        "documents": (docs, DOCUMENTS),
        "labels": ([(i, None, int(i == 7)) for i in range(14)] + [(None, 1, 1), (7, 0, None)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, passage), (2, None), (3, ""), (None, text(20)), (1, passage)], "item_id long, text string"),
    }
    for name, (given, schema) in data.items():
        table_of(spark, tmp_path, name, [] if name == empty else given, schema)
    check(spark, str(tmp_path), staged(spark, str(tmp_path), tmp_path / "stages"))


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.count() > 0 and got.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
