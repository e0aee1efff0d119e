"""The boundary tagger: its chain against enumeration, its decoding, what it learns."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronicle.operators import segment, tagger


def labellings(scores, steps):
    """All labellings of a row with their scores."""
    for y in itertools.product((0, 1), repeat=len(scores) - 1):
        y = (0, *y)
        yield y, sum(s for s, k in zip(scores[1:], y[1:], strict=True) if k) + sum(steps[a][b] for a, b in itertools.pairwise(y))


def test_chain_by_enumeration():
    r = np.random.default_rng(1)
    steps = r.normal(size=(2, 2))
    lengths = np.array([1, 2, 4, 6])
    scores = r.normal(size=(4, 6)) * 2
    inside, taken, total = tagger._chain(scores, lengths, steps)
    expected = np.zeros((2, 2))
    for k, n in enumerate(lengths):
        every = [(y, np.exp(s)) for y, s in labellings(scores[k, :n], steps)]
        z = sum(p for _, p in every)
        assert np.isclose(total[k], np.log(z))
        for t in range(n):
            assert np.isclose(inside[k, t], sum(p for y, p in every if y[t]) / z)
        assert (inside[k, n:] == 0).all()
        for y, p in every:
            for a, b in itertools.pairwise(y):
                expected[a, b] += p / z
    assert np.allclose(taken, expected)


def test_gradient_by_differences():
    r = random.Random(2)
    words = [[r.choice(["kleine", "Haus", "(x)", "rote", "Dorf"]) for _ in range(n)] for n in (1, 2, 3, 5)]
    labels = [np.array([0] + [r.randint(0, 1) for _ in w[1:]]) for w in words]
    ids = [np.array(tagger.features(w, 6)) for w in words]
    own = tagger.Tagger(6, np.random.default_rng(3).normal(size=64), np.random.default_rng(4).normal(size=(2, 2)))
    by_feature, by_step, likely = tagger._gradient(own, ids, labels)
    for k in range(0, 64, 5):
        moved = tagger.Tagger(6, own.weights + 1e-5 * (np.arange(64) == k), own.steps)
        assert np.isclose((tagger._gradient(moved, ids, labels)[2] - likely) / 1e-5, by_feature[k], atol=1e-3)
    for a, b in itertools.product((0, 1), repeat=2):
        steps = own.steps.copy()
        steps[a, b] += 1e-5
        assert np.isclose((tagger._gradient(tagger.Tagger(6, own.weights, steps), ids, labels)[2] - likely) / 1e-5, by_step[a, b], atol=1e-3)


def test_viterbi_by_enumeration(spark):
    r = random.Random(5)
    rows = [(i, [r.choice([-1.5, -0.5, 0.0, 0.5, 2.0]) for _ in range(r.randint(0, 7))]) for i in range(200)]
    steps = [[0.25, -0.5], [0.5, -0.25]]
    got = {x["i"]: x["y"] for x in spark.createDataFrame(rows, "i int, s array<double>").select("i", tagger.viterbi(F.col("s"), steps).alias("y")).collect()}
    for i, s in rows:
        every = dict(labellings([0.0, *s], steps))
        assert len(got[i]) == len(s) + 1 and every[tuple(got[i])] == max(every.values())
    tie = spark.createDataFrame([([0.0, 0.0],)], "s array<double>").select(tagger.viterbi(F.col("s"), [[0, 0], [0, 0]]).alias("y")).first()["y"]
    assert tie == [0, 0, 0]


def corpus(seed, n):
    """Values whose author set delimiters; adjectives with an ending belong to what follows."""
    r = random.Random(seed)
    fields = lambda: r.choice([f"{r.choice(['kleine', 'rote', 'schöner', 'altes'])} {r.choice(['Haus', 'Boote', 'Wege', 'Tier'])}", r.choice(["Boote", "Wege", "Tier", "Brot", "Feuer"]), f"Berg {r.choice(['Haus', 'Tier'])}"])
    return [(", ".join(fields() for _ in range(r.randint(2, 5))),) for _ in range(n)]


def test_it_learns_from_distant_labels(spark):
    train = segment.distant(spark.createDataFrame(corpus(1, 400), "value string"), "value").repartition(3)
    held = segment.distant(spark.createDataFrame(corpus(2, 150), "value string"), "value")
    made, likely = tagger.fit(train, bits=12, rounds=12)
    assert all(b > a for a, b in itertools.pairwise(likely[2:]))
    got = {x["by"]: x["f1"] for x in tagger.quality(held, made).collect()}
    assert got["tagger"] > 0.95 > 0.9 > got["never join"]
    again = tagger.quality(held, tagger.Tagger(12)).where("by = 'tagger'").first()["f1"]
    assert again == got["never join"]  # without weights no words are joined
    scored = segment.scored(held.select(F.array_join("tokens", " ").alias("v")), "v", made).collect()
    sure = [(p > 0.5) for x in scored for p in x["probabilities"]]
    assert any(sure) and not all(sure) and all(len(x["probabilities"]) == max(0, len(x["tokens"]) - 1) for x in scored)


def test_edges(spark):
    made = tagger.Tagger(8)
    df = spark.createDataFrame([([],), (["one"],), (None,), (["é" * 5000, "😀"],)], "tokens array<string>")
    got = [x["sizes"] for x in tagger.tagged(df, "tokens", made).collect()]
    assert got == [[], [1], [], [1, 1]] and made([[], ["a"], ["a", "b"]])[:2] == [[], []]
    none = spark.createDataFrame([], "tokens array<string>, labels array<int>")
    assert not tagger.fit(none, bits=4, rounds=1)[0].weights.any()
    for bad in ((["a", "b"], [0]), (["a", "b"], [1, 0])):
        with pytest.raises(Exception, match="labels that don't fit"):
            tagger.fit(spark.createDataFrame([bad], "tokens array<string>, labels array<int>"), bits=4, rounds=1)


def test_rows_of_a_batch_are_views():
    """Also of a slice, of lists without numbers and of no lists."""
    lists = pa.array([[9, 9], [1, 2, 3, 4], [], [5, 6], [7, 8]], pa.list_(pa.int32()))
    assert [x.tolist() for x in tagger._views(lists[1:4], 2)] == [[[1, 2], [3, 4]], [], [[5, 6]]]
    assert [x.tolist() for x in tagger._views(lists[3:], 1)] == [[5, 6], [7, 8]] and tagger._views(lists[:0], 2) == []
    assert all(x.base is not None for x in tagger._views(lists, 2))


def test_viterbi_folds_once(spark):
    """One fold a row: a fold that another one names is made anew in each place."""
    plan = spark.createDataFrame([([0.5],)], "s array<double>").select(tagger.viterbi(F.col("s"), [[0, 0], [0, 0]]).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
