"""Points in intervals against all pairs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronicle.operators import intervals

START = datetime(2024, 1, 1)
SPANS, POINTS = "k string, s timestamp, e timestamp, i int", "k string, at timestamp, p int"


def made(seed, n, m):
    r = random.Random(seed)
    when = lambda: START + timedelta(microseconds=r.choice([r.randint(0, 10**13), r.randint(0, 10**7), 5 * 10**6, 0]))
    spans = []
    for i in range(n):
        s = when()
        e = r.choice([None, s, s - timedelta(days=1), s + timedelta(microseconds=1), s + timedelta(seconds=r.randint(1, 90)), s + timedelta(days=r.randint(1, 400)), when()])
        spans.append((r.choice(["a", "a", "b", None]), r.choice([s, s, s, None]), e, i))
    return spans, [(r.choice(["a", "a", "b", None]), r.choice([when(), when(), when(), None]), p) for p in range(m)]


def brute(spans, points, keyed):
    return sorted((i, p) for k, s, e, i in spans for j, at, p in points if s and at and s <= at and (e is None or at < e) and (not keyed or (k is not None and k == j)))


@pytest.mark.parametrize("seed,most", [(1, 100_000), (2, 7)])
def test_all_pairs(spark, seed, most):
    spans, points = made(seed, 150, 200)
    a, b = spark.createDataFrame(spans, SPANS), spark.createDataFrame(points, POINTS)
    got = intervals.contained(a, b, "s", "e", "at", "k", most=most)
    assert got.columns == ["k", "s", "e", "i", "at", "p"]
    assert sorted((x["i"], x["p"]) for x in got.collect()) == brute(spans, points, True)
    free = intervals.contained(a.drop("k"), b.drop("k"), "s", "e", "at", unit=1000, most=most)
    assert sorted((x["i"], x["p"]) for x in free.collect()) == brute(spans, points, False)


def test_plan_and_edges(spark):
    spans, points = made(3, 20, 20)
    a, b = spark.createDataFrame(spans, SPANS), spark.createDataFrame(points, POINTS)
    got = intervals.contained(a.drop("k"), b.drop("k"), "s", "e", "at")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.contained(a.limit(0), b, "s", "e", "at", "k").count() == 0 == intervals.contained(a, b.limit(0), "s", "e", "at", "k").count()
    with pytest.raises(ValueError, match="both sides"):
        intervals.contained(a, b, "s", "e", "at")


def test_a_hot_bin_is_shared_out(spark):
    """A third of the points at one time, most intervals around it: no task gets them all."""
    spans = spark.range(50).select(F.lit(START).alias("s"), F.lit(None).cast("timestamp").alias("e"), F.col("id").alias("i"))
    points = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(START)).otherwise(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1000)).alias("at"), F.col("id").alias("p"))
    got = intervals.contained(spans, points, "s", "e", "at", most=100)
    assert got.count() == 50 * 3000 and got.distinct().count() == 50 * 3000
