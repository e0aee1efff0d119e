"""Order statistics against sorted lists."""

import math
import random

from pyspark.sql import functions as F

from chronicle.operators import selection

FRACTIONS = [0.0, 0.25, 0.5, 0.9, 1.0]


def test_quantiles_of_sorted_lists(spark):
    r = random.Random(1)
    groups = {
        "even": [float(r.randint(0, 5)) for _ in range(40)],
        "wide": [r.choice([1, -1]) * 10.0 ** r.randint(-300, 300) for _ in range(201)],
        "close": [1.0 + k * 2**-52 for k in range(30)],
        "same": [7.5] * 100,
        "one": [3.0],
        "ends": [float("-inf"), 1.0, 2.0, float("inf")],
        "huge": [-1.7e308, 1.7e308, 0.0, 1e308],
        None: [r.gauss(0, 1) for _ in range(500)],
    }
    rows = [(g, v) for g, own in groups.items() for v in own] + [("even", None), ("even", float("nan")), ("none", None)]
    r.shuffle(rows)
    got = selection.quantiles(spark.createDataFrame(rows, "g string, v double"), "v", FRACTIONS, ["g"]).collect()
    assert {x["g"] for x in got} == set(groups)
    for x in got:
        own = sorted(groups[x["g"]])
        assert x["n"] == len(own)
        place = x["fraction"] * (len(own) - 1)
        a, b = own[math.floor(place)], own[math.ceil(place)]
        want = a if a == b or place == math.floor(place) else a + (b - a) * (place - math.floor(place))
        assert x["value"] == want or (math.isnan(want) and math.isnan(x["value"])), (x, want)


def test_whole_columns_and_types(spark):
    df = spark.range(1001).selectExpr("id", "CAST(id AS decimal(10,2)) AS d", "timestamp_seconds(id) AS t", "IF(id < 700, 5L, id) AS skewed")
    for column, want in (("id", 500.0), ("d", 500.0), ("t", 500.0), ("skewed", 5.0)):
        assert [tuple(x) for x in selection.quantiles(df, column, [0.5]).collect()] == [(0.5, 1001, want)]
    assert selection.quantiles(df.limit(0), "id", [0.5]).count() == 0
    ranks = spark.createDataFrame([(0,), (1000,)], "rank long")
    assert sorted(x["value"] for x in selection.ranked(df, "id", ranks).collect()) == [0.0, 1000.0]


def test_no_task_gets_the_values(spark):
    """Rows are counted before they are dealt out: the exchange below the window has bins, not values."""
    df = spark.range(20_000).select((F.rand(3) * 1e6).alias("v"))
    plan = selection.quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_list" not in plan and "partial_count" in plan
