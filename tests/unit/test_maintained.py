"""The maintained history against the full fold, after each of many random loads."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronicle.operators import history, maintained

START = datetime(2024, 1, 1, 3)
SCHEMA = f"k long, title string, n int, row_hash string, {history.FROM} timestamp, {history.TO} timestamp"


def loads(seed, n):
    """Random times: on the slot, off it, several in a week, weeks left out."""
    r = random.Random(seed)
    at, out = START, []
    for _ in range(n):
        at += r.choice([timedelta(days=7), timedelta(days=7), timedelta(days=2, hours=5), timedelta(hours=9), timedelta(days=16)])
        out.append(at)
    return out


def after(live, closed, r, at):
    """One more extract over entities 0..19: they stay, change, go or return."""
    for k in range(20):
        now = live.get(k)
        act = r.random()
        if now is None and act < 0.3:
            live[k] = (r.choice("ab"), at)
        elif now is not None and act < 0.15:
            closed.append((k, now[0], 1, None, now[1], at))
            del live[k]
        elif now is not None and act < 0.4:
            closed.append((k, now[0], 1, None, now[1], at))
            live[k] = (now[0] + r.choice("xy"), at)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_the_full_fold(spark, seed):
    r = random.Random(seed)
    live, closed, times, state, old, advanced = {}, [], [], None, [], 0
    for at in loads(seed, 12):
        after(live, closed, r, at)
        times.append(at)
        if r.random() < 0.2:
            continue  # a load that isn't published
        rows = closed + [(k, t, 1, None, since, None) for k, (t, since) in live.items()]
        versions = spark.createDataFrame(rows, SCHEMA).coalesce(2)
        checkpoints = history.weekly_checkpoints(spark.createDataFrame([(t,) for t in times], "at timestamp"))
        new = maintained.grid(checkpoints)
        advanced += maintained.advances(old, new)
        news = maintained.changed(versions, "k", old, new, state)
        state = spark.createDataFrame(maintained.merged(state, news, "k").collect(), news.schema)
        old = new
        got, want = maintained.folded(state, "k", new), history.fold(versions, "k", checkpoints)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), at
    assert advanced >= 6


def test_only_touched_entities_are_folded(spark):
    weeks = [START + timedelta(days=7 * i) for i in range(3)]
    rows = [(k, "a", 1, None, weeks[0], None) for k in range(50)]
    one = spark.createDataFrame(rows, SCHEMA)
    state = maintained.changed(one, "k", [], weeks[:1], None)
    state = spark.createDataFrame(state.collect(), state.schema)
    rows[3] = (3, "a", 1, None, weeks[0], weeks[1])
    two = spark.createDataFrame([*rows, (3, "b", 1, None, weeks[1], None), (99, "new", 1, None, weeks[1] + timedelta(hours=1), None)], SCHEMA)
    news = maintained.changed(two, "k", weeks[:1], weeks[:2], state)
    assert sorted(x["k"] for x in news.collect()) == [3, 99]
    state = maintained.merged(state, news, "k")
    got = {x["k"]: x for x in maintained.folded(state, "k", weeks[:2]).collect()}
    assert len(got) == 50 and 99 not in got and got[3]["title"] == "b" and got[3]["previous_update_dates"] == ["2024-W01"]
    plan = maintained.touched(two, weeks[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "Join" not in plan


def test_lists_that_differ_further_back_are_folded_anew(spark):
    w = [START + timedelta(days=7 * i) for i in range(4)]
    assert maintained.advances(w[:2], w[:3]) and maintained.advances(w[:2], [w[0], w[3]]) and not maintained.advances(w[:3], [w[0], w[3]]) and not maintained.advances([], w)
    versions = spark.createDataFrame([(1, "a", 1, None, w[0], w[2]), (None, "b", 1, None, w[0], None)], SCHEMA)
    wrong = maintained.changed(versions, "k", [], w[:3], None).withColumn("content", F.lit(None).cast("struct<k:bigint,title:string,n:int,row_hash:string>"))
    right = maintained.changed(versions, "k", w[:3], [w[0], w[3]], wrong)
    assert [tuple(x) for x in maintained.folded(right, "k", [w[0], w[3]]).select("k", "title", "absent").collect()] == [(1, "a", True)]
    empty = maintained.changed(versions.limit(0), "k", [], [], None)
    assert maintained.folded(empty, "k", []).count() == 0
