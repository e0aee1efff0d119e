"""History scenarios: windows, checkpoints, what the checkpoints alone would know."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronicle.operators import history

MONDAY = datetime(2026, 1, 5, 3)
WEEK, DAY = timedelta(days=7), timedelta(days=1)
SCHEMA = f"k string, title string, {history.FROM} timestamp, {history.TO} timestamp"


def fold(spark, rows, times=None):
    v = spark.createDataFrame(rows, SCHEMA)
    grid = None if times is None else history.weekly_checkpoints(spark.createDataFrame([(t,) for t in times], "at timestamp"))
    return {r["k"]: r for r in history.fold(v, "k", grid).collect()}


def weeks(n):
    return [MONDAY + i * WEEK for i in range(n)]


def test_three_versions(spark):
    w = weeks(4)
    r = fold(spark, [("a", "1", w[0], w[1]), ("a", "2", w[1], w[3]), ("a", "3", w[3], None)], w)["a"]
    assert r["title"] == "3" and not r["absent"] and r[history.TO] is None
    assert r[history.FROM] == "2026-W02" and r["previous_update_dates"] == ["2026-W02", "2026-W04"] and r["last_updated"] == "2026-W04"


def test_closed_only(spark):
    w = weeks(3)
    r = fold(spark, [("a", "1", w[0], w[2]), ("b", "1", w[0], None)], w)
    assert r["a"]["absent"] and r["a"][history.TO] == "2026-W03" and not r["b"]["absent"]


def test_what_no_checkpoint_saw_is_not_there(spark):
    w = weeks(2)
    r = fold(spark, [("a", "1", w[0] + DAY, w[0] + 2 * DAY), ("b", "1", w[0], None)], w)
    assert set(r) == {"b"}


def test_a_window_that_ends_at_a_checkpoint_is_not_seen_by_it(spark):
    w = weeks(2)
    assert fold(spark, [("a", "1", w[0], w[1]), ("b", "x", w[0], None)], w)["a"]["absent"]


def test_changes_between_checkpoints_count_once_and_manual_runs_not(spark):
    w = weeks(2)
    r = fold(spark, [("a", "1", w[0], w[0] + DAY), ("a", "2", w[0] + DAY, w[0] + 2 * DAY), ("a", "3", w[0] + 2 * DAY, None)], [*w, w[0] + DAY, w[0] + 2 * DAY])["a"]
    assert r["previous_update_dates"] == ["2026-W02"] and r["title"] == "3"


def test_a_return_is_a_change(spark):
    w = weeks(3)
    r = fold(spark, [("a", "1", w[0], w[1]), ("a", "1", w[2], None)], w)["a"]
    assert r["previous_update_dates"] == ["2026-W03"] and not r["absent"]


def test_the_first_sighting_is_no_change_and_times_follow_from_windows(spark):
    w = weeks(2)
    r = fold(spark, [("a", "1", w[1], None), ("b", "1", w[0], None)])
    assert r["a"]["previous_update_dates"] == [] and r["a"]["last_updated"] is None and r["a"][history.FROM] == "2026-W02" and r["b"][history.FROM] == "2026-W02"


def test_no_checkpoints(spark):
    assert fold(spark, [("a", "1", MONDAY, None)], []) == {}
    assert fold(spark, [], weeks(1)) == {}


def test_missed_slot_falls_back(spark):
    w = weeks(2)
    times = spark.createDataFrame([(w[0],), (w[0] + DAY,), (w[1] + DAY,), (w[1] + 2 * DAY,)], "at timestamp")
    got = {r["week"]: (r["checkpoint"], r["fallback"]) for r in history.weekly_checkpoints(times).collect()}
    assert got == {"2026-W02": (w[0], False), "2026-W03": (w[1] + 2 * DAY, True)}


def test_ledger(spark):
    s = MONDAY.timestamp()
    ledger = spark.createDataFrame([(s - 99, 0, "extract"), (s, 0, "extract"), (s + 1, 1, "extract"), (s + 2, 0, "segments"), (s + 3, 0, "extract")], "load_id double, status int, kind string")
    got = history.ledger_times(ledger, spark.createDataFrame([(MONDAY,)], "at timestamp"))
    assert sorted(r[0] for r in got.collect()) == [MONDAY, MONDAY + timedelta(seconds=3)]


def test_apply(spark):
    def extract(*rows):
        return spark.createDataFrame(rows, "k string, a string, tags array<string>")

    v = extract().selectExpr("*", "cast(null as string) row_hash", f"cast(null as timestamp) {history.FROM}", f"cast(null as timestamp) {history.TO}")
    at = [F.lit(MONDAY + i * WEEK) for i in range(4)]
    first = [("x", None, ["1"]), ("y", "", []), ("z", "c", None)]
    v = history.apply_extract(v, extract(*first), at[0], "k")
    again = history.apply_extract(v, extract(*first), at[1], "k")
    assert sorted(map(str, again.collect())) == sorted(map(str, v.collect()))
    v = history.apply_extract(v, extract(("x", "", ["1"]), ("z", "c", None)), at[1], "k")  # null to empty is a change
    v = history.apply_extract(v, extract(*first), at[2], "k")
    rows = sorted((r["k"], str(r["a"]), r[history.FROM], r[history.TO]) for r in v.collect() if r["k"] == "x")
    w = weeks(3)
    assert rows == [("x", "", w[1], w[2]), ("x", "None", w[0], w[1]), ("x", "None", w[2], None)]
    assert v.where("k = 'y'").count() == 2 and v.where("k = 'z'").count() == 1 and history.count_live(v).first()[0] == 3


def test_latest_breaks_ties(spark):
    w = weeks(3)
    v = spark.createDataFrame([("a", "1", w[0], w[2]), ("a", "2", w[1], w[2])], SCHEMA)
    assert history.latest(v, "k").first()["title"] == "2"


def test_duplicates_are_refused(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",)], "k string")
    with pytest.raises(history.HistoryError, match="a, b$"):
        history.refuse_duplicates(df, "k")


def test_seen_searches_the_grid(spark):
    """A version stays one row, however many checkpoints it lived through, and the grid is found by search."""
    w = weeks(40)
    v = spark.createDataFrame([("a", "1", MONDAY, None), ("b", "1", w[3], w[7]), ("c", "1", w[3] + DAY, w[4]), ("d", "1", MONDAY - WEEK, w[39] + WEEK)], SCHEMA)
    grid = history.weekly_checkpoints(spark.createDataFrame([(t,) for t in w], "at timestamp"))
    rows = history.seen(v, grid, "k")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "Generate" not in plan
    assert {r["k"]: (r["__lo"], r["__hi"]) for r in rows.collect()} == {"a": (0, 39), "b": (3, 6), "d": (0, 39)}


def test_search_against_brute_force(spark):
    r = random.Random(4)
    for n in (0, 1, 2, 3, 7, 8, 33):
        grid = sorted({MONDAY + timedelta(hours=r.randint(0, 2000)) for _ in range(n)})
        times = [MONDAY + timedelta(hours=r.randint(-5, 2010)) for _ in range(40)] + grid
        df = spark.createDataFrame([(t, grid) for t in times], "t timestamp, g array<timestamp>").select("t", history._before(F.col("g"), F.col("t")).alias("n"))
        assert [x["n"] for x in df.collect()] == [sum(c < t for c in grid) for t in times]


def test_null_content_and_null_keys(spark):
    w = weeks(4)
    ev = spark.createDataFrame([("a", None, w[0]), ("a", None, w[1]), ("a", "x", w[2]), ("a", None, w[3])], "k string, c string, at timestamp")
    got = [(r["c"], r[history.FROM], r[history.TO]) for r in history.islands(ev, "k", "c", "at").orderBy(history.FROM).collect()]
    assert got == [(None, w[0], w[2]), ("x", w[2], w[3]), (None, w[3], None)]
    extract = spark.createDataFrame([(None, "1"), ("b", "2")], "k string, a string")
    v = extract.limit(0).selectExpr("*", "cast(null as string) row_hash", f"cast(null as timestamp) {history.FROM}", f"cast(null as timestamp) {history.TO}")
    for t in w:
        v = history.apply_extract(v, extract, F.lit(t), "k")
    assert v.count() == 2 and history.count_live(v).first()[0] == 2
    with pytest.raises(history.HistoryError, match="k is null"):
        history.refuse_duplicates(extract, "k")


def test_upsert_ties(spark):
    old, new = spark.createDataFrame([("a", "old", 1), ("b", "old", None)], "k string, v string, t int"), spark.createDataFrame([("a", "new", 1), ("b", "n2", None), ("b", "n1", None)], "k string, v string, t int")
    one = sorted(map(tuple, history.upsert(old, new, "k", "t").collect()))
    assert one == sorted(map(tuple, history.upsert(old.repartition(3), new.repartition(5), "k", "t").collect())) and one[0] == ("a", "new", 1) and one[1][1] in ("n1", "n2")


def test_keyed_loads_equal_general_ones(spark):
    """Unique keys: joined by the key alone, windows come out the same."""
    r = random.Random(9)
    schema = "k long, title string, tags array<string>"
    live = spark.createDataFrame([], f"{schema}, row_hash string, {history.FROM} timestamp, {history.TO} timestamp")
    for day in range(4):
        rows = [(k, r.choice(["a", "b", None]), r.choice([None, [], ["x"]])) for k in range(60) if r.random() < 0.8]
        extract, now = spark.createDataFrame(rows, schema), F.lit(MONDAY + day * DAY)
        one, two = history.apply_live(live, extract, now, "k"), history.apply_keyed(live, extract, now, "k")
        assert one.dtypes == two.dtypes and sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
        live = spark.createDataFrame(one.where(F.col(history.TO).isNull()).collect(), one.schema)


def test_live_rows_in_buckets_are_not_shuffled(spark, tmp_path):
    """From the stored buckets to the join, and from there to new buckets, there is no exchange on the live side."""
    from chronicle.sinks import tables

    schema = f"k long, title string, row_hash string, {history.FROM} timestamp, {history.TO} timestamp"
    store = tables.Store(spark, str(tmp_path / "it's"))
    extract = spark.range(200).selectExpr("id AS k", "concat('t', id % 7) AS title")
    first = history.apply_keyed(spark.createDataFrame([], schema), extract, F.lit(MONDAY), "k")
    part = store.write_buckets(first, "v/open", "k", 8)
    live = store.buckets(part, "k", schema)
    later = extract.selectExpr("k", "IF(k % 10 = 0, 'new', title) AS title").where("k <> 5")
    merged = history.apply_keyed(live, later, F.lit(MONDAY + DAY), "k")
    plan = merged._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
    assert "Bucketed: true" in plan[scan]
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any("Exchange" in line for line in plan[join:scan])  # the other side comes after
    assert sum("Exchange" in line for line in plan) == 1
    again = store.write_buckets(merged.where(F.col(history.TO).isNull()), "v/open", "k", 8)
    files = [p.name for p in (tmp_path / "it's" / again).glob("part-*.parquet")]
    assert len(files) <= 8 and len({f.split("_")[1][:5] for f in files}) == len(files)  # one file a bucket
    back = store.buckets(again, "k", schema)
    assert back.count() == 199 and back.where("title = 'new'").count() == 20
    assert store.vacuum(1, older=-60) == sorted([part, again])
