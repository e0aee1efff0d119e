"""Versions of late and shuffled streams against those of the whole set of events."""

import random
from datetime import datetime, timedelta

import pytest

from chronicle.operators import history
from chronicle.streaming import late

START = datetime(2024, 1, 1)
SCHEMA = "k long, content string, at timestamp"


def streamed(spark, tmp_path, batches, lateness):
    """What is put out when the batches come one after the other."""
    src = tmp_path / "in"
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema(SCHEMA).parquet(str(src))
        q = late.changes(stream, "k", "content", "at", lateness).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
        assert q.awaitTermination(300)
    return spark.read.parquet(str(tmp_path / "out"))


def batch_versions(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[0] is not None and r[2] is not None], SCHEMA)
    return sorted(map(repr, map(tuple, history.islands(df, "k", "content", "at").select("k", "content", history.FROM, history.TO).collect())))


def test_shuffled_batches_give_the_batch_result(spark, tmp_path):
    r = random.Random(3)
    rows = [(r.randint(0, 6), r.choice(["a", "b", None]), START + timedelta(minutes=r.randint(0, 300))) for _ in range(160)] + [(None, "x", START), (1, "x", None)]
    r.shuffle(rows)
    said = streamed(spark, tmp_path, [rows[:60], rows[60:110], rows[110:]], "2 days")
    assert sorted(map(repr, map(tuple, late.settled(said, "k", "content").collect()))) == batch_versions(spark, rows)
    assert said.where("gone").count() > 0


def test_what_the_watermark_passes_is_pruned(spark, tmp_path):
    """Events a little late split and close windows afterwards; one that is too late changes nothing."""
    t = lambda h: START + timedelta(hours=h)
    batches = [
        [(1, "a", t(0)), (1, "a", t(10)), (2, "q", t(1))],
        [(1, "b", t(5)), (1, "c", t(30))],  # inside the first window
        [(1, "d", t(60)), (3, "z", t(90))],
        [(1, "no", t(2)), (1, "e", t(85))],  # the first is too late
    ]
    said = streamed(spark, tmp_path, batches, "12 hours")
    kept = [x for b in batches for x in b if x[1] != "no"]
    assert sorted(map(repr, map(tuple, late.settled(said, "k", "content").collect()))) == batch_versions(spark, kept)


@pytest.mark.parametrize("seed", range(3))
def test_pruning_keeps_what_later_versions_need(seed):
    r = random.Random(seed)
    for _ in range(300):
        events = sorted(((r.randint(0, 20), r.choice(["a", "b", None])) for _ in range(r.randint(0, 9))), key=late.order)
        mark = r.randint(-1, 21)
        more = [(r.randint(mark + 1, 25), r.choice(["a", "b", None])) for _ in range(r.randint(0, 4))]
        whole = late.versions(sorted(events + more, key=late.order))
        left = late.pruned(events, mark)
        tail = late.versions(sorted(left + more, key=late.order))
        assert {v: u for v, u in whole.items() if u is None or u > mark}.items() <= tail.items() <= whole.items()


def test_a_key_is_read_and_written_once_a_batch():
    """One value of state, read and written once; a timer is set anew only if its time differs."""
    calls, state = [], {}

    class Known:
        def get(self):
            calls.append("get")
            return state.get("x")

        def update(self, x):
            calls.append("update")
            state["x"] = x

    class Handle:
        getValueState = staticmethod(lambda *_: Known())  # noqa: N815
        registerTimer = staticmethod(lambda _: calls.append("register"))  # noqa: N815
        deleteTimer = staticmethod(lambda _: calls.append("delete"))  # noqa: N815

    class Clock:
        getCurrentWatermarkInMs = staticmethod(lambda: 0)  # noqa: N815

    own = late._Versions("k", "content")
    own.init(Handle())
    event = lambda a, c: {"micros": a * 1000, "content": c}
    out = [r.asDict() for r in own.handleInputRows((7,), iter([event(9, "a"), event(5, "b")]), Clock())]
    assert calls == ["get", "register", "update"] and [(r["k"], r["content"], r[history.FROM], r[history.TO], r["gone"]) for r in out] == [(7, "b", 5000, 9000, False), (7, "a", 9000, None, False)]
    calls.clear()
    out = [tuple(r) for r in own.handleInputRows((7,), iter([event(6, None)]), Clock())]
    assert calls == ["get", "update"] and sorted(out, key=lambda r: r[2]) == [(7, "b", 5000, 6000, False, 2), (7, None, 6000, 9000, False, 2)]
