"""Type-2 versions of a stream whose events come late and out of order.

Each key keeps the events that may still get company: those newer than the watermark, and the beginning of the
version that holds there. A batch's events go in at their own time, the key's versions are made again from what is kept, and
what differs from before is put out: a version that is new, one that closes at another time than said, and one that there
is no longer (`gone`). So a window closes retroactively, or is split, when an event turns up inside it. `settled` makes
the versions from all that was put out; for events within the allowed lateness they are those that the whole
set of events gives, in whatever batches and order it came.

A timer drops a key's passed events when the watermark has left its last one behind. Events older than the watermark
are past the allowed lateness; Spark leaves them out and counts them (`numRowsDroppedByWatermark`). Events of one time are taken in the order of their content, null
first; rows without a key or a time are left out. State is in RocksDB, by key; a key's events within the lateness must fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from chronicle.operators.history import FROM, TO

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
Event = tuple[int, str | None]  # microseconds, content


def order(event: Event) -> tuple:
    return event[0], event[1] is not None, event[1] or ""


def versions(events: list[Event]) -> dict[tuple[int, str | None], int | None]:
    """Runs of equal content of sorted events: (beginning, content) and end."""
    starts = [e for i, e in enumerate(events) if not i or events[i - 1][1] != e[1]]
    return {e: (starts[i + 1][0] if i + 1 < len(starts) else None) for i, e in enumerate(starts)}


def pruned(events: list[Event], mark: int) -> list[Event]:
    """What is kept of sorted events when nothing older than `mark` can come: later ones, and the beginning of the run before them."""
    passed = [e for e in events if e[0] <= mark]
    if not passed:
        return events
    i = len(passed) - 1
    while i and passed[i - 1][1] == passed[-1][1]:
        i -= 1
    return [passed[i], *events[len(passed) :]]


class _Versions(StatefulProcessor):
    """State of a key: its kept events, whether older ones were dropped from it, how often it has put out rows, and when it is looked at again.

    It is one value, read and written once a batch, and rows go through as they are: each call to the state store and each
    frame of a key costs more than the key's work.
    """

    def __init__(self, key: str, content: str) -> None:
        self.names = (key, content, FROM, TO, "gone", "revision")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "at array<long>, content array<string>, cut boolean, revision long, timer long")

    def _held(self) -> tuple[list[Event], bool, int, int | None]:
        said = self.known.get()
        if said is None:
            return [], False, 0, None
        at, content, cut, revision, timer = said
        return list(zip(at, content, strict=True)), cut, revision, timer

    def _keep(self, events: list[Event], cut: bool, revision: int, timer: int | None, mark: int) -> None:
        left = pruned(events, mark)
        wanted = left[-1][0] // 1000 + 1 if left and left[-1][0] > mark else None
        if wanted != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        self.known.update(([a for a, _ in left], [c for _, c in left], cut or len(left) < len(events), revision, wanted))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held, cut, revision, timer = self._held()
        new: list[Event] = [(row["micros"], row["content"]) for row in rows]
        merged = sorted([*held, *(e for e in new if not (cut and order(e) < order(held[0])))], key=order)
        before, after = versions(held), versions(merged)
        said = [(*v, until, False) for v, until in after.items() if v not in before or before[v] != until]
        said += [(*v, None, True) for v in before if v not in after]
        self._keep(merged, cut, revision + 1, timer, timerValues.getCurrentWatermarkInMs() * 1000)
        row = Row(*self.names)
        for start, content, until, gone in said:
            yield row(key[0], content, start, until, gone, revision + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, cut, revision, _ = self._held()  # its timer is gone
        self._keep(held, cut, revision, None, timerValues.getCurrentWatermarkInMs() * 1000)
        return iter(())

    def close(self) -> None:
        pass


def changes(events: DataFrame, key: str, content: str, at: str, lateness: str) -> DataFrame:
    """What a stream of events changes in the versions of its keys: (key, content, from, to, gone, revision), to be appended."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key), F.col(content).cast("string").alias("content"), F.col(at).cast("timestamp").alias("at")).withWatermark("at", lateness).withColumn("micros", F.unix_micros("at"))
    kind = events.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField(content, T.StringType()), T.StructField(FROM, T.LongType()), T.StructField(TO, T.LongType()), T.StructField("gone", T.BooleanType()), T.StructField("revision", T.LongType())])
    said = rows.groupBy(key).transformWithState(statefulProcessor=_Versions(key, content), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    return said.select(key, content, *(F.timestamp_micros(c).alias(c) for c in (FROM, TO)), "gone", "revision")


def settled(said: DataFrame, key: str, content: str) -> DataFrame:
    """The versions as the last word on each says: (key, content, from, to)."""
    last = said.groupBy(key, FROM, content).agg(F.max_by(F.struct(TO, "gone"), "revision").alias("last"))
    return last.where(~F.col("last.gone")).select(key, content, FROM, F.col(f"last.{TO}").alias(TO))
