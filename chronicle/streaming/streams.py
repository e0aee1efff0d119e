"""The same operators on streams: history in micro-batches, weeks as tumbling windows, sessions, runs of content."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chronicle.functions.timeops import iso_week


def timed(events: DataFrame, at: str, late: str) -> DataFrame:
    """With a watermark; a timestamp without time zone is taken as UTC, as watermarks need one."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def weekly(events: DataFrame, at: str, *aggregates: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Tumbling ISO weeks: seven days from Monday."""
    window = F.window(F.col(at), "7 days", "7 days", "4 days")
    return events.groupBy(window.alias("w"), *by).agg(*aggregates).withColumn("week", iso_week(F.col("w.start"))).drop("w")


def sliding(events: DataFrame, at: str, width: str, step: str, *aggregates: Column) -> DataFrame:
    return events.groupBy(F.window(F.col(at), width, step).alias("w")).agg(*aggregates).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "*").drop("w")


def sessions(events: DataFrame, at: str, key: str, gap: str, *aggregates: Column) -> DataFrame:
    return events.groupBy(F.session_window(F.col(at), gap).alias("w"), key).agg(*aggregates).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "*").drop("w")


def extracts(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """Each micro-batch is one full extract; `apply` merges it. A batch that comes again changes nothing, as equal rows stay open."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def content_runs(events: DataFrame, key: str, content: str, at: str, idle: int = 0) -> DataFrame:
    """(key, content, since, until) of runs of equal content (null is one), kept as state by key.

    A run ends when the content changes. With `idle` (milliseconds of event time; the stream needs a watermark) it
    also ends, at its last event, when the watermark has left that event so far behind; the key's state goes then.
    Runs are put out once: an event older than the last one that its key has seen in an earlier batch is left out. Where
    late events count, see `late.changes`.
    """
    schema = f"{key} long, {content} string, since timestamp, until timestamp"

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            now, since, last = state.get
            state.remove()
            yield pd.DataFrame({key: [k[0]], content: [now], "since": pd.to_datetime([since], unit="us"), "until": pd.to_datetime([last], unit="us")})
            return
        rows = pd.concat(list(frames)).sort_values(at)
        said = rows[content].astype(object).where(rows[content].notna(), None).tolist()
        micros = rows[at].to_numpy("datetime64[us]").astype("int64")
        if state.exists:
            now, since, last = state.get
            new = micros >= last
            if not new.any():
                if idle:
                    state.setTimeoutTimestamp(max(last // 1000 + idle, state.getCurrentWatermarkMs() + 1))
                return
            said = [now, *(c for c, keep in zip(said, new, strict=True) if keep)]
            micros = np.concatenate(([since], micros[new]))
        codes, _ = pd.factorize(pd.Series(said, dtype=object), use_na_sentinel=False)
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        times = pd.to_datetime(micros[first], unit="us")
        state.update((said[first[-1]], int(micros[first[-1]]), int(micros[-1])))
        if idle:
            state.setTimeoutTimestamp(max(int(micros[-1]) // 1000 + idle, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [k[0]] * (len(first) - 1), content: pd.Series([said[i] for i in first[:-1]], dtype=object), "since": times[:-1], "until": times[1:]})

    rows = events.select(key, content, at)
    timeout = GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return rows.groupBy(key).applyInPandasWithState(step, schema, f"{content} string, since long, last long", "append", timeout)
