"""The folded history kept up to date: after a load only entities that it touched are folded, from what they were.

The state has one row for each entity: its last content, the checkpoints that first saw each of its versions, and the
last one that saw it (null: every one since sees it). Two checkpoint lists share a beginning; let S be the last they share. A
version that neither begins nor ends after S means the same to both, so only entities with one that does are folded, from
the state as it was at S and from those versions. Of the checkpoints after S only the last one
can be another next time, so the state also keeps who was seen before that; lists that differ further back are folded anew.
An entity that nothing touched stays as it is: whether it is absent follows from the last checkpoint when the state is read.

Windows of one entity don't overlap; entities without a key have no history. An entity that no checkpoint has seen yet is in
the state, but not in the folded table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.functions.timeops import iso_week
from chronicle.operators.history import FROM, TO, _before

FIRSTS, SEEN, STABLE, AS_OF, ROW = "firsts", "seen", "stable", "as_of", "content"


def grid(checkpoints: DataFrame) -> list[datetime]:
    """The checkpoints, one a week, in order."""
    return [r[0] for r in checkpoints.where("checkpoint is not null").select("checkpoint").distinct().orderBy("checkpoint").collect()]


def _times(grid: Sequence[datetime]) -> Column:
    return F.array(*(F.lit(x) for x in grid)).cast("array<timestamp>") if grid else F.array().cast("array<timestamp>")


def shared(old: Sequence[datetime], new: Sequence[datetime]) -> int:
    """How many checkpoints two lists share from the beginning."""
    return next((i for i, (a, b) in enumerate(zip(old, new, strict=False)) if a != b), min(len(old), len(new)))


def advances(old: Sequence[datetime], new: Sequence[datetime]) -> bool:
    """Whether a state of the old list can be taken on to the new one: at most the old list's last checkpoint is gone."""
    return bool(old) and shared(old, new) >= max(1, len(old) - 1)


def touched(versions: DataFrame, since: datetime | None) -> DataFrame:
    """The versions that begin or end after a time; a filter that files can be skipped by."""
    return versions if since is None else versions.where((F.col(FROM) > F.lit(since)) | (F.col(TO) > F.lit(since)))


def changed(versions: DataFrame, key: str, old: Sequence[datetime], new: Sequence[datetime], state: DataFrame | None) -> DataFrame:
    """New state rows of all entities that must be folded again."""
    if state is None or not advances(old, new):
        state, old = None, []
    k = shared(old, new)
    since, tail = (new[k - 1] if k else None), list(new[k:])
    columns = [x for x in versions.columns if x not in (FROM, TO)]
    times = _times(tail)
    rows = touched(versions, since).where(F.col(key).isNotNull())
    first, last = _before(times, F.col(FROM)), F.when(F.col(TO).isNull(), F.lit(len(tail))).otherwise(_before(times, F.col(TO))) - 1
    rows = rows.withColumns({"__lo": first, "__hi": last, "__times": times}).withColumn("__sees", F.col("__lo") <= F.col("__hi"))
    began = F.lit(False) if since is None else F.col(FROM) <= F.lit(since)
    at = lambda i: F.get("__times", i)
    before_last = F.least("__hi", F.lit(len(tail) - 2))
    found = rows.groupBy(key).agg(
        F.max_by(F.struct(*columns), F.struct(F.col(TO).isNull().alias("a"), F.col(TO).alias("b"), F.col(FROM).alias("c"))).alias(ROW),
        F.array_sort(F.collect_list(F.when(F.col("__sees") & ~began, at(F.col("__lo"))))).alias("__adds"),
        F.max(F.when(F.col("__sees"), at(F.col("__hi")))).alias("__last"),
        F.max(F.when(F.col("__lo") <= before_last, at(before_last))).alias("__before"),
        F.max(F.col(TO).isNull() & (began | F.col("__sees"))).alias("__open"),
    )
    own = {FIRSTS: "array<timestamp>", SEEN: "timestamp", STABLE: "timestamp", AS_OF: "timestamp"}
    if state is None:
        found = found.withColumns({f"__{n}": F.lit(None).cast(t) for n, t in own.items()})
    else:
        found = found.join(state.select(F.col(key).alias("__key"), *(F.col(n).alias(f"__{n}") for n in own)), F.col(key) == F.col("__key"), "left")
    mark = F.lit(since).cast("timestamp")
    kept = F.filter(F.coalesce("__firsts", F.array().cast("array<timestamp>")), lambda x: x <= mark)
    found = found.withColumn("__kept", kept)

    def seen_by(time: Column) -> Column:
        """The last checkpoint up to a time, of those that the state has, that saw the entity."""
        some = F.exists("__kept", lambda x: x <= time)
        return F.when(some, F.when(F.col("__as_of") <= time, F.coalesce("__seen", time)).otherwise(F.col("__stable")))

    earlier = seen_by(mark)
    if tail:
        stable = F.greatest(earlier, F.col("__before"))
    else:  # the last checkpoint is the same: who was seen before it is as well
        stable = seen_by(F.lit(new[-2] if len(new) > 1 else None).cast("timestamp"))
    return found.select(
        key, ROW, F.concat("__kept", "__adds").alias(FIRSTS),
        F.when(~F.col("__open"), F.greatest(earlier, F.col("__last"))).alias(SEEN),
        stable.alias(STABLE), F.lit(new[-1] if new else None).cast("timestamp").alias(AS_OF),
    )


def merged(state: DataFrame | None, news: DataFrame, key: str) -> DataFrame:
    """The state with the new rows in place of their own."""
    return news if state is None else state.join(news.select(key), key, "left_anti").unionByName(news)


def folded(state: DataFrame, key: str, grid: Sequence[datetime]) -> DataFrame:
    """What `history.fold` gives for the versions that the state has."""
    times, last = _times(grid), F.lit(grid[-1] if grid else None).cast("timestamp")
    rows = state.where(F.size(FIRSTS) > 0).withColumns({"__times": times, "__seen": F.coalesce(SEEN, last)})
    previous = lambda c: F.when(c.isNotNull(), F.get("__times", F.greatest(_before(F.col("__times"), c) - 1, F.lit(0))))
    changes = F.slice(FIRSTS, 2, F.greatest(F.size(FIRSTS) - 1, F.lit(0)))
    absent = F.col("__seen") < last
    content = [f.name for f in state.schema[ROW].dataType.fields if f.name != key]
    return rows.select(
        key, *(F.col(f"{ROW}.`{x}`") for x in content),
        iso_week(previous(F.get(FIRSTS, F.lit(0)))).alias(FROM),
        F.when(absent, iso_week(F.col("__seen"))).alias(TO),
        F.transform(changes, lambda c: iso_week(previous(c))).alias("previous_update_dates"),
        iso_week(previous(F.array_max(changes))).alias("last_updated"),
        absent.alias("absent"),
    )
