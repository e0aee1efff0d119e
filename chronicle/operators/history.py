"""Type-2 history of repeated full extracts, and its reconstruction at a weekly cadence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicle.functions.timeops import iso_week, on_slot

FROM, TO = "on_website_from", "on_website_to"


class HistoryError(ValueError):
    """An extract that must not become history."""


# ---------------------------------------------------------------- type 2


def row_hash(columns: Sequence[str]) -> Column:
    """Of all columns, nulls included and told from empty texts."""
    return F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def refuse_duplicates(extract: DataFrame, key: str) -> None:
    """Raises if a key is null or occurs twice; names the first five."""
    if not extract.where(F.col(key).isNull()).isEmpty():
        raise HistoryError(f"{key} is null")
    found = [r[0] for r in extract.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").orderBy(key).limit(5).select(key).collect()]
    if found:
        raise HistoryError(f"{key} is not unique: {', '.join(map(str, found))}")


def refuse_drift(extract: DataFrame, declared: Sequence[str]) -> None:
    """Raises if the extract has a column that isn't declared, or lacks one."""
    extra, missing = sorted(set(extract.columns) - set(declared)), sorted(set(declared) - set(extract.columns))
    if extra or missing:
        raise HistoryError(f"columns changed: new {extra}, missing {missing}")


def refuse_shrinkage(before: int, after: int, share: float = 0.2, from_rows: int = 100) -> None:
    """Raises on an empty extract, and where too many live rows would go. Called before anything is written."""
    if after == 0:
        raise HistoryError("the extract is empty")
    if before >= from_rows and after < before * (1 - share):
        raise HistoryError(f"the extract has {after} rows; {before} are live")


def apply_extract(versions: DataFrame, extract: DataFrame, now: Column, key: str) -> DataFrame:
    """The versions after one more full extract.

    A row that is live and unchanged stays open; a changed or missing one closes at `now`; a new,
    changed or returning one opens at `now`. Open windows end in null. A null key equals a null key.
    Closed versions only pass through: they don't take part in the join.
    """
    live, closed = versions.where(F.col(TO).isNull()), versions.where(F.col(TO).isNotNull())
    return closed.select(*extract.columns, "row_hash", FROM, TO).unionByName(apply_live(live, extract, now, key))


def apply_live(live: DataFrame, extract: DataFrame, now: Column, key: str) -> DataFrame:
    """The open versions after one more full extract: those that stay open or open now, and those that close now."""
    columns = [c for c in extract.columns]
    live = live.select(*columns, "row_hash", FROM, TO)
    fresh = extract.withColumn("row_hash", row_hash(columns)).select(F.struct(*columns).alias("new"), F.col("row_hash").alias("new_hash"), F.col(key).alias("new_key"))
    old = live.select(F.struct(*columns).alias("old"), F.col("row_hash").alias("old_hash"), F.col(key).alias("old_key"), F.col(FROM).alias("since"))
    both = old.join(fresh, F.col("old_key").eqNullSafe(F.col("new_key")) & (F.col("old_hash") == F.col("new_hash")), "full_outer")
    held = F.col("old_hash").isNotNull()
    merged = both.select(
        F.when(held, F.col("old")).otherwise(F.col("new")).alias("row"),
        F.coalesce("old_hash", "new_hash").alias("row_hash"),
        F.when(held, F.col("since")).otherwise(now).alias(FROM),
        F.when(held & F.col("new_hash").isNull(), now).alias(TO),
    )
    return merged.select("row.*", "row_hash", FROM, TO)


def apply_keyed(live: DataFrame, extract: DataFrame, now: Column, key: str) -> DataFrame:
    """`apply_live` where each side has a key once at most and none is null, as guards have seen to.

    The join is by the key alone, so live rows that are stored in buckets of it aren't shuffled; a key whose content
    changed comes out as the row that closes and the row that opens.
    """
    columns = extract.columns
    fresh = extract.withColumn("row_hash", row_hash(columns)).select(F.col(key).alias("new_key"), F.struct(*columns).alias("new"), F.col("row_hash").alias("new_hash"))
    old = live.select(F.col(key).alias("old_key"), F.struct(*columns).alias("old"), F.col("row_hash").alias("old_hash"), F.col(FROM).alias("since"))
    both = old.join(fresh, F.col("old_key") == F.col("new_key"), "full_outer")
    none = F.lit(None).cast("timestamp")
    window = lambda row, mark, since, until: F.struct(F.col(row).alias("row"), F.col(mark).alias("row_hash"), since.alias("since"), until.alias("until"))
    stays = window("old", "old_hash", F.col("since"), none)
    closes, opens = window("old", "old_hash", F.col("since"), now.cast("timestamp")), window("new", "new_hash", now.cast("timestamp"), none)
    same = F.col("old_hash") == F.col("new_hash")
    rows = F.when(same, F.array(stays)).when(F.col("new_key").isNull(), F.array(closes)).when(F.col("old_key").isNull(), F.array(opens)).otherwise(F.array(closes, opens))
    return both.select(F.explode(rows).alias("w")).select("w.row.*", "w.row_hash", F.col("w.since").alias(FROM), F.col("w.until").alias(TO))


def count_live(versions: DataFrame) -> DataFrame:
    return versions.agg(F.count_if(F.col(TO).isNull()).alias("n_live"))


def upsert(table: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the one with the latest `order`; a batch's row replaces, it adds no version.

    Of rows of one order the batch's goes first, then the one with the least hash of its content.
    """
    rows = table.withColumn("__old", F.lit(1)).unionByName(batch.withColumn("__old", F.lit(0)))
    w = Window.partitionBy(key).orderBy(F.col(order).desc_nulls_last(), "__old", F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in table.columns)))))
    return rows.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank", "__old")


def islands(events: DataFrame, entity: str, content: str, at: str) -> DataFrame:
    """Versions of each entity from its events: runs of equal content (null is one), each open until the next begins.

    Events of one entity and time are taken in the order of their content, null first.
    """
    w = Window.partitionBy(entity).orderBy(at, content)
    before = F.struct(F.lag(content).over(w).alias("content"), F.row_number().over(w).alias("n"))
    changed = events.withColumn("__before", before).where((F.col("__before.n") == 1) | ~F.col("__before.content").eqNullSafe(F.col(content)))
    return changed.select(entity, content, F.col(at).alias(FROM), F.lead(at).over(w).alias(TO))


# ---------------------------------------------------------------- checkpoints


def load_times(versions: DataFrame) -> DataFrame:
    """All times at which a window begins or ends: what can be known of the loads without a ledger."""
    ends = versions.select(F.col(FROM).alias("at")).union(versions.select(F.col(TO).alias("at")))
    return ends.where(F.col("at").isNotNull()).distinct()


def ledger_times(ledger: DataFrame, first: DataFrame) -> DataFrame:
    """Times of the ledger's complete extract loads from the first attested one on (`first`: one row, `at`).

    A load that changed nothing shows here alone.
    """
    done = ledger.where("status = 0")
    if "kind" in ledger.columns:
        done = done.where("kind = 'extract'")
    times = done.select(F.timestamp_seconds("load_id").alias("at"))
    return times.join(F.broadcast(first.agg(F.min("at").alias("__first"))), F.col("at") >= F.col("__first")).select("at").distinct()


def weekly_checkpoints(times: DataFrame, at: str = "at", weekday: int = 1, hour: int = 3, tolerance: int = 1) -> DataFrame:
    """One load for each ISO week: the last on the weekly slot, or else the week's last (`fallback`)."""
    t = F.col(at)
    slot = F.max(F.when(on_slot(t, weekday, hour, tolerance), t))
    return times.groupBy(iso_week(t).alias("week")).agg(F.coalesce(slot, F.max(t)).alias("checkpoint"), slot.isNull().alias("fallback"))


def _grid(checkpoints: DataFrame) -> DataFrame:
    """One row with the sorted checkpoints; there is one a week, so the array is small."""
    return checkpoints.where(F.col("checkpoint").isNotNull()).agg(F.sort_array(F.collect_set("checkpoint")).alias("__grid"))


def _before(grid: Column, t: Column) -> Column:
    """How many of the sorted checkpoints lie before a time: a binary search, one step for each doubling of the grid."""
    n = F.size(grid)
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))

    def step(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        less = F.get(grid, mid) < t
        halved = F.struct(F.when(less, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(less, at["hi"]).otherwise(mid).alias("hi"))
        return F.when(at["lo"] < at["hi"], halved).otherwise(at)

    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int")), start, step, lambda at: at["lo"])


def seen(versions: DataFrame, checkpoints: DataFrame, key: str) -> DataFrame:
    """(key, version's beginning, __lo, __hi, __grid): the first and last checkpoint that sees a version, by number,
    `from <= c and (to is null or c < to)`; versions that none sees drop out.

    Each version searches the small sorted grid, which is broadcast as one row: no join by time and no row for each
    checkpoint that a version lived through.
    """
    rows = versions.select(key, FROM, TO).join(F.broadcast(_grid(checkpoints)))
    grid = F.col("__grid")
    last = F.when(F.col(TO).isNull(), F.size(grid)).otherwise(_before(grid, F.col(TO))) - 1
    return rows.select(key, FROM, _before(grid, F.col(FROM)).alias("__lo"), last.alias("__hi"), "__grid").where("__lo <= __hi")


def history_at(versions: DataFrame, checkpoints: DataFrame, key: str) -> DataFrame:
    """What the checkpoints alone would know of each entity, as ISO weeks. Windows of one entity don't overlap.

    on_website_from: the week of the interval that ends at the first sighting.
    on_website_to: the week of the last sighting, if that isn't the last checkpoint.
    previous_update_dates: weeks of the intervals that ended in a changed version; a return counts.
    """
    found = seen(versions, checkpoints, key).groupBy(key).agg(
        F.array_sort(F.collect_list("__lo")).alias("__firsts"),  # of each version that was seen, so the first is no change
        F.max("__hi").alias("__seen"),
    ).join(F.broadcast(_grid(checkpoints)))
    grid = F.col("__grid")
    previous = lambda i: F.when(i.isNotNull(), F.get(grid, F.greatest(i - 1, F.lit(0))))
    changes = F.slice("__firsts", 2, F.greatest(F.size("__firsts") - 1, F.lit(0)))
    absent = F.col("__seen") < F.size(grid) - 1
    return found.select(
        key,
        iso_week(previous(F.get("__firsts", F.lit(0)))).alias(FROM),
        F.when(absent, iso_week(F.get(grid, F.col("__seen")))).alias(TO),
        F.transform(changes, lambda i: iso_week(previous(i))).alias("previous_update_dates"),
        iso_week(previous(F.array_max(changes))).alias("last_updated"),
        absent.alias("absent"),
    )


def latest(versions: DataFrame, key: str) -> DataFrame:
    """The last version of each entity: an open one first, then by end, then by beginning."""
    w = Window.partitionBy(key).orderBy(F.col(TO).desc_nulls_first(), F.col(FROM).desc_nulls_last())
    return versions.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def fold(versions: DataFrame, key: str, checkpoints: DataFrame | None = None) -> DataFrame:
    """The latest content of each entity that a checkpoint saw, with its history."""
    grid = weekly_checkpoints(load_times(versions)) if checkpoints is None else checkpoints
    return latest(versions, key).drop(FROM, TO).join(history_at(versions, grid, key), key)


def changes_per_week(folded: DataFrame) -> DataFrame:
    """Changes and departures by week, for the weeks that have either."""
    changes = folded.select(F.explode("previous_update_dates").alias("week")).groupBy("week").agg(F.count("*").alias("changes"))
    departures = folded.where(F.col("absent")).groupBy(F.col(TO).alias("week")).agg(F.count("*").alias("departures"))
    weeks = changes.select("week").union(departures.select("week")).distinct()
    return weeks.join(changes, "week", "left").join(departures, "week", "left").fillna(0, ["changes", "departures"])
