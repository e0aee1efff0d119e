"""Points in intervals, where both sides are large: a join by hierarchical bins of time.

Bins of level k are `unit` * 4 ** k wide. An interval belongs to the lowest level whose bins are no narrower than it
is, so it stands in one or two of them, however long it is; a point stands in one bin of each level in use, thirty-odd at most.
Interval and point meet by level and bin (and key), and the exact bounds are compared there. In a bin that an interval
has part in, it covers a quarter of the bin's width or more, or its end, so few pairs are compared in vain.

A bin that holds over `most` points is hot: its points are dealt to salts, and its intervals are copied to each of them, so
no task gets more of them however many stand there. Nothing is capped, and no side is broadcast unasked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACTOR = 4


def _micros(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def contained(intervals: DataFrame, points: DataFrame, start: str, end: str, at: str, key: str | None = None, unit: int = 1_000_000, most: int = 100_000) -> DataFrame:
    """The pairs of an interval's row and a point's row with `start <= at` and (`at < end` or no end), and equal keys if one is named.

    Column names must differ between the sides, but for the key. Rows without a start or a point, or with a null key, meet nothing; an
    interval that ends at or before its start is empty. Times are kept to the microsecond, `unit` is in microseconds.
    """
    clash = (set(intervals.columns) & set(points.columns)) - {key}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    keys = [key] if key else []
    spots = points.where(F.col(at).isNotNull()).withColumn("__at", _micros(F.col(at)))
    ends = spots.agg(F.min("__at").alias("lo"), F.max("__at").alias("hi"))
    bounds = ends.first()
    if bounds["lo"] is None:
        bounds = {"lo": 0, "hi": 0}
    # what reaches beyond all points is cut to them, so that an open interval has a level of its own length
    spans = intervals.where(F.col(start).isNotNull()).withColumns({
        "__from": F.greatest(_micros(F.col(start)), F.lit(bounds["lo"])),
        "__to": F.least(F.coalesce(_micros(F.col(end)), F.lit(bounds["hi"] + 1)), F.lit(bounds["hi"] + 1)),
    }).where("__from < __to")
    highest, width = 0, unit
    while width < bounds["hi"] - bounds["lo"] + 1:
        highest, width = highest + 1, width * FACTOR
    level = F.lit(highest)
    for k in reversed(range(highest)):
        level = F.when(F.col("__to") - F.col("__from") <= unit * FACTOR**k, k).otherwise(level)
    spans = spans.withColumn("__level", level)
    used = sorted(r[0] for r in spans.select("__level").distinct().collect())  # as many as there are levels
    bin_of = lambda t, k: F.floor((t - F.lit(bounds["lo"])) / (F.lit(unit) * F.pow(F.lit(FACTOR), k)).cast("long")).cast("long")
    low, high = bin_of(F.col("__from"), F.col("__level")), bin_of(F.col("__to") - 1, F.col("__level"))
    spans = spans.withColumn("__bin", F.explode(F.sequence(low, high)))
    each = F.array(*(F.struct(F.lit(k).alias("level"), bin_of(F.col("__at"), F.lit(k)).alias("bin")) for k in used)) if used else F.array().cast("array<struct<level:int,bin:bigint>>")
    spots = spots.withColumn("__b", F.explode(each)).withColumns({"__level": F.col("__b.level"), "__bin": F.col("__b.bin")}).drop("__b")
    on = ["__level", "__bin", *keys]
    hot = spots.groupBy(*on).agg(F.ceil(F.count("*") / most).cast("int").alias("__salts")).where("__salts > 1")
    if not hot.isEmpty():
        salts = F.coalesce("__salts", F.lit(1))
        spots = spots.join(hot, on, "left").withColumn("__salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")).drop("__salts")
        spans = spans.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
        on = [*on, "__salt"]
    met = spans.join(spots, on).where("__from <= __at AND __at < __to")
    return met.select(*keys, *(c for c in [*intervals.columns, *points.columns] if c not in keys))
