"""Exact order statistics of large groups, by rounds of histograms.

An aggregate that keeps a group's values gathers them in one task. Here a round counts each group's rows in `BINS` bins between
the least and the greatest value that its answer can have, with each bin's own least and greatest value; the bin
with the sought rank gives the next round's bounds. Bins are equal parts of the values' logarithms, with their sign, and of the values in
turn, so six or seven rounds reach any double. Two different values of a bin part in the next round, since they are its
bounds, so the rounds end; each is one scan, and a task hands on no more than `BINS` rows for each group and rank.

Values are numbers (read as doubles) or times (as seconds, to the microsecond). Null and not-a-number values don't count. Rows with a
null group are a group. An infinite value is as good as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b, strict=True):
        out &= F.col(x).eqNullSafe(F.col(y))
    return out


def _magnitude(v: Column) -> Column:
    """A value's logarithm above the least double there is, with its sign; never greater for a smaller value."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log(F.abs(v)) + 745))


def ranked(df: DataFrame, column: str, ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, rank, value): the values at given ranks from 0 of each group (`ranks`: by, rank, all within their group)."""
    own, sought = [f"__g{i}" for i in range(len(by))], [f"__t{i}" for i in range(len(by))]
    value = F.col(column).cast("double")
    rows = df.select(*(F.col(b).alias(o) for b, o in zip(by, own, strict=True)), value.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    whole = rows.groupBy(*own).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    asked = ranks.select(*(F.col(b).alias(t) for b, t in zip(by, sought, strict=True)), F.col("rank").alias("__rank"), F.col("rank").alias("__left"))
    todo = asked.join(whole, _same(own, sought)).select(*sought, "__rank", "__left", "__lo", "__hi").persist(StorageLevel.MEMORY_AND_DISK)
    held, scale = [todo], _magnitude
    try:
        while not todo.where("__lo < __hi").isEmpty():
            open_ = todo.where("__lo < __hi")
            met = rows.join(open_, _same(own, sought) & F.col("__v").between(F.col("__lo"), F.col("__hi")))
            # halves, so that neither the width nor the distance overflows; infinite bounds stand alone in the end bins
            v, lo, hi = (scale(F.col(x)) / 2 for x in ("__v", "__lo", "__hi"))
            share = F.try_divide(v - lo, hi - lo)
            scale = _magnitude if scale is not _magnitude else lambda x: x
            inside = F.least(F.greatest(F.floor(F.coalesce(F.when(~F.isnan(share), share), F.lit(0.5)) * (BINS - 2)) + 1, F.lit(1)), F.lit(BINS - 2))
            bin_ = F.when(F.col("__v") == F.col("__lo"), 0).when(F.col("__v") == F.col("__hi"), BINS - 1).otherwise(inside).cast("int")
            key = [*sought, "__rank"]
            counts = met.withColumn("__bin", bin_).groupBy(*key, "__bin").agg(F.count("*").alias("__n"), F.any_value("__left").alias("__left"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
            upto = F.sum("__n").over(Window.partitionBy(*key).orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))  # at most BINS rows
            chosen = counts.withColumn("__upto", upto).where("__upto > __left AND __upto - __n <= __left")
            nearer = chosen.select(*sought, "__rank", (F.col("__left") - (F.col("__upto") - F.col("__n"))).alias("__left"), "__lo", "__hi")
            todo = todo.where("__lo >= __hi").unionByName(nearer).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(todo)
        return todo.select(*(F.col(t).alias(b) for b, t in zip(by, sought, strict=True)), F.col("__rank").alias("rank"), F.col("__lo").alias("value"))
    finally:
        for frame in held[:-1]:
            frame.unpersist()


def quantiles(df: DataFrame, column: str, fractions: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, fraction, n, value) of each group with values: between the two values next to the place, in proportion, as a median is."""
    value = F.col(column).cast("double")
    n = df.groupBy(*by).agg(F.count(F.when(~F.isnan(value), value)).alias("n")).where("n > 0")
    places = n.withColumn("fraction", F.explode(F.array(*(F.lit(float(f)) for f in fractions)))).withColumn("place", F.col("fraction") * (F.col("n") - 1))
    places = places.withColumns({"below": F.floor("place"), "above": F.ceil("place")})
    ranks = places.select(*by, F.explode(F.array("below", "above")).alias("rank")).distinct()
    found = ranked(df, column, ranks, by).persist(StorageLevel.MEMORY_AND_DISK)

    def at(end: str) -> DataFrame:
        return found.select(*(F.col(b).alias(f"__{end}{i}") for i, b in enumerate(by)), F.col("rank").alias(end), F.col("value").alias(f"__{end}"))

    for end in ("below", "above"):
        side = at(end).withColumnRenamed(end, f"__rank_{end}")
        places = places.join(side, _same(list(by), [f"__{end}{i}" for i in range(len(by))]) & (F.col(end) == F.col(f"__rank_{end}")))
    part = F.col("place") - F.col("below")
    between = F.when((part == 0) | (F.col("__below") == F.col("__above")), F.col("__below")).otherwise(F.col("__below") + (F.col("__above") - F.col("__below")) * part)
    return places.select(*by, "fraction", "n", between.alias("value"))
