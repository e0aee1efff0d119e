"""Multidimensional clustered layout, cell first: rows ordered by the z-curve over rank coordinates, then by id.

A value's coordinate in a dimension is floor(parts * s / n): of all n rows, s have a smaller value. The coordinates'
binary digits, interleaved, are z; a z is a cell. There are at most parts ** dimensions cells, 4096 with the
defaults, and everything that is gathered, broadcast or sorted in one task is a table of cells.

1. Only parts - 1 values of a dimension matter: coordinate >= k just where more than the ceil(k * n / parts)-th smallest row
   value. Values are counted, dealt by range, and the ranges' sums say in which ranges those lie; one running sum
   there finds them. So the driver gets a row for each range and parts - 1 values of each dimension.
2. Rows become (z, id, number of rows). A histogram counts them by z and block of `2 ** block_bits` ids. Its prefix sums are made
   level by level, 16 bits of the block's number at a time: counts go up to the cells, offsets come
   down again, so no sum runs over more than 65,536 rows.
3. Ids are ranked inside their block of their cell only; offset and rank are the row's position, and its file
   is position / `file_rows`.
4. A cell lies in an interval of files. A file inside it has the cell's coordinates as bounds; the files at its
   ends (two at most for each cell) get theirs from the cells that end in them. So bounds, and how many files
   a query must read and how many hold a row of its answer, come from the cells alone; rows aren't read again.

Null values are smallest, a null text has length -1, a null id has date -1 and stands before all others. Rows equal in id and z stand once, with their number, until the end, and
share their positions out in any order. Names of other columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

#: Bits of a block's number that one level of the prefix sums takes.
RADIX = 16
#: Positions that one row is made into at once.
STEP = 4096


@dataclass(frozen=True)
class Dimension:
    """A value of each row (text or long), and how far from a row's own coordinate its query reaches."""

    name: str
    value: Column
    reach: int = 0
    text: bool = False


def document_dimensions(id_col: str = "doc_id", text_col: str = "text") -> list[Dimension]:
    """Source, language, length in bytes, and a date made from the id."""
    made = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("long").cast("string")), F.lit(365)), F.lit(-1))
    return [Dimension("source", F.col("source"), text=True), Dimension("lang", F.col("lang"), text=True), Dimension("length", F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(-1)), 1), Dimension("date", made, 1)]


# ---------------------------------------------------------------- coordinates


def _key(value: Column, text: bool) -> Column:
    """A text in the order of the values; longs by their hexadecimal digits, sign turned."""
    return value if text else F.lpad(F.hex(value.bitwiseXOR(F.lit(-(2**63)))), 16, "0")


def _value(key: str | None, text: bool) -> str | int | None:
    return key if text or key is None else int(key, 16) - 2**63


def cuts(rows: DataFrame, dimensions: Sequence[Dimension], parts: int) -> list[list[tuple[bool, str | int | None]]]:
    """Of each dimension the ceil(k * n / parts)-th smallest row values, k = 1 .. parts - 1, as (is null, value); rows has the values as d0, d1, ..."""
    spark = rows.sparkSession
    each = F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"d{i}").isNotNull().alias("has"), _key(F.col(f"d{i}"), d.text).alias("key")) for i, d in enumerate(dimensions)))
    counts = rows.select(F.explode(each).alias("e")).groupBy("e.dim", "e.has", "e.key").agg(F.count("*").alias("n"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = c.checkpointed(counts.repartitionByRange(ranges, "dim", "has", "key").withColumn("part", F.spark_partition_id()))
    wanted, before = [], {}
    sums = sorted(map(tuple, counts.groupBy("dim", "part").agg(F.sum("n")).collect()))  # a row for each range, and one more for each dimension
    total = sum(n for dim, _, n in sums if dim == 0)
    for dim, part, n in sums:
        at = before.get(dim, 0)
        before[dim] = at + n
        wanted += [(dim, part, k, target - at) for k in range(1, parts) if at < (target := math.ceil(k * total / parts)) <= at + n]
    out: list[list] = [[None] * (parts - 1) for _ in dimensions]
    if not wanted:
        return [[] for _ in dimensions]
    targets = spark.createDataFrame(wanted, "dim int, part int, k int, target long")
    running = F.sum("n").over(Window.partitionBy("dim", "part").orderBy("has", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counts.where(F.col("part").isin(sorted({part for _, part, _, _ in wanted}))).withColumn("upto", running)
    hit = found.join(F.broadcast(targets), ["dim", "part"]).where("target <= upto AND target > upto - n")  # parts - 1 rows for each dimension
    for r in hit.select("dim", "k", "has", "key").collect():
        out[r["dim"]][r["k"] - 1] = (not r["has"], _value(r["key"], dimensions[r["dim"]].text))
    return out


def _coordinate(value: Column, found: list[tuple[bool, str | int | None]]) -> Column:
    """How many of the cuts are smaller than a value."""
    if not found:
        return F.lit(0)
    over = [F.lit(1) if null else (value > F.lit(cut)).cast("int") for null, cut in found]
    return F.when(value.isNull(), 0).otherwise(sum(over[1:], over[0]))


def interleaved(coordinates: Sequence[Column], bits: int) -> Column:
    """Their binary digits, highest first, each round in order."""
    z = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for x in coordinates:
            z = z * 2 + F.shiftright(x, b).bitwiseAND(F.lit(1))
    return z


def deinterleaved(z: Column, dimensions: int, bits: int) -> list[Column]:
    out = []
    for i in range(dimensions):
        x = F.lit(0)
        for b in reversed(range(bits)):
            x = x * 2 + F.shiftright(z, b * dimensions + dimensions - 1 - i).bitwiseAND(F.lit(1)).cast("int")
        out.append(x)
    return out


# ---------------------------------------------------------------- positions


def _block(doc_id: Column, bits: int) -> Column:
    """The number of an id's block; null ids have one before all others."""
    return F.coalesce(F.shiftright(doc_id, bits), F.lit(-(2 ** (63 - bits)) - 1))


def _running(n: Column, by: list[str], order: Sequence[str | Column]) -> Column:
    """Of the rows before this one."""
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    return F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - n


def offsets(histogram: DataFrame, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """Prefix sums of a histogram (z, block, n) with blocks from `low` to `high`: (z, block, start), and of the cells (z, n, start)."""
    levels = [histogram]
    while high - low >= 1 << RADIX:
        low, high = low >> RADIX, high >> RADIX
        levels.append(levels[-1].groupBy("z", F.shiftright("block", RADIX).alias("block")).agg(F.sum("n").alias("n")))
    cells = levels[-1].groupBy("z").agg(F.sum("n").alias("n"))
    cells = c.checkpointed(cells.withColumn("start", _running(F.col("n"), [], ["z"])))  # at most parts ** dimensions rows
    placed, by = cells.select("z", F.col("start").alias("base")), ["z"]
    for level in reversed(levels):
        inside = level.withColumn("above", F.shiftright("block", RADIX)).join(placed, by)
        placed = inside.select("z", "block", (F.col("base") + _running(F.col("n"), by, ["block"])).alias("start"))
        if level is not histogram:
            placed, by = placed.select("z", F.col("block").alias("above"), F.col("start").alias("base")), ["z", "above"]
    return placed, cells


@dataclass
class Layout:
    """A table's layout: its cells, where each (z, id) begins, and how coordinates come from values."""

    dimensions: list[Dimension]
    bits: int
    file_rows: int
    found: list[list[tuple[bool, str | int | None]]]
    #: (z, doc_id, n, start): rows of one id and cell, and the first one's position.
    placed: DataFrame
    #: (z, n, start)
    cells: DataFrame
    most: int

    def z(self, values: Sequence[Column]) -> Column:
        return interleaved([_coordinate(v, f) for v, f in zip(values, self.found, strict=True)], self.bits)

    def positions(self) -> DataFrame:
        """(doc_id, z, position, file) of every row."""
        rows = self.placed.withColumn("base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(STEP).cast("long"))))
        if self.most > STEP:  # one id's rows are shared out
            rows = rows.repartition(int(self.placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows = rows.withColumn("k", F.explode(F.sequence(F.col("base"), F.least(F.col("base") + STEP, F.col("n")) - 1)))
        return rows.select("doc_id", "z", (F.col("start") + F.col("k")).alias("position")).withColumn("file", F.floor(F.col("position") / self.file_rows))

    def intervals(self) -> DataFrame:
        """(z, first, last, c0, c1, ...): each cell's files and coordinates."""
        at = deinterleaved(F.col("z"), len(self.dimensions), self.bits)
        return self.cells.select("z", F.floor(F.col("start") / self.file_rows).alias("first"), F.floor((F.col("start") + F.col("n") - 1) / self.file_rows).alias("last"), *(x.alias(f"c{i}") for i, x in enumerate(at)))

    def end_files(self) -> DataFrame:
        """(file, lo0, hi0, lo1, hi1, ...) of the files in which a cell begins or ends; any other file has the bounds of one cell."""
        ends = self.intervals().withColumn("file", F.explode(F.array_distinct(F.array("first", "last"))))
        return ends.groupBy("file").agg(*(f(f"c{i}").alias(f"{n}{i}") for i in range(len(self.dimensions)) for n, f in (("lo", F.min), ("hi", F.max))))

    def _reached(self, rows: DataFrame, low: Sequence[Column], high: Sequence[Column]) -> DataFrame:
        """Rows with the cells, as q, whose queries reach into a box."""
        top = 2**self.bits - 1
        for i, d in enumerate(self.dimensions):
            rows = rows.withColumn(f"q{i}", F.explode(F.sequence(F.greatest(low[i] - d.reach, F.lit(0)), F.least(high[i] + d.reach, F.lit(top)))))
        return rows.withColumn("q", interleaved([F.col(f"q{i}") for i in range(len(self.dimensions))], self.bits))

    def queries(self) -> DataFrame:
        """(z, bounds, files_touched, files_matching): of each cell's query the files whose bounds meet it, and those that hold a row inside it."""
        k = range(len(self.dimensions))
        cells, ends = self.intervals(), self.end_files()
        own = [F.col(f"c{i}") for i in k]
        inside = self._reached(cells, own, own).groupBy("q").agg(
            F.sum(F.greatest(F.col("last") - F.col("first") - 1, F.lit(0))).alias("inner"),
            F.sum(F.col("last") - F.col("first") + 1).alias("every"),
            F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"),  # cells in reach, 9 with the defaults
        )
        shared = F.aggregate("runs", F.struct(F.lit(-1).cast("long").alias("end"), F.lit(0).cast("long").alias("n")), lambda a, r: F.struct(r["last"].alias("end"), (a["n"] + (r["first"] == a["end"]).cast("long")).alias("n")), lambda a: a["n"])
        matching = inside.select(F.col("q").alias("z"), "inner", (F.col("every") - shared).alias("files_matching"))
        met = self._reached(ends, [F.col(f"lo{i}") for i in k], [F.col(f"hi{i}") for i in k]).groupBy(F.col("q").alias("z")).agg(F.count("*").alias("met"))
        said = F.concat_ws(",", *(x for i in k for x in (own[i], own[i])))
        return cells.select("z", said.alias("bounds")).join(matching, "z").join(met, "z", "left").select("z", "bounds", (F.col("inner") + F.coalesce("met", F.lit(0))).alias("files_touched"), "files_matching")


def layout(rows: DataFrame, dimensions: list[Dimension] | None = None, parts: int = 8, file_rows: int = 1000, block_bits: int = 16, id_col: str = "doc_id") -> Layout:
    """Cells, offsets and positions of a table's rows."""
    dimensions = dimensions or document_dimensions(id_col)
    bits = max(1, (parts - 1).bit_length())
    values = rows.select(F.col(id_col).cast("long").alias("doc_id"), *(d.value.cast("string" if d.text else "long").alias(f"d{i}") for i, d in enumerate(dimensions)))
    values = c.checkpointed(values)  # texts are read once
    found = cuts(values, dimensions, parts)
    z = interleaved([_coordinate(F.col(f"d{i}"), f) for i, f in enumerate(found)], bits)
    once = values.select("doc_id", z.alias("z")).groupBy("z", "doc_id").agg(F.count("*").alias("n")).withColumn("block", _block(F.col("doc_id"), block_bits))
    once = c.checkpointed(once)
    histogram = c.checkpointed(once.groupBy("z", "block").agg(F.sum("n").alias("n"), F.max("n").alias("most")))
    state = histogram.agg(F.min("block"), F.max("block"), F.max("most")).first()
    starts, cells = offsets(histogram.drop("most"), state[0] or 0, state[1] or 0)  # no rows: any blocks
    rank = _running(F.col("n"), ["z", "block"], [F.col("doc_id").asc_nulls_first()])
    placed = once.join(starts, ["z", "block"]).select("z", "doc_id", "n", (F.col("start") + rank).alias("start"))
    return Layout(dimensions, bits, file_rows, found, placed, cells, state[2] or 0)


def described(rows: DataFrame, **options) -> DataFrame:
    """One row for each row: doc_id, z, position, file, files_touched, files_matching, file_bounds."""
    made = layout(rows, **options)
    k = range(len(made.dimensions))
    ends = made.end_files().select("file", F.concat_ws(",", *(F.col(f"{n}{i}") for i in k for n in ("lo", "hi"))).alias("end_bounds"))
    queries = F.broadcast(c.checkpointed(made.queries()))  # at most parts ** dimensions rows
    ends = F.broadcast(c.checkpointed(ends))  # at most twice as many
    found = made.positions().join(queries, "z").join(ends, "file", "left")
    return found.select("doc_id", "z", "position", "file", "files_touched", "files_matching", F.coalesce("end_bounds", "bounds").alias("file_bounds"))


def written(rows: DataFrame, path: str, files_a_task: int = 64, **options) -> Layout:
    """Writes the rows, all columns kept, in the layout's order: Parquet files of `file_rows` rows below a folder.

    Rows of one id and cell are told apart by a hash of their content; equal ones are one row, with its number, until
    they are written. Their ranks are made by 16 bits of that hash first, so one id may have any number of rows.
    """
    made = layout(rows, **options)
    id_col = options.get("id_col", "doc_id")
    z, key, row, position = (c.unused(n, rows) for n in ("__z", "__key", "__row", "__position"))
    values = [d.value.cast("string" if d.text else "long") for d in made.dimensions]
    full = rows.select(F.struct(*(F.col(f"`{x}`") for x in rows.columns)).alias(row), made.z(values).alias(z), F.col(id_col).cast("long").alias(key))
    at = made.placed.select(F.col("z").alias("pz"), F.col("doc_id").alias("pid"), "n", "start")
    full = full.join(at, (F.col(z) == F.col("pz")) & F.col(key).eqNullSafe(F.col("pid")))
    alone = full.where("n = 1").select(row, F.col("start").alias(position))
    if made.most > 1:
        said = F.to_json(row, {"ignoreNullFields": "false"})
        tied = full.where("n > 1").withColumns({"h": F.xxhash64(said), "g": F.md5(said)})
        tied = c.checkpointed(tied.groupBy(z, key, "start", "h", "g").agg(F.any_value(row).alias(row), F.count("*").alias("m")).withColumn("digit", F.shiftright("h", 48)))
        sums = tied.groupBy(z, key, "digit").agg(F.sum("m").alias("m")).select(F.col(z).alias("sz"), F.col(key).alias("sk"), F.col("digit").alias("sd"), _running(F.col("m"), [z, key], ["digit"]).alias("base"))
        ranked = tied.join(sums, (F.col(z) == F.col("sz")) & F.col(key).eqNullSafe(F.col("sk")) & (F.col("digit") == F.col("sd")))
        ranked = ranked.select(row, "m", (F.col("start") + F.col("base") + _running(F.col("m"), [z, key, "digit"], ["h", "g"])).alias("from"))
        steps = ranked.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(STEP).cast("long")))).repartition("from", "b")
        alone = alone.unionByName(steps.select(row, F.explode(F.sequence(F.col("from") + F.col("b"), F.col("from") + F.least(F.col("b") + STEP, F.col("m")) - 1)).alias(position)))
    task = F.floor(F.col(position) / (made.file_rows * files_a_task))
    alone.repartition(task).sortWithinPartitions(position).select(f"{row}.*").write.option("maxRecordsPerFile", made.file_rows).parquet(path)
    return made
