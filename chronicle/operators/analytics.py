"""Reports over a published table: fill rates, frequencies, keys, hierarchies, weeks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.functions import arrays


def _is_list(df: DataFrame, column: str) -> bool:
    return dict(df.dtypes)[column].startswith("array")


def filled(df: DataFrame, column: str) -> Column:
    """Whether a cell says anything: an empty list doesn't."""
    return arrays.length(F.col(column)) > 0 if _is_list(df, column) else F.col(column).isNotNull()


def _unpivoted(df: DataFrame, columns: Sequence[str], counts: Mapping[str, callable]) -> DataFrame:
    """One row for each column with its counts, from one aggregation."""
    aggs = [fn(c).alias(f"{name}__{i}") for i, c in enumerate(columns) for name, fn in counts.items()]
    row = F.array(*(F.struct(F.lit(c).alias("column"), F.col("__n").alias("n_rows"), *(F.col(f"{name}__{i}").alias(name) for name in counts)) for i, c in enumerate(columns)))
    return df.agg(F.count("*").alias("__n"), *aggs).select(F.explode(row).alias("r")).select("r.*")


def fill_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_filled, rate)."""
    columns = list(columns or df.columns)
    out = _unpivoted(df, columns, {"n_filled": lambda c: F.count_if(filled(df, c))})
    return out.withColumn("rate", F.when(F.col("n_rows") > 0, F.round(F.col("n_filled") / F.col("n_rows"), 4)).otherwise(0.0))


def never_filled(df: DataFrame) -> DataFrame:
    return fill_rates(df).where("n_filled = 0").select("column")


def sparse(df: DataFrame, under: float) -> DataFrame:
    return fill_rates(df).where(F.col("rate") < under).orderBy("rate", "column")


def json_list_columns(df: DataFrame) -> list[str]:
    """Text columns in which some value begins like a JSON array."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return []
    row = df.agg(*(F.max(F.col(c).startswith("[").cast("int")).alias(c) for c in texts)).first()
    return [c for c in texts if row[c]]


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_missing, pct): nulls and empty lists, JSON ones too; worst first."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    gone = lambda c: ~filled(df, c) | (F.col(c) == "[]") if kinds[c] == "string" else ~filled(df, c)
    out = _unpivoted(df, columns, {"n_missing": lambda c: F.count_if(gone(c))})
    return out.withColumn("pct", F.round(100 * F.col("n_missing") / F.col("n_rows"), 1)).orderBy(F.desc("pct"), "column")


def single_valued_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_filled, n_values): how many different elements each list column has."""
    parts = [df.select(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns]
    each = reduce(DataFrame.unionByName, parts)
    values = each.select("column", F.explode_outer("v").alias("e")).groupBy("column").agg(F.countDistinct("e").alias("n_values"))
    return each.groupBy("column").agg(F.count_if(arrays.length(F.col("v")) > 0).alias("n_filled")).join(values, "column")


def implausible_dates(df: DataFrame, column: str, first: int = 2000, last: int = 2100) -> DataFrame:
    y = F.year(column)
    return df.agg(F.count(column).alias("n"), F.count_if(~y.between(first, last)).alias("n_implausible"), F.min(y).alias("first_year"), F.max(y).alias("last_year"), F.round(F.avg((~y.between(first, last)).cast("double")), 4).alias("share"))


def placeholders(df: DataFrame, column: str) -> DataFrame:
    """Lists of numbers: how many hold one value only, how many are a run without gaps."""
    one = F.size(F.array_distinct(column)) == 1
    return df.where(arrays.length(F.col(column)) > 0).agg(F.count("*").alias("n"), F.count_if(one).alias("n_single"), F.count_if(arrays.contiguous(F.col(column))).alias("n_contiguous"))


def census(df: DataFrame, column: str, patterns: Mapping[str, str]) -> DataFrame:
    """(pattern, n): in how many texts each pattern occurs; one pass."""
    row = F.array(*(F.struct(F.lit(name).alias("pattern"), F.col(f"p{i}").alias("n")) for i, name in enumerate(patterns)))
    return df.agg(*(F.count_if(F.col(column).rlike(p)).alias(f"p{i}") for i, p in enumerate(patterns.values()))).select(F.explode(row).alias("r")).select("r.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values with their counts, null among them, most common first."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("value"))


def list_counts(df: DataFrame, column: str, json: bool = False) -> DataFrame:
    x = F.from_json(column, "array<string>") if json else F.col(column)
    return value_counts(df.select(F.explode(x).alias("value")), "value")


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with one value at most, null counting as one."""
    out = _unpivoted(df, columns, {"n_values": lambda c: F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))})
    return out.where("n_values <= 1").select("column", "n_values")


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(only_a, only_b, equal) of two sets of keys."""
    x, y = a.select(key).distinct().withColumn("__a", F.lit(1)), b.select(key).distinct().withColumn("__b", F.lit(1))
    out = x.join(y, key, "full_outer").agg(F.count_if(F.col("__b").isNull()).alias("only_a"), F.count_if(F.col("__a").isNull()).alias("only_b"))
    return out.withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def statuses(df: DataFrame, column: str, classes: Mapping[str, str]) -> DataFrame:
    """(status, n): lower-cased texts by the first pattern that they match, or `other`."""
    low = F.lower(F.trim(column))
    said = reduce(lambda acc, kv: acc.when(low.rlike(kv[1]), kv[0]), classes.items(), F.when(low.isNull(), "missing")).otherwise("other")
    return df.groupBy(said.alias("status")).agg(F.count("*").alias("n"))


def orphans(df: DataFrame, parents: str, paths: str, key: str) -> DataFrame:
    """(key, path): `parent.child` entries whose parent the row doesn't list."""
    each = df.select(key, F.col(parents).alias("__parents"), F.explode(paths).alias("path"))
    return each.where(~arrays.contains(F.col("__parents"), F.split("path", "\\.", 2)[0])).select(key, "path")


def shared_children(df: DataFrame, paths: str) -> DataFrame:
    """Children that stand under several parents."""
    pair = F.split("path", "\\.", 2)
    each = df.select(F.explode(paths).alias("path")).select(pair[0].alias("parent"), pair[1].alias("child"))
    return each.groupBy("child").agg(F.countDistinct("parent").alias("n_parents")).where("n_parents > 1")


def lost_without_parent(df: DataFrame, paths: str) -> DataFrame:
    """How many different paths there are, and how many would be left without their parents."""
    each = df.select(F.explode(paths).alias("path"))
    return each.agg(F.countDistinct("path").alias("n_paths"), F.countDistinct(F.split("path", "\\.", 2)[1]).alias("n_children"))


def childless(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parents (parent) that no child (parent, code) names."""
    return parents.join(children, "parent", "left_anti")


def stubs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is filled."""
    return df.where(~reduce(lambda a, b: a | b, (filled(df, c) for c in columns)))


def key_candidates(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """(candidate, n_rows, n_distinct, is_key) of sets of columns; one pass."""
    row = F.array(*(F.struct(F.lit(name).alias("candidate"), F.col("__n").alias("n_rows"), F.col(f"k{i}").alias("n_distinct")) for i, name in enumerate(candidates)))
    aggs = [F.countDistinct(F.struct(*cols)).alias(f"k{i}") for i, cols in enumerate(candidates.values())]
    return df.agg(F.count("*").alias("__n"), *aggs).select(F.explode(row).alias("r")).select("r.*").withColumn("is_key", F.col("n_rows") == F.col("n_distinct"))


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def in_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that share those columns with another row."""
    return df.join(duplicate_groups(df, columns).select(*columns), list(columns), "left_semi")


def conditional_coverage(df: DataFrame, by: Column, shown: Column) -> DataFrame:
    """(value, n, share): how often something holds, by group."""
    return df.groupBy(by.alias("value")).agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce(shown, F.lit(False)).cast("double")), 4).alias("share"))


def redundant(df: DataFrame, column: str, derived: Column) -> DataFrame:
    """Whether a column says what another expression says already."""
    return df.agg(F.count("*").alias("n"), F.count_if(F.col(column).eqNullSafe(derived)).alias("n_equal"))


def activity(df: DataFrame, absent: str = "absent", until: str = "on_website_to") -> DataFrame:
    """(state, n, n_consistent): active rows have no end, absent ones have one."""
    state = F.when(F.col(absent), "absent").otherwise("active")
    fits = F.col(absent) == F.col(until).isNotNull()
    return df.groupBy(state.alias("state")).agg(F.count("*").alias("n"), F.count_if(fits).alias("n_consistent"))
