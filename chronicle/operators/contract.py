"""The column contract: declared checks, judged for all rows in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.functions import arrays, text

TERM_WORDS = "(?U)\\s+"


class ContractError(ValueError):
    """The structure or the values are not what was declared."""


@dataclass(frozen=True)
class Check:
    """A test of each row; rows for which it is null pass only if `null_passes`."""

    name: str
    column: str
    test: Column
    null_passes: bool = True
    needs: tuple[str, ...] = ()

    def fails(self) -> Column:
        return ~F.coalesce(self.test, F.lit(self.null_passes))


def not_null(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNotNull())


def matches(column: str, pattern: str) -> Check:
    return Check("pattern", column, F.col(column).rlike(pattern))


def holds(column: str, said: str) -> Check:
    return Check("contains", column, F.col(column).contains(said))


def between(column: str, low, high) -> Check:
    return Check("range", column, F.col(column).between(F.lit(low), F.lit(high)))


def cleaned(column: str) -> Check:
    return Check("cleaned", column, text.is_clean(F.col(column)))


def in_vocabulary(column: str, codes: Sequence[str]) -> Check:
    return Check("vocabulary", column, F.col(column).isin(*codes))


def elements(column: str, test, name: str = "elements") -> Check:
    """Every element passes; a null element doesn't."""
    return Check(name, column, arrays.all_true(F.col(column), test))


def elements_in(column: str, codes: Sequence[str]) -> Check:
    return elements(column, lambda e: e.isin(*codes), "vocabulary")


def slugs(column: str, pattern: str = "^[a-z0-9]+(?:[_-][a-z0-9]+)*$") -> Check:
    """An open list of codes: each is a slug, whichever."""
    return elements(column, lambda e: e.rlike(pattern), "slugs")


def http_links(column: str, field: str = "url") -> Check:
    """A list of links, each resolved to a page on the web."""
    return elements(column, lambda e: e[field].rlike("^https?://"), "http_links")


def partition_holds(keywords: Column, terms: Column) -> Column:
    """Whether the terms are the text's words, in order, none left out and none made up.

    Both sides word by word without edge punctuation. Null terms pass; with a null text there
    must be no terms.
    """
    bare = lambda words: F.filter(F.transform(words, text.bare), lambda w: w != "")
    source = bare(text.tokens(keywords))
    said = bare(F.flatten(F.transform(terms, text.tokens)))
    return F.when(terms.isNull(), True).when(keywords.isNull(), F.size(terms) == 0).otherwise(F.coalesce(source == said, F.lit(False)))


def spans(keywords: str, terms: str) -> Check:
    return Check("span_partition", terms, partition_holds(F.col(keywords), F.col(terms)), needs=(keywords, terms))


def applicable(checks: Sequence[Check], columns: Sequence[str]) -> list[Check]:
    """Those whose columns are all there."""
    return [c for c in checks if set(c.needs or (c.column,)) <= set(columns)]


def schema_faults(df: DataFrame, schema: T.StructType) -> list[str]:
    """What differs from the declared columns and types; no job."""
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in schema.fields}
    return (
        [f"missing column {c}" for c in want if c not in have]
        + [f"undeclared column {c}" for c in have if c not in want]
        + [f"{c} is {have[c]}, declared {want[c]}" for c in want if c in have and have[c] != want[c]]
    )


def report(df: DataFrame, checks: Sequence[Check], unique: Sequence[str] = ()) -> DataFrame:
    """(check_name, column_name, n_rows, n_failed): one pass over the rows, and one more for each unique column."""
    checks = applicable(checks, df.columns)
    n = F.count("*").alias("n_rows")
    counts = [F.count_if(c.fails()).alias(f"f{i}") for i, c in enumerate(checks)]
    pairs = F.array(*(F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"), F.col("n_rows"), F.col(f"f{i}").alias("n_failed")) for i, c in enumerate(checks)))
    out = df.agg(n, *counts).select(F.explode(pairs).alias("r")).select("r.*")
    for column in unique:
        twice = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
        out = out.unionByName(twice.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("n_failed")).select(F.lit("unique").alias("check_name"), F.lit(column).alias("column_name"), "n_rows", "n_failed"))
    return out


def offenders(df: DataFrame, checks: Sequence[Check], key: str, most: int = 3) -> DataFrame:
    """(check_name, column_name, examples): the smallest few keys of the rows that fail."""
    checks = applicable(checks, df.columns)
    hits = F.array_compact(F.array(*(F.when(c.fails(), F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"))) for c in checks)))
    rows = df.select(F.col(key).cast("string").alias("k"), F.explode(hits).alias("c"))
    return first_examples(rows.select("c.check_name", "c.column_name", "k"), ["check_name", "column_name"], "k", most)


def first_examples(rows: DataFrame, by: Sequence[str], example: str, most: int = 3) -> DataFrame:
    """By group the count and the smallest few examples. The rank is a filter, so that each task passes on no more
    than `most` examples of a group, however many it has. Counts and examples are grouped together, so the rows are made once."""
    from pyspark.sql import Window

    each = rows.groupingSets([[*by], [*by, example]], *by, example).agg(F.count("*").alias("__n"), F.grouping(example).alias("__whole"))
    w = Window.partitionBy(*by, "__whole").orderBy(F.asc_nulls_last(example))
    few = each.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= most)
    whole = F.col("__whole") == 1
    return few.groupBy(*by).agg(F.max(F.when(whole, F.col("__n"))).alias("n"), F.array_sort(F.collect_list(F.when(~whole, F.col(example)))).alias("examples"))


def most_common(violations: DataFrame, message: str = "message", example: str = "file", most: int = 3) -> DataFrame:
    """Messages by frequency, with their count and first examples."""
    return first_examples(violations, [message], example, most).orderBy(F.desc("n"), message)


def enforce(df: DataFrame, schema: T.StructType, checks: Sequence[Check], unique: Sequence[str] = ()) -> DataFrame:
    """df, if it keeps the contract; else one error that names everything it breaks."""
    faults = schema_faults(df, schema)
    if faults:
        raise ContractError("; ".join(faults))
    broken = report(df, checks, unique).where("n_failed > 0").collect()  # a row for each check
    if broken:
        raise ContractError("; ".join(f"{r.column_name}: {r.n_failed} of {r.n_rows} rows fail {r.check_name}" for r in broken))
    return df


def refuse(violations: DataFrame) -> None:
    """Raises with all messages, the most common first."""
    found = most_common(violations).limit(100).collect()
    if found:
        raise ContractError("\n".join(f"{r.message} ({r.n} times, e.g. {', '.join(r.examples)})" for r in found))


def header_faults(have: Sequence[str], want: Sequence[str]) -> list[str]:
    """What a file's first line lacks, has too much, or has out of order."""
    missing, extra = [c for c in want if c not in have], [c for c in have if c not in want]
    out = [f"missing: {', '.join(missing)}"] * bool(missing) + [f"extra: {', '.join(extra)}"] * bool(extra)
    return out or (["columns are out of order"] if list(have) != list(want) else [])
