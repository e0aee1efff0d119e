"""Alignment of categories with published code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronicle.functions.text import normal_label


class Undecided(ValueError):
    """A category that neither matches nor is declared to match nothing."""


def align(categories: DataFrame, codelist: DataFrame, manual: DataFrame, no_match: DataFrame) -> DataFrame:
    """(column, code, label, match, source): each category's codes of the list.

    categories: column, codelist, code, label. codelist: codelist, code, label. manual: column,
    code, match (perhaps several). no_match: column, code. A manual match goes before the
    label, the label before "no match"; of codes with the same label the first counts. What is
    left has source null.
    """
    by_label = codelist.withColumn("__label", normal_label(F.col("label"))).withColumn("__rank", F.row_number().over(Window.partitionBy("codelist", "__label").orderBy(F.length("code"), "code")))
    first = by_label.where("__rank = 1").select("codelist", "__label", F.col("code").alias("__match"))
    hand = manual.select("column", "code", F.col("match").alias("__hand"))
    none = no_match.select("column", "code", F.lit(True).alias("__none")).distinct()
    rows = categories.withColumn("__label", normal_label(F.col("label"))).join(first, ["codelist", "__label"], "left").join(hand, ["column", "code"], "left").join(none, ["column", "code"], "left")
    source = F.when(F.col("__hand").isNotNull(), "manual").when(F.col("__none").isNotNull() & F.col("__match").isNull(), "no match").when(F.col("__match").isNotNull(), "label")
    return rows.select("column", "codelist", "code", "label", F.coalesce("__hand", "__match").alias("match"), source.alias("source"))


def decided(matches: DataFrame) -> DataFrame:
    """The matches, if every category is decided."""
    left = matches.where("source is null").select("column", "code").orderBy("column", "code").limit(20).collect()
    if left:
        raise Undecided(", ".join(f"{r.column}.{r.code}" for r in left))
    return matches


def matches(aligned: DataFrame) -> DataFrame:
    """One row for each column, code and match, in that order; a null match where there is none."""
    return aligned.orderBy("column", "code", F.asc_nulls_last("match"))


def unmatched(aligned: DataFrame, rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(column, code, n): categories without a match, by the number of rows that hold them."""
    each = None
    for column in columns:
        one = rows.select(F.lit(column).alias("column"), F.explode(F.array_distinct(F.col(columns[column]))).alias("code")).groupBy("column", "code").agg(F.count("*").alias("n"))
        each = one if each is None else each.unionByName(one)
    left = aligned.where("match is null").select("column", "code", "label").distinct()
    return left.join(each, ["column", "code"], "left").withColumn("n", F.coalesce("n", F.lit(0))).orderBy(F.desc_nulls_last("n"), "column", "code")


def code_uri(template: str, code):
    """The code's URI; null for a null code."""
    before, _, after = template.partition("{code}")
    return F.concat(F.lit(before), code, F.lit(after))
