"""Seeded samples: rows in the order of a hash of key and seed, the same on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows, with their place in the draw from 0 on."""
    top = df.withColumn("__draw", draw(F.col(key), seed)).orderBy("__draw", key).limit(n)
    return top.withColumn("draw", F.row_number().over(Window.orderBy("__draw", key)) - 1).drop("__draw")


def split(drawn: DataFrame, held: int) -> DataFrame:
    """The first `held` of a draw are for testing."""
    return drawn.withColumn("split", F.when(F.col("draw") < held, "test").otherwise("train"))


def stratified(df: DataFrame, key: str, stratum: Column, each: int, seed: int = 0) -> DataFrame:
    """Up to `each` rows of every stratum; one that has fewer gives what it has."""
    w = Window.partitionBy("stratum").orderBy("__draw", key)
    rows = df.withColumn("stratum", stratum).withColumn("__draw", draw(F.col(key), seed))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= each).drop("__draw")


def under_filled(sampled: DataFrame, strata: Sequence[str], each: int) -> list[str]:
    """Strata that gave fewer rows than asked for."""
    have = {r["stratum"]: r["n"] for r in sampled.groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    return [s for s in strata if have.get(s, 0) < each]


def pooled_sample(df: DataFrame, key: str, stratum: Column, each: int, pattern: Column, most: int, named: Sequence, seed: int = 0) -> DataFrame:
    """Stratified rows, some of those that a pattern marks, and named ones; each row once."""
    strata = stratified(df, key, stratum, each, seed).drop("rank").withColumn("pool", F.lit("stratum"))
    marked = sample(df.where(pattern), key, most, seed + 1).drop("draw").withColumn("stratum", F.lit(None).cast("string")).withColumn("pool", F.lit("pattern"))
    asked = df.where(F.col(key).isin(*named)).withColumn("stratum", F.lit(None).cast("string")).withColumn("pool", F.lit("named"))
    rank = F.when(F.col("pool") == "named", 0).when(F.col("pool") == "pattern", 1).otherwise(2)
    every = strata.withColumn("stratum", F.col("stratum").cast("string")).unionByName(marked).unionByName(asked)
    return every.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(rank))).where("__rank = 1").drop("__rank")


def first_seen(df: DataFrame, value: str, position: str) -> DataFrame:
    """Each value once, at its first place."""
    return df.groupBy(value).agg(F.min(position).alias(position))
