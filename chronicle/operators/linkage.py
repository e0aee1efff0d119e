"""Links between documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicle.functions.text import page_url, without_prefix

TARGET = "target:"
#: A side under this many bytes may be broadcast; larger ones are left to the optimizer.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """With a broadcast hint if the optimizer's own estimate of its size is under the bound."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= most else df


def with_address(index: DataFrame, fields: Sequence[str], link: str = "address") -> DataFrame:
    """Each document with its address document's fields where it lacks the property itself.

    One hop, from the index as read. A property that is there but empty stays empty, so this is
    no coalesce.
    """
    other = index.select(F.col("href").alias("__href"), *(F.col(f).alias(f"__{f}") for f in fields))
    joined = index.join(other, without_prefix(F.col(link), TARGET) == F.col("__href"), "left")
    return joined.withColumns({f: F.when(F.col(f"has_{f}"), F.col(f)).otherwise(F.col(f"__{f}")) for f in fields}).select(index.columns)


def with_website(index: DataFrame, base: str, link: str = "website", url: str = "url") -> DataFrame:
    """Each document's website: the linked document's URL, or else that document's page."""
    target = without_prefix(F.col(link), TARGET)
    other = index.select(F.col("href").alias("__href"), F.nullif(F.col(url), F.lit("")).alias("__url"))
    joined = index.join(other, target == F.col("__href"), "left")
    return joined.withColumn("website_url", F.coalesce("__url", page_url(base, target))).drop("__href", "__url")


def first_link(rows: DataFrame, links: str, index: DataFrame, fields: Sequence[str], prefix: str = "") -> DataFrame:
    """The document of the first link, its fields as columns; null without one."""
    other = index.select(F.col("href").alias("__href"), *(F.col(f).alias(f"{prefix}{f}") for f in fields))
    key = without_prefix(F.try_element_at(F.col(links), F.lit(1)), TARGET)
    return rows.join(small(other), key == F.col("__href"), "left").drop("__href")


def resolved(rows: DataFrame, key: str, links: str, index: DataFrame, out: str, url: str = "url", title: str = "title") -> DataFrame:
    """Links as (url, title) of their documents in the order given; those without a document drop out; none is []."""
    target = index.where(F.col(url).isNotNull()).select(F.col("href").alias("__href"), F.struct(F.col(url).alias("url"), F.col(title).alias("title")).alias("__to"))
    each = rows.select(key, F.posexplode(links).alias("__at", "__link")).withColumn("__href", without_prefix(F.col("__link"), TARGET))
    found = each.join(small(target), "__href").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__at", "__to"))).alias("__found"))
    lists = found.select(key, F.transform("__found", lambda x: x["__to"]).alias(out))
    empty = F.array().cast("array<struct<url:string,title:string>>")
    return rows.join(lists, key, "left").withColumn(out, F.coalesce(out, empty))


def first_by(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key, the first in that order."""
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__rank = 1").drop("__rank")
