"""From the raw table to the export: codes, ids, attribution, links, pivots, names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.functions import arrays, text
from chronicle.model import Model
from chronicle.operators import linkage


def decoded(df: DataFrame, model: Model) -> DataFrame:
    """Coded lists as the leaves of their links; lists with aliases replaced and each code kept once."""
    out = {}
    for c in model.coded:
        if c in df.columns:
            codes = F.transform(c, text.leaf)
            out[c] = arrays.aliased(codes, model.aliases[c]) if c in model.aliases else codes
    return df.withColumns(out) if out else df


def identified(df: DataFrame, model: Model) -> DataFrame:
    slug = text.id_slug(F.col("url"), model.slug_after)
    return df.withColumns({"id_url": slug, "id_hash": text.id_hash(slug)})


def attribution(title: Column, slug: Column, url: Column, publisher: str, licence: str) -> Column:
    """Who made it, under which terms, and where it is: the title, or else the id, always names it."""
    return F.concat(F.coalesce(title, slug), F.lit(f" von {publisher}, {licence}, "), url)


def collapsed(df: DataFrame, pivots: Mapping[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """Several lists as one of `parent.child`, in the declared order."""
    out = {name: arrays.collapsed([(p, F.col(c)) for p, c in pairs if c in df.columns]) for name, pairs in pivots.items() if any(c in df.columns for _, c in pairs)}
    return df.withColumns(out) if out else df


def renamed(df: DataFrame, drop: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Without the columns to drop, and with the new names, of those that are there."""
    df = df.drop(*[c for c in drop if c in df.columns])
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def retyped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their order and types; JSON texts of nested ones are read back."""
    have = dict(df.dtypes)
    cols = []
    for f in schema.fields:
        x = F.col(f.name) if f.name in have else F.lit(None)
        nested = isinstance(f.dataType, T.ArrayType | T.StructType)
        cols.append((F.from_json(x, f.dataType.simpleString()) if nested and have.get(f.name) == "string" else x.cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def with_terms(df: DataFrame, segments: DataFrame, keywords: str = "keywords", out: str = "keywords_extracted") -> DataFrame:
    """Materialised terms of the keyword text; null where there are none (a null text never has any)."""
    known = segments.select(F.col("keywords").alias("__keywords"), F.col("terms").alias(out))
    return df.join(known, F.col(keywords) == F.col("__keywords"), "left").drop("__keywords")


def process(raw: DataFrame, model: Model, index: DataFrame | None = None, contact_fields: Sequence[str] = (), segments: DataFrame | None = None) -> DataFrame:
    """The export: decode, ids, attribution, links, pivots, names."""
    df = identified(decoded(raw, model), model)
    if model.licence:
        title = F.col("title") if "title" in df.columns else F.lit(None).cast("string")
        df = df.withColumn("license_info", attribution(title, F.col("id_url"), F.col("url"), model.publisher, model.licence))
    if index is not None and model.contact and model.contact in df.columns:
        df = linkage.first_link(df, model.contact, index, contact_fields, "contact_info_")
    if index is not None and model.external and model.external in df.columns:
        df = linkage.resolved(df, "url", model.external, index, "further_links")
    df = renamed(collapsed(df, model.pivots), model.drop, model.renames)
    return with_terms(df, segments) if segments is not None and "keywords" in df.columns else df


def pivot_paths(parents: DataFrame, children: DataFrame) -> DataFrame:
    """All `parent.code` that a collapsed list may hold: parents (parent, vocab) with codes (vocab, code)."""
    return parents.join(children, "vocab").select(F.concat("parent", F.lit("."), "code").alias("path")).distinct().orderBy("path")
