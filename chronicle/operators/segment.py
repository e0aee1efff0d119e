"""Segmentation of an unseparated keyword text: tokens, joins, sizes, spans, terms, scores.

A value's tokens have a gap between each two; a join says that both belong to one term. Sizes
are the lengths of the terms, spans their half-open ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.functions.text import bare, tokens

# Words that neither begin nor end a term, endings of inflected adjectives, and thresholds.
FUNCTION_WORDS = (
    "der die das den dem des "
    "ein eine einer eines einem einen "
    "und oder sowie "
    "für in im am an auf aus bei mit nach von vom vor zu zum zur "
    "über unter durch gegen ohne um zwischen "
    "and of the for"
).split()
INFLECTED = "(e|er|es|em)$"
MOST_FIELD_TOKENS = 3
PROSE_WORDS = 3
UNCERTAIN = (0.2, 0.8)
CONFIDENT_JOIN, CONFIDENT_CUT = 0.8, 0.2


def spans(sizes: Column) -> Column:
    """Half-open ranges."""
    start = F.array().cast("array<struct<lo:int,hi:int>>")
    last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1))["hi"], F.lit(0))
    return F.aggregate(sizes, start, lambda acc, n: F.concat(acc, F.array(F.struct(last(acc).alias("lo"), (last(acc) + n).cast("int").alias("hi")))))


def total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0), lambda acc, n: (acc + n).cast("int"))


def is_partition(sizes: Column, n: Column) -> Column:
    return F.coalesce((F.size(sizes) > 0) & F.forall(sizes, lambda s: s >= 1) & (total(sizes) == n), F.lit(False))


def terms(words: Column, sizes: Column) -> Column:
    """The spans' words without edge punctuation; empty ones drop out."""
    joined = F.transform(spans(sizes), lambda s: bare(F.array_join(F.slice(words, s["lo"] + 1, s["hi"] - s["lo"]), " ")))
    return F.filter(joined, lambda t: t != "")


def joins_to_sizes(joins: Column) -> Column:
    """[true, false, true] is [2, 2]; no gap is one token."""
    grow = lambda acc: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.element_at(acc, -1) + 1))
    return F.aggregate(joins, F.array(F.lit(1)), lambda acc, j: F.when(j, grow(acc)).otherwise(F.concat(acc, F.array(F.lit(1)))))


def sizes_to_joins(sizes: Column) -> Column:
    inner = F.flatten(F.transform(sizes, lambda n: F.concat(F.array(F.lit(False)), F.array_repeat(F.lit(True), (n - 1).cast("int")))))
    return F.slice(inner, 2, F.greatest(F.size(inner) - 1, F.lit(0)))


def _is_function_word(word: Column) -> Column:
    return F.lower(bare(word)).isin(*FUNCTION_WORDS)


def _closes(word: Column) -> Column:
    """Whether the author's own punctuation ends a field after it."""
    return F.rtrim(word, F.lit(" \"')]")).rlike("[,;]$")


def glued(words: Column, joins: Column) -> Column:
    """Function words joined to both neighbours, but never across a comma or semicolon."""
    word = lambda i: F.try_element_at(words, (i + 1).cast("int"))
    return F.transform(joins, lambda j, i: j | (~_closes(word(i)) & (_is_function_word(word(i)) | _is_function_word(word(i + 1)))))


def decoded(words: Column, probabilities: Column, threshold: float = 0.5) -> Column:
    """Terms and sizes from the probabilities of words 1 and on; a missing one is a cut.

    A value of less than two tokens passes as it is, edge punctuation and all.
    """
    gap = lambda i: F.coalesce(F.try_element_at(probabilities, (i + 1).cast("int")) >= threshold, F.lit(False))
    joins = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda _, i: gap(i))
    sizes = joins_to_sizes(glued(words, joins))
    many = F.size(words) > 1
    return F.struct(
        F.when(many, terms(words, sizes)).otherwise(words).alias("terms"),
        F.when(many, sizes).otherwise(F.transform(words, lambda _: F.lit(1))).alias("sizes"),
    )


# ---------------------------------------------------------------- scores


def score(predicted: Column, gold: Column) -> Column:
    """hits, predicted, gold spans of a value; an invalid partition has neither hits nor predictions."""
    ok = is_partition(predicted, total(gold))
    hits = F.size(F.array_intersect(spans(predicted), spans(gold)))
    return F.struct(F.when(ok, hits).otherwise(0).alias("hits"), F.when(ok, F.size(predicted)).otherwise(0).alias("predicted"), F.size(gold).alias("gold"))


def pooled(rows: DataFrame, by: list[str], s: str = "score") -> DataFrame:
    """Micro-averages. `precision` leaves out the predictions of values without a hit, as published
    figures do; `precision_strict` doesn't."""
    hits = F.sum(f"{s}.hits")
    all_gold, some, every = F.sum(f"{s}.gold"), F.sum(F.when(F.col(f"{s}.hits") > 0, F.col(f"{s}.predicted"))), F.sum(f"{s}.predicted")
    part = lambda a, b: F.when(F.coalesce(b, F.lit(0)) > 0, a / b).otherwise(0.0)
    out = rows.groupBy(*by).agg(hits.alias("hits"), all_gold.alias("support"), part(hits, some).alias("precision"), part(hits, every).alias("precision_strict"), part(hits, all_gold).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when(F.col("hits") > 0, 2 * p * r / (p + r)).otherwise(0.0))


def sweep(rows: DataFrame, probabilities: str, gold: str, steps: int = 20) -> DataFrame:
    """Pooled scores at thresholds 1/steps ... : every value against every threshold in one pass.

    A gold term is hit at all thresholds above the probabilities at its ends and up to those inside it, so
    nothing is segmented anew: a value's terms are counted for each threshold, and three counts a threshold
    are all that is exploded. No probabilities at all count as a cut everywhere. Function words are not
    glued here.
    """
    p = F.transform(probabilities, lambda x: F.coalesce(x.cast("double"), F.lit(-1.0)))
    n = total(F.col(gold))
    given = rows.select(F.when(F.size(probabilities) == 0, F.array_repeat(F.lit(-1.0), F.greatest(n - 1, F.lit(0)))).otherwise(p).alias("p"), n.alias("n"), F.size(gold).cast("long").alias("gold"), spans(F.col(gold)).alias("spans"))
    edge = lambda i: F.coalesce(F.get("p", i - 1), F.lit(-1.0))

    def reach(s: Column) -> Column:
        inner = F.array_min(F.slice("p", s["lo"] + 1, F.greatest(s["hi"] - s["lo"] - 1, F.lit(0))))
        outer = F.greatest(F.when(s["lo"] > 0, edge(s["lo"])).otherwise(-1.0), F.when(s["hi"] < F.col("n"), edge(s["hi"])).otherwise(-1.0))
        return F.struct(outer.alias("above"), F.coalesce(inner, F.lit(2.0)).alias("upto"))

    whole = F.filter("spans", lambda s: s["hi"] > s["lo"])
    valid = (F.size("p") + 1 == F.col("n")) & (F.col("n") > 0)
    ready = given.select("p", "gold", F.when(valid, F.transform(whole, reach)).alias("terms"))
    grid = F.transform(F.sequence(F.lit(1), F.lit(steps - 1)), lambda i: i / F.lit(float(steps)))

    def counted(t: Column) -> Column:
        hits = F.size(F.filter("terms", lambda s: (s["above"] < t) & (t <= s["upto"])))
        cuts = F.size(F.filter("p", lambda x: x < t)) + 1
        good = F.col("terms").isNotNull()
        return F.struct(t.alias("threshold"), F.struct(F.when(good, hits).otherwise(0).alias("hits"), F.when(good, cuts).otherwise(0).alias("predicted"), F.col("gold").alias("gold")).alias("score"))

    each = ready.select(F.explode(F.transform(grid, counted)).alias("e")).select("e.*")
    return pooled(each, ["threshold"]).orderBy("threshold")


# ---------------------------------------------------------------- labels


def bio(sizes: Column) -> Column:
    """0 at the first word of a term, 1 inside."""
    return F.concat(F.array(F.lit(0)), F.transform(sizes_to_joins(sizes), lambda j: j.cast("int")))


def label_stats(rows: DataFrame, labels: str = "labels") -> DataFrame:
    n = F.coalesce(F.sum(F.size(labels)), F.lit(0))
    inside = F.coalesce(F.sum(total(F.col(labels))), F.lit(0))
    return rows.agg(F.count("*").alias("n_rows"), n.cast("long").alias("n_words"), inside.cast("long").alias("n_inside")).withColumn("inside_rate", F.when(F.col("n_words") > 0, F.round(F.col("n_inside") / F.col("n_words"), 4)).otherwise(0.0))


def gap_accuracy(rows: DataFrame, predicted: str, gold: str) -> DataFrame:
    each = rows.select(F.explode(F.arrays_zip(F.col(predicted).alias("p"), F.col(gold).alias("g"))).alias("z"))
    return each.agg(F.avg((F.col("z.p") == F.col("z.g")).cast("double")).alias("accuracy"))


def fields(value: Column) -> Column:
    """The author's own fields."""
    return F.filter(F.transform(F.split(value, "[;,]"), lambda f: F.trim(f)), lambda f: f != "")


def one_term(words: Column) -> Column:
    """Whether a short field reads as one term: a hyphenated start, an abbreviation at the end, or an inflected adjective first."""
    first, last = F.element_at(words, 1), F.element_at(words, -1)
    return (F.size(words) < 2) | first.endswith("-") | last.startswith("(") | (first.rlike("^\\p{L}+$") & F.lower(first).rlike(INFLECTED))


def distant(rows: DataFrame, value: str) -> DataFrame:
    """(value, tokens, labels) of values with delimiters, none of whose fields is long."""
    words = F.transform(fields(F.col(value)), tokens)
    usable = rows.where(F.col(value).rlike("[;,]")).withColumn("__words", words).where((F.size("__words") > 1) & F.forall("__words", lambda w: F.size(w) <= MOST_FIELD_TOKENS))
    inside = lambda w: F.transform(w, lambda _, i: F.when((i > 0) & one_term(w), 1).otherwise(0))
    return usable.select(value, F.flatten("__words").alias("tokens"), F.flatten(F.transform("__words", inside)).alias("labels")).where("size(tokens) > 1")


def split_rows(rows: DataFrame, split: str) -> DataFrame:
    """(tokens, labels) of the labelled rows of a split."""
    return rows.where(F.col("split") == split).select("tokens", bio(F.col("group_sizes")).alias("labels"))


def sizes_from_spans(marks: Column) -> Column:
    return F.transform(marks, lambda s: s["hi"] - s["lo"])


def is_prose(value: Column) -> Column:
    """Whether one of the author's fields holds three function words."""
    return F.exists(F.split(value, "[;,]"), lambda f: F.size(F.filter(tokens(f), _is_function_word)) >= PROSE_WORDS)


def uncertain_gaps(probabilities: Column, low: float = UNCERTAIN[0], high: float = UNCERTAIN[1]) -> Column:
    places = F.transform(probabilities, lambda p, i: F.when(p.between(low, high), i))
    return F.array_compact(places)


def cut_compounds(words: Column, probabilities: Column) -> Column:
    """Cuts right before an inflected adjective that is surely joined to its noun."""
    word = lambda i: F.try_element_at(words, (i + 1).cast("int"))
    at = lambda i: F.try_element_at(probabilities, (i + 1).cast("int"))
    hit = lambda p, i: (i > 0) & (p >= CONFIDENT_JOIN) & (at(i - 1) <= CONFIDENT_CUT) & word(i).rlike("^\\p{Ll}\\p{L}{3,}$") & word(i).rlike(INFLECTED) & word(i + 1).rlike("^\\p{Lu}")
    return F.array_compact(F.transform(probabilities, lambda p, i: F.when(hit(p, i), i - 1)))


# ---------------------------------------------------------------- scorers

Scorer = Callable[[list[list[str]]], list[list[float]]]


def rule_scorer(batch: list[list[str]]) -> list[list[float]]:
    """A stand-in where no model is at hand: joins an inflected adjective to what follows, cuts elsewhere."""
    import re

    return [[0.95 if re.search(INFLECTED, a) and a.isalpha() and b[:1].isupper() else 0.05 for a, b in zip(w, w[1:], strict=False)] for w in batch]


#: Values that a scorer without a `chunk` of its own is asked for at a time.
BATCH = 32


def answered(values: DataFrame, column: str, scorer: Scorer) -> DataFrame:
    """(column, tokens, probabilities, revision) of distinct values; those with fewer than two tokens never reach the scorer.

    A scorer is asked for as many values at a time as its `chunk` says. One with `answers` says with each which
    revision gave it; else that is null.
    """
    given = values.select(column).where(F.col(column).isNotNull()).distinct().withColumn("tokens", tokens(F.col(column)))
    none = F.array().cast("array<double>")
    batch = getattr(scorer, "chunk", BATCH)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = [list(w) for w in frame["tokens"]]
            found: list[tuple[list[float], str | None]] = []
            for i in range(0, len(words), batch):
                part = words[i : i + batch]
                got = [(p, revision) for p, revision, _ in scorer.answers(part)] if hasattr(scorer, "answers") else [(p, None) for p in scorer(part)]
                if len(got) != len(part):
                    raise ValueError(f"the scorer gave {len(got)} answers to {len(part)} values")
                found += got
            yield frame.assign(probabilities=[p for p, _ in found], revision=pd.Series([r for _, r in found], dtype=object, index=frame.index))

    schema = f"{column} string, tokens array<string>, probabilities array<double>, revision string"
    short = given.where("size(tokens) < 2").withColumns({"probabilities": none, "revision": F.lit(None).cast("string")})
    return given.where("size(tokens) > 1").mapInPandas(run, schema).unionByName(short)


def scored(values: DataFrame, column: str, scorer: Scorer) -> DataFrame:
    """(column, tokens, probabilities), as `answered` has them."""
    return answered(values, column, scorer).drop("revision")


def stale(values: DataFrame, stored: DataFrame, column: str, revision: str) -> DataFrame:
    """Distinct values without a stored segment of this revision; a null revision is stale."""
    wanted = values.select(column).where(F.col(column).isNotNull()).distinct()
    known = stored.select(F.col(column).alias("__value"), F.col("revision").alias("__revision"))
    return wanted.join(known, F.col(column) == F.col("__value"), "left").where(~F.col("__revision").eqNullSafe(F.lit(revision))).select(column)


def cache_key(value: Column, revision: str | Column) -> Column:
    """One answer for each value and producer."""
    return F.md5(F.concat(F.lit(revision) if isinstance(revision, str) else revision, F.lit("\n"), value))


def cached(values: DataFrame, cache: DataFrame, column: str, revision: str) -> tuple[DataFrame, DataFrame]:
    """Distinct values with their answer from the cache (key, probabilities), and those without one. Of several answers to one
    key the last one loaded counts, if the cache says when (`loaded`)."""
    wanted = values.select(column).where(F.col(column).isNotNull()).distinct().withColumn("key", cache_key(F.col(column), revision))
    known = wanted.join(cache, "key")
    if "loaded" in cache.columns:
        known = known.groupBy("key", column).agg(F.max_by("probabilities", "loaded").alias("probabilities"))
    return known, wanted.join(cache, "key", "left_anti")


def revision_of(code: bytes, weights: bytes) -> str:
    """Names a producer by its code and its weights."""
    import hashlib

    return ".".join(hashlib.sha256(x).hexdigest()[:12] for x in (code, weights))


def revision(code: Column, weights: Column) -> Column:
    """`revision_of` of two columns of texts."""
    return F.concat_ws(".", *(F.substring(F.sha2(x.cast("binary"), 256), 1, 12) for x in (code, weights)))
