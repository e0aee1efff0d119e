"""A boundary tagger for unseparated keyword texts: hashed features in a linear chain over two labels.

A word begins a term (0) or stands inside one (1); the first word begins one. A labelling's score is the sum of
the weights of the features of its inside words and of the steps between neighbouring labels. Fitting maximises the
likelihood of labelled rows, less a ridge: each round every partition adds up the gradient of its rows, Spark sums it by
feature, and the driver, which has one number for each of the `2 ** bits` features and nothing else, makes the step.
Decoding is a fold over the words' scores in the JVM; a word's probability is its marginal in the chain.

Values without words have no labels. Rows whose labels don't fit their words are refused. Rows may be of any number and
partitioning; sums of partitions differ in their last digits from one run to the next, and weights with them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.operators import segment

#: Rows of a batch that are laid side by side.
ROWS = 512
LOW = -1e30


@lru_cache(1 << 16)
def _shape(word: str) -> str:
    """Its kinds of characters, each run once."""
    out = ""
    for ch in word:
        kind = "9" if ch.isdigit() else "A" if ch.isupper() else "a" if ch.isalpha() else ch
        if not out.endswith(kind):
            out += kind
    return out


def features(words: list[str], bits: int) -> list[list[int]]:
    """Of each word the buckets of its features: itself and its neighbours, their endings and shapes."""
    bare = [w.strip(" ,;.:()[]\"'").lower() for w in words]
    shapes = [_shape(w) for w in words]
    out = []
    for i, w in enumerate(bare):
        before, after = (bare[i - 1], shapes[i - 1]) if i else ("^", "^"), (bare[i + 1], shapes[i + 1]) if i + 1 < len(bare) else ("$", "$")
        said = (
            "1", f"w={w}", f"e={w[-3:]}", f"s={shapes[i]}",
            f"b={before[0]}", f"be2={before[0][-2:]}", f"be3={before[0][-3:]}", f"bs={before[1]}", f"bl={words[i - 1][-1:] if i else ''}",
            f"a={after[0]}", f"as={after[1]}", f"bb={before[0]} {w}",
        )
        out.append([zlib.crc32(x.encode("utf-8", "surrogatepass")) % (1 << bits) for x in said])
    return out


PER_WORD = len(features(["a"], 8)[0])


@dataclass
class Tagger:
    """Weights of an inside word's features, and of the steps from one label to the next."""

    bits: int = 16
    weights: np.ndarray = field(default=None)
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def __post_init__(self) -> None:
        self.weights = np.zeros(1 << self.bits) if self.weights is None else self.weights

    def emissions(self, words: list[str]) -> list[float]:
        """Each word's score as an inside word."""
        return self.weights[np.array(features(words, self.bits), np.int64).reshape(len(words), PER_WORD)].sum(1).tolist()

    def __call__(self, batch: list[list[str]]) -> list[list[float]]:
        """As a scorer: how likely each word but the first stands inside a term."""
        out: list[list[float]] = [[] for _ in batch]
        for own, scores, lengths in _side_by_side([len(w) for w in batch]):
            for k, i in enumerate(own):
                scores[k, : lengths[k]] = self.emissions(batch[i])
            inside = _chain(scores, lengths, self.steps)[0]
            for k, i in enumerate(own):
                out[i] = inside[k, 1 : lengths[k]].tolist()
        return out


# ---------------------------------------------------------------- the chain


def _side_by_side(lengths: list[int]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Rows of similar length together: their numbers, an empty table of scores, their lengths."""
    order = sorted((i for i, n in enumerate(lengths) if n), key=lengths.__getitem__)
    for k in range(0, len(order), ROWS):
        own = order[k : k + ROWS]
        yield own, np.zeros((len(own), lengths[own[-1]])), np.array([lengths[i] for i in own])


def _chain(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of scores: each word's probability to stand inside, the expected steps, and the rows' log totals."""
    n, most = scores.shape
    ahead = np.zeros((most, n, 2))
    ahead[0] = [0.0, LOW]
    for t in range(1, most):
        ahead[t] = np.logaddexp(ahead[t - 1, :, :1] + steps[0], ahead[t - 1, :, 1:] + steps[1])
        ahead[t, :, 1] += scores[:, t]
    rest = np.zeros((most, n, 2))
    for t in range(most - 2, -1, -1):
        after = rest[t + 1].copy()
        after[:, 1] += scores[:, t + 1]
        back = np.logaddexp(steps[:, 0] + after[:, :1], steps[:, 1] + after[:, 1:])
        rest[t] = np.where((t + 1 < lengths)[:, None], back, 0.0)
    total = np.logaddexp(*np.moveaxis(ahead[lengths - 1, np.arange(n)], 1, 0))
    inside = np.exp(ahead[:, :, 1] + rest[:, :, 1] - total).T * (np.arange(most) < lengths[:, None])
    taken = np.zeros((2, 2))
    for t in range(1, most):
        live = t < lengths
        after = rest[t].copy()
        after[:, 1] += scores[:, t]
        pair = np.exp(ahead[t - 1][:, :, None] + steps + after[:, None, :] - total[:, None, None])
        taken += pair[live].sum(0)
    return inside, taken, total


def _gradient(tagger: Tagger, ids: list[np.ndarray], labels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the log likelihood of rows: by feature, by step, and itself. Rows are their features and labels."""
    by_feature, by_step, likely = np.zeros(1 << tagger.bits), np.zeros((2, 2)), 0.0
    for own, scores, lengths in _side_by_side([len(x) for x in labels]):
        flat, said = np.concatenate([ids[i] for i in own]), np.concatenate([labels[i] for i in own])
        live = np.arange(scores.shape[1]) < lengths[:, None]
        scores[live] = tagger.weights[flat].sum(1)
        inside, taken, total = _chain(scores, lengths, tagger.steps)
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        error = said - inside[live]
        error[first] = 0.0  # the first word's label isn't chosen
        by_feature += np.bincount(flat.ravel(), np.repeat(error, PER_WORD), 1 << tagger.bits)
        follows = np.ones(len(said), bool)
        follows[first] = False
        at = np.flatnonzero(follows)
        seen = np.zeros((2, 2))
        np.add.at(seen, (said[at - 1], said[at]), 1)
        by_step += seen - taken
        likely += float((said[at] * scores[live][at]).sum() + (seen * tagger.steps).sum() - total.sum())
    return by_feature, by_step, likely


def _views(lists: pa.ListArray, width: int) -> list[np.ndarray]:
    """Each list's numbers, `width` in a row, as a part of the one array that holds them all: no number becomes an object."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    return [x.reshape(-1, width) if width > 1 else x for x in np.split(flat, ends[:-1])] if len(lists) else []


def fit(labelled: DataFrame, bits: int = 16, rounds: int = 25, ridge: float = 0.5, rate: float = 0.5) -> tuple[Tagger, list[float]]:
    """A tagger from rows (tokens, labels), and the likelihood before each round."""
    spark = labelled.sparkSession
    fits = (F.size("tokens") == F.size("labels")) & (F.element_at("labels", 1) == 0)
    rows = labelled.where("size(tokens) > 0").select("tokens", F.when(fits, F.col("labels")).otherwise(F.raise_error(F.lit("labels that don't fit their words"))).cast("array<int>").alias("labels"))

    def hashed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            ids = [np.array(features(w, bits), np.int32).ravel() for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), batch.column(1)], ["ids", "labels"])

    rows = rows.mapInArrow(hashed, "ids array<int>, labels array<int>").persist()
    tagger, squares, said = Tagger(bits), np.full((1 << bits) + 4, 1e-8), []
    try:
        for _ in range(rounds):
            sent = spark.sparkContext.broadcast((tagger.weights, tagger.steps))  # 2 ** bits numbers

            def gradients(frames: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                own = Tagger(bits, *sent.value)
                total = np.zeros((1 << bits) + 5)
                for batch in frames:
                    ids, labels = _views(batch.column(0), PER_WORD), _views(batch.column(1), 1)
                    by_feature, by_step, likely = _gradient(own, ids, labels)
                    total += np.concatenate((by_feature, by_step.ravel(), [likely]))
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["feature", "g"])

            found = rows.mapInArrow(gradients, "feature int, g double").groupBy("feature").agg(F.sum("g").alias("g")).toArrow()  # 2 ** bits rows at most
            total = np.zeros((1 << bits) + 5)
            total[found["feature"].to_numpy()] = found["g"].to_numpy()
            sent.unpersist()
            own = np.concatenate((tagger.weights, tagger.steps.ravel()))
            said.append(float(total[-1]))
            slope = total[:-1] - ridge * own
            squares += slope**2
            own = own + rate * slope / np.sqrt(squares)
            tagger = Tagger(bits, own[: 1 << bits], own[1 << bits :].reshape(2, 2))
    finally:
        rows.unpersist()
    return tagger, said


# ---------------------------------------------------------------- decoding


def viterbi(scores: Column, steps: np.ndarray | list[list[float]]) -> Column:
    """The best labelling of each row of scores, from the second word's on; of two that score alike, a word begins a term.

    One fold over the words, with the best score and labels up to a word that begins a term and up to one that stands inside. Its result
    is named once: Spark would make it anew in each place.
    """
    (t00, t01), (t10, t11) = [[float(x) for x in row] for row in steps]
    start = F.struct(F.lit(0.0).alias("s0"), F.lit(LOW).alias("s1"), F.array(F.lit(0)).alias("p0"), F.array(F.lit(1)).alias("p1"))

    def step(a: Column, e: Column) -> Column:
        to0, from1to0 = a["s0"] + t00, a["s1"] + t10
        to1, from1to1 = a["s0"] + t01, a["s1"] + t11
        before = lambda better: F.when(better, a["p1"]).otherwise(a["p0"])
        return F.struct(
            F.greatest(to0, from1to0).alias("s0"),
            (F.greatest(to1, from1to1) + e).alias("s1"),
            F.concat(before(from1to0 > to0), F.array(F.lit(0))).alias("p0"),
            F.concat(before(from1to1 > to1), F.array(F.lit(1))).alias("p1"),
        )

    return F.aggregate(F.transform(scores, lambda x: x.cast("double")), start, step, lambda a: F.when(a["s1"] > a["s0"], a["p1"]).otherwise(a["p0"]))


def tagged(values: DataFrame, tokens: str, tagger: Tagger) -> DataFrame:
    """The rows with `scores` of the words from the second on, their labels (`predicted`) and the sizes of the terms."""
    sent = values.sparkSession.sparkContext.broadcast((tagger.bits, tagger.weights, tagger.steps))

    @F.pandas_udf("array<double>")
    def scores(words: pd.Series) -> pd.Series:
        own = Tagger(*sent.value)
        return pd.Series([None if w is None else own.emissions(list(w))[1:] for w in words])

    labels = F.when(F.size(tokens) > 0, viterbi(F.col("scores"), tagger.steps)).otherwise(F.array().cast("array<int>"))
    found = values.withColumn("scores", scores(F.col(tokens))).withColumn("predicted", labels)
    joins = F.transform(F.slice("predicted", 2, F.greatest(F.size("predicted") - 1, F.lit(0))), lambda x: x == 1)
    return found.withColumn("sizes", F.when(F.size("predicted") > 0, segment.joins_to_sizes(joins)).otherwise(F.array().cast("array<int>")))


def quality(labelled: DataFrame, tagger: Tagger) -> DataFrame:
    """Pooled exact spans of rows (tokens, labels): by the tagger, and where no words are ever joined."""
    rows = tagged(labelled, "tokens", tagger)
    gold = segment.joins_to_sizes(F.transform(F.slice("labels", 2, F.size("labels") - 1), lambda x: x == 1))
    never = F.transform("tokens", lambda _: F.lit(1))
    each = rows.select(F.explode(F.array(
        F.struct(F.lit("tagger").alias("by"), segment.score(F.col("sizes"), gold).alias("score")),
        F.struct(F.lit("never join").alias("by"), segment.score(never, gold).alias("score")),
    )).alias("e")).select("e.*")
    return segment.pooled(each, ["by"])
