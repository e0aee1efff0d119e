"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer turns words into symbols (insult, threat, menace, target, negation, reported
speech, other) with weights. Small transducers follow what a clause has said so far: whether
someone is addressed, whether a negation still holds, whether the clause reports speech. Their
composition is one table; where it reads an insult, threat or menace it puts out which kind of
clause this is (plain, targeted, negated, reported, threat). A document's score comes from the
weights of its matched clauses by kind, not from single words.

Lexicon weights and the kinds' weights are learned from labelled rows whose
crc32(doc_id as text) mod 3 is not 1, on at most `most_toxic` and `most_clean` of them (those
with the smallest hash of doc_id); the bound holds for fitting alone. A word's support is the
number of different words that stand before it, so that copies of a document count once. Stems
(first 3 to 8 letters) are learned beside whole words, for inflected languages. A learned unit is
an insult or a menace by the company it keeps: which of the two seed lists the words before it
speak for. A menace is a threat where someone is its target; without one it counts as an insult
does, as the labels speak for it (a seed threat, such as "kill", then says nothing). Every unit
that passes the thresholds is in the lexicon. Everything else reads all rows and whole texts.
Labels, lang, source and doc_id are no inputs of a score.

The kinds' weights are fitted with fixed weights as their prior, so few labels move them little and
no labels leave them as they are. A null or blank text has no clauses and gets the score of a text
without matches. Several labels of one doc_id, or of one text, count as toxic if one of them does;
a null label counts as none. Rows that share an id are scored separately. Other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, CLOSE, MENACE = range(8)
SYMBOLS = 8
SEEDS = {
    INSULT: "idiot idiots stupid moron morons loser losers scum worthless imbecile dumbass idiota estúpido imbécile idiote dummkopf",
    THREAT: "kill killed murder hurt strangle stab shoot beat burn destroy töten umbringen tuer frapper matar golpear",
    TARGET: "you your yours u he she they them his her their this these those du dich dein ihr euch sie er tu toi vous ton votre il elle ils tú usted ustedes él ella ellos",
    NEGATION: "not no never neither nor isn aren wasn don doesn didn nicht kein keine nie ne pas jamais non nunca ni",
    REPORT: "said says say wrote writes called calls quoted claimed reported sagte schrieb nannte dit écrit appelle dijo escribió llamó",
}
SEED_WEIGHT = 4.0
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
STEMS = (3, 4, 5, 6, 7, 8)
#: Words whose symbols a worker remembers; more are looked up again.
KNOWN_WORDS = 100_000
NOTHING, END = (OTHER, 0.0), (CLOSE, 0.0)
MATCHED = (INSULT, THREAT, MENACE)
KINDS = ("plain", "targeted", "negated", "reported", "threat")
#: Intercept, then a weight for each kind, for the strongest clause and for the number of clauses: what labels move the weights from.
FIXED = np.array([-3.0, 1.5, 2.0, 0.3, 0.3, 1.0, 1.0, 0.0])


def _follow(opens: int, memory: int) -> dict[tuple[int, int], int]:
    """A transducer with a state for how many more words the symbol `opens` stays in force."""
    out = {}
    for state, symbol in product(range(memory + 1), range(SYMBOLS)):
        out[state, symbol] = memory if symbol == opens else 0 if symbol == CLOSE else max(0, state - 1)
    return out


def composed() -> tuple[np.ndarray, np.ndarray]:
    """The composition of the target, negation and reported-speech transducers with the insult and
    threat ones: next state and kind put out (-1: nothing) by state and symbol."""
    target, negation, report = _follow(TARGET, 4), _follow(NEGATION, 3), _follow(REPORT, 8)
    states = list(product(range(5), range(4), range(9)))
    number = {s: i for i, s in enumerate(states)}
    step = np.zeros((len(states), SYMBOLS), np.int32)
    out = np.full((len(states), SYMBOLS), -1, np.int32)
    for (t, n, r), symbol in product(states, range(SYMBOLS)):
        i = number[t, n, r]
        step[i, symbol] = number[target[t, symbol], negation[n, symbol], report[r, symbol]]
        if symbol in (INSULT, THREAT, MENACE):
            aimed, loose = {INSULT: (1, 0), THREAT: (4, -1), MENACE: (4, 0)}[symbol]
            out[i, symbol] = 2 if n else 3 if r else aimed if t else loose
    return step, out


class Grammar:
    """Scores texts; `lexicon` has weights of words, and of stems with a * after them; those of `menaces` are no insults."""

    def __init__(self, lexicon: dict[str, float], weights: np.ndarray, menaces: frozenset[str] = frozenset()) -> None:
        self.symbols: dict[str, tuple[int, float]] = {}
        for kind, seeds in SEEDS.items():
            self.symbols.update((w, (kind, SEED_WEIGHT if kind in (INSULT, THREAT) else 0.0)) for w in seeds.split())
        self.lexicon, self.weights, self.menaces = lexicon, weights, menaces
        self.heads = {unit[: STEMS[0]] for unit in lexicon}
        step, out = composed()
        self.step, self.out = step.tolist(), out.tolist()
        self.known: dict[str, tuple[int, float]] = {}
        self.telling: set[str] = set()  # of the known ones, those that can match

    def _symbol(self, word: str) -> tuple[int, float]:
        """The lexical transducer: exact word, else its heaviest stem."""
        if word[: STEMS[0]] not in self.heads:
            return self.symbols.get(word) or (NOTHING if word[:1].isalpha() else END)
        learned, unit = max((self.lexicon.get(u, 0.0), u) for u in (word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)))
        kind, weight = self.symbols.get(word, (OTHER, 0.0))
        if learned > 0 and kind in (OTHER, INSULT):
            return MENACE if kind == OTHER and unit in self.menaces else INSULT, max(learned, weight)
        return END if not word[:1].isalpha() else self.symbols.get(word, NOTHING)

    def features(self, text: str | None) -> np.ndarray:
        sums = [0.0] * len(KINDS)
        strongest, clauses = 0.0, 0
        known, words = self.known, TOKEN.findall((text or "").lower())
        distinct = set(words)
        if len(known) > KNOWN_WORDS:
            known.clear()
            self.telling.clear()
        for w in distinct.difference(known):
            s = known[w] = self._symbol(w)
            if s[0] in MATCHED:
                self.telling.add(w)
        if not distinct.isdisjoint(self.telling):
            symbols = [known[w] for w in words]
            state, clause = 0, {}
            for symbol, weight in [*symbols, END]:
                kind = self.out[state][symbol]
                if kind >= 0:
                    clause[kind] = clause.get(kind, 0.0) + weight
                state = self.step[state][symbol]
                clauses += symbol == CLOSE
                if symbol == CLOSE and clause:
                    for k, v in clause.items():
                        sums[k] += v
                    strongest = max(strongest, *clause.values())
                    clause = {}
        # Each further clause of a kind says less than the one before it; chance matches grow with the clauses read.
        return np.array([*(math.log1p(x / SEED_WEIGHT) for x in sums), math.log1p(strongest), math.log1p(clauses)])

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + features @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a ridge around the fixed weights."""
    a = np.column_stack((np.ones(len(x)), x))
    w = FIXED.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.eye(len(w)), a.T @ (y - p) - (w - FIXED))
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, fold, word, word before) once for each megabyte of text."""
    for batch in (part for whole in batches for part in c.parts(whole, "text", 1 << 20)):
        seen: set[tuple[int, int, str, str]] = set()
        for toxic, fold, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            words = TOKEN.findall((text or "").lower())
            seen.update((toxic, fold, w, b) for b, w in zip(["", *words], words, strict=False))
        rows = [x for x in seen if x[2][0].isalpha()]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], ["toxic", "fold", "word", "before"])
    c.release()


def _weight(a: float, b: float, toxic: int, clean: int) -> float:
    """Log odds of a unit in toxic against clean texts, less one standard error."""
    ratio = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
    return min(10.0, ratio - math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)))


def _leaning(contexts: DataFrame, units: DataFrame) -> DataFrame:
    """(word, menace): whether the words before a unit, in toxic texts, speak for the threat seeds rather than the insult ones."""
    seeds = [(w, kind) for kind in (INSULT, THREAT) for w in SEEDS[kind].split()]
    toxic = contexts.where("toxic = 1").select("word", "before").distinct()
    known = toxic.join(F.broadcast(contexts.sparkSession.createDataFrame(seeds, "word string, kind int")), "word")
    each = known.groupBy("before").agg(F.count_if(F.col("kind") == THREAT).alias("t"), F.count_if(F.col("kind") == INSULT).alias("i"))
    total = each.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("i"), F.lit(0)).alias("i")).first()
    share = lambda kind: (F.col(kind) + 0.5) / F.lit(total[kind] + 1)
    says = toxic.join(each, "before").select("word", F.log(share("t") / share("i")).alias("says"))
    own = says.groupBy("word").agg(F.sum("says").alias("says"))
    starts = F.array(F.col("word"), *(F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS))
    sums = own.select("says", F.explode(F.array_compact(starts)).alias("word")).groupBy("word").agg(F.sum("says").alias("says"))
    return units.join(sums, "word", "left").withColumn("menace", F.coalesce(F.col("says") > 0, F.lit(False))).drop("says")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_toxic: int = 5000, most_clean: int = 10000, least_weight: float = 2.0) -> Grammar:
    """The grammar with a lexicon and weights learned from a bounded sample of labelled rows.

    The kinds' weights are fitted on what lexicons of one half of the sample find in the other,
    the lexicon itself on both halves. The driver sees the lexicon, which is a part of the
    sample's words, and one row of figures for each text of the sample.
    """
    said = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = said.where(F.col("toxic").isNotNull() & F.col("id").isNotNull() & ~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    texts = c.bounded(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = known.join(texts.select("id").distinct(), "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(most_toxic).union(known.where("toxic = 0").orderBy(*order).limit(most_clean))
    rows = texts.join(F.broadcast(sample), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = c.checkpointed(rows.select("toxic", F.coalesce(F.pmod(F.xxhash64("text"), F.lit(2)), F.lit(0)).cast("int").alias("fold"), "text"))
    sizes = {(r["toxic"], r["fold"]): r["n"] for r in rows.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    n = [[sizes.get((t, f), 0) for f in (0, 1)] for t in (0, 1)]
    contexts = c.checkpointed(rows.mapInArrow(_contexts, "toxic int, fold int, word string, before string").distinct())
    counted = [F.count_if((F.col("toxic") == t) & (F.col("fold") == f)).alias(f"n{t}{f}") for t in (1, 0) for f in (0, 1)]
    words = contexts.groupBy("word").agg(*counted)
    names = ["n10", "n11", "n00", "n01"]
    starts = F.array(*(F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS))
    stems = words.where(F.length("word") > STEMS[0]).select(*names, F.explode(F.array_compact(starts)).alias("stem"))
    stems = stems.groupBy(F.col("stem").alias("word")).agg(*(F.sum(x).alias(x) for x in names), F.count_if(F.col("n10") + F.col("n11") > 0).alias("forms")).where("forms > 1")
    seen = F.col("n10") + F.col("n11")
    rate = (seen + 0.5) / (sum(n[1]) + 1) / ((F.col("n00") + F.col("n01") + 0.5) / (sum(n[0]) + 1))
    units = words.select("word", *names).union(stems.select("word", *names)).where(seen > 2).where(rate > math.exp(least_weight))
    found = _leaning(contexts, units).collect()

    def lexicon(folds: tuple[int, ...]) -> dict[str, float]:
        out = {r["word"]: _weight(*(sum(r[f"n{t}{f}"] for f in folds) for t in (1, 0)), *(sum(n[t][f] for f in folds) for t in (1, 0))) for r in found}
        return {w: x for w, x in out.items() if x >= least_weight}

    menaces = frozenset(r["word"] for r in found if r["menace"])
    halves = [lexicon((1,)), lexicon((0,))]  # for each fold, what the other one says

    def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammars = [Grammar(x, FIXED, menaces) for x in halves]
        for batch in batches:
            x = [grammars[f].features(t).tolist() for f, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])
        c.release()

    rated = rows.mapInArrow(feature_rows, "toxic int, x array<double>").collect()  # at most most_toxic + most_clean rows
    x, y = np.array([r["x"] for r in rated]).reshape(len(rated), len(FIXED) - 1), np.array([r["toxic"] for r in rated], float)
    order = np.lexsort((*x.T, y))  # sums of floats in one order, whatever the order of rows
    return Grammar(dict(sorted(lexicon((0, 1)).items())), _fit(x[order], y[order]), menaces)


def scored(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted."""
    lexicon, weights, menaces = grammar.lexicon, grammar.weights, grammar.menaces

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(lexicon, weights, menaces)
        for batch in batches:
            x = [own.features(t.as_py()) for t in batch.column(2)]
            s = own.score(np.array(x).reshape(len(x), -1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])
        c.release()

    rows = c.bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def clean_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs without those that the grammar rejects, all columns kept."""
    grammar = train(docs, labels, text_col=text_col)
    lexicon, weights, menaces, at = grammar.lexicon, grammar.weights, grammar.menaces, docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(lexicon, weights, menaces)
        for batch in batches:
            x = np.array([own.features(t.as_py()) for t in batch.column(at)]).reshape(batch.num_rows, -1)
            yield batch.filter(pa.array(own.score(x) < threshold))
        c.release()

    return c.bounded(docs).mapInArrow(keep, docs.schema)
