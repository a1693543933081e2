"""Toxicity by a counterfactually regularised classifier.

Features are the distinct words of a text and their beginnings of 3 to 6 letters; those that tell toxic from other labelled
texts beyond chance (log-likelihood ratio) enter a logistic regression on presence. In labelled sentences that mention a group of
people the group's name is swapped for its siblings' names, and the squared change of the score is penalised, so that a
group's name by itself neither accuses nor clears a text. The labels' columns, languages, sources and ids are never inputs of a score.

The model is fitted on a bounded sample of labelled rows (MAX_ROWS, by a hash of the id; all of them where there are fewer), the counts
on the executors and the regression on the driver over that bounded sample's selected features. Every text is scored whole.

Defined results: null or empty text has no features and gets the score of the intercept; a doc_id with several labels counts as toxic if one
says so; null labels teach nothing; repeated rows give a row each; without any labels every score is 0; a null doc_id isn't held out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, ship

#: Labelled rows that the model is fitted on at most (the expected number of a hashed sample).
MAX_ROWS = 16_000
#: Features in the model at most, rows that a feature is in at least, log-likelihood ratio at least.
MAX_FEATURES, MIN_ROWS, MIN_RATIO = 4_000, 4, 24.0
FOLDS = 5
#: Words that a scoring worker remembers at most.
MAX_WORDS = 120_000

# Names of groups of people; each is swapped for the others of its line.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("deaf", "blind", "disabled"),
    ("old", "young", "elderly"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)

_WORD = re.compile(r"[^\W\d_]{2,}")
_SENTENCE = re.compile(r"[.!?\n]+")


def word_features(word: str) -> tuple[str, ...]:
    return (word, *(f"{word[:n]}*" for n in range(3, min(6, len(word)) + 1)))


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


@dataclass
class ToxicityModel:
    bias: float = -1e9
    weights: dict[str, float] = field(default_factory=dict)
    rows: int = 0

    def scorer(self):
        """A function from a text to its score."""
        known: dict[str, tuple[str, ...]] = {}
        weights, bias = self.weights, self.bias

        def score(text: str) -> float:
            if len(known) > MAX_WORDS:
                known.clear()
            hits: set[str] = set()
            for w in words_of(text):
                if (own := known.get(w)) is None:
                    own = known[w] = tuple(f for f in word_features(w) if f in weights)
                if own:
                    hits.update(own)
            z = bias + sum(weights[f] for f in sorted(hits))
            return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

        return score


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def _pairs(text: str, swaps: dict[str, tuple[str, ...]]) -> Iterator[tuple[tuple[str, ...], tuple[str, ...]]]:
    """For each swap in a sentence the features that go and those that come."""
    low = text.lower()
    if not any(t in low for t in swaps):
        return
    for sentence in _SENTENCE.split(low):
        words = set(_WORD.findall(sentence))
        for term in words & swaps.keys():
            mine = features_of(words)
            for other in swaps[term]:
                theirs = features_of((words - {term}) | {other})
                yield tuple(sorted(mine - theirs)), tuple(sorted(theirs - mine))


def _fit(rows: list[tuple[int, list[int]]], n_features: int, pairs: list[tuple[list[int], list[int], int]], l2: float, swap: float, steps: int = 400):
    """Logistic regression on presence, by Adam: mean log loss + l2 |w|² + swap · mean squared score change."""
    y = np.array([t for t, _ in rows], float)
    col = np.fromiter((f for _, x in rows for f in x), np.int64)
    row = np.repeat(np.arange(len(rows)), [len(x) for _, x in rows])
    pcol = np.fromiter((f for a, b, _ in pairs for f in (*a, *b)), np.int64)
    psign = np.fromiter((s for a, b, _ in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))), float)
    prow = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b, _ in pairs])
    pcount = np.array([c for _, _, c in pairs], float)
    pcount /= max(pcount.sum(), 1)
    w, base = np.zeros(n_features), min(max(y.mean(), 1e-3), 1 - 1e-3)
    b = math.log(base / (1 - base))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, w[col], len(y))
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        grad = np.bincount(col, err[row], n_features) + 2 * l2 * w
        if len(pairs):
            change = np.bincount(prow, w[pcol] * psign, len(pairs)) * pcount
            grad += 2 * swap * np.bincount(pcol, change[prow] * psign, n_features)
        g = np.append(grad, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, l2: float = 1e-4, swap: float = 1.0, identity=IDENTITY_TERMS, hold_out: bool = True) -> ToxicityModel:
    """Fit on the labelled rows of docs(doc_id, text); rows of the held-out fold teach nothing."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    if hold_out:
        known = known.filter(~held_out())
    n = known.count()
    if not n:
        return ToxicityModel()
    if n > max_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    # The sample is bounded by max_rows, so it fits each executor.
    taught = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(known), "doc_id").select("toxic", "text")
    swaps = {t: tuple(o for o in line if o != t) for line in identity for t in line}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        seen = (Counter(), Counter())
        for f in frames:
            for toxic, text in zip(f["toxic"].tolist(), f["text"].tolist(), strict=True):
                seen[toxic].update(features_of(words_of(text)))
                seen[toxic][""] += 1  # the rows
        names = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pd.DataFrame({"feature": part, "n0": [seen[0][x] for x in part], "n1": [seen[1][x] for x in part]})

    counts = taught.mapInPandas(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = counts.filter((F.col("n0") + F.col("n1") >= MIN_ROWS) | (F.col("feature") == ""))
    rows = counts.filter("feature = ''").collect()
    all0, all1 = (sum(r.n0 for r in rows), sum(r.n1 for r in rows))
    if not all0 or not all1:
        share = all1 / max(all0 + all1, 1)
        return ToxicityModel(bias=30.0 if share == 1 else -30.0, rows=all0 + all1)
    p = (F.col("n0") + F.col("n1")) / F.lit(float(all0 + all1))

    def part(k: Column, n: float) -> Column:
        return F.when(k > 0, k * F.log(k / (p * n))).otherwise(0.0) + F.when(k < n, (F.lit(float(n)) - k) * F.log((F.lit(float(n)) - k) / ((1 - p) * n))).otherwise(0.0)

    strength = F.when(p < 1, 2 * (part(F.col("n0"), all0) + part(F.col("n1"), all1))).otherwise(0.0)
    best = counts.filter("feature <> ''").withColumn("strength", strength).filter(F.col("strength") >= MIN_RATIO)
    chosen = [r.feature for r in best.orderBy(F.desc("strength"), "feature").limit(MAX_FEATURES).select("feature").collect()]
    chosen += sorted({f for t in swaps for f in word_features(t)} - set(chosen))
    number = {f: k for k, f in enumerate(chosen)}

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: Counter = Counter()
        for f in frames:
            own = [sorted(number[x] for x in features_of(words_of(t)) if x in number) for t in f["text"]]
            yield pd.DataFrame({"kind": 0, "toxic": f["toxic"], "a": own, "b": [[]] * len(f), "n": 1})
            for t in f["text"]:
                for gone, come in _pairs(t, swaps):
                    met[tuple(number[x] for x in gone if x in number), tuple(number[x] for x in come if x in number)] += 1
        if met:
            yield pd.DataFrame({"kind": 1, "toxic": 0, "a": [list(a) for a, _ in met], "b": [list(b) for _, b in met], "n": list(met.values())})

    encoded = taught.mapInPandas(encode, "kind int, toxic int, a array<int>, b array<int>, n long").collect()
    x = sorted((r.toxic, list(r.a)) for r in encoded if r.kind == 0)
    pairs = Counter()
    for r in encoded:
        if r.kind == 1:
            pairs[tuple(r.a), tuple(r.b)] += r.n
    w, b = _fit(x, len(chosen), [(list(k[0]), list(k[1]), c) for k, c in sorted(pairs.items())], l2, swap)
    return ToxicityModel(float(b), {f: float(v) for f, v in zip(chosen, w, strict=True) if abs(v) > 1e-6}, len(x))


def with_score(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """docs with the score of each whole text; all rows and columns stay."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        score = model.scorer()
        for b in batches:
            yield b.map(score).astype("float64")

    return docs.withColumn(column, scored(F.coalesce(F.col("text"), F.lit(""))))


def score_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, score, predicted."""
    model = fit_toxicity(docs, labels, max_rows)
    out = with_score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents that aren't predicted toxic, with their columns."""
    model = fit_toxicity(docs, labels, max_rows)
    mark = "_toxicity_score"
    while mark in docs.columns:
        mark += "_"
    return with_score(docs, model, mark).filter(F.col(mark) < 0.5).drop(mark)
