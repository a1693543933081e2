"""Soft-membership mixing, with DataFrame operations only.

A classifier taught by the labelled table (naive Bayes with normal features) gives each document a posterior over domains, the
combinations of label values. Document rates r, bounded from below, are fitted by distributed projected gradient descent on
|A r - b|², where A r are the expected tokens of each domain, the sum over documents of tokens x posterior x rate, and b
the targets. A step changes a rate by the inner product of the document's posterior with one vector of as many
numbers as there are domains, so the driver keeps one such vector for each step, and a rate is a fold over them:
there is no state for each document to lose. Steps are scaled by the domains' second moments over the documents that the bound does not
hold, which makes them converge in a few rounds.

Defined results: null text is the empty text, with no tokens; labels with a null among their values teach nothing; a doc_id with several
labels counts once, with the greatest; without labels there is one domain and all rates scale alike; repeated rows get a row each; an
empty table gives none; other columns of docs are kept by mix() and ignored elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialise

LABELS = ("quality",)
#: Shares of all tokens that the domains are to have.
TARGETS = {"quality0": 0.1, "quality1": 0.9}
#: Steps at most; the fit ends when every domain is within TOLERANCE of all tokens from its target.
STEPS, TOLERANCE = 40, 1e-5
# Marks whose share of the characters is a feature.
MARKS = (".", ",", "|", "#", "!", "%", "\n")


def _features(text: Column, words: Column) -> list[Column]:
    n, w = F.greatest(F.length(text), F.lit(1)), F.greatest(F.size(words), F.lit(1))
    return [
        F.log1p(F.length(text).cast("double")),
        F.size(F.array_distinct(words)) / w,
        F.log(n / w),
        F.octet_length(text) / n,
        *(F.sqrt((F.length(text) - F.length(F.replace(text, F.lit(m), F.lit("")))) / n) for m in MARKS),
    ]


N_FEATURES = 4 + len(MARKS)


def document_features(docs: DataFrame, *kept: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, tokens (words between blanks), x0.. and the kept columns: one row each."""
    split = docs.select("doc_id", *kept, F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("words", F.split("text", " "))
    tokens = F.when(F.length("text") == 0, 0).otherwise(F.size("words")).cast("long")
    return split.select("doc_id", *kept, tokens.alias("tokens"), *(x.cast("double").alias(f"x{i}") for i, x in enumerate(_features(F.col("text"), F.col("words")))))


def _domains(features: DataFrame, labels: DataFrame, names: Sequence[str]) -> tuple[list[str], list[float], list[list[float]], list[list[float]]]:
    """Names, log priors, means and variances of the domains."""
    known = labels.filter(" AND ".join(f"{c} IS NOT NULL" for c in ("doc_id", *names))).groupBy("doc_id").agg(*(F.max(c).alias(c) for c in names))
    domain = F.concat_ws("_", *(F.concat(F.lit(c), F.col(c).cast("string")) for c in names))
    taught = features.join(known.select("doc_id", domain.alias("domain")), "doc_id")
    moments = [f(f"x{i}").alias(f"{a}{i}") for i in range(N_FEATURES) for a, f in (("m", F.avg), ("v", F.var_pop))]
    rows = sorted(taught.groupBy("domain").agg(F.count("*").alias("n"), *moments).collect(), key=lambda r: r.domain)
    if not rows:
        return ["all"], [0.0], [], []
    total = sum(r.n for r in rows)
    pooled = [sum(r.n * r[f"v{i}"] for r in rows) / total for i in range(N_FEATURES)]
    # A variance never falls below a share of the pooled one, so that no single feature decides alone.
    variances = [[max(r[f"v{i}"], 0.05 * pooled[i], 1e-9) for i in range(N_FEATURES)] for r in rows]
    return [r.domain for r in rows], [math.log(r.n / total) for r in rows], [[r[f"m{i}"] for i in range(N_FEATURES)] for r in rows], variances


class DomainModel:
    """Posteriors over domains as columns of a frame that has x0.. ."""

    def __init__(self, features: DataFrame, labels: DataFrame, names: Sequence[str]):
        self.domains, self.priors, self.means, self.variances = _domains(features, labels, names)

    def __call__(self, features: DataFrame) -> DataFrame:
        """features with p0.. in place of x0.. ."""
        k, kept = len(self.domains), [c for c in features.columns if not (c[0] == "x" and c[1:].isdigit())]
        if not self.means:
            return features.select(*kept, F.lit(1.0).alias("p0"))
        logs = []
        for prior, m, v in zip(self.priors, self.means, self.variances, strict=True):
            terms = [-((F.col(f"x{i}") - m[i]) * (F.col(f"x{i}") - m[i])) / (2 * v[i]) for i in range(N_FEATURES)]
            logs.append(sum(terms, F.lit(prior - 0.5 * sum(map(math.log, v)))))
        scored = features.select(*kept, *(x.alias(f"l{i}") for i, x in enumerate(logs)))
        top = F.greatest(*(F.col(f"l{i}") for i in range(k))) if k > 1 else F.col("l0")
        scored = scored.select(*kept, *(F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in range(k)))
        total = sum((F.col(f"e{i}") for i in range(1, k)), F.col("e0"))
        return scored.select(*kept, *((F.col(f"e{i}") / total).alias(f"p{i}") for i in range(k)))


def _rate(steps: list[list[float]], k: int, least: float) -> Column:
    """The rate after these steps, from 1."""
    if not steps:
        return F.greatest(F.lit(1.0), F.lit(float(least)))
    vectors = F.array(*(F.array(*(F.lit(float(x)) for x in s)) for s in steps))
    move = lambda r, g: F.greatest(F.lit(float(least)), r - sum((g[i] * F.col(f"p{i}") for i in range(1, k)), g[0] * F.col("p0")))
    return F.aggregate(vectors, F.greatest(F.lit(1.0), F.lit(float(least))), move)


def fit_rates(table: DataFrame, shares: Sequence[float], least: float = 0.0) -> tuple[list[list[float]], np.ndarray, np.ndarray, float]:
    """Steps whose fold gives the rates; targets and reached tokens by domain; the largest miss as a share of all tokens.

    table(doc_id, tokens, p0..). The targets are these shares of as many tokens as there are, or for least > 0 of as many as leave no
    domain with less than least times its tokens.
    """
    k = len(shares)

    def sums(rate: Column, held: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of each domain, and second moments over the documents that the bound does not hold, or over all."""
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        free = F.when(F.col("_r") > least, F.col("tokens")).otherwise(F.lit(0)) if held else F.col("tokens")
        tokens = [F.sum(F.col("tokens") * F.col(f"p{i}") * F.col("_r")).alias(f"a{i}") for i in range(k)]
        moments = [F.sum(free * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"m{i}_{j}") for i, j in pairs]
        row = table.withColumn("_r", rate).agg(*tokens, *moments).first()
        m = np.zeros((k, k))
        for i, j in pairs:
            m[i, j] = m[j, i] = row[f"m{i}_{j}"] or 0.0
        return np.array([row[f"a{i}"] or 0.0 for i in range(k)]), m

    now, whole = sums(F.lit(1.0), held=False)
    total = now.sum()
    if not total:
        return [], np.zeros(k), now, 0.0
    share = np.asarray(shares, float) / (sum(shares) or 1.0)
    goal = share * total
    if least > 0:
        goal *= max([1.0, *(least * a / g for a, g in zip(now, goal, strict=True) if g > 0)])
    steps: list[list[float]] = []
    reached, free_moment = sums(_rate(steps, k, least))
    scale = 1.0
    for _ in range(STEPS):
        miss = np.abs(reached - goal).max() / total
        if miss <= TOLERANCE:
            break
        # Where the bound holds nearly all documents, those that a step would lift off it count too.
        moment = free_moment if np.trace(free_moment) > 1e-3 * np.trace(whole) else whole
        step = scale * np.linalg.solve(moment + 1e-9 * max(np.trace(whole), 1.0) * np.eye(k), reached - goal)
        after, next_moment = sums(_rate([*steps, step.tolist()], k, least))
        if np.linalg.norm(after - goal) < np.linalg.norm(reached - goal):
            steps.append(step.tolist())
            reached, free_moment, scale = after, next_moment, min(1.0, 2 * scale)
        else:
            scale /= 4
            if scale < 1e-3:
                break
    return steps, goal, reached, float(np.abs(reached - goal).max() / total)


def _copies(rate: Column) -> Column:
    """Whole copies whose expectation is the rate: the fraction is decided by a hash of the id."""
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def _fitted(docs: DataFrame, labels: DataFrame, names: Sequence[str], targets: dict[str, float], least: float):
    features = materialise(document_features(docs), "mixing-features")
    model = DomainModel(features, labels, names)
    table = model(features)
    steps, *_ = fit_rates(table, [targets.get(d, 0.0) for d in model.domains] if len(model.domains) > 1 else [1.0], least)
    return features, table, model, _rate(steps, len(model.domains), least)


def mixing_rates(docs: DataFrame, labels: DataFrame, names: Sequence[str] = LABELS, targets: dict[str, float] = TARGETS, least: float = 0.0) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_tokens, p_<domain>.., rate, copies. targets: shares of all tokens by domain name."""
    _, table, model, rate = _fitted(docs, labels, names, targets, least)
    return table.select("doc_id", F.col("tokens").alias("n_tokens"), *(F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(model.domains)), rate.alias("rate"), _copies(rate).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, names: Sequence[str] = LABELS, targets: dict[str, float] = TARGETS, least: float = 1.0) -> DataFrame:
    """docs with each row repeated as often as its rate asks; with least >= 1 no row is lost. All columns stay."""
    features, _, model, rate = _fitted(docs, labels, names, targets, least)
    drop_table(features)
    # The rates are computed again beside the text, so that no text moves; docs' own columns travel in one whose name none of the others has.
    beside = document_features(docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")), "whole")
    return model(beside).select("whole", F.explode(F.array_repeat(F.lit(0), _copies(rate))).alias("copy")).select("whole.*")
