"""Toxicity and mixing: held-out accuracy, swaps of identity terms, targets that are met; the pipeline against its stages."""

import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from fleetloom.llm import mixing, toxicity
from fleetloom.llm.common import materialise, read_table
from fleetloom.llm.jaccard_join import jaccard_components
from fleetloom.llm.secret_scan import find_secrets

SF = "/root/testdata/sf0.001"
SAY = ["weather", "market", "garden", "music", "bread", "river", "window", "paper", "street", "summer", "train", "letter"]
BAD = ["vilewort", "grumscum", "dolthead"]


def sentences(rng, n, extra=()):
    words = [rng.choice(SAY) for _ in range(n)]
    for w in extra:
        words.insert(rng.randrange(len(words)), w)
    return " ".join(words) + "."


def toxic_corpus(n=1500, seed=4):
    """Toxic texts often name a group; clean ones seldom do."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        extra = [rng.choice(BAD) + rng.choice(["", "s", "ish"])] * toxic + ["muslims"] * (rng.random() < (0.6 if toxic else 0.02))
        docs.append((i, sentences(rng, rng.randint(5, 60), extra)))
        labels.append((i, 1, toxic))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_folds(spark):
    docs, labels = toxic_corpus()
    got = toxicity.score_toxicity(*frames(spark, docs, labels)).collect()
    truth = {i: t for i, _, t in labels}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.98


def test_the_fit_against_plain_loops():
    rng = random.Random(8)
    rows = [(int(rng.random() < 0.4), sorted(rng.sample(range(6), rng.randint(0, 4)))) for _ in range(40)]
    pairs = [([0], [1], 3), ([2, 3], [4], 1), ([5], [], 2)]
    l2, swap, steps = 1e-3, 0.7, 60
    w, b = toxicity._fit(rows, 6, pairs, l2, swap, steps)

    def gradient(x):
        """Of mean log loss + l2 |w|² + swap · weighted mean of squared score changes, term by term."""
        g = [2 * l2 * v for v in x[:6]] + [0.0]
        for toxic, own in rows:
            err = (1 / (1 + math.exp(-(x[6] + sum(x[i] for i in own)))) - toxic) / len(rows)
            for i in [*own, 6]:
                g[i] += err
        for gone, come, n in pairs:
            change = (sum(x[i] for i in gone) - sum(x[i] for i in come)) * n / 6
            for i in gone:
                g[i] += 2 * swap * change
            for i in come:
                g[i] -= 2 * swap * change
        return g

    share = sum(t for t, _ in rows) / len(rows)
    x, m, v = [0.0] * 6 + [math.log(share / (1 - share))], [0.0] * 7, [0.0] * 7
    for t in range(1, steps + 1):
        for i, g in enumerate(gradient(x)):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
        x = [x[i] - 0.1 * (m[i] / (1 - 0.9**t)) / (math.sqrt(v[i] / (1 - 0.999**t)) + 1e-8) for i in range(7)]
    assert [*w, b] == pytest.approx(x)


def test_rare_domains_stay_domains(spark):
    docs = spark.createDataFrame([(i, "good words, well said. " * (5 + i % 7) if i % 10 else "bad|bad!#") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(60)], "doc_id long, quality int")
    got = mixing.mixing_rates(docs, labels)
    assert {"p_quality0", "p_quality1"} <= set(got.columns) and got.filter("p_quality0 > 0.5").count() == 6


def test_swaps_take_the_weight_off_a_groups_name(spark):
    d, l = frames(spark, *toxic_corpus())
    plain, fair = (toxicity.fit_toxicity(d, l, swap=s).scorer() for s in (0.0, 30.0))
    neutral = "the muslims and the garden and the river in summer."
    other = neutral.replace("muslims", "christians")
    assert abs(fair(neutral) - fair(other)) < 0.5 * abs(plain(neutral) - plain(other)) + 1e-9
    assert fair(neutral) < 0.5 and fair("the dolthead and the garden in summer.") > 0.5


def test_odd_rows_and_labels(spark):
    docs, labels = toxic_corpus(400)
    d, l = frames(spark, [*docs, (None, "x"), (9000, None), (9001, ""), (3, "again"), (9002, "dolthead " * 60_000)], [*labels, (3, None, None), (None, 1, 1), (4, 0, 1)])
    got = toxicity.score_toxicity(d, l).collect()
    assert len(got) == 405 and sum(r.doc_id is None for r in got) == 1 and not next(r for r in got if r.doc_id is None).held_out
    by_id = {r.doc_id: r for r in got}
    assert by_id[9000].score == by_id[9001].score and by_id[9002].predicted == 1
    assert all(r.score == 0 for r in toxicity.score_toxicity(d, l.limit(0)).collect())
    assert toxicity.score_toxicity(d.limit(0), l).count() == 0
    extra = d.withColumn("score", d.doc_id).withColumn("_toxicity_score", d.doc_id)
    assert toxicity.drop_toxic(extra, l).columns == extra.columns


def test_the_sample_is_bounded(spark):
    d, l = frames(spark, *toxic_corpus(1200))
    assert 150 < toxicity.fit_toxicity(d, l, max_rows=250).rows < 350


def mixed_corpus(n=900, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        low = rng.random() < 0.3
        words = [rng.choice(SAY) for _ in range(rng.randint(5, 120))]
        docs.append((i, " ".join(f"{w}###" if low else w for w in words)))
        if i % 2:
            labels.append((i, int(not low), 0))
    return docs, labels


def brute_posteriors(texts, labels):
    """The same classifier in plain numpy."""

    def row(t):
        w, n = t.split(" "), max(len(t), 1)
        return [math.log1p(len(t)), len(set(w)) / len(w), math.log(n / len(w)), len(t.encode()) / n, *(math.sqrt(t.count(m) / n) for m in mixing.MARKS)]

    x = {i: row(t) for i, t in texts}
    by = {}
    for i, q, _ in labels:
        by.setdefault(q, []).append(x[i])
    total = sum(map(len, by.values()))
    pooled = sum(len(v) * np.var(v, axis=0) for v in by.values()) / total
    model = [(math.log(len(by[q]) / total), np.mean(by[q], axis=0), np.maximum.reduce([np.var(by[q], axis=0), 0.05 * pooled, np.full(len(pooled), 1e-9)])) for q in sorted(by)]
    out = {}
    for i, v in x.items():
        logs = np.array([p - 0.5 * np.log(s).sum() - ((np.array(v) - m) ** 2 / (2 * s)).sum() for p, m, s in model])
        e = np.exp(logs - logs.max())
        out[i] = e / e.sum()
    return out


def test_mixing_against_brute_force(spark):
    docs, labels = mixed_corpus()
    want = brute_posteriors(docs, labels)
    goal = {"quality0": 0.15, "quality1": 0.85}
    got = mixing.mixing_rates(*frames(spark, docs, labels), targets=goal).collect()
    assert len(got) == len(docs)
    tokens = {i: len(t.split(" ")) for i, t in docs}
    for r in got:
        assert r.n_tokens == tokens[r.doc_id] and np.allclose([r.p_quality0, r.p_quality1], want[r.doc_id], atol=1e-6)
        assert r.rate >= 0 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
    total = sum(tokens.values())
    for d, share in goal.items():
        assert sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in got) / total == pytest.approx(share, abs=1e-4)
    spread = sum(r.copies * r.n_tokens * r.p_quality1 for r in got) / total
    assert spread == pytest.approx(0.85, abs=0.05)


def test_mixing_keeps_every_row_where_asked(spark):
    docs, labels = mixed_corpus(400)
    d, l = frames(spark, [*docs, (None, None), (5, "")], labels)
    extra = d.withColumn("tokens", d.doc_id).withColumn("x0", d.doc_id).withColumn("copies", d.doc_id)
    out = mixing.mix(extra, l, targets={"quality0": 0.1, "quality1": 0.9})
    assert out.columns == extra.columns
    rows = out.collect()
    assert {(r.doc_id, r.text) for r in rows} == {(r.doc_id, r.text) for r in d.collect()} and len(rows) > 402


def test_mixing_without_labels_or_rows(spark):
    d, l = frames(spark, *mixed_corpus(50))
    assert {round(r.rate, 9) for r in mixing.mixing_rates(d, l.limit(0)).collect()} == {1.0}
    assert mixing.mixing_rates(d.limit(0), l).count() == 0


def test_mixing_runs_no_python_on_executors(spark):
    d, l = frames(spark, *mixed_corpus(50))
    plan = mixing.mixing_rates(d, l)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_pipeline_mixes_to_the_targets_of_op10(spark, monkeypatch):
    docs, labels = frames(spark, *mixed_corpus(400))
    monkeypatch.setattr(corpus_pipeline, "read_table", lambda *_: labels)
    copies = lambda d: dict(d.groupBy("doc_id").count().collect())
    got = copies(corpus_pipeline.mixing(spark, docs, SF))
    assert got == copies(mixing.mix(docs, labels, targets={"quality0": 0.1, "quality1": 0.9})) and sum(got.values()) > 400


def test_pipeline_stages_take_effect(spark):
    docs = read_table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        source = docs
        docs = materialise(stage(spark, docs, SF), f"test-{name}")
        kept[name] = (source, docs)
        if name != "tokens":
            assert docs.columns == columns
    source, clean = kept["toxicity"]
    scores = {r.doc_id: r.predicted for r in toxicity.score_toxicity(source, read_table(spark, SF, "labels")).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, p in scores.items() if not p} and clean.count() < before
    source, single = kept["near_copies"]
    groups = {r.component_id for r in jaccard_components(source).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups)
    source, redacted = kept["secrets"]
    assert redacted.count() == source.count() and not any(s for r in redacted.collect() for s in find_secrets(r.text) if s[0] in ("access", "hex"))
    source, mixed = kept["mixing"]
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in source.collect()}
    assert kept["tokens"][1].count() == mixed.count()
    assert corpus_pipeline.run(spark, SF).count() == mixed.count()
