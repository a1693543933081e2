"""Operators on pairs, against brute force: Jaccard join, embedding near-dedup, components."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetloom.llm import embed_dedup, jaccard_join
from fleetloom.llm.components import connected_components


def brute_components(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def similar(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def corpus(seed, families=6, members=25):
    """Families of edited copies, chains among them, shared passages, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 150, 420, 900]))]
        current = base
        for k in range(members):
            words = list(base if k % 3 else current)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if k % 4 == 0:
                current = words
            if rng.random() < 0.2:
                words = words + passage
            texts.append(" ".join(words))
    texts += [" ".join(passage + [rng.choice(vocabulary) for _ in range(40)]) for _ in range(20)]
    texts += ["", None, "One", "one", "a b c", "A  b\tc", " \n", "x " * 300, "x " * 301, texts[0], texts[0].upper()]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_are_those_of_brute_force(spark, seed):
    texts = corpus(seed)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = brute_components(sets, [(a, b) for a in sets for b in range(a) if similar(sets[a], sets[b])])
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_jaccard_join_of_empty_and_null_rows(spark):
    schema = "doc_id long, text string"
    assert jaccard_join.jaccard_components(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, "x" * 200_000)], schema)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(0, 2, 3), (1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (4, 1, 4)]
    kept = sorted((r.doc_id or 0) for r in jaccard_join.drop_near_copies(docs).collect())
    assert kept == [0, 1, 2, 3, 4]


def test_one_of_each_group_stays_beside_clashing_columns(spark):
    text = "a b c d e f g h i j"
    rows = [(3, text, 1, 2, 3, 4, 5), (1, text, 6, 7, 8, 9, 10), (1, text, 6, 7, 8, 9, 11), (None, text, 0, 0, 0, 0, 0), (7, "other words stand here today", 1, 1, 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _rows int, _stays int, rows int, stays int, id int")
    out = jaccard_join.drop_near_copies(docs)
    assert out.columns == docs.columns and sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 7]


def test_hot_keys_change_no_result(spark, monkeypatch):
    texts = corpus(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    for least in (1, 4):  # all keys hot, many keys hot
        monkeypatch.setattr(jaccard_join, "HOT_LEAST", least)
        monkeypatch.setattr(jaccard_join, "HOT", 0.0)
        monkeypatch.setattr(jaccard_join, "HOT_HERE", 0.0)
        assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()} == want


def test_near_copies_without_an_id_link_as_leaders_and_as_members(spark):
    sig = lambda t: jaccard_join._signature(jaccard_join.Shingler().sets([t])[0])
    rows, want, leads = [], {}, set()
    for k in range(12):
        words = [f"f{k}w{i}" for i in range(100)]
        edit = lambda *at, words=words: " ".join("new" if i in at else w for i, w in enumerate(words))
        a, middle, b = edit(20, 40), edit(), edit(60, 80)  # a and b are linked by the middle only
        assert similar(shingles(a), shingles(middle)) and similar(shingles(middle), shingles(b)) and not similar(shingles(a), shingles(b))
        rows += [(2 * k + 1, a), (None, middle), (None, middle), (2 * k + 2, b)]
        want |= {2 * k + 1: 2 * k + 1, 2 * k + 2: 2 * k + 1}
        leads.add(sig(middle) < min(sig(a), sig(b)))
    assert leads == {True, False}
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert sorted(r.component_id for r in got if r.doc_id is None) == sorted(2 * [2 * k + 1 for k in range(12)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), unique=True).map(sorted), max_size=14), st.integers(1, 8))
def test_divide_skip_counts_like_a_scan(lists, least):
    counts = {}
    for x in lists:
        for i in x:
            counts[i] = counts.get(i, 0) + 1
    assert jaccard_join.divide_skip(lists, least) == {i: n for i, n in counts.items() if n >= least}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=2, max_size=9))
def test_searches_find_what_the_threshold_asks(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    want = [i for i, s in enumerate(sets[1:]) if similar(sets[0], s)]
    assert jaccard_join.linked(arrays[0], arrays[1:]) == want
    base = arrays[0]
    sides = [(len(a), len(set(sets[0]) - s), np.setxor1d(a, base)) for a, s in zip(arrays, sets, strict=True)]
    got = sorted(set(jaccard_join.linked_by_differences(sides, sides, len(base))))
    assert got == sorted((i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if similar(a, b))


def test_needed_holds_for_random_pairs():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 700))
        both = int(np.ceil(rng.uniform(0.857, 1) * n))
        pool = rng.choice(1 << 40, 2 * n - both, replace=False).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:both], pool[n:]]))
        if similar(set(a.tolist()), set(b.tolist())):
            common = len(np.intersect1d(a[: jaccard_join.shown(len(a))], b[: jaccard_join.shown(len(b))]))
            assert common >= max(jaccard_join.needed(len(a)), jaccard_join.needed(len(b)))


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(1, 200)] + [(500, 501), (7, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, 500: 500, 501: 500}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed, n=6_000, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, n, 10):  # groups of near copies around some rows
        size = int(rng.integers(1, 8))
        x[k + 1 : k + 1 + size] = x[k] + rng.normal(scale=0.12, size=(len(x[k + 1 : k + 1 + size]), dim))
    return x.astype(np.float32)


def test_embedding_links_against_brute_force(spark):
    x = vectors(5)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame([(i, v.tolist(), "c") for i, v in enumerate(x)], "vec_id long, embedding array<float>, component_id string")
    got = {r.vec_id: r for r in embed_dedup.embedding_components(df).collect()}
    counts = np.array([got[i].n_links for i in range(len(x))])
    assert (counts <= linked.sum(1)).all()  # none below the threshold
    assert counts.sum() >= 0.9 * linked.sum()  # recall with several cells
    want = brute_components(range(len(x)), zip(*map(np.ndarray.tolist, np.nonzero(linked)), strict=True))
    assert np.mean([got[i].component_id == want[i] for i in range(len(x))]) >= 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_one_cell_is_exact(spark):
    x = vectors(8, 700)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    for how in ({"cells": 1}, {"cells": 9, "probes": 9}):
        got = {r.vec_id: r.n_links for r in embed_dedup.embedding_components(df, **how).collect()}
        assert [got[i] for i in range(len(x))] == linked.sum(1).tolist()


def test_recall_beyond_the_sample():
    """Cells fitted on a sample that is smaller than the table, homes and probes as the operator deals them."""
    x = vectors(11, 30_000, 32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    k = embed_dedup.n_cells(len(u))
    assert len(u) > embed_dedup.MAX_SAMPLE and k > 80
    centroids = embed_dedup.spherical_kmeans(u[np.random.default_rng(1).choice(len(u), embed_dedup.MAX_SAMPLE, replace=False)], k)
    top = np.argsort(-(u @ centroids.T), axis=1)[:, : embed_dedup.n_probes(k)]
    met = links = 0
    for a in range(0, len(u), 2_000):
        i, j = np.nonzero(u[a : a + 2_000] @ u.T >= 0.95)
        i += a
        i, j = i[i < j], j[i < j]
        links += len(i)
        met += ((top[i] == top[j][:, :1]).any(1) | (top[j] == top[i][:, :1]).any(1)).sum()
    assert links > 5_000 and met >= 0.9 * links


def test_embeddings_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embed_dedup.embedding_components(df).collect())
    assert got == [(1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 3, 1), (10, 3, 1)]
    assert embed_dedup.embedding_components(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
