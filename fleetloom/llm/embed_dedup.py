"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells, one representative for each group.

Centroids are fitted on a bounded hashed sample (MAX_SAMPLE vectors); every vector is then indexed in the cell of its nearest centroid
and asked for in its nearest cells (probes). Vectors with equal components form one class first. Large cells are cut into blocks of members
and of queries, so no task holds a whole cell; a block's product is one matrix multiplication in double precision. A block returns how many vectors
each of its vectors is linked to, not the pairs, and a forest of links with as many edges as vertices at most.

A pair is counted once: a query counts all that it meets; a member also counts a query that it wouldn't meet itself.
The number of cells follows the same rule at every size, half the square root of the number of classes, and the probes grow with the square root of the
cells. A pair is missed when neither vector's home is among the other's probes; with cells=1, or as many probes as cells, the result is exact.
The sample bounds the cells at MAX_SAMPLE / ROWS_A_CELL; beyond that (25 million classes) raise max_sample, or cells hold ever more vectors.

Defined results: vectors that are null or empty, have null or non-finite components or no length link with nothing and are their own component;
vectors of different lengths never link; rows of a repeated id give a row each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_table, materialise, ship, shuffle_partitions
from .components import connected_components

THRESHOLD = 0.95
#: Vectors that the centroids are fitted on at most (the expected number of a hashed sample), rounds, rows of the sample for each cell.
MAX_SAMPLE, ROUNDS, ROWS_A_CELL = 20_000, 10, 8
#: Cells that a vector is asked for in at least.
LEAST_PROBES = 4
#: Cells whose sizes may be broadcast.
MAX_BROADCAST = 100_000
#: Members and queries of a block.
MEMBERS, QUERIES = 1_024, 2_048


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, float) for v in vectors], float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """k unit centroids of unit rows: each is the normalised mean of the rows nearest to it."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[a : a + 4096] @ c.T).argmax(1) for a in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1)
        gone = size < 1e-12
        c = np.where(gone[:, None], x[rng.choice(len(x), k)], sums / np.where(gone, 1, size)[:, None])
    return c


def n_cells(n: int, max_sample: int = MAX_SAMPLE) -> int:
    """How many cells n classes have."""
    return max(1, min(math.ceil(math.sqrt(n) / 2), max_sample // ROWS_A_CELL, n))


def n_probes(k: int) -> int:
    """In how many of k cells a vector is asked for."""
    return min(k, max(LEAST_PROBES, math.ceil(math.sqrt(k) / 2)))


def fit_cells(classes: DataFrame, max_sample: int = MAX_SAMPLE, cells: int | None = None) -> dict[int, np.ndarray]:
    """Centroids for each length of vectors among classes(sig, vector)."""
    out = {}
    # As many rows as there are lengths of vectors.
    for dim, n in ((r.dim, r.n) for r in classes.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).collect()):
        k = min(cells, n) if cells else n_cells(n, max_sample)
        if k == 1:
            out[dim] = np.zeros((1, dim))
            continue
        own = classes.filter(F.size("vector") == dim)
        if n > max_sample:
            own = own.filter(F.pmod(F.xxhash64("sig", F.lit(5)), F.lit(1 << 30)) < int(max_sample / n * (1 << 30)))
        rows = sorted(own.select("sig", "vector").collect())
        out[dim] = spherical_kmeans(_unit(r.vector for r in rows), min(k, len(rows)))
    return out


def _assign(classes: DataFrame, cells: dict[int, np.ndarray], probes: int | None) -> DataFrame:
    """classes with home and probes: numbers of cells, apart for each length of vectors."""
    first, at = {}, 0
    for dim in sorted(cells):
        first[dim], at = at, at + len(cells[dim])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, own in f.groupby(f["vector"].map(len)):
                near = _unit(own["vector"]) @ cells[dim].T
                top = np.argsort(-near, axis=1, kind="stable")[:, : probes or n_probes(len(cells[dim]))] + first[dim]
                yield own.assign(home=top[:, 0], probes=list(top))[["sig", "vector", "n", "home", "probes"]]

    kind = dict(classes.dtypes)["vector"]
    return classes.select("sig", "vector", "n").mapInPandas(run, f"sig long, vector {kind}, n long, home int, probes array<int>")


def _labels(q: np.ndarray, m: np.ndarray, q_ids: np.ndarray, m_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id reachable through links q[i] - m[i], for queries and members."""
    lq, lm = q_ids.copy(), m_ids.copy()
    while True:
        nq, nm = lq.copy(), lm.copy()
        np.minimum.at(nq, q, lm[m])
        np.minimum.at(nm, m, nq[q])
        if np.array_equal(nq, lq) and np.array_equal(nm, lm):
            return lq, lm
        lq, lm = nq, nm


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """rows of blocks -> (sig, other, add): other is null where add is a count, else a link to other."""

    def block(f: list[tuple]) -> pd.DataFrame | None:
        q, m = [r for r in f if r[0]], [r for r in f if not r[0]]
        if not q or not m:
            return None
        q_ids, m_ids = np.array([r[1] for r in q]), np.array([r[1] for r in m])
        qi, mi = np.nonzero(_unit(r[2] for r in q) @ _unit(r[2] for r in m).T >= threshold)
        other = q_ids[qi] != m_ids[mi]
        qi, mi = qi[other], mi[other]
        if not len(qi):
            return None
        q_n, m_n = np.array([r[3] for r in q]), np.array([r[3] for r in m])
        counts_q = np.bincount(qi, m_n[mi], len(q)).astype(np.int64)
        m_probes, q_home = np.array([r[5] for r in m]), np.array([r[4] for r in q])
        unseen = (m_probes[mi] != q_home[qi][:, None]).all(1)
        counts_m = np.bincount(mi[unseen], q_n[qi[unseen]], len(m)).astype(np.int64)
        lq, lm = _labels(qi, mi, q_ids, m_ids)
        ids, to = np.concatenate([q_ids, m_ids]), np.concatenate([lq, lm])
        hooked, counted = ids != to, np.concatenate([counts_q, counts_m]) > 0
        n = np.concatenate([counts_q, counts_m])
        return pd.DataFrame(
            {
                "sig": np.concatenate([ids[counted], ids[hooked]]),
                "other": pd.array([None] * int(counted.sum()) + to[hooked].tolist(), "Int64"),
                "add": np.concatenate([n[counted], np.zeros(int(hooked.sum()), np.int64)]),
            }
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []
        for f in frames:
            for r in zip(*(f[c] for c in ("cell", "mb", "qb", "is_query", "sig", "vector", "n", "home", "probes")), strict=True):
                if r[:3] != key:
                    if held and (out := block(held)) is not None:
                        yield out
                    key, held = r[:3], []
                held.append(r[3:])
        if held and (out := block(held)) is not None:
            yield out

    n = shuffle_partitions(rows.sparkSession)
    return rows.repartition(n, "cell", "mb", "qb").sortWithinPartitions("cell", "mb", "qb").mapInPandas(run, "sig long, other long, add long")


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, cells: int | None = None, probes: int | None = None, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vectors(vec_id, embedding) -> vec_id, n_links, component_id, kept. cells, probes: instead of those that follow from the number of classes."""
    spark: SparkSession = vectors.sparkSession
    ship(spark)
    v = F.col(column)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    # Adding 0 makes -0 and 0 one value.
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.when(good, F.transform(v, lambda x: x + F.lit(0).cast("float"))).alias("vector"))
    rows = rows.withColumn("sig", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    ids = rows.select("vec_id", "sig")
    classes = rows.filter("sig IS NOT NULL").groupBy("sig").agg(F.first("vector").alias("vector"), F.count("*").alias("n"))
    classes = materialise(classes, "vector-classes")
    fitted = fit_cells(classes, cells=cells)
    placed = materialise(_assign(classes, fitted, probes), "placed")
    asked = placed.select("sig", "vector", "n", "home", "probes", F.explode("probes").alias("cell"))
    # One row of three numbers for each cell that has vectors. Their number is known here, so a broadcast is asked for only where it is small.
    sizes = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("n_mb"))
    queries = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("n_qb"))
    blocks = sizes.join(queries, "cell")
    blocks = F.broadcast(blocks) if sum(map(len, fitted.values())) <= MAX_BROADCAST else blocks
    mine, theirs = F.pmod(F.xxhash64("sig", F.lit(1)), F.col("n_mb")).cast("int"), F.pmod(F.xxhash64("sig", F.lit(2)), F.col("n_qb")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    common = ("sig", "vector", "n", "home", "probes")
    members = placed.withColumn("cell", F.col("home")).join(blocks, "cell").select("cell", mine.alias("mb"), every("n_qb").alias("qb"), F.lit(False).alias("is_query"), *common)
    queries = asked.join(blocks, "cell").select("cell", every("n_mb").alias("mb"), theirs.alias("qb"), F.lit(True).alias("is_query"), *common)
    met = materialise(_compare(members.union(queries), threshold), "met")
    drop_table(placed)
    counts = met.filter("other IS NULL").groupBy("sig").agg(F.sum("add").alias("links"))
    components = connected_components(met.filter("other IS NOT NULL").select(F.col("sig").alias("a"), F.col("other").alias("b")))
    named = ids.join(components.withColumnRenamed("id", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    own = classes.select("sig", F.col("n").alias("copies")).join(counts, "sig", "left")
    first = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("first_id"))
    out = named.join(own, "sig", "left").join(first, "component", "left")
    out = out.select("vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), F.coalesce("first_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
