"""Whitening and clustering against plain versions."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening, zone_clusters
from tidemark.llm.registry import ship

EXTRA = ["id", "x", "key", "cluster", "low", "row", "place", "component", "n"]


@pytest.fixture(scope="module")
def vectors(spark):
    """Three far groups and odd rows: hot, repeated, null, short, empty and non-finite vectors, a null id."""
    ship(spark)
    random = np.random.default_rng(3)
    data = [(i, (random.normal(size=4) + 9 * (i % 3)).astype(np.float32).tolist()) for i in range(300)]
    data += [(1000 + i, [1.5, -2.25, 0.0, 7.0]) for i in range(200)]  # a hot vector
    data += [(5, data[5][1]), (5, data[6][1]), (None, [0.1, 0.2, 0.3, 0.4]), (7, None), (8, []), (9, [1.0, 2.0]),
             (10, [1.0, None, 2.0, 3.0]), (11, [math.nan, 0.0, 0.0, 0.0]), (12, [math.inf, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
    return df.withColumns({c: F.lit(c) for c in EXTRA}).repartition(5).cache()


def kept(df, size=4):
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    return [(i, [math.floor(64 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]


def plain_clusters(rows, k, rounds):
    name = lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [x for _, x in sorted(rows, key=lambda r: (name(r), r[1]))[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, x in rows:
            groups.setdefault(nearest(x)[1], []).append(x)
        centroids = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else centroids[i] for i in range(len(centroids))]
    return sorted((str(i), nearest(x)[1], nearest(x)[0]) for i, x in rows), centroids


@pytest.mark.parametrize("k", [1, 5, 16, 700])
def test_clusters_against_plain(vectors, k):
    want, centroids = plain_clusters(kept(vectors), k, 3)
    got = zone_clusters.cluster(vectors, k, 3, 4).collect()
    assert sorted((str(r.id), r.cluster, r.distance) for r in got) == want
    assert all(r.centroid == centroids[r.cluster] for r in got)
    assert {r.inertia for r in got} == {sum(d for *_, d in want)}
    for c in {r.cluster for r in got}:
        assert {r.cluster_inertia for r in got if r.cluster == c} == {sum(d for _, i, d in want if i == c)}


def test_boxes_leave_out_far_centroids(spark, vectors):
    got = zone_clusters.cluster(vectors.where("vec_id < 300"), 3, 3, 4)
    assert got.where("candidates < 3").count() > 150  # three groups far apart; blocks where the curve changes group need more


@pytest.mark.parametrize("scale", [2.0 ** 20, 2.0 ** 22])
def test_clusters_of_large_components(spark, scale):
    random = np.random.default_rng(4)
    data = [(i, [float(v) for v in random.normal(size=3) * scale]) for i in range(60)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    want, _ = plain_clusters(kept(df, 3), 4, 2)
    got = zone_clusters.cluster(df, 4, 2, 3).collect()
    assert sorted((str(r.id), r.cluster, r.distance) for r in got) == want


def test_no_vectors(vectors):
    none = vectors.where("false")
    assert zone_clusters.cluster(none).count() == whitening.whiten(none).count() == 0
    assert zone_clusters.cluster(vectors.where("vec_id = 7")).columns == zone_clusters.cluster(vectors, 2, 1, 4).columns


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 2), (5, 2), (2, 1)])
def test_curve_goes_through_every_cell_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = [k.tobytes() for k in zone_clusters.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def spectrum(d, values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    full = np.zeros(d)
    full[:len(values)] = values
    return (q * full) @ q.T


@pytest.mark.parametrize("d,values", [
    (150, np.linspace(2, 1, 150)), (200, np.r_[50, 49.9999, 3, np.linspace(1, 0.99, 150)]), (40, np.r_[5, 5, 5, 1, 0.5]),
    (16, np.linspace(3, 1, 16)), (5, [2.0, 1.0]), (1, [4.0]), (12, [])])
def test_leading_components(d, values):
    a = spectrum(d, values)
    k = min(16, d)
    e, v = whitening.leading(lambda x: a @ x, d, k)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:k]
    top = max(want[0], 1e-300)
    assert np.abs(e - want).max() <= 1e-12 * top
    assert np.abs(a @ v - v * e).max() <= 1e-12 * top
    assert np.abs(v.T @ v - np.eye(k)).max() < 1e-12


def test_a_direction_hidden_from_the_start_is_found():
    d = 60
    start = whitening._orthonormal(np.random.default_rng(5).normal(size=(d, 20)))
    hidden = np.random.default_rng(9).normal(size=d)
    hidden -= start @ (start.T @ hidden)
    hidden /= np.linalg.norm(hidden)
    a = start @ np.diag(np.linspace(2, 1, 20)) @ start.T + 9 * np.outer(hidden, hidden)
    e, _ = whitening.leading(lambda x: a @ x, d, 16)
    assert abs(e[0] - 9) < 1e-10


def test_inner_solver():
    a = spectrum(30, np.linspace(5, 1, 30))
    b = np.random.default_rng(1).normal(size=(30, 4))
    shift = np.array([0.0, 0.5, 2.03, 6.0])
    x = whitening.minres(lambda v: a @ v, shift, lambda v: v, b, 60, 1e-13)
    assert np.abs(a @ x - x * shift - b).max() < 1e-6


def plain_whitened(rows, k):
    x = np.array([v for _, v in rows], np.int64)
    unique = np.unique(x, axis=0)
    n, mean = len(unique), unique.mean(0)
    e, v = np.linalg.eigh((unique - mean).T @ (unique - mean) / n)
    e, v = e[::-1], v[:, ::-1]
    sums = (unique + whitening.OFFSET).sum(0)
    deviation = ((n * (x + whitening.OFFSET) - sums).astype(object) ** 2).sum(1)
    return n, (x - mean) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum(), deviation


@pytest.mark.parametrize("k", [2, 16])
def test_whitening_against_plain(vectors, k):
    rows = sorted(kept(vectors), key=str)
    n, y, share, deviation = plain_whitened(rows, min(k, 4))
    got = whitening.whiten(vectors, k).collect()
    assert len(got) == len(rows) * min(k, 4)
    assert {r.n for r in got} == {n} and all(r.identity_error < 1e-12 for r in got)
    by = {}
    for r in got:
        by.setdefault((str(r.id), r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    signs = {}
    for (i, _), expected, d in zip(rows, y, deviation):
        for c, value in enumerate(expected, 1):
            found = by[str(i), d][c]
            signs.setdefault(c, set()).update({round(float(np.sign(f * value))) for f in found if abs(value) > 1e-6})
            assert any(abs(abs(f) - abs(value)) < 1e-9 for f in found)
    assert all(len(s) == 1 for s in signs.values())
    assert all(abs(r.explained - share[r.component - 1]) < 1e-12 for r in got)


def test_whitening_without_variance(spark, vectors):
    assert whitening.whiten(vectors.where("vec_id >= 1000")).count() == 0  # a single distinct vector
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(20)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_deviations_stay_exact_when_they_are_large(spark):
    data = [(i, [1e7 if i == 0 else i * 3.3, float(i)]) for i in range(400)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    rows = kept(df, 2)
    *_, deviation = plain_whitened(rows, 2)
    want = {i: d if d < 1 << 63 else None for (i, _), d in zip(rows, deviation)}
    got = whitening.whiten(df).select("id", "deviation").distinct().collect()
    assert {r.id: r.deviation for r in got} == want
    assert any(v is None for v in want.values()) and any(v is not None for v in want.values())
