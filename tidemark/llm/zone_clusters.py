"""Centroid clustering with zone maps along a space-filling curve.

Vectors of whole numbers are put in the order of a Hilbert curve (a range partitioning and a sort
by the key) and written once as blocks, each with the box of its least and greatest components.
A round reads the blocks only. For a block, the distance from a centroid to the box bounds the
distances of all its vectors from below, the farthest corner bounds them from above; a centroid
whose lower bound exceeds the least upper bound is nearest to none of them. The candidates
left are compared exactly, block by block, on whole numbers.

A round sends sums and counts per centroid and component to the driver, a fixed size; sums are
exact, so results do not depend on the order of rows, on blocks or on retries.

Defined cases: vectors that are null, hold null or non-finite components, or do not have exactly
``size`` components are left out; a null id is hashed like an empty one; repeated rows count as
often as they occur; the first centroids of equal hash (repeated ids) are ordered by their
components; fewer vectors than centroids give fewer centroids; without vectors the result is
empty. Components are exact up to 2**62; a distance or sum beyond a long is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import matrix, packed, unpacked, whole_numbers
from tidemark.sources.scratch import written

CURVE_BITS = 2  # per component
BLOCK = 128  # vectors
_EXACT = 1 << 20  # products of smaller components are exact in doubles


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row on the Hilbert curve through a grid of 2**bits cells a side, as bytes that sort."""
    x = cells.T.astype(np.uint8 if bits <= 8 else np.uint32)
    n, one = len(x), x.dtype.type
    for level in range(bits - 1, 0, -1):  # undo the turns of the cubes, from the largest
        bit, low = one(1 << level), one((1 << level) - 1)
        for i in range(n):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low).astype(x.dtype)
            x[0] ^= np.where(turned, low, swap).astype(x.dtype)
            x[i] ^= swap
    for i in range(1, n):  # reflected code
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], x.dtype)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & one(1 << level), one((1 << level) - 1), one(0)).astype(x.dtype)
    x ^= turn
    planes = np.stack([(x >> level) & one(1) for level in range(bits - 1, -1, -1)])  # level, component, row
    return np.packbits(planes.reshape(bits * n, -1).T.astype(np.uint8), axis=1)


def _keyed(size: int, centre: list[float], spread: list[float]):
    """Cells are cut at the mean and at even steps of the deviation around it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = 1 << CURVE_BITS - 1
        for batch in batches:
            x = matrix(batch.column(1), size)
            cells = np.clip(np.floor((x - centre) / spread) + half, 0, 2 * half - 1)
            keys = hilbert_keys(cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.tobytes() for k in keys], pa.binary()), batch.column(0),
                 pa.array([packed(r) for r in x], pa.binary())], names=["key", "id", "x"])

    return run


def _blocked(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate([unpacked(r, size) for r in batch.column(2).to_pylist()]) if len(batch) else np.zeros((0, size))
            ids = batch.column(1)
            cuts = range(0, len(x), BLOCK)
            blocks = [x[i:i + BLOCK] for i in cuts]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids.slice(i, BLOCK).to_pylist() for i in cuts], pa.list_(pa.int64())),
                pa.array([packed(b) for b in blocks], pa.binary()),
                pa.array([b.min(0).tolist() for b in blocks], pa.list_(pa.int64())),
                pa.array([b.max(0).tolist() for b in blocks], pa.list_(pa.int64()))], names=["ids", "x", "low", "high"])

    return run


def zone_map(vectors: DataFrame, size: int) -> DataFrame:
    """The vectors (``id``, ``x``) in curve order as written blocks: ``ids``, packed ``x``, ``low`` and ``high``."""
    places = F.posexplode("x").alias("place", "c")
    moments = vectors.select(places).groupBy("place").agg(
        F.avg("c").alias("mean"), F.stddev_pop("c").alias("spread")).orderBy("place").collect()  # one row per component
    if not moments:
        moments = [{"mean": 0.0, "spread": 0.0}] * size
    keyed = vectors.mapInArrow(_keyed(size, [m["mean"] for m in moments], [m["spread"] or 1.0 for m in moments]),
                               "key binary, id bigint, x binary")
    # Equal vectors have equal keys: a number of the row lets a hot vector go to many partitions.
    ordered = keyed.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("key", "row")
    return written(ordered.sortWithinPartitions("key").select("key", "id", "x").mapInArrow(
        _blocked(size), "ids array<bigint>, x binary, low array<bigint>, high array<bigint>"), "zone-map")


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows from centroids."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if most < _EXACT:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    if most >= 1 << 27:  # Python's whole numbers
        x, c = x.astype(object), c.astype(object)
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1)


def _candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each box, the centroids that may be nearest to something in it."""
    a, b, c = (v.astype(np.float64) for v in (low[:, None], high[:, None], centroids[None]))
    under, over = c - a, b - c
    near = np.square(np.maximum(np.maximum(-under, -over), 0)).sum(2)
    far = np.square(np.maximum(np.abs(under), np.abs(over))).sum(2)
    return near <= far.min(1, keepdims=True) * (1 + 1e-12)  # beyond 2**53 doubles are rounded


def _nearest(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """Ids, vectors, clusters, distances and the number of candidates of each block."""
    size = centroids.shape[1]
    for batch in batches:
        if not len(batch):
            continue
        may = _candidates(matrix(batch.column(2), size), matrix(batch.column(3), size), centroids)
        for i, raw in enumerate(batch.column(1).to_pylist()):
            x, who = unpacked(raw, size), np.flatnonzero(may[i])
            d = _squares(x, centroids[who])
            best = d.argmin(1)  # of equal ones the smaller number
            yield batch.column(0)[i].values, x, who[best], np.take_along_axis(d, best[:, None], 1)[:, 0], len(who)


def _sums(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = centroids.shape
        total, n = np.zeros((k, size), object), [0] * k
        for _, x, cluster, _, _ in _nearest(batches, centroids):
            for c in np.unique(cluster).tolist():
                mine = x[cluster == c]
                total[c] += mine.sum(0, dtype=np.int64 if np.abs(mine).max() < 1 << 50 else object)
                n[c] += len(mine)
        some = [c for c in range(k) if n[c]]
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(some, pa.int32()), "n": pa.array([n[c] for c in some], pa.int64()),
            "sums": pa.array([total[c].tolist() for c in some], pa.list_(pa.int64()))})

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance, tried in _nearest(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()),
                 pa.array(np.full(len(ids), tried), pa.int32())], names=["id", "cluster", "distance", "candidates"])

    return run


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the ``k`` smallest hex sha256 of seed and id."""
    name = F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name.cast("binary"), 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of their vectors; one without vectors stays."""
    rows = blocks.mapInArrow(_sums(centroids), "cluster int, n bigint, sums array<bigint>")
    sums = rows.select("cluster", "n", F.posexplode("sums").alias("place", "c")).groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum("c").alias("c")).collect()  # one row per centroid and component
    out = centroids.copy()
    for r in sums:
        out[r["cluster"], r["place"]] = r["c"] // r["n"]
    return out


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, seed: str = "1:", id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: ``id``, ``cluster``, squared ``distance``, ``candidates`` of its block,
    ``cluster_inertia``, ``inertia`` and ``centroid`` (its components)."""
    vectors = whole_numbers(df, id_col, vector_col, size=size)
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return vectors.select("id", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "bigint"), ("candidates", "int"), ("cluster_inertia", "bigint"),
            ("inertia", "bigint"), ("centroid", "array<bigint>"))])
    blocks = zone_map(vectors, size)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    rows = written(blocks.mapInArrow(_assigned(centroids), "id bigint, cluster int, distance bigint, candidates int"), "nearest")
    inertia = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    at = F.col("cluster") + 1
    each = F.lit([inertia.get(c, 0) for c in range(len(centroids))]).cast("array<bigint>")
    places = F.lit([c.tolist() for c in centroids]).cast("array<array<bigint>>")
    return rows.select("*", F.element_at(each, at).alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
                       F.element_at(places, at).alias("centroid"))


def digest(components) -> str:
    """The hex sha256 of whole numbers joined by commas."""
    return hashlib.sha256(",".join(str(int(c)) for c in components).encode()).hexdigest()
