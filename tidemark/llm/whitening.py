"""Whitening of embeddings by the leading components of their covariance, found by Jacobi-Davidson.

The covariance is never built. Its product with a few vectors is one pass over the written list of
distinct vectors: every task multiplies its centred rows, Spark adds up the parts, and a table of
components times vectors reaches the driver. The driver keeps an orthonormal search space
and takes the best approximations in it (Rayleigh-Ritz); what converged is locked and projected
out. For the others the correction equation, projected on what is orthogonal to all
approximations, is solved by a few steps of MINRES, all columns in step, so that one pass serves
all of them. This ends when every residual has reached double precision, after a fresh
product with the final vectors; a random block is tried against them, so that no larger
component was missed.

Vectors are whole numbers, floor(64 * c) + ``OFFSET``; sums are exact, and rows are centred by an exact
whole shift first and a fraction below 1 then, so nothing is lost to the offset.

Defined cases: rows whose vector is null, empty or holds null or non-finite components are left out; so
are vectors of another than the most frequent length (of equally frequent ones the longest), which lie
in another space. Repeated vectors count once in the fit and are all returned, null ids too. Components
whose variance is zero to double precision have no whitened value and are not returned (a single
distinct vector has none, so nothing is returned). A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import matrix, packed, unpacked, whole_numbers
from tidemark.sources.scratch import written

OFFSET = 1_000_000
BLOCK = 1024  # vectors
INNER_STEPS = 6  # of MINRES, at most
OUTER_STEPS = 200
TOLERANCE = 64 * np.finfo(np.float64).eps  # of a residual, relative to the largest eigenvalue
NOTHING = 1e-12  # of the largest eigenvalue: no variance

Multiply = Callable[[np.ndarray], np.ndarray]


def minres(multiply: Multiply, shift: np.ndarray, project: Multiply, rhs: np.ndarray, steps: int, reduce: float) -> np.ndarray:
    """Approximate solutions of project (A - shift_j) project x_j = rhs_j, all columns in step."""
    length = lambda v: np.sqrt((v * v).sum(0))
    floor = np.finfo(np.float64).tiny
    x = np.zeros_like(rhs)
    v_old, w_old, w = (np.zeros_like(rhs) for _ in range(3))
    gamma = length(rhs)
    first, eta = gamma.copy(), gamma.copy()
    v = rhs / np.maximum(gamma, floor)
    s_old, s, c_old, c = np.zeros_like(gamma), np.zeros_like(gamma), np.ones_like(gamma), np.ones_like(gamma)
    for _ in range(steps):
        image = project(multiply(v) - v * shift)
        delta = (v * image).sum(0)
        new = image - delta * v - gamma * v_old
        gamma_new = length(new)
        a0 = c * delta - c_old * s * gamma
        a1 = np.maximum(np.sqrt(a0 * a0 + gamma_new * gamma_new), floor)
        a2, a3 = s * delta + c_old * c * gamma, s_old * gamma
        c_old, c, s_old, s = c, a0 / a1, s, gamma_new / a1
        w_old, w = w, (v - a3 * w_old - a2 * w) / a1
        x += c * eta * w
        eta = -s * eta
        v_old, v, gamma = v, new / np.maximum(gamma_new, floor), gamma_new
        if (np.abs(eta) <= reduce * first).all():
            break
    return x


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the bases; columns that add nothing go."""
    new = new / np.maximum(np.sqrt((new * new).sum(0)), np.finfo(np.float64).tiny)
    for _ in range(2):
        for basis in bases:
            new = new - basis @ (basis.T @ new)
        u, size, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, size > 1e-8]
    for basis in bases:
        new = new - basis @ (basis.T @ new)
    return np.linalg.qr(new)[0] if new.shape[1] else new


def leading(multiply: Multiply, d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric operator without negative ones, and its unit vectors."""
    random = np.random.default_rng(5)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    space = _orthonormal(random.normal(size=(d, min(d, k + 4))))
    image, tried = multiply(space), False
    for outer in range(OUTER_STEPS):
        small = space.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        space, image = space @ y, image @ y
        want = min(k - len(values), space.shape[1])
        largest = max(float(values[0]) if len(values) else 0.0, float(theta[0]) if len(theta) else 0.0)
        rest = image[:, :want] - space[:, :want] * theta[:want]
        rest -= locked @ (locked.T @ rest)
        size = np.sqrt((rest * rest).sum(0))
        done = int(np.logical_and.accumulate(size <= TOLERANCE * largest).sum())
        if done:  # in order, so that a locked one is never smaller than one still sought
            locked, values = np.hstack([locked, space[:, :done]]), np.append(values, theta[:done])
            space, image, rest, theta = space[:, done:], image[:, done:], rest[:, done:], theta[done:]
            want -= done
        if len(values) == k:
            fresh = multiply(locked)  # the claim is checked against a new product
            small = locked.T @ fresh
            theta, y = np.linalg.eigh((small + small.T) / 2)
            order = np.argsort(-theta, kind="stable")
            vectors, images = locked @ y[:, order], fresh @ y[:, order]
            size = np.sqrt(np.square(images - vectors * theta[order]).sum(0))
            good = bool((size <= 2 * TOLERANCE * largest).all())
            if good and (tried or k == d):
                return theta[order], vectors
            # Once more with a random block beside them: whatever was missed comes out on top.
            more = _orthonormal(random.normal(size=(d, min(4, d - k))), vectors) if good else np.zeros((d, 0))
            tried = good
            locked, values = np.zeros((d, 0)), np.zeros(0)
            extra = multiply(more) if more.shape[1] else more
            if more.shape[1]:  # some powers of the operator turn the block towards its largest part
                for _ in range(3):
                    more = _orthonormal(extra, vectors)
                    extra = multiply(more)
            space, image = np.hstack([vectors, more]), np.hstack([images, extra])
            continue
        if space.shape[1] > 3 * k:  # restart with the best
            space, image = space[:, :k + want], image[:, :k + want]
        near = space[:, :want]
        hold = np.hstack([locked, near])
        project = lambda v: v - hold @ (hold.T @ v)  # noqa: B023, E731
        found = minres(multiply, theta[:want], project, -project(rest), INNER_STEPS, 0.5 ** (outer + 1))
        new = _orthonormal(found, locked, space)
        if not new.shape[1]:
            new = _orthonormal(random.normal(size=(d, min(d, k))), locked, space)
        space, image = np.hstack([space, new]), np.hstack([image, multiply(new) if new.shape[1] else new])
    raise ArithmeticError(f"{k - len(values)} of {k} components have not reached double precision")


def _packed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), size)
            blocks = [x[i:i + BLOCK] for i in range(0, len(x), BLOCK)]
            yield pa.RecordBatch.from_pydict({"x": pa.array([packed(b) for b in blocks], pa.binary())})

    return run


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            yield unpacked(raw, size)


@dataclass
class Fit:
    """The distinct vectors, written as packed blocks, with their exact number and sums."""

    blocks: DataFrame
    size: int
    n: int
    sums: list[int]

    @classmethod
    def of(cls, vectors: DataFrame, size: int) -> Fit:
        blocks = written(vectors.select("x").distinct().mapInArrow(_packed(size), "x binary"), "distinct-vectors")

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [0] * (size + 1)
            for x in _blocks(batches, size):
                part = x.sum(0, dtype=np.int64 if np.abs(x).max() < 1 << 50 else object).tolist()
                total = [a + b for a, b in zip(total, [*part, len(x)])]
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(size + 1), pa.int32()),
                                              "c": pa.array([str(t) for t in total], pa.string())})

        rows = blocks.mapInArrow(added, "place int, c string").groupBy("place").agg(
            F.sum(F.col("c").cast("decimal(38,0)")).alias("c")).collect()  # a row per dimension and one
        found = {r["place"]: int(r["c"]) for r in rows}
        return cls(blocks, size, found.get(size, 0), [found.get(i, 0) for i in range(size)])

    @property
    def shift(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def fraction(self) -> list[float]:
        return [(s % self.n) / self.n for s in self.sums]

    def _summed(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum over all centred blocks of ``part``, an array of the given shape."""
        size, shift, fraction = self.size, np.array(self.shift), np.array(self.fraction)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, np.longdouble)
            for x in _blocks(batches, size):
                total += part((x - shift) - fraction)
            yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(total.size), pa.int32()),
                                              "v": pa.array(total.ravel().astype(np.float64))})

        rows = self.blocks.mapInArrow(run, "place int, v double").groupBy("place").agg(F.sum("v").alias("v"))
        out = np.zeros(int(np.prod(shape)))
        for r in rows.collect():  # as many as the array has entries, whatever the number of vectors
            out[r["place"]] = r["v"]
        return out.reshape(shape)

    def times(self, v: np.ndarray) -> np.ndarray:
        """The product of the covariance with the columns of ``v``."""
        return self._summed(lambda x: x.T @ (x @ v), v.shape) / self.n

    def trace(self) -> float:
        return float(self._summed(lambda x: np.array([(x * x).sum()]), (1,))[0]) / self.n

    def identity_error(self, scaled: np.ndarray) -> float:
        """The largest entry of the whitened vectors' covariance less the identity."""
        k = scaled.shape[1]

        def part(x: np.ndarray) -> np.ndarray:
            y = x @ scaled
            return np.vstack([y.T @ y, y.sum(0)])

        found = self._summed(part, (k + 1, k)) / self.n
        return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def common_length(vectors: DataFrame) -> int | None:
    row = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return row["d"] if row else None


def _projected(fit: Fit, scaled: np.ndarray):
    size, n, shift, fraction = fit.size, fit.n, np.array(fit.shift), np.array(fit.fraction)
    left = np.array([s - n * a for s, a in zip(fit.sums, fit.shift)], object)  # n x - S = n (x - shift) - left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), size) - shift
            most = int(np.abs(x).max(initial=0)) + 1
            if (n * most) ** 2 * size < 1 << 62:
                deviation = np.square(n * x - left.astype(np.int64)).sum(1).tolist()
            else:  # by its three terms, the last ones as Python's whole numbers
                wide = most ** 2 * size >= 1 << 62 or most * n * size >= 1 << 62
                a, b = (x.astype(object), left) if wide else (x, left.astype(np.int64))
                squares, mixed = (a * a).sum(1).astype(object), (a * b).sum(1).astype(object)
                exact = n * n * squares - 2 * n * mixed + int((left * left).sum())
                deviation = [v if v < 1 << 63 else None for v in exact.tolist()]
            y = (x - fraction) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()),
                 pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64()))],
                names=["id", "deviation", "y"])

    return run


def whiten(df: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector and component: ``id``, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    vectors = whole_numbers(df, id_col, vector_col, OFFSET)
    size = common_length(vectors)
    none = vectors.where("false").select("id", *[F.lit(None).cast(t).alias(n) for n, t in (
        ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"),
        ("identity_error", "double"))])
    if size is None:
        return none
    vectors = vectors.where(F.size("x") == size)
    fit = Fit.of(vectors, size)
    e, v = leading(fit.times, size, min(components, size))
    there = e > NOTHING * e[0]
    if not there.any():
        return none
    e, v = e[there], v[:, there]
    scaled = v / np.sqrt(e)
    share, error = (e / fit.trace()).tolist(), fit.identity_error(scaled)
    rows = vectors.mapInArrow(_projected(fit, scaled), "id bigint, deviation bigint, y array<double>")
    each = rows.select("id", "deviation", F.posexplode("y").alias("place", "whitened"))
    return each.select("id", (F.col("place") + 1).alias("component"), F.lit(fit.n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.element_at(F.lit(share).cast("array<double>"), F.col("place") + 1).alias("explained"),
                       F.lit(error).alias("identity_error"))
