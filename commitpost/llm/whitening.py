"""Whitening of embeddings by their leading principal components.

Components are turned into whole numbers ``floor(1024 * c) + 100000``. Sums and products of these are whole too, so
the covariance is exact until its last division, and does not depend on how the rows are dealt to tasks: each task
subtracts the whole part of the mean before it multiplies, partial products are summed by Spark, and what the fraction
of the mean changes is a product of remainders. The driver sees dimension x dimension sums, never rows.

Householder reflections make the covariance tridiagonal, Sturm counts and bisection find its largest eigenvalues, and
inverse iteration their vectors, kept orthogonal inside clusters of close eigenvalues. They are sent to the tasks that
project the rows.

Cases: a null vector, or one with a null or not finite component (``vectors.REACH`` and more count as such), takes no
part; of vectors of several lengths the most frequent length does (the longer one of equals); repeated rows count as
often as they occur; a null id is kept; without rows the result is empty; in a direction without variance ``whitened``
is 0, ``explained`` is 0, and the direction is left out of ``identity_error``; a ``deviation`` beyond 64 bits is null;
fewer dimensions than components give as many components as dimensions; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from commitpost.plans.stage import stage

from .vectors import matrices, whole

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
EXACT = 2**53  # whole numbers below this are exact as doubles
HELD = 1 << 20  # sums kept by a task before it hands them on
COUNT = -1  # the place of the number of rows among the sums
CLUSTER = 1e-3  # eigenvalues closer than this share of the norm are one cluster


@dataclass(frozen=True)
class Whitening:
    """What whitening has learnt: ``components`` is one unit vector a row, by falling eigenvalue."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def base(self) -> np.ndarray:
        """The whole part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """The mean is base + rest / n."""
        return np.array([s % self.n for s in self.sums], np.int64)

    @property
    def varying(self) -> np.ndarray:
        return self.eigenvalues > len(self.sums) * np.finfo(float).eps * self.trace

    def whiten(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.varying, 1 / np.sqrt(np.where(self.varying, self.eigenvalues, 1)), 0)
        return ((x - self.base) - self.rest / self.n) @ self.components.T * scale

    def explained(self) -> np.ndarray:
        return np.where(self.varying, self.eigenvalues / (self.trace or 1), 0.0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2."""
        centred = x - self.base
        most = self.n * (int(np.abs(centred).max(initial=0)) + 1)
        if most * most * max(1, x.shape[1]) < 2**63:
            return ((centred * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((centred.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def integers(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").alias("vec_id"), F.col("embedding").alias("embedding"))


def _scaled(batch: pa.RecordBatch, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for rows, found in matrices(batch["embedding"]):
        if length is None or found.shape[1] == length:
            yield rows, whole(found, SCALE) + SHIFT


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(vectors: DataFrame) -> DataFrame:
    """Number and sums of the vectors of each length: ``(length, place, total)``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def out():
            for length, total in held.items():
                places = np.arange(COUNT, length, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), length, np.int64)), pa.array(places), _decimals(total)], ["length", "place", "total"]
                )

        for batch in batches:
            for _, x in _scaled(batch):
                length = x.shape[1]
                total = np.array([len(x), *x.sum(axis=0).tolist()], object)
                held[length] = held[length] + total if length in held else total
            if sum(map(len, held.values())) > HELD:
                yield from out()
                held = {}
        yield from out()

    rows = integers(vectors).mapInArrow(partial, "length bigint, place int, total decimal(38,0)")
    return rows.groupBy("length", "place").agg(F.sum("total").alias("total"))


def exact_gram(y: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Products of columns, summed over stretches of rows: whole numbers, and a bound on their magnitude."""
    top = int(np.abs(y).max(initial=0)) + 1
    step = EXACT // (top * top)
    if step < 64:  # only components of thousands: limbs of 20 bits
        high, low = y >> 20, y & ((1 << 20) - 1)
        part = [(a.astype(object).T @ b.astype(object)) << s for a, b, s in ((high, high, 40), (high, low, 20), (low, high, 20), (low, low, 0))]
        yield sum(part), len(y) * top * top
        return
    real = y.astype(np.float64)
    for at in range(0, len(y), step):
        block = real[at : at + step]
        yield (block.T @ block).astype(np.int64), len(block) * top * top


def _products(vectors: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Sums of products of the vectors less the whole part of their mean: ``(i, j, total)``, i <= j."""
    length = len(sums)
    base = np.array([s // n for s in sums], np.int64)
    i, j = np.triu_indices(length)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bound = None, 0

        def out():
            places = [pa.array(p.astype(np.int32)) for p in (i, j)]
            return pa.RecordBatch.from_arrays([*places, _decimals(held[i, j])], ["i", "j", "total"])

        for batch in batches:
            for _, x in _scaled(batch, length):
                for gram, most in exact_gram(x - base):
                    if held is not None and bound + most >= 2**62:
                        yield out()
                        held, bound = None, 0
                    held, bound = gram if held is None else held + gram, bound + most
        if held is not None:
            yield out()

    rows = integers(vectors).mapInArrow(partial, "i int, j int, total decimal(38,0)")
    return rows.groupBy("i", "j").agg(F.sum("total").alias("total"))


def covariance(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums, and the covariance with divisor n, each entry rounded once."""
    sums = stage(_sums(vectors), "whitening-sums")
    most = sums.where(F.col("place") == COUNT).orderBy(F.desc("total"), F.desc("length")).first()
    if most is None:
        return 0, [], np.zeros((0, 0))
    n, length = int(most["total"]), most["length"]
    mine = sums.where((F.col("length") == length) & (F.col("place") != COUNT)).orderBy("place").collect()
    totals = [int(r["total"]) for r in mine]
    matrix = np.zeros((length, length))
    for r in _products(vectors, n, totals).toLocalIterator():
        i, j = r["i"], r["j"]
        matrix[i, j] = matrix[j, i] = (n * int(r["total"]) - (totals[i] % n) * (totals[j] % n)) / (n * n)
    return n, totals, matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal and reflections of an equal symmetric matrix."""
    a = matrix.copy()
    reflections = []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        alpha = -size if v[0] > 0 else size
        v[0] -= alpha
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = alpha
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def above(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues are larger than each of ``at``: Sturm's count of sign changes."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count = np.zeros(len(at), np.int64)
    squares = np.concatenate([[0.0], side**2])
    pivot = np.ones(len(at))
    for d, s in zip(diagonal, squares):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def leading(diagonal: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection until neighbouring doubles are reached."""
    reach = np.concatenate([[0.0], np.abs(side)]) + np.concatenate([np.abs(side), [0.0]])
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    margin = np.finfo(float).eps * max(1e-300, np.abs([low[0], high[0]]).max()) * len(diagonal)
    low, high = low - margin, high + margin
    order = np.arange(1, k + 1)
    for _ in range(2_000):
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            break
        more = above(diagonal, side, middle) >= order
        low, high = np.where(open_ & more, middle, low), np.where(open_ & ~more, middle, high)
        if (high - low <= np.finfo(float).eps * np.maximum(np.abs(low), np.abs(high))).all():
            break
    return low + (high - low) / 2


def solve_shifted(diagonal: np.ndarray, side: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """Solves (T - shift) z = right by elimination with row exchanges."""
    n = len(diagonal)
    x = right.tolist()
    main, upper, second = (diagonal - shift).tolist(), [*side.tolist(), 0.0], [0.0] * n
    lower = side.tolist()
    for k in range(n - 1):
        if abs(main[k]) >= abs(lower[k]):
            pivot = main[k] if abs(main[k]) > tiny else tiny
            main[k] = pivot
            factor = lower[k] / pivot
            main[k + 1] -= factor * upper[k]
            x[k + 1] -= factor * x[k]
        else:
            factor = main[k] / lower[k]
            main[k], below = lower[k], upper[k]
            upper[k], main[k + 1] = main[k + 1], below - factor * main[k + 1]
            second[k], upper[k + 1] = upper[k + 1], -factor * upper[k + 1]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
    for k in range(n - 1, -1, -1):
        value = x[k]
        if k + 1 < n:
            value -= upper[k] * x[k + 1]
        if k + 2 < n:
            value -= second[k] * x[k + 2]
        pivot = main[k] if abs(main[k]) > tiny else tiny
        x[k] = value / pivot
        if abs(x[k]) > 1e150:  # only the direction matters
            x = [v * 1e-150 for v in x]
    return np.array(x)


def eigenvectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors of a tridiagonal matrix, one a row, by inverse iteration."""
    n = len(diagonal)
    norm = (np.abs(diagonal).max(initial=0) + 2 * np.abs(side).max(initial=0)) or 1.0
    tiny = np.finfo(float).eps * norm
    found: list[np.ndarray] = []
    first, shift = 0, 0.0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        shift = value if k == first else min(value, shift - 10 * tiny)
        z = np.random.default_rng(k).standard_normal(n)
        for _ in range(6):
            z = solve_shifted(diagonal, side, shift, z / np.linalg.norm(z), tiny)
            z /= np.linalg.norm(z)
            for _ in range(2):
                for other in found[first:]:
                    z = z - (other @ z) * other
            z /= np.linalg.norm(z)
        found.append(z)
    return np.array(found).reshape(len(values), n)


def principal(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and their unit vectors (largest entry positive) of a symmetric matrix."""
    scale = np.abs(matrix).max(initial=0) or 1.0
    diagonal, side, reflections = tridiagonal(matrix / scale)
    values = leading(diagonal, side, k)
    vectors = eigenvectors(diagonal, side, values).T
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    vectors = vectors.T
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values * scale, vectors * np.where(signs == 0, 1, signs)[:, None]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learns from all usable vectors; None if there are none."""
    n, sums, matrix = covariance(vectors)
    if not n:
        return None
    k = min(components, len(sums))
    if not k:
        return Whitening(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    values, found = principal(matrix, k)
    return Whitening(n, sums, np.maximum(values, 0), found, float(np.trace(matrix)))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity.

    Each stretch of rows is centred on its own mean; sums over stretches make the covariance of all."""
    kept = np.flatnonzero(model.varying)
    k = len(kept)
    if not k:
        return 0.0

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + k + k * k)
        for batch in batches:
            for _, x in _scaled(batch, len(model.sums)):
                w = model.whiten(x)[:, kept]
                mean = w.mean(axis=0)
                inside = (w - mean).T @ (w - mean) + len(w) * np.outer(mean, mean)
                total += np.concatenate([[len(w)], len(w) * mean, inside.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "total"])

    rows = integers(vectors).mapInArrow(partial, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    total = np.array([r["total"] for r in sorted(rows.collect())])  # 1 + k + k^2 numbers
    mean = total[1 : 1 + k] / total[0]
    found = total[1 + k :].reshape(k, k) / total[0] - np.outer(mean, mean)
    return float(np.abs(found - np.eye(k)).max())


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``(vec_id, deviation, whitened array)`` of every usable vector."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _scaled(batch, len(model.sums)):
                white = model.whiten(x)
                offsets = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].take(pa.array(rows)),
                        pa.array(model.deviations(x), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel())),
                    ],
                    ["vec_id", "deviation", "whitened"],
                )

    return integers(vectors).mapInArrow(project, f"vec_id {kind}, deviation bigint, whitened array<double>")


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component, see the module's text."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    model = fit(vectors, components)
    if model is None:
        return spark.createDataFrame(
            [], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        )
    error = identity_error(vectors, model)
    share = F.array(*(F.lit(float(v)) for v in model.explained())) if len(model.eigenvalues) else F.array().cast("array<double>")
    rows = transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(share, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
