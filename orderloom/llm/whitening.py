"""Whiten embeddings by the leading components of their covariance.

Spark sums what the covariance needs, exactly and a partial matrix a task; what reaches the driver is of the size of the
covariance, whatever the number of vectors. There its spectrum is divided and conquered: the polar factor of the
covariance less a shift (by QDWH iterations) gives the projector on the components beyond the shift, the covariance is
split into two smaller ones on that subspace and its complement, and so on down to single components. The
components then go back to the tasks, which whiten each row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import sized_for, stored

EXACT = 2**53  # whole numbers up to here are exact as doubles
EPS = float(np.finfo(float).eps)
_SUMS = "place long, total decimal(38,0)"
_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


# The spectrum of one matrix. Everything here is of the covariance's size.


def polar_factor(a: np.ndarray, most: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley iterations.

    The lower bound on the scaled singular values starts at rounding level, so it holds for all that are not zero.
    """
    scale = np.linalg.norm(a)
    if not scale:
        return np.eye(len(a))
    x, low, eye = a / scale, EPS, np.eye(len(a))
    for _ in range(most):
        low2 = low * low
        d = np.cbrt(4 * max(0.0, 1 - low2) / low2**2)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low2) / (low2 * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[: len(a)] @ q[len(a) :].T)
        new = (new + new.T) / 2
        step, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * low2) / (1 + wc * low2))
        if step <= 1e-8 and abs(1 - low) <= 10 * EPS:  # of third order, so the next step is nothing
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below the shift, or nothing if it parts none."""
    d = len(a)
    above = (polar_factor(a - shift * np.eye(d)) + np.eye(d)) / 2
    r = int(round(np.trace(above)))
    if not 0 < r < d:
        return None
    mixed = np.random.default_rng(d).standard_normal((d, d))
    basis = np.hstack([above @ mixed[:, :r], mixed[:, r:] - above @ mixed[:, r:]])
    for _ in range(2):  # the second time from an almost orthonormal basis, to rounding level
        basis = np.linalg.qr(basis)[0]
        basis = np.hstack([above @ basis[:, :r], basis[:, r:] - above @ basis[:, r:]])
    basis = np.linalg.qr(basis)[0]
    return basis[:, :r], basis[:, r:]


def leading_components(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    A part whose eigenvalues are equal to rounding level is not split further: any basis of it is one of eigenvectors.
    The entry of greatest size is positive in each vector.
    """
    tolerance = 4 * len(v) * EPS * max(np.linalg.norm(v), np.finfo(float).tiny)
    found: list[np.ndarray] = []
    waiting = [np.eye(len(v))]  # bases of parts, the greatest eigenvalues last
    while waiting and len(found) < count:
        basis = waiting.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        mean = np.trace(a) / len(a)
        if len(a) == 1 or np.linalg.norm(a - mean * np.eye(len(a))) <= tolerance:
            found.extend(basis.T)
            continue
        shifts = [float(np.median(np.diag(a))), float(mean), *np.quantile(np.diag(a), [0.75, 0.25, 0.9, 0.1])]
        best, least = None, np.inf
        for shift in shifts:
            parts = _split(a, shift)
            if parts:
                left = np.linalg.norm(parts[1].T @ a @ parts[0])
                if left < least:
                    best, least = parts, left
                if left <= tolerance:
                    break
        if best is None:  # an eigenvalue within rounding of every shift, and none beyond
            found.extend(basis.T)
            continue
        waiting += [basis @ best[1], basis @ best[0]]
    vectors = np.array(found).T.reshape(len(v), -1)
    vectors = np.linalg.qr(vectors)[0] if vectors.shape[1] else vectors
    values = np.einsum("ij,ik,kj->j", vectors, v, vectors)
    order = np.argsort(-values, kind="stable")[:count]
    vectors = vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


# Sums over the vectors. A task gives one total for each place of a vector or matrix; Spark adds them up by place.


@dataclass(frozen=True)
class Whitening:
    """A fitted model. ``middle`` is the mean rounded to whole numbers and ``rest`` is n times what that leaves."""

    n: int
    middle: np.ndarray
    rest: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle).astype(float) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Squared length of n x - S, exact; None beyond the range of a long."""
        gap = x - self.middle
        most = self.n * int(np.abs(gap).max(initial=0)) + max(map(abs, self.rest), default=0)
        exact = np.int64 if most * most * max(1, x.shape[1]) < 2**63 else object
        y = gap.astype(exact) * self.n - np.array(self.rest, exact)
        return [int(total) if total < 2**63 else None for total in (y * y).sum(axis=1)]


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def products(x: np.ndarray) -> np.ndarray:
    """Sums of x_i x_j over the rows, exact, as Python numbers. Doubles do the work as long as they are exact."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    greatest = int(np.abs(x).max(initial=0)) ** 2
    if greatest >= EXACT:
        wide = x.astype(object)
        return total + wide.T @ wide
    rows = max(1, EXACT // max(1, greatest) - 1)
    for start in range(0, len(x), rows):
        part = x[start : start + rows].astype(float)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _totals(of_batch):
    """A task's totals, a row for each place."""

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            values = [None if t is None else int(t) for t in np.ravel(total)]
            places = pa.array(range(len(values)), pa.int64())
            yield pa.RecordBatch.from_arrays([places, pa.array(values, pa.decimal128(38, 0))], ["place", "total"])

    return summed


def _added(vectors: DataFrame, of_batch) -> list[int]:
    added = vectors.mapInArrow(_totals(of_batch), _SUMS).groupBy("place").agg(F.sum("total").alias("total")).collect()
    return [int(row["total"]) for row in sorted(added, key=lambda row: row["place"])]


def whole_numbers(vector: Column) -> Column:
    """Entries as long: floor(64 c) + 1000000."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * 64) + F.lit(1_000_000).cast("long"))


def finite(vector: Column) -> Column:
    """Not null, and no entry null, NaN or infinite."""
    sound = F.forall(
        vector.cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def fit(vectors: DataFrame, count: int = 16) -> tuple[Whitening | None, float]:
    """The model of distinct vectors (one column ``x`` of equal lengths), and its identity error.

    Nothing is fitted to no vectors. Components whose eigenvalue is zero to rounding level can't be scaled and are left
    out, so there may be fewer than ``count``, and none for a single vector.
    """
    sums = _added(vectors, lambda x: np.append(x.astype(object).sum(axis=0), len(x)))
    if not sums or len(sums) == 1:
        return None, 0.0
    *sums, n = sums
    d = len(sums)
    whole = [(2 * s + n) // (2 * n) for s in sums]  # n times the mean is s, rounded to the nearest
    middle, rest = np.array(whole, np.int64), [s - n * m for s, m in zip(sums, whole, strict=True)]
    crossed = _added(vectors, lambda x: products(x - middle))
    v = np.array([(n * crossed[i * d + j] - rest[i] * rest[j]) / (n * n) for i in range(d) for j in range(d)]).reshape(d, d)
    values, axes = leading_components(v, min(count, d))
    usable = values > 4 * d * EPS * np.linalg.norm(v)
    model = Whitening(n, middle, rest, axes[:, usable], values[usable], float(np.trace(v)))
    return model, _identity_error(vectors, model)


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The greatest entry by size of the whitened vectors' covariance less the identity, as measured over all of them."""
    k = len(model.values)
    if not k:
        return 0.0

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                z = model.whitened(_matrix(batch.column(0)))
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int64()), pa.array(total.ravel())], ["place", "total"])

    rows = vectors.mapInArrow(summed, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    covariance = np.zeros(k * k)
    for row in rows:
        covariance[row["place"]] = row["total"] / model.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def _applied(model: Whitening, error: float):
    k = len(model.values)
    explained = model.values / model.trace

    def whitened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = _matrix(batch.column("x")), batch.num_rows
            arrays = [
                pa.array(np.repeat(np.arange(rows), k)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error)),
            ]
            arrays[0] = batch.column("vec_id").take(arrays[0])
            yield pa.RecordBatch.from_arrays(
                arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            )

    return whitened


def whiten(embeddings: DataFrame, count: int = 16) -> DataFrame:
    """A row for each sound row and component: ``vec_id``, ``component`` (from 1), ``n`` (distinct vectors), ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Rows without a vector, or with a null or non-finite entry, are dropped. Repeated rows and rows that share an id or a
    vector each get their own result, a null id stays null, and other columns take no part. A ``deviation`` beyond a long
    is null. An empty table, or one of a single distinct vector, gives no rows; vectors of different lengths have no
    covariance and raise a ValueError.
    """
    sized_for(embeddings)
    sound = embeddings.where(finite(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x")
    )
    lengths = sound.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if lengths["least"] != lengths["most"]:
        raise ValueError(f"vectors of {lengths['least']} to {lengths['most']} entries cannot be whitened together")
    spark = embeddings.sparkSession
    if not lengths["most"]:
        return spark.createDataFrame([], _RESULT)
    model, error = fit(stored(sound.select("x").distinct(), "fit-list"), count)
    if model is None or not len(model.values):
        return spark.createDataFrame([], _RESULT)
    return sound.mapInArrow(_applied(model, error), _RESULT)
