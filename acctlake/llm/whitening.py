"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries become whole numbers, ``x = floor(scale * c)``; the fit uses each distinct x-vector once. With n vectors and sums S, the
scatter adds the products of ``(n * x - S) / n``, whose numerators are exact. The scatter is factored as L L' with the largest
remaining diagonal entry as pivot, up to its rank; rotations of pairs of columns of L, until all columns are orthogonal, leave
columns whose squared norms are the eigenvalues and whose directions are the components. The product L L' is never formed again,
so small eigenvalues keep their digits.

Scale. Distinct vectors are found by one shuffle with a map-side combine, so copies of one vector are one row a task; the fit list is a
written table read three times (sums, scatter, check). Tasks add up in arrays and send one row per dimension; only these sums and one
matrix a vector length, dimension by dimension, come to the driver. Nothing there grows with the number of rows.

Defined results. Vectors that are NULL or hold NULL or non-finite entries, or entries with ``|scale * c|`` of 2^62 or more, take no part. Vectors of
different lengths are whitened apart, each length with its own fit. Components end at the rank: with one distinct vector there are none, and such
rows have no result rows; neither have empty vectors. Repeated rows and NULL ids each get their rows. Equal eigenvalues keep any
order; a component's largest entry is positive. ``deviation`` is NULL where it does not fit 64 bits. Empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import ship, stage

SCALE = 256
COMPONENTS = 4
#: Rows that are centred and multiplied at a time.
BLOCK = 4096


@dataclass
class Fit:
    """One vector length: number and sums of its distinct vectors, components as columns, their eigenvalues, the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the rows that take part, x as whole numbers."""
    kept = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    # Written for a whole array: NULL, NaN and infinite entries fail the comparison as well.
    fits = F.forall("v", lambda c: F.coalesce((F.abs(c) * scale < float(1 << 62)) & ~F.isnan(c), F.lit(False)))
    return kept.where(F.col("v").isNotNull() & fits).select("vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the vectors of each length; in blocks."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for at in range(0, len(rows), BLOCK):
            some = rows[at : at + BLOCK]
            values = column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
            yield int(length), some, values.reshape(len(some), int(length))


def largest(values: np.ndarray) -> int:
    """Largest absolute value, as a number without bounds."""
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums`` exactly; Python numbers where 64 bits may not do."""
    bound = n * largest(x) + max(map(abs, sums), default=0)
    kind = np.int64 if bound < 1 << 62 else object
    return x.astype(kind) * n - np.array(sums, kind)


def deviations(numerators: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; None where it does not fit 64 bits."""
    safe = numerators.shape[1] * largest(numerators) ** 2 < 1 << 63
    squares = numerators.astype(np.int64 if safe else object)
    return [s if s < 1 << 63 else None for s in map(int, (squares * squares).sum(axis=1))]


def add_up(rows: DataFrame) -> DataFrame:
    """``dim, place, total``: sums of the arrays ``part`` per (dim, place), in the order of ``task``, without gathering them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            parts = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column(3).value_lengths().to_numpy(zero_copy_only=False))
            for n, (dim, place) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                part = parts[ends[n - 1] if n else 0 : ends[n]]
                totals[dim, place] = totals[dim, place] + part if (dim, place) in totals else part.copy()
        for (dim, place), total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([place], pa.int32()), pa.array([total], pa.list_(pa.float64()))],
                ["dim", "place", "total"],
            )

    dealt = rows.select("dim", "place", "task", "part").repartition("dim", "place").sortWithinPartitions("dim", "place", "task")
    return dealt.mapInArrow(each, "dim int, place int, total array<double>")


def _sums(fitted: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number and exact sums of the vectors of each length."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for dim, rows, x in by_length(batch.column(0)):
                kind = np.int64 if largest(x) * len(rows) < 1 << 62 else object
                sums = [len(rows), *map(int, x.astype(kind).sum(axis=0))]
                totals[dim] = [a + b for a, b in zip(totals[dim], sums, strict=True)] if dim in totals else sums
        for dim, sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dim] * len(sums), pa.int32()), pa.array(range(len(sums)), pa.int32()),
                    pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
                ],
                ["dim", "place", "total"],
            )

    parts = fitted.select("x").mapInArrow(each, "dim int, place int, total decimal(38,0)")
    found: dict[int, dict[int, int]] = {}
    for row in parts.groupBy("dim", "place").agg(F.sum("total").alias("total")).collect():
        found.setdefault(row["dim"], {})[row["place"]] = int(row["total"])
    return {dim: (of[0], [of[i] for i in range(1, dim + 1)]) for dim, of in found.items()}


def _per_task(rows: DataFrame, part_of: Callable[[int, np.ndarray], np.ndarray]) -> DataFrame:
    """``dim, place, task, part``: the matrices that ``part_of`` gives for blocks of x, summed per task, a row for each line."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in by_length(batch.column(0)):
                part = part_of(dim, x)
                totals[dim] = totals[dim] + part if dim in totals else part
        for dim, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dim] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()),
                    pa.array(list(total), pa.list_(pa.float64())),
                ],
                ["dim", "place", "part"],
            )

    return rows.select("x").mapInArrow(each, "dim int, place int, part array<double>").withColumn("task", F.spark_partition_id())


def _matrices(summed: DataFrame) -> dict[int, np.ndarray]:
    found: dict[int, dict[int, list[float]]] = {}
    for row in summed.collect():
        found.setdefault(row["dim"], {})[row["place"]] = row["total"]
    return {dim: np.array([of[i] for i in range(len(of))]) for dim, of in found.items()}


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """Columns of a factor L with ``L @ L.T == scatter`` up to rounding; triangular with its rows in pivot order."""
    size = len(scatter)
    factor, left = np.zeros((size, size)), scatter.diagonal().copy()
    least = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    picked = np.zeros(size, bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(picked, -np.inf, left)))
        if not left[pivot] > least:
            return factor[:, :k]
        column = scatter[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        picked[pivot] = True
        root = math.sqrt(left[pivot])
        factor[:, k] = np.where(picked, 0.0, column / root)
        factor[pivot, k] = root
        left = left - factor[:, k] ** 2
    return factor


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotates pairs of columns until all are orthogonal. A round takes disjoint pairs, so they turn at once."""
    g = factor.copy()
    count = g.shape[1]
    seats = list(range(count + count % 2))
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if max(a, b) < count]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            p, q = (np.array(side, int) for side in zip(*pairs, strict=True)) if pairs else (np.empty(0, int),) * 2
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            turn = np.abs(ab) > eps * np.sqrt(aa * bb)
            if not turn.any():
                continue
            turned = True
            p, q, a, b = p[turn], q[turn], a[:, turn], b[:, turn]
            zeta = (bb[turn] - aa[turn]) / (2 * ab[turn])
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            g[:, p], g[:, q] = cosine * (a - tangent * b), cosine * (tangent * a + b)
        if not turned:
            break
    return g


def principal(scatter: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Components as columns and eigenvalues of a positive semidefinite matrix, largest first, up to its rank."""
    columns = orthogonal_columns(pivoted_cholesky(scatter))
    norms = np.sqrt((columns * columns).sum(axis=0))
    first = np.argsort(-norms, kind="stable")[:wanted]
    directions = columns[:, first] / norms[first]
    signs = np.sign(np.take_along_axis(directions, np.abs(directions).argmax(axis=0)[None, :], axis=0))
    return directions * signs, norms[first] ** 2


def project(numerators: np.ndarray, fit: Fit) -> np.ndarray:
    return (numerators.astype(float) / fit.n) @ fit.components / np.sqrt(fit.eigenvalues)


def fit_whitening(whole: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Per vector length the fit over the distinct vectors of ``whole`` (column ``x``)."""
    fitted = stage(whole.select("x").distinct(), "fit-list")
    sums = _sums(fitted)

    def scatter_of(dim: int, x: np.ndarray) -> np.ndarray:
        n, total = sums[dim]
        centre = centred(x, n, total).astype(float) / n
        return centre.T @ centre

    fits = {}
    for dim, scatter in _matrices(add_up(_per_task(fitted.where(F.size("x") > 0), scatter_of))).items():
        n, total = sums[dim]
        directions, values = principal(scatter / n, components)
        fits[dim] = Fit(n, total, directions, values, float(scatter.trace() / n))
    fits = {dim: fit for dim, fit in fits.items() if len(fit.eigenvalues)}

    # The covariance of what comes out, centred on its own mean before multiplying.
    usable = fitted.where(F.size("x").isin(sorted(fits)))
    means = {
        dim: total[0] / fits[dim].n
        for dim, total in _matrices(
            add_up(_per_task(usable, lambda dim, x: project(centred(x, fits[dim].n, fits[dim].sums), fits[dim]).sum(axis=0)[None, :]))
        ).items()
    }

    def spread(dim: int, x: np.ndarray) -> np.ndarray:
        out = project(centred(x, fits[dim].n, fits[dim].sums), fits[dim]) - means[dim]
        return out.T @ out

    for dim, total in _matrices(add_up(_per_task(usable, spread))).items():
        fits[dim].identity_error = float(np.abs(total / fits[dim].n - np.eye(len(total))).max())
    return fits


def whiten(whole: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, x in by_length(batch.column(1)):
                if dim not in fits:
                    continue
                fit = fits[dim]
                numerators, count, k = centred(x, fit.n, fit.sums), len(rows), len(fit.eigenvalues)
                repeated = pa.array(np.repeat(np.arange(count), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)).take(repeated),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, fit.n)),
                        pa.array(deviations(numerators), pa.int64()).take(repeated),
                        pa.array(project(numerators, fit).reshape(-1)),
                        pa.array(np.tile(fit.eigenvalues / fit.trace, count)),
                        pa.array(np.full(count * k, fit.identity_error)),
                    ],
                    names,
                )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return whole.select("vec_id", "x").mapInArrow(each, schema)


ship(__name__)
