"""Whitening of embeddings, with the principal components from FEAST contour integrals.

Vectors are put on an integer grid, so that copies are equal and sums exact.
The covariance of the distinct vectors is summed up in tasks; its leading
eigenpairs come from contours around parts of its spectrum. On a contour, the
quadrature of solves with the complex shifted covariance projects a random
block of vectors onto the eigenvectors inside; Rayleigh-Ritz extracts them, and
the projection is repeated on them until their residuals vanish. Inertia counts
choose the contours, and check that each gave as many pairs as there are inside.

Plan at scale:

* Copies are reduced in the map tasks before the shuffle of distinct vectors,
  which is written once. Sums, covariance and the check of the result are three
  passes over it; a task sends one matrix of the dimension, summed up by entry.
* Only one matrix of the dimension (d x d) reaches the driver and the tasks:
  its size does not depend on the number of vectors.
* Each contour is solved in a task of its own.
* The last pass reads all rows and multiplies each batch with d x 16 numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import query, table
from fieldstar.session import ship_package, stage

COMPONENTS = 16
GRID = 64
SHIFT = 1_000_000
LARGEST = 2.0**40
NODES = 12  # of the quadrature on half a contour
PER_CONTOUR = 8
ROUNDS = 40
RESIDUAL = 1e-13
LEAST = 1e-10  # eigenvalues below this share of the largest count as zero
WIDEST = 8.0  # most a contour's bounds may differ by, as a ratio
SLICE = 4096


def grid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, x) of the usable rows: entries as whole numbers, floor(64 c) + 1,000,000."""
    vector = F.col(vector_col)
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    wide = F.transform(vector, lambda c: c.cast("double"))
    rows = df.select(F.col(id_col).alias("_id"), wide.alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull() & (F.size("_v") > 0) & F.forall("_v", usable))
    return rows.select("_id", F.transform("_v", lambda c: F.floor(c * GRID) + SHIFT).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _slices(batches, d: int):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, _matrix(part.column(part.schema.get_field_index("x")), d)


def summed(fit: DataFrame, d: int, of_slice, size: int) -> np.ndarray:
    """Sum over all slices of the fit list of a flat array of `size` numbers."""

    def partial(batches):
        total = None
        for _, x in _slices(batches, d):
            part = of_slice(x).ravel()
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])

    ship_package(fit.sparkSession)
    found = fit.mapInArrow(partial, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    result = np.zeros(size)
    result[found.column("k").to_numpy()] = found.column("v").to_numpy()
    return result


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections, which keep its inertia."""
    a = matrix.copy()
    d = len(a)
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        if norm == 0:
            continue
        v[0] += norm if v[0] >= 0 else -norm
        v /= np.linalg.norm(v)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues above a shift: positive pivots of the shifted matrix (Sylvester's law of inertia)."""
    tiny = np.finfo(float).tiny
    found, pivot = 0, 1.0
    for k, value in enumerate(diagonal):
        pivot = value - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = pivot if abs(pivot) > tiny else -tiny
        found += int(pivot > 0)
    return found


def contours(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top down until `wanted` eigenvalues are inside.

    Bounds are bisected by inertia counts. Where eigenvalues are too close to be
    parted, a contour takes all of them. Eigenvalues that count as zero are left
    out. A contour spans no more than a factor of `WIDEST`, or the quadrature
    could not tell its smallest eigenvalues from those below.
    """
    diagonal, off = tridiagonal(matrix)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    top = float((diagonal + reach).max())
    if top <= 0:
        return []
    top *= 1 + 1e-9

    def bound(most: int, low: float, high: float) -> float:
        """A shift with `most` eigenvalues above it; with more, if they cannot be parted."""
        while high - low > 1e-12 * top:
            middle = (low + high) / 2
            above = count_above(diagonal, off, middle)
            if above == most:
                return middle
            low, high = (middle, high) if above > most else (low, middle)
        return low

    def clear_of(shift: float) -> float:
        """A shift near the given one that no eigenvalue is next to."""
        while count_above(diagonal, off, shift * (1 - 1e-6)) != count_above(diagonal, off, shift * (1 + 1e-6)):
            shift *= 1.001
        return shift

    largest = bound(0, 0.0, top)
    floor = LEAST * largest
    rank = count_above(diagonal, off, floor)
    wanted = min(wanted, rank)
    found, high, done = [], top, 0
    while done < wanted:
        most = min(done + PER_CONTOUR, wanted)
        low = floor if most == rank else max(floor, bound(most, floor, high))
        if low < high / WIDEST:
            low = clear_of(high / WIDEST)
        above = count_above(diagonal, off, low)
        if above > done:
            found.append((low, high, above - done))
        high, done = low, above
    return found


def feast(matrix: np.ndarray, low: float, high: float, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix between two bounds."""
    d = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - nodes)
    shifts = centre + radius * np.exp(1j * angles)
    scale = weights / 2 * radius * np.exp(1j * angles)
    block = min(d, 2 * inside + 8)
    guess = np.random.default_rng(d).standard_normal((d, block))
    shifted = [shift * np.eye(d) - matrix for shift in shifts]
    size = np.abs(matrix).sum(axis=1).max()
    for _ in range(ROUNDS):
        projected = sum((w * np.linalg.solve(z, guess)).real for w, z in zip(scale, shifted, strict=True))
        basis = np.linalg.qr(projected)[0]
        values, small = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ small
        kept = (values > low) & (values <= high)
        off = np.linalg.norm(matrix @ vectors[:, kept] - vectors[:, kept] * values[kept], axis=0)
        if kept.sum() == inside and (off <= RESIDUAL * size).all():
            order = np.argsort(-values[kept], kind="stable")
            return values[kept][order], vectors[:, kept][:, order]
        guess = vectors
    raise ArithmeticError(f"{inside} eigenvalues lie in ({low}, {high}], {kept.sum()} were found")


def leading_pairs(spark, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns; each contour is a task."""
    parts = contours(matrix, wanted)
    d = len(matrix)
    if not parts:
        return np.zeros(0), np.zeros((d, 0))

    def solve(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = feast(matrix, row["low"], row["high"], row["inside"])
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(vectors.T.tolist())], ["value", "vector"])

    rows = spark.createDataFrame(parts, "low double, high double, inside int").repartition(len(parts))
    found = rows.mapInArrow(solve, "value double, vector array<double>").toArrow().to_pylist()
    found = sorted(found, key=lambda r: -r["value"])[:wanted]
    vectors = np.array([r["vector"] for r in found]).T
    # Either sign is an eigenvector; the largest entry is made positive, so that reruns agree.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(found))])
    return np.array([r["value"] for r in found]), vectors


def _common_length(rows: DataFrame) -> int:
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return lengths["d"] if lengths else 0


def _deviation(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact; NULL where no long holds it."""
    wide = [int(s) for s in total]
    reach = max((abs(n * int(v) - s) for f in (x.min(axis=0), x.max(axis=0)) for v, s in zip(f, wide)), default=0)
    if reach < (1 << 62) and len(wide) * reach * reach < (1 << 63):
        return pa.array((((n * x - np.array(wide, "i8")) ** 2).sum(axis=1)).astype("i8"))
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, wide, strict=True)) for row in x]
    return pa.array([v if v < (1 << 63) else None for v in exact], pa.int64())


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Rows whose vector is NULL, empty, or holds a NULL or non-finite entry are
    dropped, and so are those with an entry of 2^40 or more, or of another
    length than the most frequent one (the smaller, if two are). Each distinct
    vector enters mean and covariance once; every usable row comes out, also
    repeated ones and those with a NULL id. Components are numbered from 1 by
    falling eigenvalue; eigenvalues that are zero, as far as double precision
    can tell, have none, so one distinct vector gives no rows. Where
    eigenvalues are equal, any orthonormal basis of their space may come out. A
    deviation that no long holds is NULL. An empty table gives no row. Other
    columns are ignored.
    """
    spark = df.sparkSession
    rows = grid_vectors(df, id_col, vector_col)
    kind = dict(rows.dtypes)["_id"]
    schema = (
        f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    d = _common_length(rows)
    rows = rows.filter(F.size("x") == d)
    fit = stage(rows.select("x").distinct(), "fit-list")
    n, total = _exact_sums(fit, d)
    if n < 2:
        return spark.createDataFrame([], schema)
    mean = np.array([_ratio(s, n) for s in total])

    def outer(x):
        centred = _centred(x, mean)
        return centred.T @ centred

    covariance = summed(fit, d, outer, d * d).reshape(d, d) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_pairs(spark, covariance, components)
    many = len(values)
    if not many:
        return spark.createDataFrame([], schema)
    turn = vectors / np.sqrt(values)
    explained = values / np.trace(covariance)

    def moments(x):
        white = _centred(x, mean) @ turn
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    sums = summed(fit, d, moments, many + many * many) / n
    white_mean = sums[:many]
    error = float(np.abs(sums[many:].reshape(many, many) - np.outer(white_mean, white_mean) - np.eye(many)).max())

    def out(batches):
        for part, x in _slices(batches, d):
            if not len(x):
                continue
            white = _centred(x, mean) @ turn
            each = pa.array(np.repeat(np.arange(len(x)), many))
            long = lambda v: pa.array(np.tile(v, len(x)))
            columns = [
                part.column(0).take(each),
                long(np.arange(1, many + 1, dtype="i4")),
                pa.array(np.full(len(each), n, dtype="i8")),
                _deviation(x, n, total).take(each),
                pa.array(white.ravel()),
                long(explained),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.mapInArrow(out, schema)


def _centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return x.astype("f8") - mean


def _ratio(total: int, n: int) -> float:
    return total / n  # Python divides whole numbers of any size to the nearest double


def _exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and sum per dimension, as whole numbers of any size."""

    def partial(batches):
        n, total = 0, [0] * d
        for _, x in _slices(batches, d):
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, d), pa.int64()), pa.array([n, *total], pa.decimal128(38, 0))], ["k", "v"]
            )

    if not d:
        return 0, []
    ship_package(fit.sparkSession)
    sums = fit.mapInArrow(partial, "k long, v decimal(38,0)").groupBy("k").agg(F.sum("v").alias("v")).collect()
    by_key = {r["k"]: int(r["v"]) for r in sums}
    return by_key.get(-1, 0), [by_key.get(k, 0) for k in range(d)]


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
