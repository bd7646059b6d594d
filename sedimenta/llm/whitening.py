"""Whitening of vectors by their principal components, from a shifted CholeskyQR."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.shared import arrow_map, slices, text_batches
from sedimenta.llm.topk import usable
from sedimenta.scratch import materialize, remove

#: Scale of the integers and components returned.
SCALE = 256
COMPONENTS = 4
#: Gram passes at most; two after the shifted one settle any matrix that is not singular.
PASSES = 6
#: Rows multiplied at a time, partial results that one task adds up, rows of an Arrow batch.
BLOCK = 4096
FAN_IN = 64
BATCH_ROWS = 2048
#: A component with less of the largest eigenvalue than this, times the dimensions, is none.
RANK_TOLERANCE = 1e-14

_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, per-dimension sums, and the components as columns."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def _vectors(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exact: as 64-bit integers where they fit, as Python's elsewhere."""
    most = n * int(np.abs(x.astype(float)).max(initial=0) + 1) + max((abs(s) for s in sums), default=0)
    if most < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return _deviations(x, n, sums).astype(float) / n


def solve_rows(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows @ inverse(r) for upper triangular ``r``, by forward substitution over columns."""
    out = np.empty_like(rows)
    for j in range(len(r)):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular factor of ``gram``, shifted as little as makes it positive definite."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 16, len(gram) * np.finfo(float).eps * np.trace(gram))


def _summed(rows: DataFrame, column: str, size: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``add(vectors)`` over all rows: per task, then by ever fewer tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            v = _vectors(batch.column(0))
            for i in range(0, len(v), BLOCK):
                total += add(v[i : i + BLOCK]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros(size), False
        for batch in batches:
            for part in batch.column(0):
                total, any_ = total + np.frombuffer(part.as_buffer()), True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    with text_batches(rows.sparkSession, BATCH_ROWS):
        parts = materialize(arrow_map(rows.select(column), partial, "part binary"), "gram")
    while (count := parts.count()) > 1:
        fewer = materialize(arrow_map(parts.repartition(math.ceil(count / FAN_IN)), together, "part binary"), "gram")
        remove(parts)
        parts = fewer
    found = parts.first()
    remove(parts)
    return np.zeros(size) if found is None else np.frombuffer(found.part)


def _gram(fit: DataFrame, d: int, transform: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    def add(x: np.ndarray) -> np.ndarray:
        q = transform(x)
        return q.T @ q

    return _summed(fit, "x", d * d, add).reshape(d, d)


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Principal components of the distinct integer vectors ``x`` of ``fit``, all of length ``d``.

    Each pass sums the Gram matrix of the centred rows, solved through the triangular
    factors found so far, and factors it; the first one shifts it by its rounding error. The
    product of the factors is the R of the rows' QR decomposition once the Gram matrix is
    idempotent (the identity, for rows of full rank). The SVD of R has the components.
    """
    sums = fit.select(F.count("*").alias("n"), *[F.sum(F.col("x")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(d)]).first()
    n, sums = sums[0], tuple(int(s or 0) for s in sums[1:])
    factors: list[np.ndarray] = []
    trace = 0.0
    for k in range(PASSES):

        def orthogonal(x: np.ndarray, factors=tuple(factors)) -> np.ndarray:
            q = _centred(x, n, sums)
            for r in factors:
                q = solve_rows(q, r)
            return q

        gram = _gram(fit, d, orthogonal)
        if k == 0:
            trace = float(np.trace(gram))
            if not trace > 0:
                return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
            shift = 11 * (BLOCK * d + d * (d + 1)) * np.finfo(float).eps * trace
        elif np.abs(gram @ gram - gram).max() < 1e-12:
            break
        else:
            shift = 0.0
        factors.append(cholesky(gram, shift))
    r = np.eye(d)
    for factor in factors:
        r = factor @ r
    _, singular, rows = np.linalg.svd(r)
    eigenvalues = singular**2 / n
    kept = [i for i in range(min(components, d)) if eigenvalues[i] > RANK_TOLERANCE * d * eigenvalues[0]]
    vectors = rows[kept].T
    for j in range(len(kept)):
        if vectors[np.abs(vectors[:, j]).argmax(), j] < 0:
            vectors[:, j] *= -1
    basis = vectors / np.sqrt(eigenvalues[kept])
    c = len(kept)

    def moments(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ basis
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    found = _summed(fit, "x", c * c + c, moments)
    mean = found[c * c :] / n
    error = np.abs(found[: c * c].reshape(c, c) / n - np.outer(mean, mean) - np.eye(c)).max(initial=0)
    return Whitening(n, sums, vectors, eigenvalues[kept], trace / n, float(error))


def _whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    basis = model.components / np.sqrt(model.eigenvalues)
    c = len(model.eigenvalues)
    explained = model.eigenvalues / model.trace if c else model.eigenvalues

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            deviations = _deviations(_vectors(batch.column("x")), model.n, model.sums)
            if np.abs(deviations.astype(float)).max(initial=0) ** 2 * deviations.shape[1] < 1 << 62:
                far = pa.array((deviations.astype(np.int64) ** 2).sum(axis=1), pa.int64())
            else:
                exact = (deviations.astype(object) ** 2).sum(axis=1)
                far = pa.array([int(v) if v <= _LONG else None for v in exact], pa.int64())
            at = np.repeat(np.arange(batch.num_rows), c)
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, c + 1), batch.num_rows), pa.int32()),
                    pa.array(np.full(n, model.n), pa.int64()),
                    far.take(pa.array(at)),
                    pa.array((deviations.astype(float) / model.n @ basis).ravel(), pa.float64()),
                    pa.array(np.tile(explained, batch.num_rows), pa.float64()),
                    pa.array(np.full(n, model.identity_error), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return arrow_map(rows.select("vec_id", "x"), project, schema)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable
    input row (vec_id, embedding) and component.

    Vectors become integers, floor(256 * component). The model is fitted to each distinct one
    once, so copies weigh nothing; it is as large as the square of the dimensions, whatever
    the rows. Components come by falling eigenvalue, their largest entry positive.

    Null vectors, empty ones and those with null or non-finite entries are left out, as are
    vectors of another length than most (ties to the longer): they lie in another space.
    Equal rows and null ids get rows each. There are fewer components where the vectors vary
    in fewer directions, none if all are equal or there are none: then there are no rows. A
    deviation beyond 64 bits is null. Further columns are ignored.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("embedding"))
    own = own.where(F.coalesce(usable(F.col("embedding")), F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x).cast("long"))
    own = materialize(own.select("vec_id", whole.alias("x")), "integers")
    sizes = own.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    most = sizes.first()
    if most is None:
        return _whitened(own, Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0))
    own = own.where(F.size("x") == most.d)
    fit = materialize(own.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    result = _whitened(own, fit_whitening(fit, most.d, components))
    remove(fit)
    return result
