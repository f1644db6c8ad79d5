"""Whitening of embeddings by their leading principal components.

Means and the centred covariance are sums of small matrices, one per task, over the vectors spread across
the cluster; rows meet neither the driver nor each other. The covariance, whose size is the number of dimensions squared, is
taken apart where it is collected: Householder reflections make it tridiagonal, Sturm counts bisect the leading eigenvalues, and
inverse iteration finds the eigenvectors, made orthogonal again within a cluster of close eigenvalues. The projection
is broadcast and applied to every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow.llm.common import shared_folder

FACTOR, OFFSET = 64, 1_000_000
COMPONENTS = 16
# The covariance is collected: at most this many dimensions, 32 MB.
MAX_DIMENSIONS = 2048
# An eigenvalue below this share of the largest is rounding, and no component.
LEAST_SHARE = 1e-12
# Eigenvalues closer than this share of the norm form a cluster.
CLUSTER_SHARE = 1e-3
_INVERSE_STEPS = 4


# Eigenvectors of a symmetric matrix.

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit Householder vectors that lead to them, a zero vector for no reflection."""
    a = matrix.astype(np.float64).copy()
    size = len(a)
    mirrors = []
    for k in range(size - 2):
        mirror = np.zeros(size)
        below = a[k + 1:, k]
        scale = np.abs(below[1:]).max()
        if scale > 0:
            length = np.linalg.norm(below)
            mirror[k + 1:] = below
            mirror[k + 1] += np.copysign(length, below[0])
            mirror /= np.linalg.norm(mirror)
            half = a @ mirror
            half -= (mirror @ half) * mirror
            a -= 2.0 * (np.outer(mirror, half) + np.outer(half, mirror))
        mirrors.append(mirror)
    return np.diag(a).copy(), np.diag(a, 1).copy() if size > 1 else np.zeros(0), mirrors


def eigenvalues_below(diagonal: np.ndarray, off: np.ndarray, bound: float) -> int:
    """The Sturm count: how many eigenvalues of the tridiagonal matrix are less than ``bound``."""
    tiny = np.finfo(np.float64).tiny ** 0.5
    count, pivot = 0, 1.0
    for k, value in enumerate(diagonal.tolist()):
        pivot = value - bound - (float(off[k - 1]) ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues, falling, each bisected until its bounds are neighbouring numbers or nearly so."""
    reach = np.zeros(len(diagonal))
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    margin = np.finfo(np.float64).eps * max(abs(low), abs(high), np.finfo(np.float64).tiny)
    low, high = low - 2 * margin * len(diagonal), high + 2 * margin * len(diagonal)
    found = []
    for rank in range(wanted):
        index = len(diagonal) - 1 - rank
        least, most = low, high
        while most - least > margin:
            middle = 0.5 * (least + most)
            if middle in (least, most):
                break
            if eigenvalues_below(diagonal, off, middle) > index:
                most = middle
            else:
                least = middle
        found.append(0.5 * (least + most))
        high = most
    return np.array(found)


def _shifted_solver(diagonal: np.ndarray, off: np.ndarray, shift: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves (T - shift) x = b by elimination with row exchanges; a pivot that vanishes is made tiny instead."""
    size = len(diagonal)
    floor = np.finfo(np.float64).eps * max(float(np.abs(diagonal).max()), float(np.abs(off).max()) if size > 1 else 0.0, 1e-300)
    main, upper, second = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * size
    lower, exchanged, factors = off.tolist(), [False] * size, [0.0] * size
    for k in range(size - 1):
        if abs(lower[k]) > abs(main[k]):
            exchanged[k] = True
            factor = main[k] / lower[k]
            main[k], row = lower[k], (upper[k], upper[k + 1])
            upper[k], second[k] = main[k + 1], row[1]
            main[k + 1], upper[k + 1] = row[0] - factor * upper[k], -factor * row[1]
        else:
            if abs(main[k]) < floor:
                main[k] = floor
            factor = lower[k] / main[k]
            main[k + 1] -= factor * upper[k]
        factors[k] = factor
    if abs(main[-1]) < floor:
        main[-1] = floor

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        for k in range(size - 1):
            if exchanged[k]:
                x[k], x[k + 1] = x[k + 1], x[k]
            x[k + 1] -= factors[k] * x[k]
        for k in range(size - 1, -1, -1):
            if k + 1 < size:
                x[k] -= upper[k] * x[k + 1]
            if k + 2 < size:
                x[k] -= second[k] * x[k + 2]
            x[k] /= main[k]
        return np.array(x)

    return solve


def leading_eigenvectors(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    diagonal, off, mirrors = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, wanted)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max()) if len(off) else 0.0)
    if norm == 0:
        # Every direction is an eigenvector of nothing.
        return np.zeros(wanted), np.eye(len(diagonal), wanted)
    rng = np.random.default_rng(12)
    vectors = np.zeros((len(diagonal), wanted))
    cluster = 0
    for k in range(wanted):
        if k and values[k - 1] - values[k] > CLUSTER_SHARE * norm:
            cluster = k
        # Equal eigenvalues are set apart a little, so that their systems differ.
        shift = values[k] - (k - cluster) * 4 * np.finfo(np.float64).eps * norm
        solve = _shifted_solver(diagonal, off, shift)
        vector = rng.uniform(0.5, 1.0, len(diagonal)) * rng.choice([-1.0, 1.0], len(diagonal))
        for _ in range(_INVERSE_STEPS):
            vector = solve(vector / np.abs(vector).max())
            vector /= np.abs(vector).max()
            for _ in range(2):
                vector -= vectors[:, cluster:k] @ (vectors[:, cluster:k].T @ vector)
            vector /= np.linalg.norm(vector)
        vectors[:, k] = vector
    for mirror in reversed(mirrors):
        vectors -= 2.0 * np.outer(mirror, mirror @ vectors)
    return values, vectors


# Sums over the rows.

@dataclass(frozen=True)
class Whitener:
    """What a fit found: the number of distinct vectors, their sums, and the components as columns.

    ``deviation = n x - sums`` is exact; a component's whitened value is (x - sums / n) on it, over the root of its eigenvalue.
    """

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", factor: int = FACTOR,
                  offset: int = OFFSET) -> DataFrame:
    """(vec_id, x): entries as whole numbers, floor(factor * entry) + offset.

    Rows whose vector is NULL, empty, or holds a NULL or non-finite entry are dropped.
    """
    entry = F.col(vector_col)
    usable = F.forall(entry, lambda c: F.coalesce((F.abs(c.cast("double")) < float("inf")) & ~F.isnan(c), F.lit(False)))
    whole = F.transform(entry, lambda c: F.floor(c.cast("double") * factor) + F.lit(offset).cast("long"))
    return (vectors.filter(entry.isNotNull() & (F.size(entry) > 0)).filter(usable)
            .select(F.col(id_col).alias("vec_id"), whole.alias("x")))


def _rows(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)


def _deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - sums, exact."""
    if len(rows) and n * max(abs(int(rows.max())), abs(int(rows.min()))) + int(np.abs(sums).max()) >= 1 << 62:
        raise OverflowError("n * x does not fit 64 bits; scale the vectors by a smaller factor")
    return rows * n - sums


def _summed(rows: DataFrame, size: int, width: int, kind: str, partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``partial`` (size x width) over all rows: a matrix per task, added up by entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(_rows(batch, size))
                total = part if total is None else total + part
        if total is not None:
            lines, places = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(lines.ravel(), pa.int64()), pa.array(places.ravel(), pa.int64()),
                                              pa.array(total.ravel())], ["line", "place", "value"])

    parts = rows.select("x").mapInArrow(run, f"line long, place long, value {kind}")
    out = np.zeros((size, width), dtype=np.int64 if kind == "long" else np.float64)
    # At most MAX_DIMENSIONS squared entries.
    for row in parts.groupBy("line", "place").agg(F.sum("value").alias("value")).collect():
        out[row["line"], row["place"]] = row["value"]
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on the distinct vectors of ``rows`` (vec_id, x); None if there are no rows.

    Vectors have one length, at most MAX_DIMENSIONS; others are an error. Directions without variance are
    no components, so equal vectors alone have none.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, "whitening-fit")
    # Repeated vectors meet as one from each task, so a common one is no hot key.
    rows.select("x").distinct().write.parquet(path)
    distinct = spark.read.parquet(path)
    n, least, size = distinct.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return None
    if least != size:
        raise ValueError(f"vectors have from {least} to {size} entries; they need one length")
    if size > MAX_DIMENSIONS:
        raise ValueError(f"{size} dimensions are more than {MAX_DIMENSIONS}")
    sums = _summed(distinct, size, 1, "long", lambda x: x.sum(axis=0, dtype=np.int64)[:, None])[:, 0]

    def centred(x: np.ndarray) -> np.ndarray:
        return _deviations(x, n, sums) / n

    def products(x: np.ndarray) -> np.ndarray:
        y = centred(x)
        return y.T @ y

    covariance = _summed(distinct, size, size, "double", products) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, vectors = leading_eigenvectors(covariance, min(components, size))
    real = values > LEAST_SHARE * max(float(values[0]), 0.0)
    values, vectors = values[real], vectors[:, real]
    error = 0.0
    if len(values):
        def whitened_products(x: np.ndarray) -> np.ndarray:
            z = centred(x) @ (vectors / np.sqrt(values))
            out = np.zeros((size, len(values)))
            out[:len(values)] = z.T @ z
            return out

        spread = _summed(distinct, size, len(values), "double", whitened_products)[:len(values)] / n
        error = float(np.abs(spread - np.eye(len(values))).max())
    return Whitener(n, sums, trace, values, vectors, error)


OUTPUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def project(rows: DataFrame, model: Whitener | None) -> DataFrame:
    """One row for each row and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, {OUTPUT}"
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    held = _broadcast(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        size, kept = len(m.sums), len(m.values)
        scaled = m.vectors / np.sqrt(m.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            deviations = _deviations(_rows(batch, size), m.n, m.sums)
            if size * float(np.abs(deviations).max()) ** 2 >= 2.0 ** 63:
                raise OverflowError("the squared deviation does not fit 64 bits; scale the vectors by a smaller factor")
            whitened = (deviations / m.n) @ scaled
            times = np.repeat(np.arange(batch.num_rows), kept)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(times)),
                pa.array(np.tile(np.arange(1, kept + 1), batch.num_rows), pa.int32()),
                pa.array(np.full(len(times), m.n), pa.int64()),
                pa.array(np.einsum("ij,ij->i", deviations, deviations)[times], pa.int64()),
                pa.array(whitened.ravel()), pa.array(np.tile(m.values / m.trace, batch.num_rows)),
                pa.array(np.full(len(times), m.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def _broadcast(spark: SparkSession, model: Whitener):
    """The model on every executor: the sums and COMPONENTS columns of MAX_DIMENSIONS numbers at most."""
    return spark.sparkContext.broadcast(model)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable row on the leading components, by falling eigenvalue; see ``project``.

    Unusable vectors are dropped (see ``whole_vectors``); a row without an id is kept, its id NULL. Repeated
    vectors count once in the fit and have rows like others. A table without usable rows, or with one
    distinct vector, gives no rows. Other columns are ignored.
    """
    rows = whole_vectors(vectors, id_col, vector_col)
    return project(rows, fit(rows, components))
