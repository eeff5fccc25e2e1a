"""Embedding whitening by shifted CholeskyQR.

Each entry c of a vector becomes the integer x = floor(64 c) + OFFSET. The centred rows A = x - S / n (S: sums per dimension,
n: number of vectors; n x - S is taken in integers, so nothing cancels) are factored as A = Q R:

1. A pass sums the Gram matrix of the rows; its Cholesky factor, of a Gram matrix shifted by a small multiple of the identity
   where it is not safely positive, is R1. The next pass solves each row by R1 (a triangular solve) and sums the Gram matrix
   again, and so on, until the columns are orthonormal. R is the product of the factors.
2. R = U E W^T gives the eigenvalues E^2 / n of the covariance and its unit eigenvectors, the columns of W. A whitened row is
   sqrt(n) q U, with q the row of Q: the same as the row projected on the components, over the roots of the eigenvalues, but
   orthonormal to double precision however small an eigenvalue is.

Every pass is a sum over rows: tasks send one triangle of d x d numbers each, and the driver holds d x d numbers, whatever n is.

Defined results: a null vector, or one with a null, NaN or infinite entry, is dropped; repeated rows and null ids stay, each a
row of its own; dimensions that are constant, and directions in which the rows do not vary (below RANK of the largest singular
value), have no component, so there may be fewer than asked for, and none for a single vector; equal eigenvalues have any
basis; of a component's two signs, that with a positive largest entry is taken; vectors of different lengths, and entries of
2**62 / 64 or more, are errors; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import bounded_batches, small, stored

COMPONENTS = 32
OFFSET = 1_000_000
#: Singular values at or below this times the number of dimensions times the largest are 0.
RANK = 8 * 2.0**-52
MAX_PASSES = 7
#: Numbers of a slice of rows.
SLICE_NUMBERS = 1 << 20
_ROUND = 2.0**-53


def complete_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """_id, x (array of long) of each row whose vector has only finite entries."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    scaled = F.transform(vector, lambda c: F.when(F.abs(c) < 2.0**56, F.floor(c * 64).cast("long") + OFFSET).otherwise(F.raise_error(F.lit("an entry is too large")).cast("long")))
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.filter(F.col(f"`{vector_col}`").isNotNull()).filter(~F.coalesce(bad, F.lit(False))).select(F.col(f"`{id_col}`").alias("_id"), scaled.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def dimension_sums(rows: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, exact sum of each dimension, and which dimensions vary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in small(batches):
            column = batch.column("x")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes[sizes > 0]).tolist():
                x = _matrix(column.filter(pa.array(sizes == d)))
                # in two halves, so that no sum leaves 64 bits
                now = [len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), x.min(axis=0), x.max(axis=0)]
                was = held.get(d)
                held[d] = now if was is None else [was[0] + now[0], was[1] + now[1], was[2] + now[2], np.minimum(was[3], now[3]), np.maximum(was[4], now[4])]
        for d, (n, *parts) in held.items():
            columns = [pa.array(np.full(d, d)), pa.array(np.arange(d)), pa.array(np.full(d, n)), *map(pa.array, parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "k", "n", "high", "low", "least", "most"])

    parts = rows.select("x").mapInArrow(run, "size long, k long, n long, high long, low long, least long, most long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = parts.groupBy("size", "k").agg(F.sum("n").alias("n"), whole("high"), whole("low"), F.min("least").alias("least"), F.max("most").alias("most")).orderBy("size", "k").collect()
    if not found:
        return 0, [], np.empty(0, bool)
    if found[0]["size"] != found[-1]["size"]:
        raise ValueError("vectors of different lengths")
    return found[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in found], np.array([r["least"] != r["most"] for r in found])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - sums, exactly: in 64 bits where they hold it, else as Python integers."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    y = x - base
    if y.size and int(np.abs(y).max()) * n < 1 << 61:
        return y * n - rest
    return y.astype(object) * n - rest.astype(object)


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangle, column by column."""
    out = np.empty_like(rows)
    for k in range(rows.shape[1]):
        out[:, k] = (rows[:, k] - out[:, :k] @ factor[:k, k]) / factor[k, k]
    return out


def _slices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    return small(batches, max(1, SLICE_NUMBERS // max(d, 1)))


def gram(rows: DataFrame, d: int, made: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of q^T q, with q = made(x) of `size` columns; one triangle leaves each task."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in _slices(batches, d):
            q = made(_matrix(batch.column("x")))
            total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["k", "v"])

    found = rows.select("x").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((size, size))
    at = np.array([r["k"] for r in found])
    out[upper[0][at], upper[1][at]] = out[upper[1][at], upper[0][at]] = [r["v"] for r in found]
    return out


def shifted_factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of g plus the shift; the shift grows while the factor does not exist."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, len(g) * _ROUND * float(np.trace(g)))


def cholesky_qr(rows: DataFrame, n: int, sums: list[int], varies: np.ndarray) -> list[np.ndarray]:
    """The triangular factors, first to last, of the centred rows without their constant dimensions."""
    d = int(varies.sum())
    factors: list[np.ndarray] = []
    for k in range(MAX_PASSES):
        g = gram(rows, len(varies), orthogonal(n, sums, varies, factors), d)
        low, high = np.linalg.eigvalsh(g)[[0, -1]]
        if not k:
            # before its columns are scaled, nothing is known of how far the rows are from dependent
            factors.append(shifted_factor(g, min(11 * (n * d + d * (d + 1)) * _ROUND, 1e-3) * high))
            continue
        factors.append(shifted_factor(g, 0 if low > 1e-3 * high else d * _ROUND * high))
        if abs(low - 1) < 1e-8 and abs(high - 1) < 1e-8:
            break
    return factors


def orthogonal(n: int, sums: list[int], varies: np.ndarray, factors: list[np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    """The function that centres rows and solves them by the factors in turn."""

    def run(x: np.ndarray) -> np.ndarray:
        q = (deviations(x, n, sums)[:, varies] / n).astype(np.float64)
        for r in factors:
            q = solve(q, r)
        return q

    return run


def _squares(d: np.ndarray) -> pa.Array:
    """Sum of the squares of each row, exactly; null beyond 38 digits."""
    if d.dtype != object and (not d.size or int(np.abs(d).max()) ** 2 * d.shape[1] < 1 << 62):
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = [sum(int(v) ** 2 for v in row) for row in d]
    return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """_id, component, n, deviation (decimal), whitened, explained, identity_error: a row for each complete vector and component."""
    bounded_batches(df.sparkSession)
    rows = stored(complete_vectors(df, id_col, vector_col), "vectors")
    id_type = dict(rows.dtypes)["_id"]
    schema = f"_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    n, sums, varies = dimension_sums(rows)
    if not varies.any():
        return df.sparkSession.createDataFrame([], schema)
    factors = cholesky_qr(rows, n, sums, varies)
    product = factors[0]
    for r in factors[1:]:
        product = r @ product
    left, sigma, right = np.linalg.svd(product)
    held = min(components, int((sigma > RANK * len(sigma) * sigma[0]).sum()))
    signs = np.sign(right[np.arange(len(right)), np.abs(right).argmax(axis=1)])
    turn = (left * signs)[:, :held] * np.sqrt(n)
    explained = (sigma**2 / (sigma**2).sum())[:held]
    q = orthogonal(n, sums, varies, factors)

    g = gram(rows, len(varies), lambda x: np.c_[q(x) @ turn, np.ones(len(x))], held + 1)
    covariance = g[:held, :held] / n - np.outer(g[:held, held], g[:held, held]) / n / n
    error = float(np.abs(covariance - np.eye(held)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(varies)):
            x = _matrix(batch.column("x"))
            take = pa.array(np.repeat(np.arange(len(x)), held))
            columns = [
                batch.column("_id").take(take),
                pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(take), n)),
                _squares(deviations(x, n, sums)).take(take),
                pa.array((q(x) @ turn).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(take), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's rows; a deviation beyond 64 bits is null here, as the column is a long."""
    rows = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select(F.col("_id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", "explained", "identity_error")


QUERIES = {"op12_whitening": op12_whitening}
#: Eigenvectors are beyond SQL; tests/llm/test_whitening.py holds the query against a decomposition of the whole matrix.
ORACLES: dict[str, str] = {}
