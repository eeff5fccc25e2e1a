import math
from fractions import Fraction

import numpy as np
import pytest

from skillweave.llm import whitening as w


def brute(vectors):
    """x of each complete vector, exact sums, eigenvalues and eigenvectors of the exact covariance."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    d = [[n * a - s for a, s in zip(v, sums, strict=True)] for v in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in d), n**3)) for j in range(len(sums))] for i in range(len(sums))])
    e, v = np.linalg.eigh(cov)
    return x, d, e[::-1], v[:, ::-1]


def check(rows, vectors, ids, count, tolerance=1e-6):
    x, d, e, v = brute(vectors)
    n = len(x)
    assert len(rows) == n * count
    z = np.zeros((n, count))
    at = {i: k for k, i in enumerate(ids)}
    for r in rows:
        k = at[r["_id"]]
        assert (r.n, int(r.deviation)) == (n, sum(a * a for a in d[k])) and 1 <= r.component <= count
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-6)
        assert r.identity_error < 1e-9
        z[k, r.component - 1] = r.whitened
    assert np.abs(z.T @ z / n - np.eye(count)).max() < 1e-9
    a = np.array([[float(Fraction(c, n)) for c in row] for row in d])
    want = a @ v[:, :count] / np.sqrt(e[:count])
    assert np.abs(z - want * np.sign((z * want).sum(axis=0))).max() < tolerance * np.abs(want).max()


def frame(spark, vectors, ids=None):
    rows = [(k if ids is None else ids[k], v, "y", 1) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, component int").repartition(3)


def test_scales_far_apart(spark):
    r = np.random.default_rng(1)
    v = (r.normal(size=(400, 8)) * [1e7, 1e5, 1e3, 40, 5, 1, 0.2, 0.05]).tolist()
    check(w.whiten(frame(spark, v)).collect(), v, range(400), 8, 1e-4)


def test_nulls_repeats_and_dependent_dimensions(spark):
    r = np.random.default_rng(2)
    v = [[*map(float, a), 3.5, 2 * math.floor(64 * a[0]) / 64] for a in r.normal(size=(60, 4))]
    v += [v[0], v[1]]
    bad = [None, [None, *v[0][1:]], [math.nan, *v[0][1:]], [math.inf, *v[0][1:]], [*v[0][:-1], -math.inf]]
    rows = w.whiten(frame(spark, [*v, *bad])).collect()
    check(rows, v, range(62), 4)


def test_null_ids_stay(spark):
    v = [[1.0, 0.0], [0.0, 3.0], [2.0, 2.0]]
    rows = w.whiten(frame(spark, v, [None, None, 5])).collect()
    assert sorted((r["_id"] is None, r.component) for r in rows) == [(False, 1), (False, 2), (True, 1), (True, 1), (True, 2), (True, 2)]


def test_fewer_vectors_than_dimensions(spark):
    v = np.random.default_rng(3).normal(size=(5, 40)).tolist()
    check(w.whiten(frame(spark, v)).collect(), v, range(5), 4)


def test_exact_beyond_64_bits():
    x = np.array([[1 << 61, 5], [-(1 << 61), 6], [7, 7]])
    sums = [7, 18]
    d = w.deviations(x, 3, sums)
    assert d.tolist() == [[3 * int(a) - s for a, s in zip(row, sums, strict=True)] for row in x]
    assert w._squares(d[2:]).to_pylist()[0] == 14**2 + 3**2
    big = [[int(v) for v in row] for row in d[:1]]
    assert w._squares(d[:1]).to_pylist()[0] == (None if sum(v * v for v in big[0]) >= 10**38 else sum(v * v for v in big[0]))


def test_single_vector_and_empty_tables(spark):
    assert w.whiten(frame(spark, [[1.0, 2.0]])).count() == 0
    assert w.whiten(frame(spark, [[], []])).count() == 0
    assert w.whiten(frame(spark, [[1.0, 2.0]]).limit(0)).count() == 0


def test_lengths_that_differ_are_an_error(spark):
    with pytest.raises(ValueError, match="different lengths"):
        w.whiten(frame(spark, [[1.0, 2.0], [1.0]]))


def test_query_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = w.op12_whitening(spark, sf_dir).withColumnRenamed("vec_id", "_id").collect()
    check(rows, [r.embedding for r in table], [r.vec_id for r in table], 32)
