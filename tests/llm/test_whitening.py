"""Whitening against numpy's own eigenvectors, and the contour solver on hard spectra."""

from __future__ import annotations

import numpy as np
import pytest
from ladewerk.llm import feast, whitening

ROWS = "vec_id long, embedding array<float>, component string, n int"


def _plain(vectors, k):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    values, basis = np.linalg.eigh(np.cov(x.T, bias=True))
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return ((n * x - total) ** 2).sum(axis=1), (x - total / n) @ basis / np.sqrt(values), values / np.trace(np.cov(x.T, bias=True))


def test_rows_agree_with_numpy(spark):
    rng = np.random.default_rng(5)
    good = (rng.standard_normal((300, 12)) * np.linspace(1, 3, 12)).astype(np.float32).tolist()
    good[7] = good[3]  # a repeated vector counts twice
    odd = [None, [], [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1.0] * 5, [1e30] * 12]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)] + [(1000 + i, v, None, None) for i, v in enumerate(odd)]
    rows.append((None, good[0], "x", 1))
    rows.append((5, good[5], "x", 1))
    found = whitening.whiten(spark.createDataFrame(rows, ROWS).repartition(5), 4).toPandas()
    kept = [*good, good[0], good[5]]
    deviation, white, explained = _plain(kept, 4)
    assert len(found) == 4 * len(kept) and found.n.eq(len(kept)).all()
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    one = found[found.vec_id == 42].sort_values("component")
    assert one.deviation.tolist() == [deviation[42]] * 4
    assert np.allclose(np.abs(one.whitened), np.abs(white[42]), atol=1e-9) and np.allclose(one.explained, explained, rtol=1e-9)
    signs = np.sign(one.whitened.to_numpy() / white[42])
    again = found[found.vec_id == 11].sort_values("component").whitened.to_numpy()
    assert np.allclose(again, white[11] * signs, atol=1e-9)
    assert found.vec_id.isna().sum() == 4 and (found.vec_id == 5).sum() == 8


def test_data_without_variance_has_no_components(spark):
    assert whitening.whiten(spark.createDataFrame([], ROWS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "", 0)], ROWS)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], "", 0) for i in range(20)], ROWS)
    assert whitening.whiten(line, 3).select("component").distinct().count() == 1


def test_large_numbers_stay_exact():
    grid = np.array([[3 << 40, -(5 << 40)], [1, 2]])
    off = whitening._exact(grid, 1 << 30, [7, 9])
    assert off[0, 0] == (3 << 70) - 7 and off.dtype == object
    assert whitening._squares(off)[0] is None
    assert whitening._squares(np.array([[3, 4]])) == [25]


@pytest.mark.parametrize(
    "values",
    [np.arange(1, 41.0), np.full(30, 7.0), 1e4 + np.arange(30) * 1e-3, 10.0 ** -np.arange(0, 12, 0.5), np.r_[1.0, 2, 3, np.zeros(37)], [4.0], [5.0, 5, 5, 1, 0]],
)
def test_contour_integration_misses_no_eigenvalue(values):
    values = np.array(values, float)
    turn, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((len(values), len(values))))
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = feast.leading(matrix, 8)
    expected = np.sort(values)[::-1][:8]
    expected = expected[expected > 1e-12 * values.max()]
    assert len(found) == len(expected) and np.allclose(found, expected, rtol=1e-11, atol=1e-11 * values.max())
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12


def test_inertia_counts_indefinite_matrices():
    matrix = np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, -2]])
    assert [feast.count_above(matrix, s) for s in (-3, -1.5, 0, 0.5, 2)] == [3, 2, 1, 1, 0]
    assert feast.leading(np.zeros((3, 3)), 2)[0].size == 0
