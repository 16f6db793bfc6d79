import math

import numpy as np
import pytest

from stayline.llm import feast
from stayline.llm import whitening as w

ROWS = "vec_id bigint, embedding array<float>, label int"


def exact(kept):
    """(n, deviations, integer vectors) of valid vectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in kept]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    return n, [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x], np.array(x, dtype=np.int64)


def test_agrees_with_a_dense_solution(spark):
    rng = np.random.default_rng(1)
    mixed = rng.standard_normal((400, 24)) @ (rng.standard_normal((24, 24)) * np.linspace(3, 0.1, 24))
    vectors = [[float(c) for c in v] for v in mixed]
    vectors += [vectors[0]] * 90  # copies of one vector
    rows = [(n, v, 0) for n, v in enumerate(vectors)]
    odd = [(900, None, 1), (901, [*vectors[1][:23], None], 1), (902, [float("nan")] * 24, 1), (903, [float("inf")] + [0.0] * 23, 1),
           (904, [], 1), (905, [1.0], 1), (906, [float(2**41)] * 24, 1), (None, vectors[2], None)]
    frame = spark.createDataFrame(rows + odd, ROWS).repartition(7)
    got = w.whitening(frame).collect()
    n, deviations, x = exact([*vectors, vectors[2]])
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    wanted = (x - x.mean(axis=0)) @ axes / np.sqrt(values)
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    by_row = {(r.vec_id, r.component): r for r in got}
    ids = [*range(len(vectors)), None]
    for component in range(1, 9):
        own = np.array([by_row[i, component].whitened for i in ids])
        sign = np.sign(own[0] * wanted[0, component - 1])
        assert np.allclose(own * sign, wanted[:, component - 1], atol=1e-8)
        assert by_row[5, component].explained == pytest.approx(values[component - 1] / np.trace(np.cov(x.T, bias=True)), rel=1e-9)
    assert [by_row[i, 1].deviation for i in ids] == deviations
    (error,) = {r.identity_error for r in got}
    assert error < 1e-9


def test_few_components_and_none(spark):
    # vectors in a plane have two components, equal ones none
    plane = [(n, [float(n % 5), float(n % 3), 1.0, float(n % 5 + n % 3)], 0) for n in range(60)]
    got = w.whitening(spark.createDataFrame(plane, ROWS)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 120
    assert sum({r.explained for r in got}) == pytest.approx(1)
    assert w.whitening(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, ROWS)).collect() == []
    assert w.whitening(spark.createDataFrame([], ROWS)).collect() == []
    assert w.whitening(spark.createDataFrame([(1, None, 0)], ROWS)).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(0, [1e9, 0.0], 0), (1, [-1e9, 1.0], 0), (2, [0.0, 0.5], 0)]
    got = w.whitening(spark.createDataFrame(rows, ROWS)).collect()
    _, deviations, _ = exact([v for _, v, _ in rows])
    assert {r.vec_id: r.deviation for r in got} == {n: d if d < 2**63 else None for n, d in enumerate(deviations)}


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    np.geomspace(1e9, 1e-3, 40),  # spread over twelve orders of magnitude
    np.r_[np.full(12, 5.0), np.linspace(4.9999, 1, 20)],  # a multiple eigenvalue across the last wanted place
    np.r_[5.0, 5.0 - 1e-9, 4.0, np.full(30, 1e-14)],
    np.linspace(1, 2, 60),
    np.r_[3.0, np.zeros(9)],
    np.array([2.0]),
])
def test_pairs_of_hard_spectra(spark, values):
    matrix = spectrum(values)
    matrix = (matrix + matrix.T) / 2
    found, vectors = feast.largest_pairs(spark, matrix, 8)
    top = max(values)
    wanted = [v for v in sorted(values, reverse=True)[:8] if v > 1e-12 * top]
    assert np.allclose(found, wanted, rtol=1e-9, atol=1e-12 * top)
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-10 * top


def test_inertia_counts():
    values = np.r_[np.linspace(-3, 4, 30), np.full(5, 1.5)]
    diagonal, beside = feast.tridiagonal(spectrum(values))
    shifts = np.linspace(-4, 5, 50)
    assert feast.above(shifts, diagonal, beside).tolist() == [(values > s).sum() for s in shifts]
    assert feast.above(np.array([0.0]), np.zeros(3), np.zeros(2)).tolist() == [0]
