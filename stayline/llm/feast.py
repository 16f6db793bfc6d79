"""The largest eigenvalues of a symmetric matrix and their vectors by contour integration (FEAST).

The spectrum above a shift is cut into intervals of few eigenvalues. Around each a circle is laid, and the projector onto
the eigenvectors inside is a quadrature over solves with the matrix shifted to complex points of the circle; each solve is
one task. Rayleigh-Ritz on the projected block gives the pairs, which are projected again until their residuals are at
rounding level. How many eigenvalues an interval holds is known beforehand by inertia: the signs of the pivots of the shifted
matrix in tridiagonal form. An interval that yields another number of pairs is not accepted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

#: Quadrature points on the upper half of a circle; the lower half is its mirror image.
POINTS = 8
#: Eigenvalues of an interval are at most so many, unless they lie too close to be told apart.
INTERVAL_VALUES = 4
ROUNDS = 40
#: Residual, as a share of the largest eigenvalue, that counts as none.
RESIDUAL = 1e-13
#: Orders of matrices taken here: the matrix goes to every task, 128 MB at most.
MAX_ORDER = 4096


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and the one beside it of a tridiagonal matrix with the same eigenvalues, by Householder reflections."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    for k in range(n - 2):
        column = a[k + 1 :, k]
        norm = np.linalg.norm(column)
        if norm == 0:
            continue
        v = column.copy()
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        below = a[k + 1 :, k + 1 :]
        p = below @ v
        q = p - (v @ p) * v
        below -= 2 * (np.outer(v, q) + np.outer(q, v))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, column[0])
        a[k + 2 :, k] = a[k, k + 2 :] = 0
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(shifts: np.ndarray, diagonal: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Inertia: for each shift, how many eigenvalues of the tridiagonal matrix exceed it."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - shifts
    count = (pivot > 0).astype(int)
    with np.errstate(over="ignore"):  # behind a pivot next to zero comes one of infinite size, and then a usual one
        for a, b in zip(diagonal[1:], beside, strict=True):
            pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
            pivot = a - shifts - b * b / pivot
            count += pivot > 0
    return count


@dataclass
class _Interval:
    low: float
    high: float
    count: int
    block: np.ndarray | None = None
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    tried: int = field(default=0)


def _intervals(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> list[_Interval]:
    """Intervals that hold the `wanted` largest eigenvalues and at most a few smaller ones, each with its number of them;
    none below what is zero up to rounding."""
    reach = np.abs(np.concatenate((beside, [0]))) + np.abs(np.concatenate(([0], beside)))
    high = float((diagonal + reach).max())
    if high <= 0:
        return []
    top, bottom = high * (1 + 1e-12), float((diagonal - reach).min()) - 1e-12 * high
    floor = high * len(diagonal) * np.finfo(float).eps * 8
    counted = lambda shift: int(above(np.array([shift]), diagonal, beside)[0])

    def edge(inner: float, outer: float) -> float:
        """Where between the two shifts the count first differs from that of `inner`."""
        own = counted(inner)
        for _ in range(60):
            middle = (inner + outer) / 2
            inner, outer = (middle, outer) if counted(middle) == own else (inner, middle)
        return inner

    def centred(shift: float) -> float:
        """The middle of the gap between eigenvalues in which a shift lies."""
        return (edge(shift, bottom) + edge(shift, top)) / 2

    total = counted(floor)
    enough = min(wanted, total)
    open_, done = [(floor, top, total, 0)], []
    while open_:
        low, high, below, beyond = open_.pop()  # with the numbers of eigenvalues above either end
        if below == beyond or beyond >= enough:
            continue
        if below - beyond <= INTERVAL_VALUES or high - low <= 1e-10 * top:
            done.append(_Interval(centred(low), top if beyond == 0 else centred(high), below - beyond))
            continue
        middle = (low + high) / 2
        between = counted(middle)
        open_ += [(low, middle, below, between), (middle, high, between, beyond)]
    return done


def _project(spark: SparkSession, sent, intervals: list[_Interval]) -> list[np.ndarray]:
    """The block of each interval, projected onto the eigenvectors inside: one task per interval and point."""
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    points = []
    for number, own in enumerate(intervals):
        centre, radius = (own.low + own.high) / 2, (own.high - own.low) / 2
        for node, weight in zip(nodes, weights, strict=True):
            turn = np.exp(0.5j * np.pi * (1 + node))
            z, w = centre + radius * turn, 0.5 * weight * radius * turn
            points.append((number, float(z.real), float(z.imag), float(w.real), float(w.imag), own.block.tobytes(), own.block.shape[1]))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = sent.value
        for frame in frames:
            for number, zr, zi, wr, wi, block, width in frame.itertuples(index=False):
                y = np.frombuffer(block).reshape(-1, width)
                part = complex(wr, wi) * np.linalg.solve(complex(zr, zi) * np.eye(len(matrix)) - matrix, y)
                yield pd.DataFrame({"number": [number], "part": [np.ascontiguousarray(part.real).tobytes()]})

    schema = "number int, zr double, zi double, wr double, wi double, block binary, width int"
    dealt = spark.createDataFrame(points, schema).repartition(len(points))
    out = [np.zeros_like(own.block) for own in intervals]
    for number, part in sorted((r[0], bytes(r[1])) for r in dealt.mapInPandas(solve, "number int, part binary").collect()):
        out[number] += np.frombuffer(part).reshape(out[number].shape)
    return out


def largest_pairs(spark: SparkSession, matrix: np.ndarray, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, vectors as columns) of the `wanted` largest positive eigenvalues, falling; fewer where the others are
    zero up to rounding. The vectors of equal eigenvalues are any orthonormal ones."""
    order = len(matrix)
    if order > MAX_ORDER:
        raise ValueError(f"a matrix of order {order} is too large to go to every task")
    diagonal, beside = tridiagonal(matrix)
    intervals = _intervals(diagonal, beside, wanted)
    if not intervals:
        return np.zeros(0), np.zeros((order, 0))
    rng = np.random.default_rng(seed)
    scale = max(own.high for own in intervals)
    for own in intervals:
        own.block = rng.standard_normal((order, min(order, 2 * own.count + 4)))
    sent = spark.sparkContext.broadcast(matrix)
    try:
        for _ in range(ROUNDS):
            todo = [own for own in intervals if own.pairs is None]
            if not todo:
                break
            for own, block in zip(todo, _project(spark, sent, todo), strict=True):
                basis, _ = np.linalg.qr(block)
                values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
                vectors = basis @ turn
                inside = (values > own.low) & (values <= own.high)
                residual = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
                own.block, own.tried = vectors, own.tried + 1
                if inside.sum() == own.count and residual.max(initial=0) <= RESIDUAL * order * scale:
                    own.pairs = values[inside], vectors[:, inside]
                elif own.tried % 8 == 0:  # a wider block, where eigenvalues crowd around the interval
                    more = rng.standard_normal((order, min(order, 2 * vectors.shape[1]) - vectors.shape[1]))
                    own.block = np.hstack((vectors, more))
        else:
            raise RuntimeError("an interval did not yield as many pairs as its inertia counts")
    finally:
        sent.unpersist()
    found = np.hstack([own.pairs[1] for own in intervals])
    basis, _ = np.linalg.qr(found)
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    falling = np.argsort(-values)[:wanted]
    return values[falling], (basis @ turn)[:, falling]
