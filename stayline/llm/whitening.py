"""Whitening of embeddings: vectors are made integers, centred, and written in the leading components of their covariance,
each divided by its standard deviation.

Sums are exact. The covariance is added up from centred blocks, one matrix per task, row by row of the matrix, so that what
meets in one place depends on the number of dimensions alone. Its leading pairs come from `feast`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.feast import largest_pairs
from stayline.llm.tables import read, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond this have no place on the integer grid and count as not finite.
LARGEST = float(1 << 40)
#: Matrices of tasks are added up in so many heaps before the heaps are.
HEAPS = 32
_LONG = (1 << 63) - 1


@dataclass
class Fit:
    """What the vectors have in common: their number, exact sums per dimension, leading eigenvalues (falling) and vectors as
    columns, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        # whole and fractional parts apart, as sums may exceed what a double holds
        return np.array([total // self.n + total % self.n / self.n for total in self.sums])


def _finite(entry: Column) -> Column:
    return entry.isNotNull() & ~F.isnan(entry) & (F.abs(entry) < LARGEST)


def integer_vectors(rows: DataFrame, vector: str = "embedding", name: str = "vec_id") -> DataFrame:
    """(vec_id, x) of the rows whose vector is there, is finite throughout, and has as many entries as most vectors (more
    entries win a tie). An empty vector counts as none."""
    entries = F.col(vector).cast("array<double>")
    whole = rows.select(F.col(name).alias("vec_id"), entries.alias("entries"))
    # a null entry is not finite: the test is false for it, never null
    valid = whole.where(F.size("entries") > 0).where(F.forall("entries", _finite))
    common = valid.groupBy(F.size("entries").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).head()
    grid = F.transform("entries", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT).cast("long"))
    return valid.where(F.size("entries") == (common["d"] if common else 0)).select("vec_id", grid.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("x"))
    return lists.flatten().to_numpy().reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch)
            if len(x):
                n, total = n + len(x), x.sum(axis=0) + (0 if total is None else total)
        if n:
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "sums": pa.array([total.tolist()], pa.list_(pa.int64()))})

    parts = vectors.select("x").mapInArrow(add, "n bigint, sums array<bigint>")
    cells = parts.select("n", F.posexplode("sums").alias("at", "value")).groupBy("at")
    # decimal, as the sum over all tasks may exceed a long
    rows = cells.agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).orderBy("at").collect()
    return (int(rows[0]["n"]) if rows else 0), [int(row["value"]) for row in rows]


def _covariance(vectors: DataFrame, n: int, mean: np.ndarray) -> np.ndarray:
    order = len(mean)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch)
            if len(x):
                centred = x - mean
                total = centred.T @ centred + (0 if total is None else total)
        if total is not None:
            heap = TaskContext.get().partitionId() % HEAPS
            columns = {"row": np.arange(order, dtype=np.int32), "heap": np.full(order, heap, np.int32), "sums": list(total)}
            yield pa.RecordBatch.from_pydict({**columns, "sums": pa.array([r.tolist() for r in total], pa.list_(pa.float64()))})

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(order)
        for part in frame["sums"]:
            total += part
        return pd.DataFrame({"row": [frame["row"].iloc[0]], "heap": [np.int32(0)], "sums": [total]})

    schema = "row int, heap int, sums array<double>"
    parts = vectors.select("x").mapInArrow(products, schema)
    heaps = parts.groupBy("row", "heap").applyInPandas(lambda frame: summed(frame), schema)
    rows = heaps.groupBy("row").applyInPandas(lambda frame: summed(frame), schema).collect()
    matrix = np.zeros((order, order))
    for row in rows:
        matrix[row["row"]] = row["sums"]
    return (matrix + matrix.T) / (2 * n)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit:
    """Leading components of (x) vectors of equal length; none where all vectors are equal or there are none."""
    n, sums = _sums(vectors)
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    found = Fit(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    matrix = _covariance(vectors, n, found.mean)
    found.trace = float(np.trace(matrix))
    found.values, found.vectors = largest_pairs(vectors.sparkSession, matrix, components)
    return found


def whitened(vectors: DataFrame, found: Fit) -> DataFrame:
    """vec_id, deviation (null where it exceeds a long) and w, the coordinates of each vector."""
    mean, scaled = (found.mean, found.vectors / np.sqrt(found.values)) if found.n else (np.zeros(0), np.zeros((0, 0)))
    n, sums = found.n, found.sums

    def deviations(x: np.ndarray) -> list[int | None]:
        apart = max(int(x.max()) * n - min(sums), max(sums) - int(x.min()) * n, 1)
        if len(sums) * apart**2 <= _LONG:
            return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
        return [value if value <= _LONG else None for value in exact]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            if len(x) and scaled.shape[1]:
                w = (x - mean) @ scaled
                ends = np.arange(0, w.size + 1, w.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(deviations(x), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))],
                    names=["vec_id", "deviation", "w"],
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "x").mapInArrow(project, f"vec_id {kind}, deviation bigint, w array<double>")


def identity_error(rows: DataFrame, n: int, components: int) -> float:
    """Largest entry, without sign, of the covariance of `w` minus the identity."""
    entry = lambda at: F.get("w", F.lit(at))
    means = rows.agg(*[(F.sum(entry(at)) / n).alias(f"m{at}") for at in range(components)]).head()
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    centred = lambda at: entry(at) - F.lit(means[at])
    found = rows.agg(*[(F.sum(centred(a) * centred(b)) / n).alias(f"c{a}_{b}") for a, b in pairs]).head()
    return max(abs(value - (a == b)) for value, (a, b) in zip(found, pairs, strict=True))


def whitening(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every valid vector and component.

    Rows are dropped whose vector is null, empty, holds an entry that is null, not finite or 2^40 or more, or differs in
    length from most. There are as many components as the covariance has positive eigenvalues, at most `components`; equal
    vectors only, or none, give no rows. Repeated rows and null ids each have rows. deviation is null where it exceeds a
    long. Other columns are not looked at.
    """
    vectors = integer_vectors(rows)
    found = fit(vectors, components)
    placed = stored(whitened(vectors, found), "whitened")
    # a component without variance up to rounding is none
    count = len(found.values)
    error = identity_error(placed, found.n, count) if count else 0.0
    shares = F.array(*[F.lit(float(value / found.trace)) for value in found.values]) if count else F.array().cast("array<double>")
    each = placed.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in their eight leading components."""
    return whitening(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
