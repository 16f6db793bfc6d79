"""Numbering and looking back inside groups, for data in which one group may hold a third of all rows.

Rows are range-sorted by group and order, so a large group lies in several slices and a slice is bounded, whatever the
groups are. Each slice is numbered on its own. Only the group that reaches over the end of a slice matters to the next
one, so slices exchange one small row each: which group ends them, how many of its rows they hold, and the last row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stayline.operators.sides import literal
from stayline.sources.store import stored

# monotonically_increasing_id keeps the partition above bit 33 and the row inside the partition below it
_ROW_BITS = 33


class Edge(NamedTuple):
    """A slice as the next one sees it: its rows, its first and last groups, its last row, and the rows of the last group."""

    slice: int
    rows: int
    first: tuple
    last: tuple
    tail: tuple
    in_last: int


def _sorted_slices(
    df: DataFrame, order: Sequence[Column], name: str, passing: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Rows in order, stored, with their position and the slice it lies in, and what `passing` adds to sorted slices."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    if passing:
        ordered = passing(ordered)
    placed = stored(ordered.withColumn("_pos", F.monotonically_increasing_id()), name)
    return placed.withColumn("_slice", F.shiftright("_pos", _ROW_BITS))


def _starts(rows: Sequence[tuple[int, int]], start: int) -> list[tuple[int, int]]:
    """Number of the first row of each slice, from the slices' sizes in order."""
    starts, total = [], start
    for at, size in rows:
        starts.append((at, total))
        total += size
    return starts


def _counted_in_slice(ordered: DataFrame, keys: Sequence[str], previous: Mapping[str, str]) -> DataFrame:
    """Add `_local`, the place of a row among those of its group in its slice, and `_back_<name>`, a column of the row before
    it there. Rows already lie in order, so a slice is one pass that remembers a single row, and nothing is shuffled."""
    kinds = {f"_back_{name}": ordered.schema[source].dataType for name, source in previous.items()}
    schema = StructType([*ordered.schema.fields, StructField("_local", LongType()), *[StructField(*kind) for kind in kinds.items()]])
    keys, sources, names = list(keys), list(previous.values()), schema.names

    # a closure without names of this package, so that workers need not have it on their path
    def passes(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def differs(column):
            before, after = column.slice(0, len(column) - 1), column.slice(1)
            unlike = pc.not_equal(before, after)
            if pa.types.is_floating(column.type):
                unlike = pc.and_not(unlike, pc.and_(pc.is_nan(before), pc.is_nan(after)))
            nulls = pc.xor(pc.is_null(before), pc.is_null(after))
            return pc.coalesce(unlike, nulls).to_numpy(zero_copy_only=False)

        last, run = None, 0
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            columns = dict(zip(batch.schema.names, batch.columns))
            # the row before the first one: the last of the batch before, or any row where there is none
            led = {c: pa.concat_arrays([columns[c].slice(0, 1) if last is None else last[c], columns[c]]) for c in {*keys, *sources}}
            start = np.zeros(size, dtype=bool)
            for key in keys:
                start |= differs(led[key])
            start[0] |= last is None
            place = np.arange(size)
            begin = np.maximum.accumulate(np.where(start, place, -1))
            local = np.where(begin < 0, place + 1 + run, place - begin + 1)
            begins = pa.array(start)
            backs = [pc.if_else(begins, pa.scalar(None, led[s].type), led[s].slice(0, size)) for s in sources]
            last, run = {c: column.slice(size, 1) for c, column in led.items()}, int(local[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64()), *backs], names)

    return ordered.mapInArrow(passes, schema)


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], number: str, previous: Mapping[str, str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """Add the 1-based place of each row in its group, and columns of the row before it.

    `order` must be total inside a group, that is end in something unique. `previous` maps a new column to the column it
    takes from the preceding row. `position` names a column for the 1-based place among all rows, by keys and order.
    """
    previous = dict(previous or {})
    placed = _sorted_slices(
        df, [*[F.col(key) for key in keys], *order], "slices", lambda rows: _counted_in_slice(rows, keys, previous)
    )
    inside = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy("_slice").agg(F.max("_pos").alias("_end")).orderBy("_slice").collect()
    # of a slice only its first and last rows matter to the next one
    edges = placed.where((inside == 0) | F.col("_pos").isin([row["_end"] for row in sizes]))
    edges = edges.select("_pos", "_local", F.struct(*keys).alias("_group"), F.struct(F.lit(True), *previous.values()).alias("_tail"))
    at = {row["_pos"]: row for row in edges.collect()}
    summary = [
        Edge(row["_slice"], row["_end"] - (row["_slice"] << _ROW_BITS) + 1, tuple(at[row["_slice"] << _ROW_BITS]["_group"]),
             tuple(at[row["_end"]]["_group"]), tuple(at[row["_end"]]["_tail"])[1:], at[row["_end"]]["_local"])
        for row in sizes
    ]
    carried = _carried(summary)

    kinds = [StructField(name, df.schema[source].dataType) for name, source in previous.items()]
    starts = dict(_starts([(edge.slice, edge.rows) for edge in summary], 1))
    rows = [
        (at, starts[at], *(carried.get(at) or (None, *[None] * (len(keys) + len(previous))))) for at in starts
    ]
    schema = StructType(
        [
            StructField("_slice", LongType()), StructField("_start", LongType()), StructField("_before", LongType()),
            *[StructField(f"_key_{key}", df.schema[key].dataType) for key in keys],
            *[StructField(f"_carry_{kind.name}", kind.dataType) for kind in kinds],
        ]
    )
    # one row per slice, of known size: the planner broadcasts it while that is small
    local = placed.join(literal(df.sparkSession, rows, schema), "_slice")
    goes_on = F.col("_before").isNotNull()
    for key in keys:
        goes_on &= F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    first = (F.col("_local") == 1) & goes_on
    columns = [
        *df.columns,
        (F.when(goes_on, F.col("_before")).otherwise(0) + F.col("_local")).alias(number),
        *[F.when(first, F.col(f"_carry_{name}")).otherwise(F.col(f"_back_{name}")).alias(name) for name in previous],
    ]
    if position:
        columns.append((F.col("_start") + inside).alias(position))
    return local.select(*columns)


def _carried(summary: Sequence[Edge]) -> dict[int, tuple]:
    """For each slice whose first group began before it: rows before, the group, and the row before."""
    carried, group, count, tail = {}, None, 0, ()
    for edge in summary:
        if group is not None and edge.first == group:
            carried[edge.slice] = (count, *group, *tail)
        # a slice of one group adds to what came before it
        went_on = group is not None and edge.last == group
        group, tail = edge.last, edge.tail
        count = edge.in_last + (count if went_on else 0)
    return carried


def assign_keys(df: DataFrame, natural_key: Sequence[str], id_column: str, start: int = 1) -> DataFrame:
    """Dense integers in natural-key order, without sorting everything in one task.

    Range-sorted partitions number their own rows; the driver adds up one row count per partition.
    """
    placed = _sorted_slices(df, [F.col(key) for key in natural_key], "keys")
    counts = placed.groupBy("_slice").agg(F.count("*").alias("_rows")).orderBy("_slice").collect()
    starts = literal(df.sparkSession, _starts(counts, start), "_slice bigint, _start bigint")
    inside = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(starts, "_slice").select((F.col("_start") + inside).alias(id_column), *df.columns)
