"""What the operators of this package share: input tables, intermediate tables, and batches of rows in Python."""

from __future__ import annotations

import gc
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayline.sources.store import stored, work_path

__all__ = ["blocks", "read", "release", "sized_broadcast", "stored", "tuned_for_text", "work_path"]

#: Rows handed to Python at once; a text may be long, so the batches are far below Spark's own 10,000 rows.
BATCH_ROWS = 1_000

#: Ids (eight bytes each) that may be sent to every task.
BROADCAST_IDS = 2_000_000


def tuned_for_text(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tuned_for_text(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def as_bytes(column: str = "text") -> Column:
    """Text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict | None], schema: str | StructType) -> DataFrame:
    """Apply `function` to each Arrow batch; it returns columns by name in the order of `schema`, or None."""
    target = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = function(batch)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [_array(columns[field.name], field.type) for field in target], schema=target
                )

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def blocks(total: int, size: int) -> int:
    """Number of blocks of about `size` rows that hold `total` rows, one at least."""
    return max(1, -(-total // size))


def release(spark: SparkSession) -> None:
    """Let the driver notice which shuffles are no longer needed, so that their files go before more are written. What
    Python lets go of first is noticed in the second turn."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def sized_broadcast(ids: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table of ids, to be broadcast where it is counted to be small, and to be shuffled with its partner else,
    however small its files are. `rows` spares the count where their number is known."""
    rows = ids.count() if rows is None else rows
    return F.broadcast(ids) if rows <= BROADCAST_IDS else ids.hint("merge")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return re.sub(r"\s", "_", name)
