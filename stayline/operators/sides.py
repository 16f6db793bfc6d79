"""Small tables held in the plan itself.

Joins carry no broadcast hints: Spark knows the size of a stored dimension or a literal table and broadcasts it while
that stays under `spark.sql.autoBroadcastJoinThreshold`, and shuffles it beyond.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def literal(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A table of known rows, whose exact size the planner sees."""
    types = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = to_arrow_schema(types)
    columns = [pa.array([row[at] for row in rows], type=field.type) for at, field in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=fields), types)
