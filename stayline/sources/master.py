"""Hand-maintained tables: the property master and the monthly targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class DuplicateKey(ValueError):
    pass


def load_master(spark: SparkSession, path: str, schema: str, key: Sequence[str], kind: str = "csv") -> DataFrame:
    """Read a maintained table in its declared schema; a missing or repeated key is an error, as nothing downstream
    could tell which row is meant."""
    options = {"header": True, "mode": "FAILFAST"} if kind == "csv" else {}
    table = spark.read.schema(schema).format(kind).options(**options).load(path)
    return check_key(table, key, path)


def check_key(table: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """The table itself; DuplicateKey where a key is missing or repeated."""
    incomplete = F.lit(False)
    for column in key:
        incomplete = incomplete | F.col(column).isNull()
    wrong = table.groupBy(*key).count().where((F.col("count") > 1) | incomplete).limit(5).collect()
    if wrong:
        raise DuplicateKey(f"{name}: key {list(key)} missing or repeated, for example {[tuple(r)[:-1] for r in wrong]}")
    return table
