"""Gold snapshots, always published together."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.guests import by_stay_month, guest_metrics, stay_fact, with_months
from stayline.sources.store import new_version, publish, version_path
from stayline.vocabulary import PMS, Vocabulary


def refresh_gold(
    spark: SparkSession, bookings: DataFrame, properties: DataFrame, guests: DataFrame, lines: DataFrame, out: str,
    as_of: dt.date, vocab: Vocabulary = PMS,
) -> str:
    """Write guest metrics and the room-night fact as one version and publish both at once, so reports never mix
    two loads and readers of the former version go on undisturbed."""
    version = new_version()
    guest_metrics(bookings, as_of, vocab).write.parquet(version_path(out, version, "guest_metrics"))
    fact = by_stay_month(stay_fact(bookings, properties, guests, lines).drop("created_month", "stay_year", "stay_month"))
    with_months(fact.hint("rebalance", F.col("stay_period"))).write.partitionBy("stay_period").parquet(
        version_path(out, version, "stay_fact")
    )
    publish(spark, out, version)
    return version
