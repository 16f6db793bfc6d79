"""Business rules shared by every report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.vocabulary import PMS, Vocabulary

BOOKING_KEY = ["booking_id", "created_year"]


def not_unconfirmed_hold(vocab: Vocabulary = PMS) -> Column:
    """Drop bookings that are both unpaid and still only reserved.

    Three-valued on purpose: a reserved booking with unknown payment is dropped, too.
    """
    return ~((F.col("payment_status") == vocab.unpaid) & (F.col("booking_status") == vocab.held))


def round2(value: Column) -> Column:
    """Two decimals, half away from zero, with the same IEEE steps on every engine."""
    value = value.cast("double")
    size = F.floor(F.abs(value) * 100 + F.lit(0.5)).cast("double") / 100
    return F.when(value < 0, -size).otherwise(size)


def ratio(part: Column, whole: Column, scale: int = 1) -> Column:
    """part * scale / whole as double; null where the denominator is null or zero."""
    return part.cast("double") * scale / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return round2(ratio(part, whole, 100))
