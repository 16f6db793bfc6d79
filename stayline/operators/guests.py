"""Guest-grain and room-night-grain gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.dates import month_of
from stayline.functions.rules import BOOKING_KEY, not_unconfirmed_hold
from stayline.vocabulary import PMS, Vocabulary

PERSONAL = ["national_id", "full_name", "phone"]


def guest_metrics(bookings: DataFrame, as_of: dt.date, vocab: Vocabulary = PMS) -> DataFrame:
    """Lifetime and this-year figures per guest; the year is that of check-in, holds do not count."""
    this_year = F.year("checkin") == as_of.year
    totals = (
        bookings.where(not_unconfirmed_hold(vocab))
        .groupBy("guest_id")
        .agg(
            F.count("*").alias("bookings"),
            F.sum("booking_total").alias("spend"),
            F.min("created_at").cast("date").alias("first_sale"),
            F.max("created_at").cast("date").alias("last_sale"),
            F.count_if(this_year).alias("bookings_this_year"),
            F.sum(F.when(this_year, F.col("booking_total"))).alias("spend_this_year"),
        )
    )
    count = F.col("bookings")
    once, few, regular, many = vocab.segments
    segment = F.when(count == 1, once).when(count <= 3, few).when(count <= 9, regular).otherwise(many)
    return totals.withColumns(
        {
            "active_this_year": F.col("bookings_this_year") >= 1,
            "returning": count > 1,
            "segment": segment,
        }
    )


def stay_fact(bookings: DataFrame, properties: DataFrame, guests: DataFrame, lines: DataFrame) -> DataFrame:
    """One wide row per room-night. Header columns repeat on every night: add up `total`, never `booking_total`.

    Headers meet guests and properties first, at booking grain; lines join last, on the whole booking key.
    """
    headers = (
        bookings.join(guests.select("guest_id", *PERSONAL), "guest_id")
        .join(properties.select("property_id", F.col("name").alias("property")), "property_id")
        .select(
            *BOOKING_KEY, "property_id", "property", "guest_id", *PERSONAL, "channel", "sub_channel", "agent_name",
            "booking_status", "payment_status", "currency", "created_at", "room_nights", "booking_total",
        )
    )
    nights = lines.select(
        *BOOKING_KEY, "stay_date", "room_number", "room_type", "quantity", "unit_price", "total", "adults", "children",
    )
    return with_months(headers.join(nights, BOOKING_KEY))


def with_months(fact: DataFrame) -> DataFrame:
    """Month of sale, year and month of stay, each beside the date it is taken from. They are made of that date wherever
    rows are, so they need not move with them."""
    parts = {
        "created_at": [F.month("created_at").alias("created_month")],
        "stay_date": [F.year("stay_date").alias("stay_year"), F.month("stay_date").alias("stay_month")],
    }
    return fact.select(*[column for name in fact.columns for column in (name, *parts.get(name, []))])


def by_stay_month(fact: DataFrame) -> DataFrame:
    """Add the partition column the fact is stored by."""
    return fact.withColumn("stay_period", month_of(F.col("stay_date")))


def pii_safe(df: DataFrame, salt: str | None = None) -> DataFrame:
    """Drop what identifies a person; with a salt, a hashed id stays behind for joins."""
    if salt is None:
        return df.drop(*PERSONAL)
    hashed = F.sha2(F.concat(F.lit(salt), F.col("national_id")), 256)
    return df.withColumn("guest_hash", hashed).drop(*PERSONAL)
