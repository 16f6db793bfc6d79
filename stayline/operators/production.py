"""Reports on the date of sale.

Revenue is read from the headers, whose totals were filled from their lines; no line is joined here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.rules import not_unconfirmed_hold, percent
from stayline.vocabulary import PMS, Vocabulary


def _sales_months(bookings: DataFrame, *keys: str) -> DataFrame:
    return bookings.groupBy(*keys, F.year("created_at").alias("year"), F.month("created_at").alias("month")).agg(
        F.sum("booking_total").alias("revenue"), F.count("*").alias("bookings")
    )


def _in_area(bookings: DataFrame, channels: DataFrame, area: str) -> DataFrame:
    wanted = channels.where(F.col("area") == area).select("channel")
    return bookings.join(wanted, "channel", "left_semi")


def production(
    bookings: DataFrame, properties: DataFrame, channels: DataFrame, vocab: Vocabulary = PMS
) -> DataFrame:
    """Revenue and bookings the reservations desk sold, per property and month of sale."""
    sold = _sales_months(
        _in_area(bookings.where(not_unconfirmed_hold(vocab)), channels, vocab.desk_area), "property_id"
    )
    names = properties.select("property_id", F.col("name").alias("property"))
    return sold.join(names, "property_id")


def agent_attainment(
    bookings: DataFrame, agents: DataFrame, targets: DataFrame, vocab: Vocabulary = PMS
) -> DataFrame:
    """Sales of each agent and month against the target; agents without one stay, with null attainment."""
    sold = _sales_months(bookings.where(not_unconfirmed_hold(vocab)), "agent_src_id")
    named = sold.join(agents.select("agent_id", "agent_src_id", "agent_name", "area"), "agent_src_id")
    return named.join(targets, ["agent_id", "year", "month"], "left").select(
        "agent_id",
        "agent_name",
        "area",
        "year",
        "month",
        "revenue",
        "bookings",
        "production_target",
        percent(F.col("revenue"), F.col("production_target")).alias("attainment_pct"),
    )


def agent_daily(
    bookings: DataFrame, agents: DataFrame, channels: DataFrame, exclude_holds: bool = True,
    vocab: Vocabulary = PMS,
) -> DataFrame:
    """Daily sales of each agent through the reservations desk's channels, newest first.

    `agent_month` is the single-column key BI tools relate to monthly targets.
    """
    sold = bookings.where(F.col("room_nights").isNotNull())
    if exclude_holds:
        sold = sold.where(not_unconfirmed_hold(vocab))
    daily = (
        _in_area(sold, channels, vocab.desk_area)
        .groupBy("agent_src_id", F.to_date("created_at").alias("sale_date"))
        .agg(
            F.sum("booking_total").alias("revenue"),
            F.sum("room_nights").alias("room_nights"),
            F.count("*").alias("bookings"),
        )
    )
    day = F.col("sale_date")
    month = F.concat(F.year(day), F.lpad(F.month(day).cast("string"), 2, "0"))
    return (
        daily.join(agents.select("agent_id", "agent_src_id", "agent_name"), "agent_src_id")
        .select(
            "agent_id",
            "agent_name",
            "sale_date",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            "revenue",
            "room_nights",
            "bookings",
            F.concat_ws("-", F.col("agent_id"), month).alias("agent_month"),
        )
        .orderBy(day.desc_nulls_last())
    )
