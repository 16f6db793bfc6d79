"""Reports on the night of stay.

They share one shape: lines meet their headers first, which moves them once at most, and shrink to a row per booking and
period where they then lie, as the rows of a booking lie together already. So counting bookings needs no second shuffle.
AQE splits a booking that owns much of the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.dates import month_bounds
from stayline.functions.rules import BOOKING_KEY, not_unconfirmed_hold, percent, ratio, round2
from stayline.vocabulary import INTERNAL_PROPERTIES, PIVOT_PROPERTIES, PMS, Vocabulary


def in_categories(lines: DataFrame, room_types: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Lines whose room type the dimension files under one of the categories."""
    wanted = room_types.where(F.col("category").isin(*categories)).select("room_type")
    return lines.join(wanted, "room_type", "left_semi")


def _per_booking(lines: DataFrame, headers: DataFrame, *period: Column) -> DataFrame:
    """One row per booking and period, with the columns of its header."""
    more = [column for column in headers.columns if column not in BOOKING_KEY]
    return lines.join(headers, BOOKING_KEY).groupBy(*BOOKING_KEY, *period, *more).agg(
        F.sum("total").alias("revenue"), F.count("*").alias("nights"), F.sum("quantity").alias("quantity")
    )


def _by_stay_month(lines: DataFrame, headers: DataFrame) -> DataFrame:
    return _per_booking(lines, headers, F.year("stay_date").alias("year"), F.month("stay_date").alias("month"))


def _headers(bookings: DataFrame, vocab: Vocabulary, *columns: str) -> DataFrame:
    return bookings.where(not_unconfirmed_hold(vocab)).select(*BOOKING_KEY, "property_id", *columns)


def _in_area(headers: DataFrame, channels: DataFrame, area: str) -> DataFrame:
    wanted = channels.where(F.col("area") == area).select("channel")
    return headers.join(wanted, "channel", "left_semi")


def _occupancy(lines: DataFrame, headers: DataFrame, properties: DataFrame) -> DataFrame:
    totals = (
        _by_stay_month(lines, headers)
        .groupBy("property_id", "year", "month")
        .agg(F.sum("revenue").alias("revenue"), F.count("*").alias("bookings"))
    )
    names = properties.select("property_id", F.col("name").alias("property"))
    return totals.join(names, "property_id").select("property_id", "property", "year", "month", "revenue", "bookings")


def occupancy_total(
    lines: DataFrame, bookings: DataFrame, properties: DataFrame, room_types: DataFrame, vocab: Vocabulary = PMS
) -> DataFrame:
    """Lodging revenue and bookings per property and month of stay."""
    return occupancy_by_category(lines, bookings, properties, room_types, [vocab.lodging], vocab)


def occupancy_by_category(
    lines: DataFrame, bookings: DataFrame, properties: DataFrame, room_types: DataFrame,
    categories: Sequence[str] | None = None, vocab: Vocabulary = PMS,
) -> DataFrame:
    """The same for chosen room categories, lodging and tents by default."""
    wanted = in_categories(lines, room_types, categories or [vocab.lodging, vocab.tent])
    return _occupancy(wanted, _headers(bookings, vocab), properties)


def occupancy_reservations_desk(
    lines: DataFrame, bookings: DataFrame, properties: DataFrame, channels: DataFrame, room_types: DataFrame,
    vocab: Vocabulary = PMS,
) -> DataFrame:
    """Lodging sold through the reservations desk's channels."""
    wanted = in_categories(lines, room_types, [vocab.lodging])
    headers = _in_area(_headers(bookings, vocab, "channel"), channels, vocab.desk_area)
    return _occupancy(wanted, headers, properties)


def paid_partner_split(
    lines: DataFrame, bookings: DataFrame, channels: DataFrame, room_types: DataFrame, vocab: Vocabulary = PMS
) -> DataFrame:
    """Room-nights and revenue of paying guests against partner redemptions, per property and month of stay."""
    wanted = in_categories(lines, room_types, [vocab.lodging])
    areas = channels.select("channel", "area")
    headers = _headers(bookings, vocab, "channel").join(areas, "channel")
    partner = F.col("area") == vocab.partner_area
    paid = F.col("area") != vocab.partner_area
    totals = (
        _by_stay_month(wanted, headers)
        .groupBy("property_id", "month", "year")
        .agg(
            F.sum("nights").alias("nights"),
            F.sum("revenue").alias("revenue"),
            F.coalesce(F.sum(F.when(paid, F.col("nights"))), F.lit(0)).alias("paid_nights"),
            F.sum(F.when(paid, F.col("revenue"))).alias("paid_revenue"),
            F.coalesce(F.sum(F.when(partner, F.col("nights"))), F.lit(0)).alias("partner_nights"),
            F.sum(F.when(partner, F.col("revenue"))).alias("partner_revenue"),
        )
    )
    return totals.withColumns(
        {
            f"{side}_{measure}_pct": percent(F.col(f"{side}_{measure}"), F.col(measure))
            for side in ("paid", "partner")
            for measure in ("nights", "revenue")
        }
    )


def agent_by_property(
    lines: DataFrame, bookings: DataFrame, properties: DataFrame, channels: DataFrame, room_types: DataFrame,
    agents: DataFrame, vocab: Vocabulary = PMS,
) -> DataFrame:
    """Lodging revenue and quantity per agent and property, by month of stay, for the reservations desk's channels.

    Agents are told apart by id; the dimension only lends its name, so an agent it lacks still shows.
    """
    wanted = in_categories(lines, room_types, [vocab.lodging])
    headers = _in_area(_headers(bookings, vocab, "channel", "agent_src_id"), channels, vocab.desk_area)
    totals = (
        _by_stay_month(wanted, headers)
        .groupBy("agent_src_id", "property_id", "month", "year")
        .agg(F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity"))
    )
    properties = properties.select("property_id", F.col("name").alias("property"))
    agents = agents.select("agent_src_id", "agent_name")
    return totals.join(properties, "property_id").join(agents, "agent_src_id", "left")


def daily_occupancy_pivot(
    lines: DataFrame, bookings: DataFrame, properties: DataFrame, room_types: DataFrame, as_of: dt.date,
    property_ids: Sequence[int] = PIVOT_PROPERTIES, excluded: Sequence[int] = INTERNAL_PROPERTIES,
    lodging_only: bool = True, exclude_holds: bool = True, vocab: Vocabulary = PMS,
) -> DataFrame:
    """One row per night of the current month, with revenue, room-nights and occupancy of each listed property."""
    first, following = month_bounds(as_of)
    month = lines.where((F.col("stay_date") >= first) & (F.col("stay_date") < following))
    if lodging_only:
        month = in_categories(month, room_types, [vocab.lodging])
    headers = bookings.where(~F.col("property_id").isin(*excluded))
    if exclude_holds:
        headers = headers.where(not_unconfirmed_hold(vocab))
    nights = _per_booking(month, headers.select(*BOOKING_KEY, "property_id"), F.col("stay_date"))
    daily = nights.groupBy("stay_date", "property_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("nights").alias("nights")
    )
    daily = daily.join(properties.select("property_id", "room_count"), "property_id")

    def block(property_id: int) -> list[Column]:
        here = F.col("property_id") == property_id
        sold = F.coalesce(F.sum(F.when(here, F.col("nights"))), F.lit(0))
        rooms = F.max(F.when(here, F.col("room_count")))
        return [
            F.sum(F.when(here, F.col("revenue"))).alias(f"p{property_id}_revenue"),
            sold.alias(f"p{property_id}_nights"),
            percent(sold, rooms).alias(f"p{property_id}_occupancy_pct"),
        ]

    columns = [column for property_id in property_ids for column in block(property_id)]
    return daily.groupBy("stay_date").agg(*columns).orderBy("stay_date")


def same_month_by_year(
    lines: DataFrame, bookings: DataFrame, month: int, years: Sequence[int], vocab: Vocabulary = PMS
) -> DataFrame:
    """One month side by side over several years, per property, with the growth of the last year over the one before."""
    day = F.col("stay_date")
    # later years count for no column but keep a property in the list; a range per year prunes every other month
    inside = (day >= dt.date(max(years) + 1, 1, 1)) & (F.month(day) == month)
    for year in range(min(years), max(years) + 1):
        first, following = month_bounds(dt.date(year, month, 1))
        inside |= (day >= first) & (day < following)
    nights = _per_booking(lines.where(inside), _headers(bookings, vocab), F.year(day).alias("year"))

    def of_year(column: str, year: int) -> Column:
        return F.sum(F.when(F.col("year") == year, F.col(column)).otherwise(0))

    columns = []
    for year in years:
        columns += [of_year("revenue", year).alias(f"revenue_{year}"), of_year("nights", year).alias(f"nights_{year}")]
    last, before = f"revenue_{years[-1]}", f"revenue_{years[-2]}"
    growth = round2((ratio(F.col(last), F.col(before)) - 1) * 100)
    return nights.groupBy("property_id").agg(*columns).withColumn("yoy_pct", growth).orderBy("property_id")


def rate_vs_network(lines: DataFrame, bookings: DataFrame, properties: DataFrame) -> DataFrame:
    """Average room-night amount of each property against the average over every room-night of the chain.

    Lines are read once: totals per booking keep those without a header, which count for the chain alone, and the chain's
    total is added up over the properties' totals.
    """
    per_booking = lines.groupBy(*BOOKING_KEY).agg(F.sum("total").alias("amount"), F.count("total").alias("counted"))
    per_property = (
        per_booking.join(bookings.select(*BOOKING_KEY, "property_id"), BOOKING_KEY, "left")
        .groupBy("property_id")
        .agg(F.sum("amount").alias("amount"), F.sum("counted").alias("counted"))
    )
    # a row per property
    chain = Window.partitionBy()
    totals = per_property.select(
        "property_id",
        ratio(F.col("amount"), F.col("counted")).alias("rate"),
        ratio(F.sum("amount").over(chain), F.sum("counted").over(chain)).alias("network"),
    )
    names = properties.select("property_id", F.col("name").alias("property"))
    return totals.join(names, "property_id").select(
        "property_id",
        "property",
        round2(F.col("rate")).alias("avg_rate"),
        round2(F.col("network")).alias("network_rate"),
        percent(F.col("rate"), F.col("network")).alias("pct_of_network"),
    )
