"""Guest lists and return behaviour."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.dates import month_bounds
from stayline.functions.rules import BOOKING_KEY
from stayline.functions.text import given_names, mobile_number
from stayline.operators.ordered import rank_within
from stayline.sources.store import stored
from stayline.vocabulary import INTERNAL_PROPERTIES, SURVEY_DAYS


def post_stay_contacts(
    bookings: DataFrame, guests: DataFrame, as_of: dt.date, days: Sequence[int] = SURVEY_DAYS,
    excluded: Sequence[int] = INTERNAL_PROPERTIES,
) -> DataFrame:
    """Mobile number and given names of the guests who checked out on some days of the current month.

    Each guest counts once, with the stay of the highest total; unusable numbers are dropped after that.
    """
    first, following = month_bounds(as_of)
    checkouts = [day for day in (first + dt.timedelta(days=number - 1) for number in days) if day < following]
    left = bookings.where(F.col("checkout").isin(*checkouts) & ~F.col("property_id").isin(*excluded))
    # a null total ranks below every amount
    best = F.struct(
        F.col("booking_total").isNull(), -F.col("booking_total"), F.col("checkin").isNull(), F.col("checkin"),
        *BOOKING_KEY,
    )
    return (
        left.join(guests.select("guest_id", "national_id", "full_name", "phone"), "guest_id")
        .groupBy("national_id")
        .agg(F.min_by(F.struct("full_name", "phone"), best).alias("guest"))
        .select(
            mobile_number(F.col("guest.phone")).alias("phone"),
            given_names(F.col("guest.full_name")).alias("given_names"),
        )
        .where(F.col("phone").isNotNull())
    )


def stays(bookings: DataFrame) -> DataFrame:
    """Stays that have nights, one per booking."""
    return bookings.where(F.col("checkin").isNotNull()).select("guest_id", *BOOKING_KEY, "checkin", "checkout")


def stay_pairs(bookings: DataFrame) -> DataFrame:
    """Pairs of an earlier and a later stay of one guest, told without listing them.

    Pairing every stay with every later one grows with the square of a guest's stays. All pairs that share a later
    stay also share everything the report shows but the earlier booking, and those are simply all stays with an
    earlier check-in. So there is one row per later stay: how many stays it pairs with, and which positions its
    pairs take among the guest's pairs in order of check-in. Guests with one pair only are left out.
    """
    # set down once: the headers may be a view over all lines
    all_stays = stored(stays(bookings), "stays")
    # one row per guest and day, hence never more rows per guest than the calendar has days
    days = all_stays.groupBy("guest_id", "checkin").agg(F.count("*").alias("same_day"))
    by_day = Window.partitionBy("guest_id").orderBy("checkin")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("same_day").over(before), F.lit(0))
    days = days.withColumn("earlier_stays", earlier).withColumn("pairs", F.col("same_day") * F.col("earlier_stays"))
    days = days.withColumns(
        {
            "pairs_before": F.coalesce(F.sum("pairs").over(before), F.lit(0)),
            "guest_pairs": F.sum("pairs").over(Window.partitionBy("guest_id")),
        }
    ).where((F.col("earlier_stays") > 0) & (F.col("guest_pairs") > 1))
    numbered = rank_within(all_stays, ["guest_id", "checkin"], [F.col(key) for key in BOOKING_KEY], "_nth")
    last = F.col("pairs_before") + F.col("_nth") * F.col("earlier_stays")
    return numbered.join(days, ["guest_id", "checkin"]).select(
        "guest_id",
        *BOOKING_KEY,
        "checkin",
        "checkout",
        "earlier_stays",
        (last - F.col("earlier_stays") + 1).alias("first_pair"),
        last.alias("last_pair"),
        "guest_pairs",
    )


def pair_rows(bookings: DataFrame, low: int = 1, high: int = 10, guests: DataFrame | None = None) -> DataFrame:
    """The pairs at positions `low` to `high` of each guest, or of some guests (guest_id), as rows.

    A position among a guest's pairs tells both stays: the later one by the range it falls in, the earlier one by how far
    into the range it lies, as that is its number among the guest's stays. So only the pairs that are asked for are made.
    """
    later = stay_pairs(bookings).where((F.col("last_pair") >= low) & (F.col("first_pair") <= high))
    everyone = stays(bookings)
    if guests is not None:
        later, everyone = (rows.join(guests.select("guest_id"), "guest_id", "left_semi") for rows in (later, everyone))
    places = F.sequence(F.greatest("first_pair", F.lit(low).cast("long")), F.least("last_pair", F.lit(high).cast("long")))
    asked = later.withColumn("pair_no", F.explode(places))
    asked = asked.withColumn("stay_no", F.col("pair_no") - F.col("first_pair") + 1)
    order = [F.col("checkin"), *[F.col(key) for key in BOOKING_KEY]]
    numbered = rank_within(everyone, ["guest_id"], order, "stay_no")
    earlier = numbered.select("guest_id", "stay_no", *[F.col(name).alias(f"earlier_{name}") for name in (*BOOKING_KEY, "checkin", "checkout")])
    return asked.join(earlier, ["guest_id", "stay_no"]).select(
        "guest_id", "pair_no", *[f"earlier_{name}" for name in (*BOOKING_KEY, "checkin", "checkout")], *BOOKING_KEY, "checkin",
        "checkout", F.date_diff("checkin", "earlier_checkin").alias("days_between"),
    )


def return_intervals(bookings: DataFrame) -> DataFrame:
    """Days between consecutive stays of each guest who came back, one row per return."""
    order = [F.col("checkin"), *[F.col(key) for key in BOOKING_KEY]]
    numbered = rank_within(
        stays(bookings), ["guest_id"], order, "stay_no",
        previous={"previous_checkin": "checkin", "previous_checkout": "checkout"},
    )
    return numbered.where(F.col("stay_no") > 1).select(
        "guest_id",
        *BOOKING_KEY,
        "stay_no",
        "previous_checkin",
        "previous_checkout",
        "checkin",
        F.date_diff("checkin", "previous_checkin").alias("days_between"),
        F.date_diff("checkin", "previous_checkout").alias("gap_days"),
    )


def median_return(intervals: DataFrame) -> DataFrame:
    """Returns and the median number of days between stays. The exact median counts each distinct number of days,
    of which the calendar allows a few thousand."""
    return intervals.agg(F.count("*").alias("returns"), F.median("days_between").alias("median_days"))
