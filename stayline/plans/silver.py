"""Full rebuild of the conformed layer from all of bronze."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.rules import BOOKING_KEY
from stayline.operators.conform import (
    add_date_parts,
    backfill_headers,
    dedup_bookings,
    dedup_guests,
    keep_with_header,
    offset_collisions,
    rate_as_of,
    raw_lines,
    to_local_currency,
    with_parsed,
)
from stayline.operators.keys import carried, check_append_only, keyed
from stayline.sources.schemas import ARRIVAL
from stayline.sources.store import (
    counted,
    has_published,
    new_version,
    publish,
    read_published,
    retire,
    scratch,
    version_path,
)
from stayline.vocabulary import PMS, Vocabulary

DEFAULT_RATE = Decimal("3.0")


_NIGHT = [
    *BOOKING_KEY, "stay_date", "room_number", "room_type", "quantity", "unit_price", "total", "adults", "children",
]


class SilverCounts(NamedTuple):
    guests: int
    bookings: int
    lines: int
    quarantined: int
    version: str


def split_unusable(raw: DataFrame, properties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Set aside the lines no booking can be built from, each with its reason: no booking id, no readable sale date,
    a time of sale that is no time, a stay date that is no date, or a property the master does not list. A missing time
    or stay date is none of these: the line stays, and its booking has no moment of sale or the line no night."""
    known = properties.select("property_id").distinct().withColumn("_known", F.lit(True))
    reason = (
        F.when(F.col("booking_id").isNull(), "no booking id")
        .when(F.col("sale_day").isNull(), "unreadable sale date")
        .when((F.trim("created_time_txt") != "") & F.col("sale_seconds").isNull(), "unreadable sale time")
        .when(F.col("stay_date_txt").isNotNull() & F.col("stay_day").isNull(), "unreadable stay date")
        .when(F.col("_known").isNull(), "unknown property")
    )
    # each step reads the columns it needs of bronze and looks the few properties up again; a copy of all lines costs more
    judged = with_parsed(raw).join(known, "property_id", "left").withColumn("reason", reason).drop("_known")
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())


def build_silver(
    spark: SparkSession, raw: DataFrame, properties: DataFrame, out: str, usd_rate: Decimal = DEFAULT_RATE,
    rates: DataFrame | None = None, tie_break: Sequence[str] = ARRIVAL, vocab: Vocabulary = PMS,
) -> SilverCounts:
    """Rebuild guests, bookings and stay nights into a new version and publish it when all three are complete.

    Each table is written before the next one reads it, so a lost executor costs its own tasks and not the chain
    before them. With `rates` every sale is converted at the rate of its day, sales before the first rate and all others
    at `usd_rate`. Guests keep the ids that the version published last knew them by, even those who are missing for a
    while. Rows are counted as they are written. Intermediate tables are dropped at the end, and so are all versions but
    the last two.
    """
    with scratch(spark):
        return _build(spark, raw, properties, out, usd_rate, rates, tie_break, vocab)


def _build(spark, raw, properties, out, usd_rate, rates, tie_break, vocab) -> SilverCounts:
    version = new_version()

    former = read_published(spark, out, "guest_keys") if has_published(spark, out) else None
    rows: dict[str, int] = {}

    def write(table: str, frame: DataFrame) -> DataFrame:
        path = version_path(out, version, table)
        frame, written = counted(frame)
        frame.write.parquet(path)
        rows[table] = written()
        return spark.read.schema(frame.schema).parquet(path)

    usable, unusable = split_unusable(raw, properties)
    write("quarantine", unusable)

    guests = write("guests", keyed(dedup_guests(usable, tie_break, vocab), former, "national_id", "guest_id"))
    keys = write("guest_keys", carried(former, guests, "national_id", "guest_id"))
    if former is not None:
        check_append_only(former, keys, "national_id", "guest_id")
    headers = write("_headers", dedup_bookings(usable, guests, tie_break))

    lines = raw_lines(usable, tie_break)
    if rates is None:
        lines = to_local_currency(lines, usd_rate, vocab=vocab)
    else:
        lines = to_local_currency(rate_as_of(lines, rates, usd_rate), F.col("usd_rate"), vocab=vocab).drop("usd_rate")
    # a booking's lines stay or go together, so dropping first numbers the rest no differently
    # one sort by night, booking and room gives the place among lines of a room and the line's number; files hold
    # neighbouring nights, so their min/max statistics prune scans
    kept = keep_with_header(lines, headers).select(*dict.fromkeys([*_NIGHT, *tie_break]))
    numbered = offset_collisions(kept, tie_break, line_id="line_id")
    nights = write(
        "stay_nights",
        add_date_parts(numbered).select("line_id", *_NIGHT, "day", "month", "year"),
    )
    write("bookings", backfill_headers(headers, nights).withColumn("loaded_at", F.localtimestamp()))
    counts = SilverCounts(rows["guests"], rows["bookings"], rows["stay_nights"], rows["quarantine"], version)
    publish(spark, out, version)
    retire(spark, out)
    return counts
