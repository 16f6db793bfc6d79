"""From raw room-night lines to guests, bookings and stay nights."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.dates import moment, parse_day, seconds_of_day
from stayline.functions.rules import BOOKING_KEY
from stayline.functions.text import country_of, title_case
from stayline.operators.ordered import rank_within
from stayline.sources.master import check_key
from stayline.sources.schemas import ARRIVAL, HEADER_MONEY, LINE_MONEY
from stayline.sources.store import stored
from stayline.vocabulary import PMS, Vocabulary


def _null_last(column: str) -> list[Column]:
    """Two fields that make a smallest-struct pick prefer any value over null."""
    return [F.col(column).isNull().alias(f"no_{column}"), F.col(column)]


def with_parsed(raw: DataFrame) -> DataFrame:
    """Add the sale day, its seconds after midnight and the night of stay. Bronze stores them since landing, so that
    the rebuilds that follow every load parse nothing; lines from elsewhere are parsed here."""
    parsers = {
        "sale_day": ("created_date_txt", parse_day),
        "sale_seconds": ("created_time_txt", seconds_of_day),
        "stay_day": ("stay_date_txt", parse_day),
    }
    missing = {name: parser for name, parser in parsers.items() if name not in raw.columns and parser[0] in raw.columns}
    return raw.withColumns({name: parse(F.col(text)) for name, (text, parse) in missing.items()})


def with_created(raw: DataFrame) -> DataFrame:
    """Name the sale date and time of raw lines as the conformed tables do."""
    renamed = with_parsed(raw).withColumnsRenamed({"sale_day": "created_date", "sale_seconds": "created_seconds"})
    return renamed.withColumn("created_year", F.year("created_date"))


def has_national_id() -> Column:
    return F.col("national_id").isNotNull() & (F.col("national_id") != "")


def dedup_guests(raw: DataFrame, tie_break: Sequence[str] = ARRIVAL, vocab: Vocabulary = PMS) -> DataFrame:
    """One row per national id, taken from its earliest sale, so the first contact is the genuine one.

    A smallest-row aggregate rather than a window: each map task keeps one row per guest, so a placeholder id that
    fills a third of the export costs no more than any other.
    """
    first = F.struct(*_null_last("created_date"), *[F.col(c) for c in tie_break])
    return (
        with_created(raw.where(has_national_id()))
        .groupBy("national_id")
        .agg(F.min(F.struct(first.alias("at"), "full_name", "phone")).alias("first"))
        .select(
            "national_id",
            title_case(F.col("first.full_name")).alias("full_name"),
            F.col("first.phone").alias("phone"),
            F.col("first.at.created_date").alias("first_booking"),
            country_of(F.col("national_id"), vocab).alias("country"),
        )
    )


_HEADER = [
    "property_id",
    "channel",
    "sub_channel",
    "agent_name",
    "agent_src_id",
    "status_code",
    "booking_status",
    "payment_status",
    "currency",
]


def dedup_bookings(raw: DataFrame, guests: DataFrame, tie_break: Sequence[str] = ARRIVAL) -> DataFrame:
    """One header per booking id and sale year: the earliest sale whose guest is known.

    Lines of unknown guests go first, by a list of the ids that lack one, which is short or empty. The others shrink to one
    sale per booking on the map side, and only that meets the guests; sales alike in all else go by national id.
    """
    earliest = F.struct(*_null_last("created_date"), *_null_last("created_seconds"), *[F.col(c) for c in tie_break])
    sold = raw.where(has_national_id())
    ids = guests.groupBy("national_id").agg(F.min(F.struct("guest_id")).alias("guest"))
    unknown = stored(sold.select("national_id").distinct().join(ids, "national_id", "left_anti"), "unknown-guests")
    sale = F.struct(earliest.alias("at"), F.struct(*_HEADER).alias("header"), "national_id")
    picked = (
        with_created(sold.join(unknown, "national_id", "left_anti"))
        .groupBy(*BOOKING_KEY)
        .agg(F.min(sale).alias("sale"))
        .withColumn("national_id", F.col("sale.national_id"))
    )
    header = {name: F.col(f"sale.header.{name}") for name in _HEADER}
    header["agent_name"] = title_case(header["agent_name"])
    return picked.join(ids, "national_id").select(
        *BOOKING_KEY,
        header["property_id"].alias("property_id"),
        F.col("guest.guest_id").alias("guest_id"),
        moment(F.col("sale.at.created_date"), F.col("sale.at.created_seconds")).alias("created_at"),
        *[header[name].alias(name) for name in _HEADER[1:]],
    )


def offset_collisions(
    lines: DataFrame,
    tie_break: Sequence[str] = ARRIVAL,
    keys: Sequence[str] = ("stay_date", *BOOKING_KEY, "room_number"),
    line_id: str | None = None,
) -> DataFrame:
    """Keep every line of a room billed more than once a night: the nth one moves to room + 1000 * (n - 1).

    Lines without a room number have nothing to move and keep it null. `line_id` names a column for a dense number of
    all lines in the same order, which costs nothing more.
    """
    order = [F.col("room_type").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    numbered = rank_within(lines, keys, order, "_nth", position=line_id)
    moved = (F.col("room_number") + 1000 * (F.col("_nth") - 1)).cast("int")
    return numbered.withColumn("room_number", moved).drop("_nth")


def is_dollar(vocab: Vocabulary = PMS) -> Column:
    return F.upper("currency").isin(*vocab.usd_spellings)


def to_local_currency(
    lines: DataFrame, rate: Decimal | Column, money: str = LINE_MONEY, vocab: Vocabulary = PMS,
    unit_price_as: str | None = None,
) -> DataFrame:
    """Bring dollar totals to local currency; unknown currencies count as local.

    The unit price keeps its currency, unless `unit_price_as` names a column for its converted value. `rate` is one
    rate for the run or a column, such as the one `rate_as_of` adds.
    """
    factor = rate if isinstance(rate, Column) else F.lit(Decimal(rate))

    def local(amount: str) -> Column:
        return F.when(is_dollar(vocab), F.col(amount) * factor).otherwise(F.col(amount)).cast(money)

    converted = {"total": local("total")}
    if unit_price_as:
        converted[unit_price_as] = local("unit_price")
    return lines.withColumns(converted)


def rate_as_of(
    lines: DataFrame, rates: DataFrame, before: Decimal | None = None, sale_date: str = "created_date"
) -> DataFrame:
    """Add `usd_rate`, the latest rate on or before the sale date; `before` serves the sales before the first one.

    `rates` has one row per `rate_date`, which is checked, so it is never longer than the calendar. It is stretched to
    one row per day up to the newest rate, which turns the as-of match into an equality join; the newest stays open.
    """
    known = check_key(rates.select("rate_date", "usd_rate").where("rate_date IS NOT NULL"), ["rate_date"], "rates")
    following = F.lead("rate_date").over(Window.orderBy("rate_date"))
    spans = known.withColumn("_until", F.date_sub(following, 1)).where("_until IS NOT NULL")
    daily = spans.select(F.explode(F.sequence("rate_date", "_until")).alias(sale_date), F.col("usd_rate").alias("_rate"))
    newest = known.agg(F.max("rate_date").alias("day")).scalar()
    open_rate = known.agg(F.max_by("usd_rate", "rate_date").alias("rate")).scalar()
    kind = rates.schema["usd_rate"].dataType
    dated = lines.join(daily, sale_date, "left").withColumn(
        "usd_rate",
        F.coalesce("_rate", F.when(F.col(sale_date) >= newest, open_rate), F.lit(before).cast(kind)),
    )
    return dated.select(*lines.columns, "usd_rate")


def keep_with_header(lines: DataFrame, bookings: DataFrame) -> DataFrame:
    """Lines of the bookings that have a header.

    Keys alone are compared first, once a booking, so lines stay where they are while the bookings without a header are few
    enough to send to them; Spark knows the size of that list and shuffles lines beyond its broadcast threshold.
    """
    complete = lines.where(" AND ".join(f"{key} IS NOT NULL" for key in BOOKING_KEY))
    lost = complete.select(*BOOKING_KEY).distinct().join(bookings.select(*BOOKING_KEY), BOOKING_KEY, "left_anti")
    return complete.join(stored(lost, "without-header"), BOOKING_KEY, "left_anti")


def header_totals(lines: DataFrame, money: str = HEADER_MONEY) -> DataFrame:
    """Booking-grain totals of stay lines.

    Nights are told apart by a bit each in words of 64 days: lines become a row per booking and word, and words bookings.
    Sums and bit operations need no buffer that grows. Three narrow columns of a line move, once, by booking: that serves
    both groupings and the join to headers. A booking of very many lines is a task of its own that streams through them.
    """
    lines = lines.select(*BOOKING_KEY, "stay_date", "total").repartition(*BOOKING_KEY)
    day = F.unix_date("stay_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), day.bitwiseAND(F.lit(63)))
    words = lines.groupBy(*BOOKING_KEY, F.shiftright(day, 6).alias("_word")).agg(
        F.count("*").alias("lines"),
        F.sum("total").alias("total"),
        F.min("stay_date").alias("first"),
        F.max("stay_date").alias("last"),
        F.bit_or(bit).alias("days"),
    )
    return words.groupBy(*BOOKING_KEY).agg(
        F.sum("lines").alias("room_nights"),
        F.sum("total").cast(money).alias("booking_total"),
        F.min("first").alias("checkin"),
        F.date_add(F.max("last"), 1).alias("checkout"),
        F.coalesce(F.sum(F.bit_count("days").cast("long")), F.lit(0)).alias("stay_days"),
    )


def backfill_headers(bookings: DataFrame, lines: DataFrame, money: str = HEADER_MONEY) -> DataFrame:
    """Write line totals back to the headers, so header reports never join lines. Headers without lines keep nulls."""
    return bookings.join(header_totals(lines, money), BOOKING_KEY, "left")


def add_date_parts(lines: DataFrame) -> DataFrame:
    day = F.col("stay_date")
    return lines.withColumns({"day": F.dayofmonth(day), "month": F.month(day), "year": F.year(day)})


_LINE = [
    "created_date", "stay_date", "room_number", "room_type", "quantity", "total", "currency", "adults", "children",
]


def raw_lines(raw: DataFrame, carry: Sequence[str] = ARRIVAL) -> DataFrame:
    """The line half of a raw row, with its keys parsed, and whatever else the caller orders lines by."""
    lines = with_created(raw).withColumnRenamed("stay_day", "stay_date")
    return lines.select(
        *BOOKING_KEY,
        *_LINE,
        F.col("unit_price").cast(LINE_MONEY).alias("unit_price"),
        *[name for name in carry if name not in _LINE],
    )
