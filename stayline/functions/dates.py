"""Dates arrive as DD/MM/YYYY text and times as HH:MM:SS text."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    """Null for anything that is no real date; one-digit days and months are accepted."""
    return F.try_to_date(text, "d/M/yyyy")


def seconds_of_day(text: Column) -> Column:
    """Seconds after midnight of an H:MM or H:MM:SS text; null where the text is no time of day."""
    pattern = r"\A([01]?[0-9]|2[0-3]):([0-5][0-9])(?::([0-5][0-9]))?\z"

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("int")

    return part(1) * 3600 + part(2) * 60 + F.coalesce(part(3), F.lit(0))


def moment(day: Column, seconds: Column) -> Column:
    """Zone-less timestamp from a date and its seconds after midnight."""
    zero = F.lit(0)
    return day.cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def month_of(day: Column) -> Column:
    """YYYYMM as an integer."""
    return F.year(day) * 100 + F.month(day)


def today_in(zone: str) -> dt.date:
    """The calendar day at the properties, for callers that want a live `as_of`."""
    return dt.datetime.now(ZoneInfo(zone)).date()


def month_bounds(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the month and first day of the next one."""
    first = as_of.replace(day=1)
    following = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return first, following
