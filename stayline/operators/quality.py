"""Health checks: a count and a traffic light each.

All checks are one grouping. A pass over each table turns every row into a few tagged keys, one for each thing that is
checked of it: a line names its booking and its room type, a header names itself as a booking, and its guest, channel,
property and agent, and each dimension names its members. Keys of both sides of a reference so meet in one group, counted on
the map side, and whoever is named but not known shows without a join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Sequence
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators.conform import has_national_id, with_created

OK, WARN, CRITICAL = "OK", "WARN", "CRITICAL"
NEVER_RUN, LAST_FAILED, STALE = "WARN: never run", "CRITICAL: last run failed", "WARN: older than 2 days"
LAST_ABANDONED = "CRITICAL: last run abandoned"


class Check(NamedTuple):
    number: int
    label: str
    # counts up to this are a warning, above it critical; None never turns critical
    warn_up_to: int | None


# fixed values: labels and limits of the checks
CHECKS = [
    Check(1, "bookings of unknown guests", 10),
    Check(2, "lines without a booking", 0),
    Check(3, "lines with a negative amount", 5),
    Check(4, "repeated national ids", 0),
    Check(5, "properties without a city", 2),
    Check(6, "channels missing from the dimension", None),
    Check(7, "bookings of unknown properties", 0),
    Check(8, "last silver build", None),
    Check(9, "bookings above the amount limit", 3),
    Check(10, "check-outs before check-in", 0),
    Check(11, "agents missing from the dimension", 0),
    Check(12, "room types missing from the dimension", 0),
    Check(13, "bookings differing between bronze and silver", 0),
]
AMOUNT_LIMIT = Decimal(150_000)


def _unpivot(one_row: DataFrame, numbers: list[int]) -> DataFrame:
    """One row per check from a one-row frame with columns c<number>."""
    entries = [F.struct(F.lit(n).alias("check_no"), F.col(f"c{n}").cast("long").alias("found")) for n in numbers]
    return one_row.select(F.inline(F.array(*entries)))


def rated(counts: DataFrame) -> DataFrame:
    """Add label and status to (check_no, found)."""
    label, status = F.lit(None).cast("string"), F.lit(OK)
    for check in CHECKS:
        mine = F.col("check_no") == check.number
        label = F.when(mine, check.label).otherwise(label)
        if check.warn_up_to is None:
            status = F.when(mine & (F.col("found") > 0), WARN).otherwise(status)
        else:
            status = (
                F.when(mine & (F.col("found") > check.warn_up_to), CRITICAL)
                .when(mine & (F.col("found") > 0), WARN)
                .otherwise(status)
            )
    return counts.select("check_no", label.alias("label"), "found", status.alias("status"))


# what is grouped, and the checks that are read off it
_GUESTS, _BOOKINGS, _IDS, _CHANNELS, _PROPERTIES, _AGENTS, _TYPES, _STAGED = range(8)
_GROUPINGS = {
    1: {_GUESTS}, 2: {_BOOKINGS}, 3: {_TYPES}, 4: {_IDS}, 5: {_PROPERTIES}, 6: {_CHANNELS}, 7: {_PROPERTIES},
    9: {_CHANNELS}, 10: {_CHANNELS}, 11: {_AGENTS}, 12: {_TYPES}, 13: {_STAGED, _GUESTS},
}


def _entry(
    grouping: int, number: str | None = None, year: str | None = None, text: str | None = None, named: bool = True,
    first: Column | None = None, second: Column | None = None,
) -> Column:
    """A key that a row names or, if not, makes known, with up to two flags of the row."""
    def column(name: str | None, kind: str) -> Column:
        return (F.lit(None) if name is None else F.col(name)).cast(kind)

    def flag(value: Column | None) -> Column:
        # a flag that is null is not raised
        return F.lit(0) if value is None else F.when(value, 1).otherwise(0)

    return F.struct(
        F.lit(grouping).alias("grouping"), column(number, "bigint").alias("number"), column(year, "int").alias("year"),
        column(text, "string").alias("text"), F.lit(int(named)).alias("named"), F.lit(int(not named)).alias("known"),
        flag(first).alias("first"), flag(second).alias("second"),
    )


_Entries = dict[int, Column]


def _tagged(table: DataFrame, entries: _Entries, wanted: Collection[int]) -> list[DataFrame]:
    chosen = [entry for grouping, entry in entries.items() if grouping in wanted]
    return [table.select(F.inline(F.array(*chosen)))] if chosen else []


def _header_entries(limit: Decimal) -> _Entries:
    return {
        _GUESTS: _entry(_GUESTS, "guest_id"),
        _BOOKINGS: _entry(_BOOKINGS, "booking_id", "created_year", named=False),
        _CHANNELS: _entry(
            _CHANNELS, text="channel", first=F.col("booking_total") > F.lit(limit), second=F.col("checkout") < F.col("checkin")
        ),
        _PROPERTIES: _entry(_PROPERTIES, "property_id"),
        _AGENTS: _entry(_AGENTS, "agent_src_id"),
    }


def _line_entries() -> _Entries:
    return {
        _BOOKINGS: _entry(_BOOKINGS, "booking_id", "created_year"),
        _TYPES: _entry(_TYPES, text="room_type", first=(F.col("unit_price") < 0) | (F.col("total") < 0)),
    }


def _guest_entries() -> _Entries:
    return {_GUESTS: _entry(_GUESTS, "guest_id", named=False), _IDS: _entry(_IDS, text="national_id")}


def _counts(parts: Sequence[DataFrame], checks: Sequence[int]) -> DataFrame:
    """(check_no, found) from tagged rows of all tables that the checks look at."""
    groups = (
        reduce(DataFrame.unionAll, parts)
        .groupBy("grouping", "number", "year", "text")
        .agg(*[F.sum(name).alias(name) for name in ("named", "first", "second")], F.max("known").alias("known"))
    )
    of = lambda grouping: F.col("grouping") == grouping
    complete = (
        F.when(of(_BOOKINGS), F.col("number").isNotNull() & F.col("year").isNotNull())
        .when(F.col("grouping").isin(_IDS, _CHANNELS, _TYPES), F.col("text").isNotNull())
        .otherwise(F.col("number").isNotNull())
    )
    # a key with a null in it names nobody; as a member of a dimension it is merely missing and not counted
    lost = (F.col("known") == 0) | ~complete
    unlisted = (F.col("known") == 0) & complete & (F.col("named") > 0)
    total = lambda grouping, value, where=F.lit(True): F.sum(F.when(of(grouping) & where, value))
    found: dict[int, Callable[[], Column]] = {
        1: lambda: total(_GUESTS, F.col("named"), lost),
        2: lambda: total(_BOOKINGS, F.col("named"), lost),
        3: lambda: total(_TYPES, F.col("first")),
        # rows beyond the first of each id, and all without one
        4: lambda: total(_IDS, F.col("named") - F.when(complete, 1).otherwise(0)),
        5: lambda: total(_PROPERTIES, F.col("first")),
        6: lambda: total(_CHANNELS, F.lit(1), unlisted),
        # a booking without any property is one of an unknown property, too
        7: lambda: total(_PROPERTIES, F.col("named"), lost),
        9: lambda: total(_CHANNELS, F.col("first")),
        10: lambda: total(_CHANNELS, F.col("second")),
        11: lambda: total(_AGENTS, F.lit(1), unlisted),
        12: lambda: total(_TYPES, F.lit(1), unlisted),
        # every header names a guest once
        13: lambda: F.abs(F.coalesce(total(_STAGED, F.lit(1)), F.lit(0)) - F.coalesce(total(_GUESTS, F.col("named")), F.lit(0))),
    }
    return _unpivot(groups.agg(*[F.coalesce(found[n](), F.lit(0)).alias(f"c{n}") for n in checks]), list(checks))


def _wanted(checks: Sequence[int]) -> set[int]:
    return set().union(*[_GROUPINGS[number] for number in checks])


def _staged(raw: DataFrame, properties: DataFrame) -> DataFrame:
    """Raw lines that a header is made from: those with a guest and a known property."""
    known = properties.select("property_id")
    return with_created(raw.where(has_national_id())).join(known, "property_id", "left_semi")


def table_checks(
    checks: Sequence[int], raw: DataFrame | None = None, guests: DataFrame | None = None, bookings: DataFrame | None = None,
    lines: DataFrame | None = None, properties: DataFrame | None = None, channels: DataFrame | None = None,
    agents: DataFrame | None = None, room_types: DataFrame | None = None, amount_limit: Decimal = AMOUNT_LIMIT,
) -> DataFrame:
    """(check_no, found) of any checks but the eighth, from one pass over each table that is handed in."""
    wanted = _wanted(checks)
    tables: list[tuple[DataFrame | None, _Entries]] = [
        (guests, _guest_entries()),
        (bookings, _header_entries(amount_limit)),
        (lines, _line_entries()),
        (properties, {_PROPERTIES: _entry(_PROPERTIES, "property_id", named=False, first=F.col("city").isNull())}),
        (channels, {_CHANNELS: _entry(_CHANNELS, text="channel", named=False)}),
        (agents, {_AGENTS: _entry(_AGENTS, "agent_src_id", named=False)}),
        (room_types, {_TYPES: _entry(_TYPES, text="room_type", named=False)}),
        (None if raw is None else _staged(raw, properties), {_STAGED: _entry(_STAGED, "booking_id", "created_year")}),
    ]
    parts = [part for table, entries in tables if table is not None for part in _tagged(table, entries, wanted)]
    return _counts(parts, checks)


def last_build(runs: DataFrame, as_of: dt.datetime, process: str = "build_silver") -> DataFrame:
    """Check 8, already rated: its count is always 1, its status tells never run, failed, stale or fine."""
    started = F.max("started_at")
    last = runs.where(F.col("process") == process).agg(
        F.max_by("status", F.struct("started_at", "run_id")).alias("last_status"), started.alias("last_start")
    )
    limit = F.lit(as_of - dt.timedelta(days=2)).cast("timestamp_ntz")
    status = (
        F.when(F.col("last_start").isNull(), NEVER_RUN)
        .when(F.col("last_status") == "ERROR", LAST_FAILED)
        .when(F.col("last_status") == "ABANDONED", LAST_ABANDONED)
        .when(F.col("last_start") < limit, STALE)
        .otherwise(OK)
    )
    return last.select(
        F.lit(8).alias("check_no"), F.lit(CHECKS[7].label).alias("label"), F.lit(1).cast("long").alias("found"),
        status.alias("status"),
    )


def health_report(
    raw: DataFrame, guests: DataFrame, bookings: DataFrame, lines: DataFrame, properties: DataFrame,
    channels: DataFrame, agents: DataFrame, room_types: DataFrame, runs: DataFrame, as_of: dt.datetime,
    process: str = "build_silver", amount_limit: Decimal = AMOUNT_LIMIT,
) -> DataFrame:
    """All thirteen checks as one table, from one pass over each of the others."""
    checks = [check.number for check in CHECKS if check.number in _GROUPINGS]
    counts = table_checks(checks, raw, guests, bookings, lines, properties, channels, agents, room_types, amount_limit)
    return rated(counts).unionByName(last_build(runs, as_of, process))
