import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.operators import conform
from stayline.sources.master import DuplicateKey
from tests.conftest import day, rows_of


def guests_of(raw):
    return conform.dedup_guests(raw).withColumn("guest_id", F.xxhash64("national_id"))


def test_guest_is_taken_from_the_first_sale(raw):
    lines = raw(
        dict(created_date_txt="02/03/2025", full_name="LATE NAME"),
        dict(created_date_txt="1/3/2025", full_name="FIRST O'NAME", phone="1"),
        dict(created_date_txt="garbage", full_name="UNDATED"),
        dict(created_date_txt="01/03/2025", full_name="TIE"),
        dict(national_id=""), dict(national_id=None), dict(national_id="X1", full_name=None),
    )
    assert rows_of(conform.dedup_guests(lines), "national_id", "full_name", "phone", "first_booking", "country") == [
        ("12345678", "First O'Name", "1", day("2025-03-01"), "Perú"),
        ("X1", None, "987654321", day("2025-01-05"), "Extranjero"),
    ]


def test_recycled_booking_ids_stay_apart(raw):
    lines = raw(
        dict(created_date_txt="05/01/2024", national_id="A"), dict(created_date_txt="05/01/2025", national_id="B"),
        dict(created_date_txt="06/01/2025", national_id="C"),
    )
    headers = conform.dedup_bookings(lines, guests_of(lines))
    assert rows_of(headers, "booking_id", "created_year") == [(1, 2024), (1, 2025)]
    assert headers.join(guests_of(lines), "guest_id").where("created_year = 2025").head().national_id == "B"


def test_sale_times_are_compared_as_times(raw):
    lines = raw(dict(created_time_txt="10:00:00", channel="ten"), dict(created_time_txt="9:05:00", channel="nine"))
    header = conform.dedup_bookings(lines, guests_of(lines)).head()
    assert (header.channel, header.created_at) == ("nine", dt.datetime(2025, 1, 5, 9, 5))


def test_header_needs_a_known_guest(raw):
    lines = raw(
        dict(created_date_txt="01/01/2025", national_id="stranger", channel="first"),
        dict(created_date_txt="02/01/2025", national_id="known", channel="second"),
        dict(booking_id=2, national_id=""),
    )
    known = guests_of(lines).where("national_id = 'known'")
    assert rows_of(conform.dedup_bookings(lines, known), "booking_id", "channel") == [(1, "second")]


def test_collisions_keep_every_line(raw):
    lines = conform.raw_lines(raw(
        dict(room_type="SUITE"), dict(room_type="FAMILIAR"), dict(room_type=None), dict(room_type="SUITE"),
        dict(room_number=None, room_type="A"), dict(room_number=None, room_type="B"),
        dict(room_number=1101, room_type="Z"), dict(stay_date_txt="11/02/2025", room_type="SUITE"),
    ))
    placed = conform.offset_collisions(lines)
    assert rows_of(placed, "room_number", "room_type", "ingest_seq") == sorted([
        (101, "FAMILIAR", 1), (1101, "SUITE", 0), (2101, "SUITE", 3), (3101, None, 2),
        (None, "A", 4), (None, "B", 5), (1101, "Z", 6), (101, "SUITE", 7),
    ], key=repr)


def test_dollars_in_any_spelling_are_converted(raw):
    spellings = ["USD", "usd", "Dolares", "dólares", "SOLES", None]
    lines = raw(*[dict(currency=c, total=Decimal("10.005")) for c in spellings])
    got = conform.to_local_currency(lines, Decimal("3.75")).orderBy("ingest_seq").collect()
    assert [r.total for r in got] == [Decimal("37.52")] * 4 + [Decimal("10.01")] * 2
    assert {r.unit_price for r in got} == {Decimal("100")}
    priced = conform.to_local_currency(lines, Decimal("3.75"), unit_price_as="unit_price_local").orderBy("ingest_seq")
    assert [r.unit_price_local for r in priced.collect()] == [Decimal("375.00")] * 4 + [Decimal("100.00")] * 2


def test_rate_as_of_takes_the_latest_known_rate(raw, table):
    sales = ["31/12/2024", "01/01/2025", "09/01/2025", "10/01/2025", "01/06/2026", "x"]
    lines = conform.raw_lines(raw(*[dict(created_date_txt=s) for s in sales]))
    rates = table("rate_date date, usd_rate decimal(6,4)", (day("2025-01-10"), Decimal("3.8")), (day("2025-01-01"), Decimal("3.7")))
    got = conform.rate_as_of(lines, rates).orderBy("ingest_seq").collect()
    assert [r.usd_rate and float(r.usd_rate) for r in got] == [None, 3.7, 3.7, 3.8, 3.8, None]
    none = conform.rate_as_of(lines, rates.where("false")).collect()
    assert {r.usd_rate for r in none} == {None} and len(none) == 6
    early = conform.rate_as_of(lines, rates, Decimal("3.5")).orderBy("ingest_seq").collect()
    assert [float(r.usd_rate) for r in early] == [3.5, 3.7, 3.7, 3.8, 3.8, 3.5]


def test_rates_of_one_day_must_be_one(raw, table):
    lines = conform.raw_lines(raw(dict()))
    twice = table("rate_date date, usd_rate decimal(6,4)", (day("2025-01-01"), Decimal("3.8")), (day("2025-01-01"), Decimal("3.7")))
    with pytest.raises(DuplicateKey):
        conform.rate_as_of(lines, twice)


def test_header_totals_come_from_lines(table):
    bookings = table("booking_id long, created_year int", (1, 2024), (1, 2025), (2, 2025))
    lines = table(
        "booking_id long, created_year int, stay_date date, total decimal(10,2)",
        (1, 2025, day("2025-02-10"), Decimal("10")), (1, 2025, day("2025-02-10"), Decimal("20")),
        (1, 2025, day("2025-02-12"), None), (1, 2024, day("2025-02-11"), Decimal("5")), (1, 2024, None, Decimal("1")),
    )
    got = {(r.booking_id, r.created_year): tuple(r)[2:] for r in conform.backfill_headers(bookings, lines).collect()}
    assert got[1, 2025] == (3, Decimal("30.00"), day("2025-02-10"), day("2025-02-13"), 2)
    assert got[1, 2024] == (2, Decimal("6.00"), day("2025-02-11"), day("2025-02-12"), 1)
    assert got[2, 2025] == (None,) * 5


def test_lines_stay_with_their_header(table):
    lines = table("booking_id long, created_year int, n int", (1, 2024, 1), (1, 2025, 2), (2, 2025, 3))
    assert rows_of(conform.keep_with_header(lines, lines.where("n = 2")), "n") == [(2,)]


def test_date_parts(table):
    frame = conform.add_date_parts(table("stay_date date", (day("2025-02-10"),), (None,)))
    assert rows_of(frame, "day", "month", "year") == [(10, 2, 2025), (None, None, None)]
