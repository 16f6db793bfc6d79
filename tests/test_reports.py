import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.operators import contacts, guests, occupancy, production
from stayline.operators.conform import backfill_headers
from stayline.vocabulary import PMS
from tests.conftest import day, rows_of

D = Decimal


@pytest.fixture(scope="module")
def w(spark):
    """A small warehouse in the production vocabulary."""

    class Tables:
        properties = spark.createDataFrame(
            [(10, "Sea", 10), (20, "Hill", 4), (30, "Sea", 5)], "property_id int, name string, room_count int"
        )
        channels = spark.createDataFrame(
            [("AGENCIAS", PMS.desk_area), ("SOCIOS VIP", PMS.partner_area), ("WALKING", PMS.property_area)],
            "channel string, area string",
        )
        room_types = spark.createDataFrame(
            [("SUITE", PMS.lodging), ("~CARPAS", PMS.tent), ("BOX", PMS.other)], "room_type string, category string"
        )
        agents = spark.createDataFrame(
            [(1, 7, "Ana", "A"), (2, 8, "Bo", "A"), (3, 9, "Cy", "A")],
            "agent_id long, agent_src_id long, agent_name string, area string",
        )
        bookings = spark.createDataFrame(
            [
                # the same id in two years, staying in the same month of one property
                (1, 2024, 10, 1, dt.datetime(2024, 12, 30, 9), "AGENCIAS", 7, "Pagado", "Confirmado"),
                (1, 2025, 10, 2, dt.datetime(2025, 1, 2, 9), "AGENCIAS", 7, "Pagado", "Confirmado"),
                (2, 2025, 10, 2, dt.datetime(2025, 1, 2, 10), "SOCIOS VIP", 8, "Pagado", "Confirmado"),
                (3, 2025, 10, 3, dt.datetime(2025, 1, 3, 10), "AGENCIAS", 7, "No pagado", "Reservado"),
                (4, 2025, 20, 3, dt.datetime(2025, 1, 4, 10), "WALKING", 9, None, "Confirmado"),
                (5, 2025, 30, 4, dt.datetime(2025, 1, 5, 10), "AGENCIAS", 0, "No pagado", "Confirmado"),
                (6, 2025, 20, 4, dt.datetime(2025, 1, 5, 10), "AGENCIAS", 9, "Pagado", "Confirmado"),
            ],
            "booking_id long, created_year int, property_id int, guest_id long, created_at timestamp_ntz, channel string,"
            " agent_src_id long, payment_status string, booking_status string",
        )
        lines = spark.createDataFrame(
            [
                (1, 2024, day("2025-02-10"), "SUITE", 1, D("100")), (1, 2024, day("2025-02-11"), "SUITE", 1, D("100")),
                (1, 2025, day("2025-02-10"), "SUITE", 2, D("50")), (1, 2025, day("2025-02-10"), "BOX", 1, D("7")),
                (2, 2025, day("2025-02-10"), "SUITE", 1, D("0")), (3, 2025, day("2025-02-10"), "SUITE", 1, D("999")),
                (4, 2025, day("2025-02-10"), "SUITE", 1, D("0")), (4, 2025, day("2024-02-10"), "SUITE", 1, D("80")),
                (5, 2025, day("2025-02-10"), "~CARPAS", 1, D("30")), (5, 2025, day("2025-03-01"), "SUITE", 1, D("10")),
            ],
            "booking_id long, created_year int, stay_date date, room_type string, quantity int, total decimal(10,2)",
        )
        headers = backfill_headers(bookings, lines)

    return Tables


def test_namesakes_of_other_years_count_once_each(w):
    got = occupancy.occupancy_total(w.lines, w.bookings, w.properties, w.room_types)
    assert rows_of(got.where("month = 2 and year = 2025")) == [
        (10, "Sea", 2025, 2, D("250.00"), 3), (20, "Hill", 2025, 2, D("0.00"), 1),
    ]
    # properties sharing a name stay apart
    assert rows_of(got.where("month = 3")) == [(30, "Sea", 2025, 3, D("10.00"), 1)]


def test_tents_on_request(w):
    got = occupancy.occupancy_by_category(w.lines, w.bookings, w.properties, w.room_types)
    assert rows_of(got.where("property_id = 30 and month = 2"), "revenue") == [(D("30.00"),)]
    only = occupancy.occupancy_by_category(w.lines, w.bookings, w.properties, w.room_types, [PMS.tent])
    assert only.count() == 1


def test_reservations_desk_only(w):
    got = occupancy.occupancy_reservations_desk(w.lines, w.bookings, w.properties, w.channels, w.room_types)
    assert rows_of(got, "property_id", "month", "revenue", "bookings") == [(10, 2, D("250.00"), 2), (30, 3, D("10.00"), 1)]


def test_split_survives_months_without_revenue(w):
    got = occupancy.paid_partner_split(w.lines, w.bookings, w.channels, w.room_types)
    rows = {(r.property_id, r.year, r.month): r for r in got.collect()}
    sea = rows[10, 2025, 2]
    assert (sea.nights, sea.paid_nights, sea.partner_nights) == (4, 3, 1)
    assert (sea.paid_nights_pct, sea.partner_nights_pct, sea.paid_revenue_pct) == (75.0, 25.0, 100.0)
    hill = rows[20, 2025, 2]
    assert (hill.partner_nights, hill.partner_revenue, hill.paid_revenue_pct) == (0, None, None)


def test_production_is_on_the_sale_date(w):
    got = production.production(w.headers, w.properties, w.channels)
    assert rows_of(got, "property_id", "year", "month", "revenue", "bookings") == [
        (10, 2024, 12, D("200.00"), 1), (10, 2025, 1, D("57.00"), 1), (20, 2025, 1, None, 1), (30, 2025, 1, D("40.00"), 1),
    ]


def test_attainment_keeps_agents_without_target(spark, w):
    targets = spark.createDataFrame(
        [(1, 2024, 12, D("300")), (2, 2025, 1, D("0"))], "agent_id long, year int, month int, production_target decimal(12,2)"
    )
    got = production.agent_attainment(w.headers, w.agents, targets)
    assert rows_of(got, "agent_id", "year", "month", "revenue", "bookings", "attainment_pct") == [
        (1, 2024, 12, D("200.00"), 1, 66.67), (1, 2025, 1, D("57.00"), 1, None), (2, 2025, 1, D("0.00"), 1, None),
        (3, 2025, 1, D("80.00"), 2, None),
    ]


def test_daily_production(w):
    got = production.agent_daily(w.headers, w.agents, w.channels)
    assert [tuple(r) for r in got.collect()] == [
        (1, "Ana", day("2025-01-02"), 2025, 1, 2, D("57.00"), 2, 1, "1-202501"),
        (1, "Ana", day("2024-12-30"), 2024, 12, 30, D("200.00"), 2, 1, "1-202412"),
    ]
    with_holds = production.agent_daily(w.headers, w.agents, w.channels, exclude_holds=False)
    assert with_holds.where("sale_date = DATE '2025-01-03'").head().revenue == D("999.00")


def test_agent_by_property_keeps_agents_missing_from_the_dimension(w):
    got = occupancy.agent_by_property(w.lines, w.bookings, w.properties, w.channels, w.room_types, w.agents)
    assert rows_of(got, "agent_src_id", "agent_name", "property_id", "month", "revenue", "quantity") == [
        (0, None, 30, 3, D("10.00"), 1), (7, "Ana", 10, 2, D("250.00"), 4),
    ]


def test_daily_pivot(w):
    pivot = occupancy.daily_occupancy_pivot(
        w.lines, w.bookings, w.properties, w.room_types, day("2025-02-20"), [10, 20], [30]
    )
    assert [tuple(r) for r in pivot.collect()] == [
        (day("2025-02-10"), D("150.00"), 3, 30.0, D("0.00"), 1, 25.0),
        # a property that sold nothing that night shows no denominator either
        (day("2025-02-11"), D("100.00"), 1, 10.0, None, 0, None),
    ]
    everything = occupancy.daily_occupancy_pivot(
        w.lines, w.bookings, w.properties, w.room_types, day("2025-02-20"), [10], [30], False, False
    )
    assert everything.head().p10_nights == 5


def test_years_side_by_side(w):
    got = occupancy.same_month_by_year(w.lines, w.bookings, 2, [2024, 2025])
    assert [tuple(r) for r in got.collect()] == [
        (10, D("0.00"), 0, D("257.00"), 5, None), (20, D("80.00"), 1, D("0.00"), 1, -100.0),
        (30, D("0.00"), 0, D("30.00"), 1, None),
    ]


def test_rate_against_every_night_of_the_chain(w):
    got = occupancy.rate_vs_network(w.lines, w.bookings, w.properties)
    assert rows_of(got) == [
        (10, "Sea", 209.33, 137.6, 152.13), (20, "Hill", 40.0, 137.6, 29.07), (30, "Sea", 20.0, 137.6, 14.53),
    ]


def test_line_totals_equal_header_totals(w):
    assert w.lines.agg(F.sum("total")).head()[0] == w.headers.agg(F.sum("booking_total")).head()[0]


def header(n, guest, checkin, checkout, total="10", prop=10):
    return (n, 2025, prop, guest, checkin and day(checkin), checkout and day(checkout), total and D(total))


HEADERS = (
    "booking_id long, created_year int, property_id int, guest_id long, checkin date, checkout date,"
    " booking_total decimal(12,2)"
)


def test_contacts_dedup_before_dropping_bad_numbers(table):
    people = table(
        "guest_id long, national_id string, full_name string, phone string",
        (1, "A", "Perez Lopez Ana Maria", "987654321"), (2, "B", "Ruiz Bo Cy", "n/a"), (3, "B", "Other One Bad Luck", "51987654321"),
        (4, "C", "Internal Guest X Y", "987654321"), (5, "D", "Other Month X Y", "987654321"),
    )
    bookings = table(
        HEADERS,
        header(1, 1, "2025-06-01", "2025-06-13"), header(2, 1, "2025-06-02", "2025-06-14", "99"),
        header(3, 2, "2025-06-01", "2025-06-14", "50"), header(4, 3, "2025-06-01", "2025-06-14", None),
        header(5, 4, "2025-06-01", "2025-06-13", prop=999), header(6, 5, "2025-05-01", "2025-05-13"),
    )
    got = contacts.post_stay_contacts(bookings, people, day("2025-06-20"))
    assert rows_of(got) == [("51987654321", "Ana Maria")]


def stays(table, counts):
    """Guest g has counts[g] stays, some of them starting on one day."""
    rows = []
    for guest, count in counts.items():
        for i in range(count):
            start = day("2025-01-01") + dt.timedelta(days=7 * (i * 3 // 4))
            rows.append((len(rows), 2025, guest, start, start + dt.timedelta(days=2 + i % 3)))
    return table("booking_id long, created_year int, guest_id long, checkin date, checkout date", *rows)


def test_pairs_agree_with_listing_them(table):
    bookings = stays(table, {1: 1, 2: 2, 3: 3, 4: 4, 5: 9, 6: 40}).unionByName(
        table("booking_id long, created_year int, guest_id long, checkin date, checkout date", (900, 2025, 3, None, None))
    )
    all_stays = [tuple(r) for r in bookings.where("checkin is not null").collect()]
    wanted = []
    for guest in range(1, 7):
        mine = sorted((s for s in all_stays if s[2] == guest), key=lambda s: (s[3], s[0]))
        pairs = [later for later in mine for earlier in mine if earlier[3] < later[3]]
        if len(pairs) > 1:
            for later in dict.fromkeys(pairs):
                at = [i for i, p in enumerate(pairs, start=1) if p == later]
                wanted.append((guest, later[0], 2025, later[3], later[4], len(at), at[0], at[-1], len(pairs)))
    got = contacts.stay_pairs(bookings)
    assert rows_of(got) == sorted(wanted, key=repr)
    assert {row[0] for row in wanted} == {3, 4, 5, 6}


def test_pairs_are_spelled_out_where_asked_for(table):
    bookings = stays(table, {1: 1, 2: 2, 4: 5, 6: 9})
    rows = [tuple(r) for r in contacts.stays(bookings).collect()]
    every = {}
    for guest in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == guest), key=lambda r: (r[3], r[1], r[2]))
        pairs = [(e, l) for l in own for e in own if e[3] < l[3]]
        every[guest] = pairs if len(pairs) > 1 else []
    def spelled(low, high, guests):
        return sorted(((g, n, *e[1:], *l[1:], (l[3] - e[3]).days) for g in guests for n, (e, l) in enumerate(every[g], 1) if low <= n <= high), key=repr)
    assert rows_of(contacts.pair_rows(bookings, 1, 10**6)) == spelled(1, 10**6, every)
    assert rows_of(contacts.pair_rows(bookings, 3, 7)) == spelled(3, 7, every)
    assert rows_of(contacts.pair_rows(bookings, 2, 30, table("guest_id long", (6,)))) == spelled(2, 30, [6])


def test_intervals_between_consecutive_stays(table):
    got = contacts.return_intervals(stays(table, {1: 1, 2: 2, 6: 9}))
    assert got.where("guest_id = 1").count() == 0
    assert rows_of(got.where("guest_id = 2"), "stay_no", "days_between", "gap_days") == [(2, 0, -2)]
    longer = got.where("guest_id = 6").orderBy("stay_no").collect()
    assert [r.stay_no for r in longer] == list(range(2, 10))
    assert [r.days_between for r in longer] == [0, 7, 7, 7, 0, 7, 7, 7]
    assert contacts.median_return(got).head().median_days == 7.0


def test_guest_metrics(table):
    ddl = HEADERS + ", created_at timestamp_ntz, payment_status string, booking_status string"
    rows = []
    for guest, count in {1: 1, 2: 2, 3: 3, 4: 4, 9: 9, 10: 10}.items():
        for i in range(count):
            checkin = "2025-06-01" if (guest == 2 and i == 0) else "2024-06-01"
            rows.append((*header(len(rows), guest, checkin, "2025-06-02"), dt.datetime(2024, 1, 1 + i, 23), "Pagado", "Reservado"))
    rows.append((*header(99, 1, "2025-06-01", "2025-06-02"), dt.datetime(2024, 1, 1), "No pagado", "Reservado"))
    rows.append((*header(98, 50, "2025-06-01", "2025-06-02"), dt.datetime(2024, 1, 1), "No pagado", "Reservado"))
    got = {r.guest_id: r for r in guests.guest_metrics(table(ddl, *rows), day("2025-03-01")).collect()}
    assert {g: r.segment for g, r in got.items()} == dict(zip([1, 2, 3, 4, 9, 10], ["Nuevo", "Ocasional", "Ocasional", "Fiel", "Fiel", "VIP"]))
    assert [got[1].returning, got[2].returning] == [False, True]
    assert (got[1].bookings_this_year, got[1].spend_this_year, got[1].active_this_year) == (0, None, False)
    assert (got[2].bookings_this_year, got[2].spend_this_year, got[2].active_this_year) == (1, D("10.00"), True)
    assert (got[3].first_sale, got[3].last_sale) == (day("2024-01-01"), day("2024-01-03"))


def test_pii_leaves_no_person_behind(table):
    people = table("guest_id long, national_id string, full_name string, phone string, spend int", (1, "A", "B", "C", 5))
    assert guests.pii_safe(people).columns == ["guest_id", "spend"]
    hashed = guests.pii_safe(people, "salt")
    assert hashed.columns == ["guest_id", "spend", "guest_hash"] and len(hashed.head().guest_hash) == 64
