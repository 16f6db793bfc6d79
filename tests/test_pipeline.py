import datetime as dt
import time
from decimal import Decimal
from threading import Event, Thread

import pytest
from pyspark.sql import functions as F

from stayline.operators.keys import KeysChanged, check_append_only
from stayline.operators.quality import LAST_ABANDONED, last_build
from stayline.operators.validation import silver_rules, validate
from stayline.plans.load import run_load
from stayline.plans.runlog import RunLog, recent_runs, run_stats
from stayline.plans.silver import build_silver
from stayline.sources.bronze import land_batch, read_bronze
from stayline.sources.store import (
    child_folders,
    counted,
    publish,
    published_version,
    read_published,
    scratch,
    shared_root,
    stored,
)
from tests.conftest import day, rows_of


@pytest.fixture
def properties(table):
    return table("property_id int, name string, city string, room_count int", (10, "Sea", "Lima", 10), (20, "Hill", None, 4))


@pytest.fixture
def batch(raw):
    return raw(
        dict(booking_id=1, created_date_txt="05/01/2024", stay_date_txt="10/02/2025", national_id="A"),
        dict(booking_id=1, created_date_txt="05/01/2025", stay_date_txt="10/02/2025", currency="USD"),
        dict(booking_id=1, created_date_txt="05/01/2025", stay_date_txt="10/02/2025", room_type="~CARPAS"),
        dict(booking_id=1, created_date_txt="05/01/2025", stay_date_txt="11/02/2025", national_id=""),
        dict(booking_id=2, created_date_txt="06/01/2025", stay_date_txt="11/02/2025", national_id=None),
        dict(booking_id=3, created_date_txt="06/01/2025", stay_date_txt="31/02/2025"),
        dict(booking_id=4, created_date_txt="x", stay_date_txt="11/02/2025"),
        dict(booking_id=5, created_date_txt="06/01/2025", stay_date_txt="11/02/2025", property_id=77),
        dict(booking_id=None, created_date_txt="06/01/2025", stay_date_txt="11/02/2025"),
        dict(booking_id=6, created_date_txt="07/01/2025", stay_date_txt=None, national_id="C", agent_src_id=8),
    )


def silver_of(spark, out):
    bookings, lines = read_published(spark, out, "bookings"), read_published(spark, out, "stay_nights")
    return rows_of(read_published(spark, out, "guests")), rows_of(bookings.drop("loaded_at")), rows_of(lines)


def test_silver_from_bronze(spark, folder, batch, properties):
    land_batch(batch, f"{folder}/bronze", "b1")
    raw = read_bronze(spark, f"{folder}/bronze")
    counts = build_silver(spark, raw, properties, f"{folder}/silver", Decimal("3.75"))
    assert counts[:4] == (3, 3, 5, 4)
    bookings = read_published(spark, f"{folder}/silver", "bookings")
    lines = read_published(spark, f"{folder}/silver", "stay_nights")
    assert rows_of(bookings, "booking_id", "created_year", "room_nights", "booking_total", "checkin", "checkout", "stay_days") == [
        (1, 2024, 1, Decimal("100.00"), day("2025-02-10"), day("2025-02-11"), 1),
        (1, 2025, 3, Decimal("575.00"), day("2025-02-10"), day("2025-02-12"), 2),
        (6, 2025, 1, Decimal("100.00"), None, None, 0),
    ]
    assert lines.agg(F.sum("total")).head()[0] == bookings.agg(F.sum("booking_total")).head()[0]
    # the second item billed to a room moved aside, and the line without a guest stayed with its booking
    assert rows_of(lines.where("created_year = 2025 and booking_id = 1"), "room_number", "room_type", "stay_date") == [
        (101, "SUITE", day("2025-02-10")), (101, "SUITE", day("2025-02-11")), (1101, "~CARPAS", day("2025-02-10")),
    ]
    reasons = read_published(spark, f"{folder}/silver", "quarantine")
    assert rows_of(reasons, "reason") == [
        ("no booking id",), ("unknown property",), ("unreadable sale date",), ("unreadable stay date",),
    ]
    guests = read_published(spark, f"{folder}/silver", "guests")
    for name, frame in {"guests": guests, "bookings": bookings, "stay_nights": lines}.items():
        broken = validate(frame, silver_rules(guests, bookings, properties)[name]).where("violations > 0")
        assert broken.collect() == []


def test_a_sale_time_that_is_no_time_is_set_aside(spark, folder, raw, properties):
    lines = raw(dict(booking_id=1, created_time_txt="25:99"), dict(booking_id=2, created_time_txt=None), dict(booking_id=3))
    counts = build_silver(spark, lines, properties, f"{folder}/silver")
    assert counts[:4] == (1, 2, 2, 1)
    assert rows_of(read_published(spark, f"{folder}/silver", "quarantine"), "booking_id", "reason") == [(1, "unreadable sale time")]


def test_intermediate_tables_and_old_versions_go(spark, folder, batch, properties):
    home = f"{shared_root(spark)}/stayline/{spark.sparkContext.applicationId}"
    before = set(child_folders(spark, home))
    versions = [build_silver(spark, batch, properties, f"{folder}/silver").version for _ in range(3)]
    assert set(child_folders(spark, home)) <= before
    assert {name for name in child_folders(spark, f"{folder}/silver") if name != "_published"} == set(versions[1:])


def test_silver_twice_is_the_same_and_the_former_version_stays(spark, folder, batch, properties):
    out = f"{folder}/silver"
    first = build_silver(spark, batch, properties, out)
    before = silver_of(spark, out)
    second = build_silver(spark, batch, properties, out)
    assert first.version != second.version == published_version(spark, out)
    assert silver_of(spark, out) == before
    assert read_published(spark, out, "bookings", first.version).count() == 3


def test_guests_keep_their_ids(spark, folder, raw, properties):
    out = f"{folder}/silver"

    def ids(*national_ids):
        build_silver(spark, raw(*[dict(booking_id=n, national_id=i) for n, i in enumerate(national_ids)]), properties, out)
        return dict(rows_of(read_published(spark, out, "guests"), "national_id", "guest_id"))

    assert ids("M", "T") == {"M": 1, "T": 2}
    # a smaller id arrives and a guest is missing for a while
    assert ids("A", "Z", "T") == {"A": 3, "T": 2, "Z": 4}
    assert ids("M", "B", "A") == {"M": 1, "A": 3, "B": 5}
    assert rows_of(read_published(spark, out, "guest_keys"), "guest_id", "national_id") == [
        (1, "M"), (2, "T"), (3, "A"), (4, "Z"), (5, "B"),
    ]
    assert rows_of(read_published(spark, out, "bookings"), "booking_id", "guest_id") == [(0, 1), (1, 5), (2, 3)]


@pytest.mark.parametrize("after", [[("A", 1)], [("A", 1), ("B", 3)], [("A", 1), ("B", 2), ("C", 2)], [("A", 1), ("B", 2), ("B", 3)]])
def test_a_registry_that_changes_is_refused(table, after):
    kind = "national_id string, guest_id bigint"
    before = table(kind, ("A", 1), ("B", 2))
    check_append_only(before, table(kind, ("A", 1), ("B", 2), ("C", 3)), "national_id", "guest_id")
    with pytest.raises(KeysChanged):
        check_append_only(before, table(kind, *after), "national_id", "guest_id")


def test_rows_are_counted_as_they_are_written(spark, folder, table):
    for rows in ([(1,), (2,), (3,)], []):
        frame, written = counted(table("x int", *rows).repartition(2))
        frame.write.mode("overwrite").parquet(f"{folder}/t")
        assert written() == len(rows)
    frame, written = counted(table("x int", (1,)).where("x > 1 AND false"))
    frame.write.mode("overwrite").parquet(f"{folder}/t")
    assert written() == 0


def test_jobs_of_two_threads_drop_their_own_tables(spark, table):
    rows, begun, ended, seen = table("x int", (1,)), Event(), Event(), []

    def short():
        with scratch(spark):
            stored(rows, "short")
            begun.set()
            ended.wait(60)

    thread = Thread(target=short)
    with scratch(spark):
        thread.start()
        begun.wait(60)
        own = stored(rows, "long")
        ended.set()
        thread.join()
        seen = own.collect()
    assert len(seen) == 1


def test_room_offset_onto_a_taken_room_is_reported(spark, folder, raw, properties):
    lines = raw(dict(room_type="A"), dict(room_type="B"), dict(room_number=1101))
    build_silver(spark, lines, properties, f"{folder}/silver")
    nights = read_published(spark, f"{folder}/silver", "stay_nights")
    rules = silver_rules(nights, nights.select("booking_id", "created_year").distinct(), properties)["stay_nights"]
    broken = validate(nights, rules).where("violations > 0").collect()
    assert [(r.rule, r.violations) for r in broken] == [("unique: booking_id, created_year, stay_date, room_number", 1)]


def test_sales_are_converted_at_the_rate_of_their_day(spark, folder, raw, properties, table):
    lines = raw(dict(currency="USD", created_date_txt="05/01/2025"), dict(booking_id=2, currency="USD", created_date_txt="05/03/2025"))
    rates = table("rate_date date, usd_rate decimal(6,4)", (day("2025-01-01"), Decimal("3.5")), (day("2025-03-01"), Decimal("4")))
    build_silver(spark, lines, properties, f"{folder}/silver", rates=rates)
    assert rows_of(read_published(spark, f"{folder}/silver", "bookings"), "booking_total") == [
        (Decimal("350.00"),), (Decimal("400.00"),),
    ]


def test_load_end_to_end(spark, folder, batch, raw, properties):
    window = (day("2025-02-01"), day("2025-02-28"))

    def load(rows, batch_id):
        return run_load(spark, folder, rows, batch_id, *window, properties, day("2025-03-01"))

    first = load(batch, "b1")
    assert first.reload == (0, 10) and first.silver[:2] == (3, 3)
    again = load(batch, "b1")
    assert again.silver[:4] == first.silver[:4] and read_bronze(spark, f"{folder}/bronze").count() == 10
    agents = rows_of(read_published(spark, f"{folder}/dimensions", "dim_agent"), "agent_id", "agent_src_id")
    assert agents == [(1, 7), (2, 8)]
    fact = read_published(spark, f"{folder}/gold", "stay_fact")
    assert fact.count() == 5 and read_published(spark, f"{folder}/gold", "guest_metrics").count() == 3

    # a correction replaces the eight February lines and brings a new agent; the two undated ones of the first batch stay
    third = load(raw(dict(booking_id=9, agent_src_id=3)), "b2")
    assert third.reload.deleted == 8 and third.silver.bookings == 2
    agents = rows_of(read_published(spark, f"{folder}/dimensions", "dim_agent"), "agent_id", "agent_src_id", "active")
    assert agents == [(1, 7, True), (2, 8, True), (3, 3, True)]
    log = RunLog(spark, f"{folder}/run_log").runs()
    assert log.count() == 15 and rows_of(log.select("status").distinct()) == [("OK",)]


def test_failed_step_leaves_a_trail(spark, folder):
    log = RunLog(spark, f"{folder}/log")
    with pytest.raises(ValueError, match="broke"):
        with log.step("load_raw", "LAND") as step:
            step.rows = 5
            raise ValueError("it broke")
    with log.step("build_silver", "REBUILD", "note") as step:
        running = log.runs().where("process = 'build_silver'").head()
        assert (running.status, running.ended_at) == ("RUNNING", None)
        step.rows = 7
    runs = {r.process: r for r in log.runs().collect()}
    assert (runs["load_raw"].status, runs["load_raw"].message, runs["load_raw"].rows) == ("ERROR", "it broke", 5)
    done = runs["build_silver"]
    assert (done.status, done.message, done.rows) == ("OK", "note", 7)
    assert done.seconds > 0 and done.ended_at > done.started_at


def test_a_run_that_is_no_longer_heard_of_is_abandoned(spark, folder, monkeypatch):
    log = RunLog(spark, f"{folder}/log", lease=dt.timedelta(seconds=9))
    appended = []
    append = log._append
    monkeypatch.setattr(log, "_append", lambda *values: (append(*values), appended.append(values)))
    with log.step("build_silver", "REBUILD"):
        # the lease is renewed while the step goes on
        deadline = time.monotonic() + 60
        while len(appended) < 2 and time.monotonic() < deadline:
            time.sleep(0.2)
        begun, renewed = appended[0][-1], appended[-1][-1]
        assert renewed > begun
        state = lambda at: {r.status for r in log.runs(at).collect()}
        assert state(begun + dt.timedelta(milliseconds=1)) == {"RUNNING"}
        later = renewed + dt.timedelta(days=1)
        assert state(later) == {"ABANDONED"}
        assert last_build(log.runs(later), later).head().status == LAST_ABANDONED
    assert state(later) == {"OK"} and log.runs().head().ended_at is not None


def test_recent_runs_and_statistics(table):
    at = dt.datetime(2025, 3, 1, 8, 5, 9)
    rows = [(n, "a", "X", 1, "OK" if n % 3 else "ERROR", None, Decimal(n), at + dt.timedelta(hours=n), None) for n in range(60)]
    rows.append((99, "old", "X", 1, "OK", None, None, at - dt.timedelta(days=40), None))
    runs = table(
        "run_id long, process string, action string, rows long, status string, message string, seconds decimal(10,2),"
        " started_at timestamp_ntz, ended_at timestamp_ntz", *rows,
    )
    latest = recent_runs(runs).collect()
    assert len(latest) == 50 and latest[0].run_id == 59 and latest[0].started == "03/03/2025 19:05:09"
    stats = rows_of(run_stats(runs, at + dt.timedelta(hours=60)))
    assert stats == [("a", 60, 40, 20, 29.5, Decimal("59.00"), at + dt.timedelta(hours=59))]


def test_publication_is_the_last_step(spark, folder, table):
    table("x int", (1,)).write.parquet(f"{folder}/v1/t")
    publish(spark, folder, "v1")
    table("x int", (2,)).write.parquet(f"{folder}/v2/t")
    assert rows_of(read_published(spark, folder, "t")) == [(1,)]
    publish(spark, folder, "v2")
    assert rows_of(read_published(spark, folder, "t")) == [(2,)]
