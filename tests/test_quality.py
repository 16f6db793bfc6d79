import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.operators import quality, validation
from stayline.operators.validation import MaxLength, NotNull, References, Unique
from tests.conftest import day

NOW = dt.datetime(2025, 3, 10, 12)
RUNS = "run_id long, process string, status string, started_at timestamp_ntz"


@pytest.fixture
def sound(raw, table):
    """A warehouse no check complains about."""
    return dict(
        raw=raw(dict(booking_id=1), dict(booking_id=1), dict(booking_id=2), dict(booking_id=3, national_id=""),
                dict(booking_id=4, property_id=77)),
        guests=table("guest_id long, national_id string", (1, "12345678"), (2, "X")),
        bookings=table(
            "booking_id long, created_year int, property_id int, guest_id long, channel string, agent_src_id long,"
            " booking_total decimal(12,2), checkin date, checkout date",
            (1, 2025, 10, 1, "AGENCIAS", 7, Decimal("150000"), day("2025-02-10"), day("2025-02-11")),
            (2, 2025, 10, 1, None, None, None, None, None),
        ),
        lines=table(
            "booking_id long, created_year int, room_type string, unit_price decimal(10,2), total decimal(10,2)",
            (1, 2025, "SUITE", Decimal("0"), Decimal("0")), (2, 2025, None, None, None),
        ),
        properties=table("property_id int, city string", (10, "Lima")),
        channels=table("channel string", ("AGENCIAS",)),
        agents=table("agent_src_id long", (7,)),
        room_types=table("room_type string", ("SUITE",)),
        runs=table(RUNS, (1, "build_silver", "OK", NOW - dt.timedelta(hours=5)), (2, "other", "ERROR", NOW)),
        as_of=NOW,
    )


def report(tables):
    return {r.check_no: (r.found, r.status) for r in quality.health_report(**tables).collect()}


def test_nothing_to_report(sound):
    got = report(sound)
    assert sorted(got) == list(range(1, 14))
    assert got.pop(8) == (1, "OK")
    assert set(got.values()) == {(0, "OK")}


def replaced(sound, name, sql):
    sound[name].createOrReplaceTempView("t")
    return {**sound, name: sound[name].sparkSession.sql(sql)}


FAULTS = [
    (1, "guests", "SELECT * FROM t WHERE guest_id <> 1", (2, "WARN")),
    (2, "lines", "SELECT * FROM t UNION ALL SELECT 1, 2024, 'SUITE', 1, 1", (1, "CRITICAL")),
    (3, "lines", "SELECT booking_id, created_year, room_type, unit_price - 1 AS unit_price, total FROM t", (1, "WARN")),
    (3, "lines", "SELECT t.* EXCEPT (total), CAST(-1 AS DECIMAL(10,2)) AS total FROM t, range(3)", (6, "CRITICAL")),
    (4, "guests", "SELECT guest_id, 'X' AS national_id FROM t", (1, "CRITICAL")),
    (5, "properties", "SELECT 10 AS property_id, CAST(NULL AS STRING) AS city", (1, "WARN")),
    (5, "properties", "SELECT CAST(id AS INT) AS property_id, CAST(NULL AS STRING) AS city FROM range(9, 12)", (3, "CRITICAL")),
    (6, "channels", "SELECT 'SOCIOS VIP' AS channel", (1, "WARN")),
    (7, "bookings", "SELECT t.* EXCEPT (property_id), 11 AS property_id FROM t", (2, "CRITICAL")),
    (9, "bookings", "SELECT t.* EXCEPT (booking_total), booking_total + 1 AS booking_total FROM t", (1, "WARN")),
    (10, "bookings", "SELECT t.* EXCEPT (checkout), checkin - INTERVAL 1 DAY AS checkout FROM t", (1, "CRITICAL")),
    (11, "agents", "SELECT 8L AS agent_src_id", (1, "CRITICAL")),
    (12, "room_types", "SELECT 'BOX' AS room_type", (1, "CRITICAL")),
    (13, "raw", "SELECT t.* EXCEPT (created_date_txt), concat('01/01/', 2020 + ingest_seq) AS created_date_txt FROM t", (1, "CRITICAL")),
]


@pytest.mark.parametrize("number,name,sql,wanted", FAULTS, ids=[f"{f[0]}-{f[1]}-{f[3][1]}" for f in FAULTS])
def test_every_check_fires(sound, number, name, sql, wanted):
    assert report(replaced(sound, name, sql))[number] == wanted


@pytest.mark.parametrize("runs,wanted", [
    ([], quality.NEVER_RUN),
    ([(1, "build_silver", "OK", NOW - dt.timedelta(days=1)), (2, "build_silver", "ERROR", NOW)], quality.LAST_FAILED),
    ([(1, "build_silver", "OK", NOW - dt.timedelta(days=2, seconds=1))], quality.STALE),
    ([(1, "build_silver", "ERROR", NOW - dt.timedelta(days=1)), (2, "build_silver", "OK", NOW)], quality.OK),
])
def test_last_build(table, runs, wanted):
    row = quality.last_build(table(RUNS, *runs), NOW).head()
    assert (row.check_no, row.found, row.status) == (8, 1, wanted)


def test_constraints(table):
    parents = table("p int", (1,), (2,))
    rows = table("a int, b int, name string", (1, 1, "x"), (1, 1, None), (1, 1, "toolong"), (None, 1, "y"), (None, 1, "y"), (3, 2, "z"))
    got = validation.validate(rows, [
        NotNull("a"), MaxLength("name", 3), Unique(("a", "b")), References(("a",), parents, ("p",)),
    ])
    assert {r.rule: r.violations for r in got.collect()} == {
        "not null: a": 2, "length <= 3: name": 1, "unique: a, b": 2, "references: a": 1,
    }


def test_dimension_rules(table):
    agents = table("agent_id long, agent_src_id long, agent_name string, area string", (1, 7, "Ana", "x"), (2, 7, None, "x"))
    properties = table("property_id int, name string", (10, "Sea"))
    targets = table("agent_id long, year int, month int", (1, 2025, 1), (1, 2025, 1), (9, 2025, 1))
    rules = validation.dimension_rules(agents, properties)
    found = {r.rule: r.violations for r in validation.validate(agents, rules["dim_agent"]).collect()}
    assert found["unique: agent_src_id"] == 1 and found["not null: agent_name"] == 1
    found = {r.rule: r.violations for r in validation.validate(targets, rules["agent_targets"]).collect()}
    assert found["unique: agent_id, year, month"] == 1 and found["references: agent_id"] == 1


def scans(df):
    """Table names of the file scans in a plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sorted(re.findall(r"Relation \[([a-z_]+)#", plan))


def test_every_table_is_read_once(spark, sound, folder):
    tables = {}
    for name, frame in sound.items():
        if name == "as_of":
            continue
        # the first column tells the scans apart
        frame.withColumn(f"of_{name}", F.lit(1)).select(f"of_{name}", *frame.columns).write.parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    report = quality.health_report(**tables, as_of=NOW)
    # properties are looked up by the raw lines, too
    assert scans(report) == sorted([f"of_{name}" for name in tables] + ["of_properties"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan and "CartesianProduct" not in plan
    guests = tables["guests"].withColumn("full_name", F.lit("x")).withColumn("phone", F.lit("x"))
    rules = {"guests": [Unique(("guest_id",)), NotNull("national_id")],
             "bookings": [References(("guest_id",), guests, ("guest_id",)), MaxLength("channel", 3)]}
    found = validation.validate_all({"guests": guests, "bookings": tables["bookings"]}, rules)
    assert scans(found) == ["of_bookings", "of_guests"]
    assert {(r.table_name, r.rule): r.violations for r in found.collect()} == {
        ("guests", "unique: guest_id"): 0, ("guests", "not null: national_id"): 0,
        ("bookings", "references: guest_id"): 0, ("bookings", "length <= 3: channel"): 1,
    }


def test_null_keys_are_nobodys(table):
    guests = table("guest_id long, national_id string", (None, None), (None, None), (3, "X"))
    bookings = table(
        "booking_id long, created_year int, property_id int, guest_id long, channel string, agent_src_id long,"
        " booking_total decimal(12,2), checkin date, checkout date",
        (1, 2025, None, None, None, None, None, None, None), (2, None, 10, 3, "C", 7, None, None, None),
    )
    lines = table("booking_id long, created_year int, room_type string, unit_price decimal(10,2), total decimal(10,2)",
                  (2, None, None, None, None))
    got = quality.table_checks([1, 2, 4, 6, 7, 11, 12], guests=guests, bookings=bookings, lines=lines)
    assert {r.check_no: r.found for r in got.collect()} == {1: 1, 2: 1, 4: 2, 6: 1, 7: 2, 11: 1, 12: 0}
