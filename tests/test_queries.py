"""Every registered query against its oracle, and the plans behind them."""

import re

import pytest

import __spark_entry__ as driver
from checks.compare import compare, oracle_connection
from stayline.operators import occupancy
from stayline.plans.registry import JOBS
from stayline.sources.testdata import LENS, Warehouse

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", list(JOBS))
def test_query_matches_its_oracle(spark, connection, name):
    assert compare(spark, connection, FOLDER, driver.queries()[name], driver.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    assert set(JOBS) <= set(driver.queries()) and set(JOBS) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "occupancy_total", "occupancy_reservations_desk", "paid_partner_split", "agent_by_property", "production",
    "agent_attainment", "agent_daily", "daily_occupancy_pivot", "same_month_by_year", "rate_vs_network", "guest_metrics",
    "stay_pairs", "return_intervals", "health_report", "dedup_guests", "dedup_bookings", "title_case",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_in_the_jvm_without_cross_products(spark, name):
    plan = final_plan(driver.queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


# reports and the exchanges of raw lines they may take: one, however large the headers are
ONE_EXCHANGE = [
    "occupancy_total", "occupancy_reservations_desk", "occupancy_by_category", "paid_partner_split", "agent_by_property",
    "daily_occupancy_pivot", "same_month_by_year", "rate_vs_network",
]


def exchanges_above_lines(plan: str) -> int:
    """Shuffles on the way from the line scan up to where lines are bookings or properties."""
    lines = plan.splitlines()
    at = next(n for n, line in enumerate(lines) if "FileScan" in line and "l_shipdate" in line or "l_extendedprice" in line and "FileScan" in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :|+-*")), 0
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :|+-*"))
        if indent < depth:
            depth = indent
            found += "Exchange hashpartitioning(booking_id" in line
    return found


@pytest.mark.parametrize("name", ONE_EXCHANGE)
def test_lines_are_shuffled_once_where_headers_do_not_fit_a_broadcast(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = driver.queries()[name](spark, FOLDER)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert exchanges_above_lines(df._jdf.queryExecution().executedPlan().toString()) <= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_both_bounds_of_each_year_reach_the_scan(spark):
    plan = final_plan(driver.queries()["same_month_by_year"](spark, FOLDER))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_shipdate" in line)
    # the view turns timestamps into dates, and the filter lies on the date
    assert "stay_date" in plan and scan.split("DataFilters")[1].count("l_shipdate") > 1


def test_dimensions_are_broadcast(spark):
    w = Warehouse(spark, FOLDER)
    report = occupancy.occupancy_total(w.stay_nights, w.bookings, w.properties, w.room_types, LENS)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2


def test_month_and_columns_reach_the_scan(spark):
    plan = final_plan(driver.queries()["daily_occupancy_pivot"](spark, FOLDER))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line)
    assert "l_shipdate" in scan.split("PushedFilters")[1]
    assert not re.search(r"l_tax|l_quantity|l_discount", scan.split("ReadSchema")[1])
