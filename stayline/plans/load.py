"""The load: reload window, silver, dimensions, gold, each step audited."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators import quality, validation
from stayline.operators.dimensions import (
    build_agent_dim,
    build_room_type_dim,
    channel_dim,
    latest_agents,
    refresh_dim,
    room_types,
)
from stayline.plans.gold import refresh_gold
from stayline.plans.runlog import RunLog
from stayline.plans.silver import DEFAULT_RATE, SilverCounts, build_silver
from stayline.session import tuned
from stayline.sources.bronze import Reload, read_bronze, reload_window, vacuum
from stayline.sources.store import (
    child_folders,
    counted,
    new_version,
    publish,
    read_published,
    retire,
    scratch,
    version_path,
)
from stayline.vocabulary import CHANNEL_SEED, PMS, ROOM_TYPE_SEED, Vocabulary


class LoadResult(NamedTuple):
    reload: Reload
    silver: SilverCounts
    gold_version: str
    # checks that are not OK, and rows that break a constraint
    alerts: int
    violations: int


def refresh_dimensions(
    spark: SparkSession, raw: DataFrame, lines: DataFrame, out: str,
    channel_seed: Sequence[tuple[str, str]] = CHANNEL_SEED, room_seed: Sequence[tuple[str, str]] = ROOM_TYPE_SEED,
    vocab: Vocabulary = PMS,
) -> int:
    """Publish the derived dimensions: built on the first load, extended by new members on later ones."""
    channels = channel_dim(spark, channel_seed)
    if child_folders(spark, out):
        agents = read_published(spark, out, "dim_agent")
        found = latest_agents(raw, channels, vocab=vocab)
        found = found.withColumns({"active": F.lit(True), "created_at": F.localtimestamp()})
        agents = refresh_dim(agents, found, "agent_src_id", "agent_id")
        types = read_published(spark, out, "dim_room_type")
        found = room_types(lines, room_seed, vocab).withColumn("active", F.lit(True))
        types = refresh_dim(types, found, "room_type", "room_type_id")
    else:
        agents = build_agent_dim(raw, channels, vocab=vocab)
        types = build_room_type_dim(lines, room_seed, vocab)
    version = new_version()
    tables = {"dim_channel": channels, "dim_agent": agents, "dim_room_type": types}
    rows = 0
    for name, frame in tables.items():
        frame, written = counted(frame)
        frame.write.parquet(version_path(out, version, name))
        rows += written()
    publish(spark, out, version)
    retire(spark, out)
    return rows


def check_load(
    spark: SparkSession, out: str, raw: DataFrame, silver: str, dims: str, properties: DataFrame, runs: DataFrame,
    as_of: dt.datetime,
) -> tuple[int, int]:
    """Publish the health report and the constraint counts of what is now in place; returns the checks that are not OK
    and the rows that break a constraint. Rooms that collide after they were moved show among the latter."""
    guests, bookings, lines = (read_published(spark, silver, table) for table in ("guests", "bookings", "stay_nights"))
    channels, agents, types = (read_published(spark, dims, t) for t in ("dim_channel", "dim_agent", "dim_room_type"))
    report = quality.health_report(raw, guests, bookings, lines, properties, channels, agents, types, runs, as_of)
    rules = validation.silver_rules(guests, bookings, properties) | validation.dimension_rules(agents, properties)
    tables = {
        "guests": guests, "bookings": bookings, "stay_nights": lines, "properties": properties, "dim_channel": channels,
        "dim_agent": agents, "dim_room_type": types,
    }
    broken = validation.validate_all(tables, rules)
    version = new_version()
    report.write.parquet(version_path(out, version, "health"))
    broken.write.parquet(version_path(out, version, "violations"))
    publish(spark, out, version)
    retire(spark, out)
    alerts = read_published(spark, out, "health", version).where(F.col("status") != quality.OK).count()
    found = read_published(spark, out, "violations", version).agg(F.sum("violations")).head()[0]
    return alerts, int(found or 0)


def run_load(
    spark: SparkSession, root: str, batch: DataFrame, batch_id: str, low: dt.date, high: dt.date,
    properties: DataFrame, as_of: dt.date, usd_rate: Decimal = DEFAULT_RATE, rates: DataFrame | None = None,
    vocab: Vocabulary = PMS,
) -> LoadResult:
    """Replace a window of bronze, rebuild everything that depends on it, and check what came of it. `root` holds one
    folder per layer. Every layer keeps its last two versions, and nothing intermediate is left."""
    with scratch(spark):
        return _run_load(spark, root, batch, batch_id, low, high, properties, as_of, usd_rate, rates, vocab)


def _run_load(
    spark, root, batch, batch_id, low, high, properties, as_of, usd_rate, rates, vocab
) -> LoadResult:
    tuned(spark)
    bronze, silver, dims, gold = (f"{root}/{layer}" for layer in ("bronze", "silver", "dimensions", "gold"))
    log = RunLog(spark, f"{root}/run_log")
    with log.step("load_raw", "RELOAD_WINDOW", f"{low} to {high}") as step:
        reload = reload_window(spark, bronze, low, high, batch, batch_id)
        step.rows = reload.landed
    raw = read_bronze(spark, bronze)
    with log.step("build_silver", "REBUILD") as step:
        counts = build_silver(spark, raw, properties, silver, usd_rate, rates, vocab=vocab)
        step.rows = counts.guests + counts.bookings + counts.lines
        step.message = f"guests {counts.guests}, bookings {counts.bookings}, lines {counts.lines}"
    lines = read_published(spark, silver, "stay_nights")
    with log.step("refresh_dimensions", "APPEND_NEW") as step:
        step.rows = refresh_dimensions(spark, raw, lines, dims, vocab=vocab)
    with log.step("refresh_gold", "SNAPSHOT"):
        bookings, guests = (read_published(spark, silver, table) for table in ("bookings", "guests"))
        version = refresh_gold(spark, bookings, properties, guests, lines, gold, as_of, vocab)
        retire(spark, gold)
    with log.step("check_load", "VALIDATE") as step:
        now = dt.datetime.combine(as_of, dt.time())
        alerts, violations = check_load(spark, f"{root}/quality", raw, silver, dims, properties, log.runs(), now)
        step.rows = alerts + violations
        step.message = f"alerts {alerts}, violations {violations}"
        vacuum(spark, bronze)
    return LoadResult(reload, counts, version, alerts, violations)
