"""Every job as a named query over the driver's tables. `checks/oracles.py` holds the SQL each is compared with."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stayline.functions.rules import BOOKING_KEY
from stayline.functions.text import country_of, title_case
from stayline.operators import conform, contacts, dimensions, guests, occupancy, production, quality, validation
from stayline.operators.ordered import assign_keys
from stayline.operators.sides import literal
from stayline.plans.gold import refresh_gold
from stayline.plans.runlog import RunLog, current_runs, recent_runs, run_stats
from stayline.plans.silver import build_silver
from stayline.session import tuned
from stayline.sources import bronze, master, schemas
from stayline.sources.store import read_published, stored, work_path
from stayline.sources.testdata import (
    CHANNELS,
    INTERNAL,
    LENS,
    PIVOT,
    ROOM_TYPES,
    RUN_AS_OF,
    STAY_AS_OF,
    TIE_BREAK,
    Warehouse,
)

RATE = Decimal("3.75")
WINDOW = (dt.date(2000, 6, 1), dt.date(2000, 6, 30))
COMPARE_YEARS = (1997, 1998, 1999, 2000)
SALT = "stayline"
EXPORT_LINES = 1_000_000
HEALTH_PROCESS = "job_0"
LEASE_AS_OF = dt.datetime(2024, 1, 15)


def _by_day(bronze_rows: DataFrame) -> DataFrame:
    return bronze_rows.groupBy("stay_day").agg(F.count("*").alias("lines"), F.sum("total").alias("revenue"))


# --- bronze


def date_quarantine(w: Warehouse) -> DataFrame:
    good, bad = bronze.normalise_dates(w.raw_stays, {"stay_date_txt": "stay_date", "created_date_txt": "created_date"})
    rows = good.withColumn("state", F.lit("good")).unionByName(bad.withColumn("state", F.lit("bad")))
    return rows.groupBy("state", "stay_date", "created_date").agg(F.count("*").alias("lines"))


def land_raw_roundtrip(w: Warehouse) -> DataFrame:
    export, path = work_path(w.spark, "export"), work_path(w.spark, "bronze")
    # compressed, as exports of this size arrive; a file is read by one task, so its lines are bounded
    rows = w.raw_stays.select(*schemas.RAW_COLUMNS).write.option("maxRecordsPerFile", EXPORT_LINES)
    rows.csv(export, header=True, quote='"', escape='"', compression="gzip")
    bronze.land_raw(w.spark, export, path, "base")
    return _by_day(bronze.read_bronze(w.spark, path))


def delete_window(w: Warehouse) -> DataFrame:
    path = work_path(w.spark, "bronze")
    bronze.land_batch(w.raw_stays, path, "base")
    bronze.delete_window(w.spark, path, *WINDOW)
    return _by_day(bronze.read_bronze(w.spark, path))


def reload_window(w: Warehouse) -> DataFrame:
    """Replaces one month by corrected lines."""
    path = work_path(w.spark, "bronze")
    bronze.land_batch(w.raw_stays, path, "base")
    month, _ = bronze.normalise_dates(w.raw_stays, {"stay_date_txt": "stay_date"})
    corrected = month.where(F.col("stay_date").between(*WINDOW)).withColumn(
        "total", (F.col("total") * 2).cast("decimal(18,6)")
    )
    bronze.reload_window(w.spark, path, *WINDOW, corrected, "correction")
    return _by_day(bronze.read_bronze(w.spark, path))


# --- silver


def dedup_guests(w: Warehouse) -> DataFrame:
    return conform.dedup_guests(w.raw_stays, TIE_BREAK, LENS)


def title_cased(w: Warehouse) -> DataFrame:
    return w.guests.select("guest_id", title_case(F.col("full_name")).alias("full_name"))


def derived_country(w: Warehouse) -> DataFrame:
    return w.guests.select("guest_id", country_of(F.col("national_id"), LENS).alias("country"))


def dedup_bookings(w: Warehouse) -> DataFrame:
    """Booking ids folded together, so that many sales compete for one header."""
    folded = w.raw_stays.withColumn("booking_id", F.col("booking_id") % 500)
    return conform.dedup_bookings(folded, w.guests, TIE_BREAK)


def offset_collisions(w: Warehouse) -> DataFrame:
    """Nights moved to the first of their year, so that rooms collide often."""
    lines = conform.raw_lines(w.raw_stays, TIE_BREAK).withColumn("stay_date", F.trunc("stay_date", "year"))
    placed = conform.offset_collisions(lines, TIE_BREAK)
    return placed.select(*BOOKING_KEY, "stay_date", "room_number", "room_type", "total", "l_partkey", "l_suppkey")


def to_local_currency(w: Warehouse) -> DataFrame:
    lines = conform.to_local_currency(conform.raw_lines(w.raw_stays, TIE_BREAK), RATE)
    return lines.select(*BOOKING_KEY, "l_partkey", "l_suppkey", "currency", "unit_price", "total")


def rate_as_of(w: Warehouse) -> DataFrame:
    """Rates start in the second half of 1995; what was sold before is converted at the run's rate."""
    dated = conform.rate_as_of(conform.raw_lines(w.raw_stays, TIE_BREAK), w.rates, RATE)
    lines = conform.to_local_currency(dated, F.col("usd_rate"))
    return lines.select(*BOOKING_KEY, "l_partkey", "l_suppkey", "created_date", "usd_rate", "total")


def keep_with_header(w: Warehouse) -> DataFrame:
    kept = conform.keep_with_header(w.stay_nights, w.sales.where(conform.has_national_id()).withColumn(
        "created_year", F.substring("created_date_txt", -4, 4).cast("int")))
    return kept.select(*BOOKING_KEY, "stay_date", "room_number", "total", "l_partkey", "l_suppkey")


def date_parts(w: Warehouse) -> DataFrame:
    return conform.add_date_parts(w.stay_nights).groupBy("stay_date", "day", "month", "year").agg(
        F.count("*").alias("lines")
    )


def _silver(w: Warehouse):
    """Silver from a stored copy of the raw lines, as bronze would hold them, some of them with a time that is none."""
    odd = F.when(F.col("src_order") % 89 == 0, "25:99").otherwise(F.col("created_time_txt"))
    lines = w.raw_stays.withColumn("created_time_txt", odd)
    raw, out = stored(conform.with_parsed(lines), "raw"), work_path(w.spark, "silver")
    return out, build_silver(w.spark, raw, w.properties, out, RATE, tie_break=TIE_BREAK, vocab=LENS)


def silver_counts(w: Warehouse) -> DataFrame:
    _, counts = _silver(w)
    return literal(w.spark, [counts[:4]], "guests bigint, bookings bigint, lines bigint, quarantined bigint")


def silver_bookings(w: Warehouse) -> DataFrame:
    out, _ = _silver(w)
    return read_published(w.spark, out, "bookings").drop("loaded_at")


def silver_nights(w: Warehouse) -> DataFrame:
    out, _ = _silver(w)
    return read_published(w.spark, out, "stay_nights")


def master_targets(w: Warehouse) -> DataFrame:
    """Targets maintained as a CSV file, read back under their key."""
    path = work_path(w.spark, "targets")
    w.property_targets.write.csv(path, header=True)
    targets = master.load_master(w.spark, path, schemas.PROPERTY_TARGETS, ["property_id", "year", "month"])
    return targets.join(w.properties.select("property_id", "name", "room_count"), "property_id")


def surrogate_keys(w: Warehouse) -> DataFrame:
    return assign_keys(w.guests.select("national_id"), ["national_id"], "guest_key")


def stable_guest_keys(w: Warehouse) -> DataFrame:
    """Guest ids after a rebuild that brought guests with smaller national ids than those of the first year."""
    out, raw = work_path(w.spark, "silver"), stored(conform.with_parsed(w.raw_stays), "raw")
    for lines in (raw.where(F.year("sale_day") == 1995), raw):
        build_silver(w.spark, lines, w.properties, out, RATE, tie_break=TIE_BREAK, vocab=LENS)
    return read_published(w.spark, out, "guests").select("guest_id", "national_id")


def constraint_violations(w: Warehouse) -> DataFrame:
    faulty = w.with_faults()
    headers = stored(faulty.headers, "headers")
    tables = {"guests": faulty.guests, "bookings": headers, "stay_nights": faulty.stay_nights}
    return validation.validate_all(tables, validation.silver_rules(faulty.guests, headers, faulty.properties))


def dimension_violations(w: Warehouse) -> DataFrame:
    """Constraints of dimensions and targets, with a fault planted for each kind of rule."""
    faulty = w.with_faults()
    agents = stored(faulty.agents, "agents")
    tables = {
        "properties": faulty.properties, "dim_channel": faulty.channels, "dim_agent": agents,
        "dim_room_type": faulty.room_types, "property_targets": faulty.property_targets,
        "agent_targets": faulty.agent_targets,
    }
    return validation.validate_all(tables, validation.dimension_rules(agents, w.properties))


# --- dimensions


def calendar(w: Warehouse) -> DataFrame:
    """The calendar over every night stayed and every day sold."""
    nights = w.stay_nights.agg(F.min("stay_date").alias("low"), F.max("stay_date").alias("high"))
    sales = w.bookings.agg(
        F.to_date(F.min("created_at")).alias("low"), F.to_date(F.max("created_at")).alias("high")
    )
    span = nights.unionByName(sales).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return dimensions.calendar_between(span)


def channel_areas(w: Warehouse) -> DataFrame:
    """Bookings per channel with the area the dimension gives it."""
    seed = dimensions.channel_dim(w.spark, CHANNELS)
    sold = w.bookings.groupBy("channel").agg(F.count("*").alias("bookings"))
    return sold.join(seed, "channel", "left").select(
        "channel", "channel_id", F.coalesce("area", F.lit(LENS.unclassified)).alias("area"), "active", "bookings"
    )


def agent_dim(w: Warehouse) -> DataFrame:
    return dimensions.build_agent_dim(w.raw_stays, w.channels, ["src_order"], LENS, RUN_AS_OF)


def room_type_dim(w: Warehouse) -> DataFrame:
    return dimensions.build_room_type_dim(w.stay_nights, ROOM_TYPES, LENS)


def dim_refresh(w: Warehouse) -> DataFrame:
    """A guest register started from one year's sales and extended by everybody else."""
    first = F.substring("created_date_txt", -4, 4) == "1995"
    known = assign_keys(w.sales.where(first).select("national_id").distinct(), ["national_id"], "guest_key")
    return dimensions.refresh_dim(known, w.sales.select("national_id").distinct(), "national_id", "guest_key")


# --- gold


def stay_fact(w: Warehouse) -> DataFrame:
    lines = w.stay_nights
    return guests.stay_fact(w.headers, w.properties, w.guests, lines)


def pii_safe(w: Warehouse) -> DataFrame:
    """Nights and revenue by hashed guest, without anything that identifies the guest."""
    return guests.pii_safe(stay_fact(w), SALT).groupBy("guest_hash").agg(
        F.count("*").alias("nights"), F.sum("total").alias("revenue")
    )


def gold_refresh(w: Warehouse) -> DataFrame:
    out = work_path(w.spark, "gold")
    # headers lie stored in a warehouse; both tables are made from them
    refresh_gold(w.spark, stored(w.headers, "headers"), w.properties, w.guests, w.stay_nights, out, STAY_AS_OF, LENS)
    metrics, fact = (read_published(w.spark, out, table) for table in ("guest_metrics", "stay_fact"))
    both = [
        (metrics, "guest_metrics", F.sum("spend")),
        (fact, "stay_fact", F.sum("total")),
    ]
    parts = [
        table.agg(F.count("*").alias("row_count"), amount.cast("decimal(38,2)").alias("amount")).withColumn(
            "table_name", F.lit(name)
        )
        for table, name, amount in both
    ]
    return parts[0].unionByName(parts[1])


def _occupancy(function: Callable, *more: str) -> Callable[[Warehouse], DataFrame]:
    def query(w: Warehouse) -> DataFrame:
        return function(w.stay_nights, w.bookings, *[getattr(w, name) for name in more], vocab=LENS)

    return query


def daily_occupancy_pivot(w: Warehouse) -> DataFrame:
    return occupancy.daily_occupancy_pivot(
        w.stay_nights, w.bookings, w.properties, w.room_types, STAY_AS_OF, PIVOT, INTERNAL, vocab=LENS
    )


def daily_occupancy_pivot_all(w: Warehouse) -> DataFrame:
    """Every sold item and every hold counted, as the source report does."""
    return occupancy.daily_occupancy_pivot(
        w.stay_nights, w.bookings, w.properties, w.room_types, STAY_AS_OF, PIVOT, INTERNAL,
        lodging_only=False, exclude_holds=False, vocab=LENS,
    )


def same_month_by_year(w: Warehouse) -> DataFrame:
    return occupancy.same_month_by_year(w.stay_nights, w.bookings, STAY_AS_OF.month, COMPARE_YEARS, LENS)


def post_stay_contacts(w: Warehouse) -> DataFrame:
    return contacts.post_stay_contacts(w.headers, w.guests, STAY_AS_OF, excluded=INTERNAL)


# --- quality and runs


def health_report(w: Warehouse) -> DataFrame:
    f = w.with_faults()
    # headers and agents lie stored in a warehouse; here they are views over all lines and sales
    return quality.health_report(
        f.raw_stays, f.guests, stored(f.headers, "headers"), f.stay_nights, f.properties, f.channels,
        stored(f.agents, "agents"), f.room_types, f.runs, RUN_AS_OF, HEALTH_PROCESS,
    )


def _check(number: int, *tables: str) -> Callable[[Warehouse], DataFrame]:
    def query(w: Warehouse) -> DataFrame:
        faulty = w.with_faults()
        names = {"raw": "raw_stays", "bookings": "headers", "lines": "stay_nights", "sold": "bookings"}
        frames = {name if name != "sold" else "bookings": getattr(faulty, names.get(name, name)) for name in tables}
        return quality.rated(quality.table_checks([number], **frames))

    return query


HEALTH = {
    "health_01": _check(1, "bookings", "guests"),
    # headers without totals will do
    "health_02": _check(2, "lines", "sold"),
    "health_03": _check(3, "lines"),
    "health_04": _check(4, "guests"),
    "health_05": _check(5, "properties"),
    "health_06": _check(6, "bookings", "channels"),
    "health_07": _check(7, "bookings", "properties"),
    "health_08": lambda w: quality.last_build(w.runs, RUN_AS_OF, HEALTH_PROCESS),
    "health_09": _check(9, "bookings"),
    "health_10": _check(10, "bookings"),
    "health_11": _check(11, "bookings", "agents"),
    "health_12": _check(12, "lines", "room_types"),
    "health_13": _check(13, "raw", "properties", "bookings"),
}


def run_audit(w: Warehouse) -> DataFrame:
    """Two audited steps over the tables, one of which fails."""
    log = RunLog(w.spark, work_path(w.spark, "run_log"))
    with log.step("count_lines", "SCAN") as step:
        step.rows = w.stay_nights.count()
    try:
        with log.step("load_targets", "READ") as step:
            step.rows = w.bookings.count()
            path = work_path(w.spark, "targets")
            w.bookings.select("property_id", "created_year").write.csv(path, header=True)
            master.load_master(w.spark, path, "property_id int, created_year int", ["property_id"])
    except master.DuplicateKey:
        pass
    return log.runs().select(
        "process", "action", "rows", "status",
        (F.col("seconds") >= 0).alias("timed"), (F.col("ended_at") >= F.col("started_at")).alias("ended"),
    )


def run_states(w: Warehouse) -> DataFrame:
    """Runs by state on a day: ended, still within their lease, or abandoned."""
    return current_runs(w.run_events, LEASE_AS_OF).groupBy("status").agg(F.count("*").alias("runs"))


JOBS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "date_quarantine": date_quarantine,
    "land_raw_roundtrip": land_raw_roundtrip,
    "delete_window": delete_window,
    "reload_window": reload_window,
    "dedup_guests": dedup_guests,
    "title_case": title_cased,
    "derive_country": derived_country,
    "dedup_bookings": dedup_bookings,
    "offset_collisions": offset_collisions,
    "to_local_currency": to_local_currency,
    "rate_as_of": rate_as_of,
    "keep_with_header": keep_with_header,
    "backfill_headers": lambda w: w.headers,
    "date_parts": date_parts,
    "silver_counts": silver_counts,
    "silver_bookings": silver_bookings,
    "silver_nights": silver_nights,
    "master_targets": master_targets,
    "surrogate_keys": surrogate_keys,
    "stable_guest_keys": stable_guest_keys,
    "constraint_violations": constraint_violations,
    "dimension_violations": dimension_violations,
    "calendar": calendar,
    "channel_dim": channel_areas,
    "agent_dim": agent_dim,
    "room_type_dim": room_type_dim,
    "dim_refresh": dim_refresh,
    "guest_metrics": lambda w: guests.guest_metrics(w.headers, STAY_AS_OF, LENS),
    "stay_fact": stay_fact,
    "pii_safe": pii_safe,
    "gold_refresh": gold_refresh,
    "occupancy_total": _occupancy(occupancy.occupancy_total, "properties", "room_types"),
    "occupancy_reservations_desk": _occupancy(
        occupancy.occupancy_reservations_desk, "properties", "channels", "room_types"
    ),
    "occupancy_by_category": _occupancy(occupancy.occupancy_by_category, "properties", "room_types"),
    "paid_partner_split": _occupancy(occupancy.paid_partner_split, "channels", "room_types"),
    "agent_by_property": _occupancy(
        occupancy.agent_by_property, "properties", "channels", "room_types", "agents"
    ),
    "production": lambda w: production.production(w.headers, w.properties, w.channels, LENS),
    "agent_attainment": lambda w: production.agent_attainment(w.headers, w.agents, w.agent_targets, LENS),
    "agent_daily": lambda w: production.agent_daily(w.headers, w.agents, w.channels, vocab=LENS),
    "daily_occupancy_pivot": daily_occupancy_pivot,
    "daily_occupancy_pivot_all": daily_occupancy_pivot_all,
    "same_month_by_year": same_month_by_year,
    "post_stay_contacts": post_stay_contacts,
    "rate_vs_network": lambda w: occupancy.rate_vs_network(w.stay_nights, w.bookings, w.properties),
    "stay_pairs": lambda w: contacts.stay_pairs(w.headers),
    "stay_pair_rows": lambda w: contacts.pair_rows(w.headers),
    "return_intervals": lambda w: contacts.return_intervals(w.headers),
    "return_median": lambda w: contacts.median_return(contacts.return_intervals(w.headers)),
    **HEALTH,
    "health_report": health_report,
    "recent_runs": lambda w: recent_runs(w.runs),
    "run_stats": lambda w: run_stats(w.runs, RUN_AS_OF),
    "run_audit": run_audit,
    "run_states": run_states,
}


def presented(df: DataFrame) -> DataFrame:
    """Money and rates as doubles, the form the oracle compares."""
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.withColumns(casts) if casts else df


def as_query(job: Callable[[Warehouse], DataFrame]):
    return lambda spark, folder: presented(job(Warehouse(tuned(spark), folder)))
