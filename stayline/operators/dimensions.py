"""Calendar, channel, agent and room-type dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.text import title_case
from stayline.operators.conform import with_created
from stayline.operators.ordered import assign_keys
from stayline.operators.sides import literal
from stayline.sources.schemas import ARRIVAL
from stayline.vocabulary import CHANNEL_SEED, PMS, ROOM_TYPE_SEED, Vocabulary

# Names a calendar shows, Sunday and January first.
DAY_NAMES = {
    "en": ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"],
    "es": ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"],
}
MONTH_NAMES = {
    "en": ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
           "November", "December"],
    "es": ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre",
           "Noviembre", "Diciembre"],
}
FIRST_DAY = dt.date(2021, 1, 1)
LAST_DAY = dt.date(2035, 12, 31)


def calendar_of(days: DataFrame, language: str = "en") -> DataFrame:
    """Describe each day of a one-column frame `date`."""
    day = F.col("date")

    def named(names: list[str], position) -> object:
        return F.element_at(F.array(*[F.lit(name) for name in names]), position)

    weekday = F.dayofweek(day) - 1
    month_name = named(MONTH_NAMES[language], F.month(day))
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        weekday.alias("day_of_week"),
        named(DAY_NAMES[language], weekday + 1).alias("day_name"),
        month_name.alias("month_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.concat_ws(" ", F.substring(month_name, 1, 3), F.year(day)).alias("month_label"),
        F.concat(F.lit("Q"), F.quarter(day), F.lit(" "), F.year(day)).alias("quarter_label"),
        (F.year(day) * 100 + F.month(day)).alias("year_month"),
    )


def build_calendar(
    spark: SparkSession, low: dt.date = FIRST_DAY, high: dt.date = LAST_DAY, language: str = "en"
) -> DataFrame:
    """One row per day from `low` to `high`, both included."""
    return calendar_between(spark.range(1).select(F.lit(low).alias("low"), F.lit(high).alias("high")), language)


def calendar_between(bounds: DataFrame, language: str = "en") -> DataFrame:
    """Calendar for a one-row frame `low`, `high`, such as the span of the dates in a table."""
    return calendar_of(bounds.select(F.explode(F.sequence("low", "high")).alias("date")), language)


def channel_dim(spark: SparkSession, seed: Sequence[tuple[str, str]] = CHANNEL_SEED) -> DataFrame:
    rows = [(number, channel, area, True) for number, (channel, area) in enumerate(seed, start=1)]
    return literal(spark, rows, "channel_id bigint, channel string, area string, active boolean")


def latest_agents(
    raw: DataFrame, channels: DataFrame, tie_break: Sequence[str] = ARRIVAL, vocab: Vocabulary = PMS
) -> DataFrame:
    """One row per agent id with the name and area of its latest sale; one person keeps one row whatever the spelling."""
    latest = F.struct("created_date", "created_seconds", *tie_break)
    agents = (
        with_created(raw.where((F.col("agent_src_id") > 0) & F.col("agent_name").isNotNull()))
        .groupBy("agent_src_id")
        .agg(F.max_by(F.struct("agent_name", "channel"), latest).alias("last"))
        .select("agent_src_id", title_case(F.col("last.agent_name")).alias("agent_name"), F.col("last.channel").alias("channel"))
    )
    areas = channels.select("channel", "area")
    return agents.join(areas, "channel", "left").select(
        "agent_src_id", "agent_name", F.coalesce("area", F.lit(vocab.unclassified)).alias("area")
    )


def build_agent_dim(
    raw: DataFrame, channels: DataFrame, tie_break: Sequence[str] = ARRIVAL, vocab: Vocabulary = PMS,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """The agent dimension with keys in order of source id. `as_of` is the time the members are recorded."""
    recorded = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    keyed = assign_keys(latest_agents(raw, channels, tie_break, vocab), ["agent_src_id"], "agent_id")
    return keyed.withColumns({"active": F.lit(True), "created_at": recorded})


def room_types(
    lines: DataFrame, mapping: Sequence[tuple[str, str]] = ROOM_TYPE_SEED, vocab: Vocabulary = PMS
) -> DataFrame:
    """Distinct room types of the lines with their category; types nobody classified are `other`."""
    listed = literal(lines.sparkSession, mapping, "room_type string, category string")
    found = lines.select("room_type").where(F.col("room_type").isNotNull()).distinct()
    return found.join(listed, "room_type", "left").select(
        "room_type", F.coalesce("category", F.lit(vocab.other)).alias("category")
    )


def build_room_type_dim(
    lines: DataFrame, mapping: Sequence[tuple[str, str]] = ROOM_TYPE_SEED, vocab: Vocabulary = PMS
) -> DataFrame:
    return assign_keys(room_types(lines, mapping, vocab), ["room_type"], "room_type_id").withColumn(
        "active", F.lit(True)
    )


def refresh_dim(dim: DataFrame, candidates: DataFrame, key: str, id_column: str) -> DataFrame:
    """Append the members a dimension does not hold yet. Existing rows and keys stay, new keys go on from the largest."""
    fresh = candidates.join(dim.select(key), key, "left_anti")
    last = dim.agg(F.max(id_column)).head()[0] or 0
    return dim.unionByName(assign_keys(fresh, [key], id_column, start=last + 1))
