"""The driver's order tables seen as a booking warehouse.

Every view is a plain projection (raw lines: one join), so reading through it costs what reading the table costs.
The expressions are valid in Spark and in DuckDB, which lets the checks build the same views in both; `{ts}` stands
for the zone-less timestamp type. Booking ids are recycled each year: order key k becomes id k / 7 in year 1995 + k % 7.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.conform import backfill_headers
from stayline.operators.dimensions import channel_dim, latest_agents
from stayline.operators.sides import literal
from stayline.vocabulary import Vocabulary

SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
LENS = Vocabulary(
    unpaid="Unpaid",
    held="Held",
    lodging="Lodging",
    tent="Tent",
    other="Other",
    desk_area="Reservations",
    partner_area="Partners",
    property_area="Property",
    unclassified="Unclassified",
    domestic="Domestic",
    foreign="Foreign",
    segments=("New", "Occasional", "Loyal", "VIP"),
)
# one channel and one room type are left out on purpose
CHANNELS = [
    ("1-URGENT", LENS.desk_area),
    ("2-HIGH", LENS.desk_area),
    ("3-MEDIUM", LENS.partner_area),
    ("4-NOT SPECIFIED", LENS.property_area),
]
ROOM_TYPES = [
    ("AF", LENS.lodging),
    ("AO", LENS.lodging),
    ("NF", LENS.lodging),
    ("NO", LENS.lodging),
    ("RF", LENS.tent),
]
STAY_AS_OF = dt.date(2000, 6, 15)
RATES_FROM = dt.date(1995, 7, 1)
RUN_AS_OF = dt.datetime(2024, 1, 31)
PIVOT = (1, 4, 6, 8, 12, 17, 21)
INTERNAL = (3, 13, 23)
# a total order of raw lines that repeat room and night
TIE_BREAK = ["src_order", "room_number", "l_partkey", "l_suppkey", "total"]


def _digits(number: str, width: int) -> str:
    text = f"cast({number} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


def _day_text(day: str) -> str:
    return f"concat({_digits(f'day({day})', 2)}, '/', {_digits(f'month({day})', 2)}, '/', cast(year({day}) as string))"


def guest_columns(key: str) -> dict[str, str]:
    return {
        "national_id": f"case when {key} % 4 = 0 then concat('PX', {_digits(key, 7)}) else {_digits(key, 8)} end",
        "full_name": f"concat('RÍOS', cast({key} % 11 as string), ' D''LUNA-PAZ ANA', cast({key} % 7 as string), ' ROSA')",
        "phone": f"case {key} % 3 when 0 then {_digits(key, 9)} when 1 then concat('51', {_digits(key, 9)}) else 'n/a' end",
    }


PROPERTIES = {
    "property_id": "n_nationkey",
    "name": "n_name",
    "city": "case when n_nationkey % 10 = 3 then null else concat('CITY_', cast(n_nationkey as string)) end",
    "room_count": "cast(20 + 3 * n_nationkey as int)",
}
GUESTS = {"guest_id": "c_custkey", **guest_columns("c_custkey")}

_SALE_YEAR = "cast(1995 + {key} % 7 as int)"
_BOOKING_KEY = {"booking_id": "cast(floor({key} / 7) as bigint)", "created_year": _SALE_YEAR}
_SALE_DAY = f"make_date({_SALE_YEAR.format(key='o_orderkey')}, month(o_orderdate), least(day(o_orderdate), 28))"
_SALE_TIME = f"concat({_digits('o_orderkey % 24', 2)}, ':30:00')"
_HEADER = {
    "property_id": "cast(o_custkey % 25 as int)",
    "channel": "o_orderpriority",
    "sub_channel": "o_orderstatus",
    "agent_src_id": "o_orderkey % 37",
    "agent_name": "concat(case when o_orderkey % 2 = 0 then 'MARÍA DE-LA-CRUZ N' else 'maria de-la-cruz n' end,"
    " cast(o_orderkey % 37 as string))",
    "status_code": "cast(o_orderkey % 4 as int)",
    "booking_status": "case when o_orderkey % 3 = 0 then 'Held' else 'Confirmed' end",
    "payment_status": "case when o_orderstatus = 'P' then 'Unpaid' else 'Paid' end",
    "currency": "case o_orderkey % 10 when 0 then 'Dolares' when 5 then 'usd' when 1 then null else 'LOCAL' end",
}
BOOKINGS = {
    **{name: text.format(key="o_orderkey") for name, text in _BOOKING_KEY.items()},
    "guest_id": "o_custkey",
    "created_at": f"cast(concat(cast({_SALE_DAY} as string), ' ', {_SALE_TIME}) as {{ts}})",
    **_HEADER,
}
_LINE = {
    "room_number": "l_linenumber",
    "room_type": "concat(l_returnflag, l_linestatus)",
    "quantity": "cast(l_quantity as int)",
    "unit_price": "cast(50 + 1000 * cast(l_discount as decimal(4,2)) as decimal(10,2))",
    "total": "cast(l_extendedprice as decimal(12,2))",
    "adults": "cast(1 + l_linenumber % 2 as int)",
    "children": "cast(l_linenumber % 3 as int)",
}
STAY_NIGHTS = {
    **{name: text.format(key="l_orderkey") for name, text in _BOOKING_KEY.items()},
    "stay_date": "cast(l_shipdate as date)",
    **_LINE,
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
}
# header fields of one order as raw text, and the line fields beside them
RAW_HEADER = {
    "src_order": "o_orderkey",
    "booking_id": _BOOKING_KEY["booking_id"].format(key="o_orderkey"),
    "created_date_txt": _day_text(_SALE_DAY),
    "created_time_txt": _SALE_TIME,
    **{
        name: f"case when o_custkey % 50 = 0 then '' else {text} end" if name == "national_id" else text
        for name, text in guest_columns("o_custkey").items()
    },
    **_HEADER,
}
RAW_LINE = {
    "src_order": "l_orderkey",
    "stay_date_txt": f"case when l_orderkey % 97 = 0 then '31/02/2000' else {_day_text('l_shipdate')} end",
    **_LINE,
    "unit_price": f"cast({_LINE['unit_price']} as decimal(18,6))",
    "total": "cast(cast(l_extendedprice as decimal(12,2)) as decimal(18,6))",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
}
RUNS = {
    "run_id": "event_id",
    "process": "concat('job_', cast(user_id % 3 as string))",
    "action": "event_type",
    "rows": "cast(floor(value) as bigint)",
    "status": "case when event_type = 'error' then 'ERROR' else 'OK' end",
    "message": "props",
    "seconds": "cast(value as decimal(10,2))",
    "started_at": "ts",
    "ended_at": "ts",
}
# four events a run: a start, two renewals, and an end unless the process died
RUN_EVENTS = {
    **{name: text for name, text in RUNS.items() if name != "run_id"},
    "run_id": "cast(floor(event_id / 4) as bigint)",
    "is_end": "event_id % 4 = 3 and floor(event_id / 4) % 3 <> 0",
    "lease_until": "ts + interval '12' hour",
}


def projection(columns: dict[str, str], timestamp: str) -> list[str]:
    return [f"{text.format(ts=timestamp) if '{ts}' in text else text} as {name}" for name, text in columns.items()]


@dataclass(frozen=True)
class Warehouse:
    """The views over one folder of driver tables, each built when it is first asked for."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _view(self, table: str, columns: dict[str, str]) -> DataFrame:
        return self.table(table).selectExpr(*projection(columns, "timestamp_ntz"))

    @cached_property
    def properties(self) -> DataFrame:
        return self._view("nation", PROPERTIES)

    @cached_property
    def guests(self) -> DataFrame:
        return self._view("customer", GUESTS)

    @cached_property
    def bookings(self) -> DataFrame:
        """Headers as they are sold, without totals."""
        return self._view("orders", BOOKINGS)

    @cached_property
    def stay_nights(self) -> DataFrame:
        return self._view("lineitem", STAY_NIGHTS)

    @cached_property
    def headers(self) -> DataFrame:
        """Headers with the totals of their lines; texts are made once both have met."""
        sold = self.table("orders").selectExpr(
            *projection({name: text.format(key="o_orderkey") for name, text in _BOOKING_KEY.items()}, "timestamp_ntz"), "*"
        )
        columns = {name: name if name in _BOOKING_KEY else text for name, text in BOOKINGS.items()}
        totals = ["room_nights", "booking_total", "checkin", "checkout", "stay_days"]
        return backfill_headers(sold, self.stay_nights).selectExpr(*projection(columns, "timestamp_ntz"), *totals)

    @cached_property
    def sales(self) -> DataFrame:
        """The header half of the raw lines, one row per order."""
        return self._view("orders", RAW_HEADER)

    @cached_property
    def raw_stays(self) -> DataFrame:
        """Lines with the header of their order; texts are made once both have met, so that the join moves no texts."""
        line, header = ({name: text for name, text in columns.items() if name != "src_order"} for columns in (RAW_LINE, RAW_HEADER))
        both = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        key = {"src_order": RAW_LINE["src_order"]}
        return both.selectExpr(*projection(key | line | header, "timestamp_ntz"))

    @cached_property
    def channels(self) -> DataFrame:
        return channel_dim(self.spark, CHANNELS)

    @cached_property
    def room_types(self) -> DataFrame:
        """The room-type dimension as it would lie stored."""
        return literal(self.spark, [*ROOM_TYPES, ("RO", LENS.other)], "room_type string, category string")

    @cached_property
    def agents(self) -> DataFrame:
        latest = latest_agents(self.sales, self.channels, ["src_order"], LENS)
        return latest.select((F.col("agent_src_id") + 100).alias("agent_id"), "agent_src_id", "agent_name", "area")

    @cached_property
    def agent_targets(self) -> DataFrame:
        """Targets for the months agents of the reservations desk sold in; one agent in ten has a target of zero."""
        desk = self.agents.where(F.col("area") == LENS.desk_area).select("agent_id", "agent_src_id")
        months = self.bookings.select(
            "agent_src_id", F.year("created_at").alias("year"), F.month("created_at").alias("month")
        ).distinct()
        step = F.col("agent_src_id") % 10
        target = F.when(step == 3, F.lit(0)).otherwise(50_000 + 1_000 * step).cast("decimal(12,2)")
        return months.join(desk, "agent_src_id").select("agent_id", "year", "month", target.alias("production_target"))

    @cached_property
    def property_targets(self) -> DataFrame:
        months = self.bookings.select(
            "property_id", F.year("created_at").alias("year"), F.month("created_at").alias("month")
        ).distinct()
        return months.select(
            "property_id", "year", "month",
            (20_000 + 100 * F.col("property_id")).cast("decimal(12,2)").alias("occupancy_target"),
            (30_000 + 100 * F.col("month")).cast("decimal(12,2)").alias("production_target"),
        )

    @cached_property
    def rates(self) -> DataFrame:
        """An exchange rate from the first day of each quarter anything was sold in, but for the earliest two."""
        quarters = self.bookings.select(F.trunc(F.to_date("created_at"), "quarter").alias("rate_date")).distinct()
        quarters = quarters.where(F.col("rate_date") >= F.lit(RATES_FROM))
        rate = (F.lit(3) + F.month("rate_date") * F.lit(1).cast("decimal(2,0)") / 100).cast("decimal(6,4)")
        return quarters.select("rate_date", rate.alias("usd_rate"))

    @cached_property
    def runs(self) -> DataFrame:
        return self._view("events", RUNS)

    @cached_property
    def run_events(self) -> DataFrame:
        return self._view("events", RUN_EVENTS)

    def with_faults(self) -> "Faulty":
        return Faulty(self.spark, self.folder)


class Faulty(Warehouse):
    """The same warehouse with one fault planted per health check and per kind of constraint on dimensions."""

    @cached_property
    def channels(self) -> DataFrame:
        """One channel listed twice in another area."""
        seed = Warehouse.channels.func(self)
        return seed.unionByName(seed.where("channel = '2-HIGH'").withColumn("area", F.lit(None).cast("string")))

    @cached_property
    def room_types(self) -> DataFrame:
        """A room type without a category."""
        types = Warehouse.room_types.func(self)
        return types.withColumn("category", F.when(F.col("room_type") != "RO", F.col("category")))

    @cached_property
    def agents(self) -> DataFrame:
        """Some agents without a name, and some listed twice."""
        named = F.when(F.col("agent_src_id") % 9 != 0, F.col("agent_name"))
        agents = Warehouse(self.spark, self.folder).agents.withColumn("agent_name", named)
        return agents.unionByName(agents.where("agent_src_id % 11 = 0"))

    @cached_property
    def property_targets(self) -> DataFrame:
        """Targets of a property that the master lacks, and targets without a month."""
        targets = Warehouse.property_targets.func(self)
        return targets.withColumns(
            {
                "property_id": F.when(F.col("property_id") % 8 == 0, 900).otherwise(F.col("property_id")),
                "month": F.when(F.col("month") != 2, F.col("month")),
            }
        )

    @cached_property
    def agent_targets(self) -> DataFrame:
        """Targets of agents that the dimension lacks."""
        targets = Warehouse(self.spark, self.folder).agent_targets
        lost = F.when(F.col("month") == 3, F.lit(-1).cast("bigint")).otherwise(F.col("agent_id"))
        return targets.withColumn("agent_id", lost)

    @cached_property
    def guests(self) -> DataFrame:
        shared = F.when(F.col("guest_id") % 100 == 1, F.lit("00000000")).otherwise(F.col("national_id"))
        return Warehouse.guests.func(self).withColumn("national_id", shared)

    @cached_property
    def headers(self) -> DataFrame:
        number = F.col("booking_id")
        return Warehouse.headers.func(self).withColumns(
            {
                "guest_id": F.when(number % 499 == 0, -1 - F.col("guest_id")).otherwise(F.col("guest_id")),
                "property_id": F.when(number % 397 == 0, 900).otherwise(F.col("property_id")),
                "agent_src_id": F.when(number % 311 == 0, 1000 + F.col("agent_src_id")).otherwise(F.col("agent_src_id")),
                "checkout": F.when(number % 293 == 0, F.date_sub("checkin", 2)).otherwise(F.col("checkout")),
            }
        )

    @cached_property
    def stay_nights(self) -> DataFrame:
        part = F.col("l_partkey")
        return Warehouse.stay_nights.func(self).withColumns(
            {
                "created_year": F.when(part % 211 == 0, F.col("created_year") + 100).otherwise(F.col("created_year")),
                "total": F.when(part % 199 == 0, -F.col("total")).otherwise(F.col("total")),
                "room_type": F.when(part % 193 == 0, F.concat("room_type", F.lit("?"))).otherwise(F.col("room_type")),
            }
        )
