"""Declared constraints as a job that counts what breaks them; Spark tables enforce nothing by themselves.

All rules are one grouping over one pass of each table: a row names, for each rule that concerns it, its key or that it
breaks the rule, and a parent of references names its keys as known. Keys are compared as text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class MaxLength:
    column: str
    limit: int


@dataclass(frozen=True)
class Unique:
    """No two rows share the columns; rows with a null among them are exempt, as in SQL."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class References:
    """Every complete key exists in the parent."""

    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


Rule = NotNull | MaxLength | Unique | References


def validate(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of offending rows."""
    return validate_all({"": table}, {"": rules}).select("rule", "violations")


def validate_all(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """(table_name, rule, violations) of every table that has rules."""
    every = [(name, rule) for name in tables for rule in rules[name]]
    passes: dict[int, tuple[DataFrame, list[Column]]] = {}

    def name_in(table: DataFrame, number: int, key: Column, named: Column | int, known: int = 0) -> None:
        _, entries = passes.setdefault(id(table), (table, []))
        entries.append(F.struct(
            F.lit(number).alias("rule"), key.alias("key"), F.lit(named).cast("int").alias("named"), F.lit(known).alias("known"),
        ))

    none = F.lit(None).cast("array<string>")
    for number, (name, rule) in enumerate(every):
        table = tables[name]
        if isinstance(rule, NotNull):
            name_in(table, number, none, F.col(rule.column).isNull())
        elif isinstance(rule, MaxLength):
            name_in(table, number, none, F.coalesce(F.length(rule.column) > rule.limit, F.lit(False)))
        else:
            name_in(table, number, _key(rule.columns), 1)
            if isinstance(rule, References):
                name_in(rule.parent, number, _key(rule.parent_columns), 0, 1)
    parts = [table.select(F.inline(F.array(*entries))) for table, entries in passes.values()]
    groups = reduce(DataFrame.unionAll, parts).groupBy("rule", "key").agg(
        F.sum("named").alias("named"), F.max("known").alias("known")
    )
    counts = groups.agg(*[
        F.coalesce(F.sum(F.when(F.col("rule") == number, _broken(rule))), F.lit(0)).alias(f"r{number}")
        for number, (_, rule) in enumerate(every)
    ])
    rows = [
        F.struct(F.lit(name).alias("table_name"), F.lit(_label(rule)).alias("rule"), F.col(f"r{number}").alias("violations"))
        for number, (name, rule) in enumerate(every)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _key(columns: Sequence[str]) -> Column:
    """The columns as text; null where one of them is, as such a key refers to nothing and repeats nothing."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(complete, F.array(*[F.col(c).cast("string") for c in columns]))


def _broken(rule: Rule) -> Column:
    """Offending rows of a group."""
    if isinstance(rule, Unique):
        return F.when(F.col("key").isNotNull(), F.col("named") - 1)
    if isinstance(rule, References):
        return F.when(F.col("key").isNotNull() & (F.col("known") == 0), F.col("named"))
    return F.col("named")


def _label(rule: Rule) -> str:
    if isinstance(rule, NotNull):
        return f"not null: {rule.column}"
    if isinstance(rule, MaxLength):
        return f"length <= {rule.limit}: {rule.column}"
    kind = "unique" if isinstance(rule, Unique) else "references"
    return f"{kind}: {', '.join(rule.columns)}"


# the limits below are fixed values, as the tables declare them


def silver_rules(guests: DataFrame, bookings: DataFrame, properties: DataFrame) -> dict[str, list[Rule]]:
    """The constraints of the conformed tables, by table."""
    key = ("booking_id", "created_year")
    return {
        "guests": [Unique(("guest_id",)), NotNull("national_id"), MaxLength("national_id", 20),
                   MaxLength("full_name", 200), MaxLength("phone", 50)],
        "bookings": [Unique(key), NotNull("booking_id"), NotNull("created_year"), NotNull("property_id"),
                     NotNull("guest_id"), References(("property_id",), properties, ("property_id",)),
                     References(("guest_id",), guests, ("guest_id",)), MaxLength("channel", 100),
                     MaxLength("sub_channel", 100), MaxLength("agent_name", 200), MaxLength("booking_status", 50),
                     MaxLength("payment_status", 50), MaxLength("currency", 20)],
        "stay_nights": [NotNull("booking_id"), NotNull("created_year"), References(key, bookings, key),
                        Unique((*key, "stay_date", "room_number")), MaxLength("room_type", 50)],
    }


def dimension_rules(agents: DataFrame, properties: DataFrame) -> dict[str, list[Rule]]:
    """The constraints of dimensions and targets, by table."""
    return {
        "properties": [Unique(("property_id",)), NotNull("property_id"), NotNull("name"), MaxLength("name", 200)],
        "dim_channel": [Unique(("channel",)), NotNull("channel"), NotNull("area")],
        "dim_agent": [Unique(("agent_src_id",)), NotNull("agent_src_id"), NotNull("agent_name"), NotNull("area")],
        "dim_room_type": [Unique(("room_type",)), NotNull("room_type"), NotNull("category")],
        "property_targets": [Unique(("property_id", "year", "month")), NotNull("year"), NotNull("month"),
                             References(("property_id",), properties, ("property_id",))],
        "agent_targets": [Unique(("agent_id", "year", "month")), NotNull("year"), NotNull("month"),
                          References(("agent_id",), agents, ("agent_id",))],
    }
