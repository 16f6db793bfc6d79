"""Surrogate keys that outlive rebuilds.

A table of members is rebuilt from scratch every time, so numbering it anew would hand the id of one member to another. The
registry of all members ever seen travels from one version to the next instead: whoever is in it keeps the id, whoever is
not gets the next free ones in natural order, and nobody is ever taken out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.ordered import assign_keys
from stayline.operators.validation import References, Unique, validate_all
from stayline.sources.store import stored


class KeysChanged(ValueError):
    """A registry lost a member, changed an id, or gave one id twice."""


def keyed(members: DataFrame, registry: DataFrame | None, key: str, id_column: str) -> DataFrame:
    """Members (one row per `key`) with their ids in front: those of the registry, and new ones behind its largest. Without
    a registry ids are dense from 1 in the order of the key."""
    if registry is None:
        return assign_keys(members, [key], id_column)
    members = stored(members, "members")
    known = members.join(registry.select(key, id_column), key).select(id_column, *members.columns)
    fresh = members.join(registry.select(key), key, "left_anti")
    last = registry.agg(F.max(id_column)).head()[0] or 0
    return known.unionByName(assign_keys(fresh, [key], id_column, start=last + 1))


def carried(registry: DataFrame | None, members: DataFrame, key: str, id_column: str) -> DataFrame:
    """The registry after members got their ids: all it held, and the new ones."""
    present = members.select(key, id_column)
    if registry is None:
        return present
    return registry.select(key, id_column).unionByName(present.join(registry.select(key), key, "left_anti"))


def check_append_only(before: DataFrame, after: DataFrame, key: str, id_column: str) -> None:
    """Raise where a pair of the former registry is missing or an id or member stands twice."""
    pair = (key, id_column)
    rules = {"before": [References(pair, after, pair)], "after": [Unique((key,)), Unique((id_column,))]}
    broken = validate_all({"before": before, "after": after}, rules).where("violations > 0").collect()
    if broken:
        raise KeysChanged("; ".join(f"{row['table_name']}: {row['violations']} rows break {row['rule']}" for row in broken))
