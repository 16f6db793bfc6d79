"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.tables import stored

#: Each round at least halves the longest way to a component's smallest member; this many rounds mean a fault.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (u, v): root is the smallest node reachable from it.

    Alternates two kinds of rounds until nothing changes: each node hangs its larger neighbours below its smallest
    neighbour, then its smaller ones and itself. Links stay as many rows as there were at first, and never gather in one
    group: only minima are aggregated. Every round is written to the shared folder, so a lost executor costs a re-read.
    An empty table gives an empty one; loops, repeated links and null ends are ignored.
    """
    edges = stored(
        links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        upward = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # u < v
        larger = upward.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        hung = stored(larger.where("u <> v").distinct(), "links")
        smallest = hung.groupBy("u").agg(F.min("v").alias("low"))
        lowered = hung.join(smallest, "u")
        edges = stored(
            lowered.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct(),
            "links",
        )
        former, state = state, _state(edges)
        if state == former:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()


def _state(edges: DataFrame) -> tuple:
    """Equal for equal link tables; a sum of row hashes, so nothing is collected."""
    code = F.xxhash64("u", "v")
    low = F.sum(code.bitwiseAND(F.lit(0xFFFFFFFF)))
    return tuple(edges.agg(F.count("*"), low, F.sum(F.shiftrightunsigned(code, 32))).head())
