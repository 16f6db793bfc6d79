"""What is sent to the driver and to every task. On a few rows Spark broadcasts whatever no hint forbids."""

import random

import pytest
from pyspark.sql import functions as F

from stayline.llm import line_dedup, packing, simhash, tables
from stayline.sources import store


def nested(plan):
    """(depth, node) of each line of a plan's text."""
    for line in plan.splitlines():
        node = line.lstrip(" :+-*")
        yield len(line) - len(node), node


def broadcasts(plan):
    """Plans of the tables that are broadcast."""
    nodes = list(nested(plan))
    for at, (depth, node) in enumerate(nodes):
        if node.startswith("BroadcastExchange"):
            below = []
            for further, inner in nodes[at + 1 :]:
                if further <= depth:
                    break
                below.append(inner)
            yield below


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_plans(monkeypatch):
    """Plans of the tables that the operators' modules store while a test runs, by name."""
    plans = []

    def watch(*modules):
        def noted(df, name, path=None):
            plans.append((name, plan_of(df)))
            return store.stored(df, name, path)

        for module in modules:
            monkeypatch.setattr(module, "stored", noted)
        return plans

    return watch


def test_broadcasts_are_found():
    plan = """AdaptiveSparkPlan
+- Project
   +- BroadcastHashJoin
      :- BroadcastExchange
      :  +- Generate explode
      :     +- LocalTableScan
      +- Sort"""
    assert list(broadcasts(plan)) == [["Generate explode", "LocalTableScan"]]


def test_links_of_fingerprints_broadcast_no_probes(spark):
    prints = spark.range(50).withColumnRenamed("id", "print")
    assert not list(broadcasts(plan_of(simhash.links(prints))))


def variants():
    """Texts of lines with many variants, some of which share more differences than are listed as subsets."""
    pick = random.Random(3)
    rows = []
    for family in range(4):
        usual = [f"f{family}w{n}" for n in range(70)]
        odd = [f"odd{family}x{n}" for n in range(9)]
        for member in range(14):
            own = list(usual)
            for at in pick.sample(range(70), 3):
                own[at] = pick.choice(odd)
            if member < 5:
                own[:9] = odd
            rows.append(" ".join(own))
    pick.shuffle(rows)
    return rows


def exploded(plans):
    """Names of the tables whose plans broadcast what comes out of explode, be it counted before or not."""
    return [name for name, plan in plans if any("Generate explode" in " ".join(below) for below in broadcasts(plan))]


def test_near_duplicates_broadcast_nothing_exploded(docs, stored_plans):
    plans = stored_plans(simhash)
    simhash.drop_near_duplicates(docs("a b c d", "a b c d e", "x y z")).count()
    assert plans
    assert not exploded(plans)


def test_lines_broadcast_nothing_exploded(spark, docs, stored_plans):
    plans = stored_plans(line_dedup)
    kept = line_dedup.kept_lines(docs(*variants()), bits=12)
    assert kept.agg(F.sum("n_links")).head()[0] > 0
    assert "wide-members" in dict(plans)
    # a row per family of the words that most of its lines hold, which are fewer than those they are found among
    assert exploded(plans) == ["from-usual"]
    assert not exploded([("kept", plan_of(kept))])


def test_packing_broadcasts_a_row_per_block_at_most(spark, docs, stored_plans):
    found = tables.stored(
        spark.range(40).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "id % 9 + 1 AS length", "0L AS ids_crc32"), "found"
    )
    plans = stored_plans(packing)
    packed = packing.pack(found, capacity=10, block_pieces=10)
    assert packed.count() == 40
    below = [inner for _, plan in [*plans, ("packed", plan_of(packed))] for inner in broadcasts(plan)]
    assert below
    assert all("min(struct(n, " in " ".join(inner) for inner in below)


def test_tables_beyond_the_count_are_not_broadcast(spark, monkeypatch):
    ids = spark.range(10)
    assert list(broadcasts(plan_of(spark.range(20).join(tables.sized_broadcast(ids), "id"))))
    monkeypatch.setattr(tables, "BROADCAST_IDS", 9)
    assert not list(broadcasts(plan_of(spark.range(20).join(tables.sized_broadcast(ids), "id"))))


def test_lines_are_the_same_without_broadcasts(docs, monkeypatch):
    rows = docs(*variants())
    usual = sorted(map(str, line_dedup.kept_lines(rows, bits=12).collect()))
    monkeypatch.setattr(tables, "BROADCAST_IDS", 0)
    assert sorted(map(str, line_dedup.kept_lines(rows, bits=12).collect())) == usual
