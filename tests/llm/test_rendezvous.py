import hashlib
import math
import re
import zlib

from pyspark.sql import functions as F

from stayline.llm.rendezvous import rendezvous, shard_documents, with_slots
from tests.llm.conftest import ODD


def plain(key, weights):
    def value(shard):
        digest = hashlib.md5(f"{key}:{shard}".encode()).hexdigest()[:13]
        return -weights[shard] / math.log((int(digest, 16) + 0.5) / 16**13)

    return max(range(len(weights)), key=lambda shard: (value(shard), -shard))


def test_shards_are_those_of_the_rule(spark):
    weights = [1.0, 2.0, 0.5, 1.0]
    rows = spark.range(300).select("id", rendezvous(F.col("id"), weights).alias("s")).collect()
    assert [r.s for r in rows] == [plain(r.id, weights) for r in rows]


def test_weights_and_growth(spark):
    ids = spark.range(20_000)
    few, more = [1.0, 3.0], [1.0, 3.0, 4.0]
    rows = ids.select(rendezvous(F.col("id"), few).alias("a"), rendezvous(F.col("id"), more).alias("b")).groupBy("a", "b").count().collect()
    counts = {(r.a, r.b): r["count"] for r in rows}
    assert set(counts) == {(0, 0), (1, 1), (0, 2), (1, 2)}
    assert abs((counts[1, 1] + counts[1, 2]) / 20_000 - 0.75) < 0.02
    assert abs((counts[0, 2] + counts[1, 2]) / 20_000 - 0.5) < 0.02


def test_documents_get_gapless_slots(docs):
    rows = shard_documents(docs(*ODD, *[f"t{n}" for n in range(300)], (None, "x"), (None, None), (5, "y")), shards=7).collect()
    assert len(rows) == len(ODD) + 303
    by_shard = {}
    for row in rows:
        by_shard.setdefault(row.shard, []).append(row.slot)
        assert row.grown_shard in (row.shard, 7)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert len({row.shard for row in rows if row.doc_id is None}) == 1
    for row in rows[:5]:
        if row.doc_id is not None and row.doc_id < len(ODD) and row.doc_id != 5:
            raw = (ODD[row.doc_id] or "").encode()
            assert (row.size, row.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    assert shard_documents(docs("a").where("false")).count() == 0


def test_one_group_that_fills_the_table(spark):
    frame = spark.range(1000).select(F.lit(1).alias("g"), F.lit(0).alias("k")).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", 6)
    try:
        slots = [r.slot for r in with_slots(frame, "g", ["k"]).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 2)
    assert sorted(slots) == list(range(1000))


def test_columns_may_have_any_names(spark):
    names = ["_row", "_pos", "_range", "_n", "_first", "_before"]
    frame = spark.range(50).select((F.col("id") % 3).alias("g"), "id", *[F.lit(7).alias(name) for name in names])
    got = with_slots(frame, "g", ["id"])
    assert got.columns == [*frame.columns, "slot"]
    assert sorted((r.g, r.slot, r.id, r._before) for r in got.collect()) == sorted((n % 3, n // 3, n, 7) for n in range(50))


def test_main_path_runs_no_python(docs):
    plan = shard_documents(docs("a", "b"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|Cartesian|NestedLoop", plan)
