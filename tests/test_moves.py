"""What moves between tasks or is set down: figures that would grow with the tables."""

from pyspark.sql import functions as F

from stayline.operators import conform
from stayline.operators.guests import stay_fact, with_months
from stayline.operators.ordered import rank_within
from stayline.plans import registry
from stayline.plans.silver import split_unusable
from stayline.session import SETTINGS, tuned
from stayline.sources.testdata import Warehouse

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbering_inside_slices_shuffles_nothing(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    ranked = rank_within(frame, ["k"], [F.col("id")], "n", {"before": "id"}, position="place")
    assert "hashpartitioning" not in _plan(ranked)
    rows = {row["id"]: row for row in ranked.collect()}
    assert all(rows[i]["n"] == i // 3 + 1 and rows[i]["before"] == (i - 3 if i > 2 else None) for i in range(100))


def test_nulls_and_nans_are_groups_like_any_other(spark):
    values = [None, None, float("nan"), float("nan"), 1.0, 1.0, 2.0]
    frame = spark.createDataFrame([(k, i) for i, k in enumerate(values)], "k double, id int").repartition(3)
    got = rank_within(frame, ["k"], [F.col("id")], "n").orderBy("id").collect()
    assert [row["n"] for row in got] == [1, 2, 1, 2, 1, 2, 1]


def test_header_totals_move_lines_once(spark):
    row = ["id % 1 AS booking_id", "cast(id % 1 AS int) AS created_year", "date_add(date'2000-01-01', cast(id AS int)) AS stay_date", "1.0BD AS total"]
    totals = conform.header_totals(spark.range(200).selectExpr(*row))
    assert _plan(totals).count("Exchange hashpartitioning") == 1
    assert totals.head()["stay_days"] == 200


def test_lines_with_a_header_stay_where_they_are(spark):
    former = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        keys = spark.range(20_000).selectExpr("id AS booking_id", "2000 AS created_year")
        lines = keys.selectExpr("booking_id + 5 AS booking_id", "created_year", "booking_id AS line").unionByName(
            spark.sql("SELECT cast(NULL AS bigint) AS booking_id, 2000 AS created_year, -1L AS line"))
        kept = conform.keep_with_header(lines, keys)
        assert "SortMergeJoin" not in _plan(kept)
        assert kept.count() == 19_995
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", former)


def test_sales_meet_in_bookings_once(spark):
    w = Warehouse(tuned(spark), FOLDER)
    picked = conform.dedup_bookings(w.raw_stays, w.guests, registry.TIE_BREAK)
    assert _plan(picked).count("hashpartitioning(booking_id") == 1


def test_usable_lines_are_read_where_they_lie(spark, tmp_path):
    w = Warehouse(tuned(spark), FOLDER)
    conform.with_parsed(w.raw_stays).write.parquet(f"{tmp_path}/raw")
    usable, unusable = split_unusable(spark.read.parquet(f"{tmp_path}/raw"), w.properties.where("property_id <> 3"))
    assert all(f"{tmp_path}/raw" in name for name in usable.select("src_order").inputFiles() if "nation" not in name)
    assert usable.count() + unusable.count() == w.raw_stays.count() and unusable.count() > 0


def test_raw_lines_get_their_texts_after_the_join(spark):
    plan = Warehouse(spark, FOLDER).raw_stays._jdf.queryExecution().optimizedPlan().toString()
    assert "ROSA" in plan and "ROSA" not in plan[plan.index("Join Inner"):]


def test_the_export_is_compressed(spark, monkeypatch):
    seen = []
    land = registry.bronze.land_raw
    monkeypatch.setattr(registry.bronze, "land_raw", lambda spark, source, *more: seen.append(source) or land(spark, source, *more))
    w = Warehouse(tuned(spark), FOLDER)
    assert registry.land_raw_roundtrip(w).agg(F.sum("lines")).head()[0] == w.raw_stays.count()
    names = spark.read.csv(seen, header=True).inputFiles()
    assert names and all(name.endswith(".csv.gz") for name in names)


def test_gold_reads_stored_headers(spark, monkeypatch):
    seen, refresh = [], registry.refresh_gold
    monkeypatch.setattr(registry, "refresh_gold", lambda spark, bookings, *more: seen.append(bookings) or refresh(spark, bookings, *more))
    registry.gold_refresh(Warehouse(tuned(spark), FOLDER))
    assert all("/headers-" in name for name in seen[0].inputFiles())


def test_months_of_the_fact_are_made_of_its_dates(spark):
    w = Warehouse(tuned(spark), FOLDER)
    fact = stay_fact(w.headers, w.properties, w.guests, w.stay_nights)
    bare = fact.drop("created_month", "stay_year", "stay_month")
    assert with_months(bare).columns == fact.columns
    assert with_months(bare).exceptAll(fact).isEmpty()


def test_large_generated_methods_are_not_left_to_the_interpreter(spark):
    assert tuned(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == SETTINGS["spark.sql.codegen.hugeMethodLimit"] == "8000"
