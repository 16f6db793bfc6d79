import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayline.operators.ordered import assign_keys, rank_within
from tests.conftest import rows_of


@pytest.fixture
def skewed(spark):
    """A third of all rows in one group, a group without key, and many small groups."""
    pick = random.Random(3)
    rows = [("hot", pick.randrange(40), n) for n in range(400)] + [(None, pick.randrange(5), 1000 + n) for n in range(150)]
    rows += [(f"g{pick.randrange(300)}", pick.randrange(9), 2000 + n) for n in range(650)]
    pick.shuffle(rows)
    return spark.createDataFrame(rows, "k string, at int, id int").repartition(7)


@pytest.mark.parametrize("slices", [1, 2, 9])
def test_groups_of_any_size_are_numbered_alike(spark, skewed, slices):
    window = Window.partitionBy("k").orderBy("at", "id")
    wanted = skewed.withColumns(
        {
            "n": F.row_number().over(window), "before": F.lag("id").over(window), "at_before": F.lag("at").over(window),
            "place": F.row_number().over(Window.orderBy("k", "at", "id")),
        }
    )
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        got = rank_within(
            skewed, ["k"], [F.col("at"), F.col("id")], "n", {"before": "id", "at_before": "at"}, position="place"
        )
        assert got.columns == wanted.columns
        assert rows_of(got) == rows_of(wanted)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 2)


def test_one_group_over_many_slices(spark):
    frame = spark.range(500).selectExpr("'only' as k", "id").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        got = rank_within(frame, ["k"], [F.col("id")], "n", {"before": "id"}).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 2)
    assert [r.n for r in got] == list(range(1, 501))
    assert [r.before for r in got] == [None, *range(499)]


def test_numbering_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, id int")
    assert rank_within(empty, ["k"], [F.col("id")], "n", {"before": "id"}, position="place").count() == 0


def test_assign_keys_is_dense_and_ordered(spark):
    names = [f"n{i:04d}" for i in range(997)]
    random.Random(5).shuffle(names)
    frame = spark.createDataFrame([(n, n[::-1]) for n in names], "name string, other string").repartition(5)
    keyed = assign_keys(frame, ["name"], "id", start=10).orderBy("name").collect()
    assert [r.id for r in keyed] == list(range(10, 10 + 997))
    assert all(r.other == r.name[::-1] for r in keyed)


def test_assign_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "name string")
    assert assign_keys(empty, ["name"], "id").count() == 0
