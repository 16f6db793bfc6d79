from decimal import Decimal

import pytest

from stayline.sources import bronze, schemas
from stayline.sources.master import DuplicateKey, load_master
from tests.conftest import day, rows_of

JUNE = (day("2025-06-01"), day("2025-06-30"))


def nights(*texts, **more):
    return [dict(stay_date_txt=t, **more) for t in texts]


def content(spark, path):
    return rows_of(bronze.read_bronze(spark, path), "stay_date_txt", "booking_id", "batch_id")


def test_csv_lands_unchanged(spark, folder):
    headers = ["SUB CANAL" if c == "sub_channel" else c.upper() for c in schemas.RAW_COLUMNS]
    line = '5,10,01/02/2025,9:05:00,12345678,"PEREZ ""LA"" LOPEZ, ANA",,AGENCIAS,,ana,7,1,Reservado,No pagado,USD,31/02/2025,101,CABAÑA,1,10.5,10.5,2,'
    with open(f"{folder}/export.csv", "w", encoding="utf-8") as file:
        file.write(",".join(headers) + "\n" + line + "\n" + line.replace("31/02/2025", "28/02/2025") + "\n")
    assert bronze.land_raw(spark, f"{folder}/export.csv", f"{folder}/bronze", "b1") == 2
    rows = bronze.read_bronze(spark, f"{folder}/bronze").orderBy("ingest_seq").collect()
    assert rows[0].full_name == 'PEREZ "LA" LOPEZ, ANA' and rows[0].room_type == "CABAÑA"
    assert [r.stay_day for r in rows] == [None, day("2025-02-28")]
    assert [r.stay_month for r in rows] == [None, 202502]
    assert rows[0].sale_day == day("2025-02-01") and rows[0].sale_seconds == 32700
    assert rows[0].total == Decimal("10.5") and rows[0].children is None


def test_parquet_lands_by_name(spark, folder, raw):
    raw(*nights("01/06/2025")).withColumnRenamed("sub_channel", "SUB CANAL").write.parquet(f"{folder}/export")
    renames = {"SUB CANAL": "sub_channel"}
    assert bronze.land_raw(spark, f"{folder}/export", f"{folder}/bronze", "b1", "parquet", renames) == 1


def test_delete_keeps_what_stays_outside(spark, folder, raw):
    path = f"{folder}/bronze"
    dates = ["31/05/2025", "01/06/2025", "15/06/2025", "30/06/2025", "01/07/2025", "31/02/2025", None]
    # all of them sold inside the window, which must not matter
    bronze.land_batch(raw(*nights(*dates, created_date_txt="10/06/2025")), path, "b1")
    assert bronze.delete_window(spark, path, *JUNE) == 3
    assert [row[0] for row in content(spark, path)] == ["01/07/2025", "31/02/2025", "31/05/2025", None]
    assert bronze.delete_window(spark, path, *JUNE) == 0


def test_delete_of_part_of_a_month(spark, folder, raw):
    path = f"{folder}/bronze"
    bronze.land_batch(raw(*nights("09/06/2025", "10/06/2025", "05/07/2025", "06/07/2025")), path, "b1")
    bronze.land_batch(raw(*nights("12/06/2025")), path, "b2")
    before = {r.stay_date_txt: r.ingest_seq for r in bronze.read_bronze(spark, path).collect()}
    assert bronze.delete_window(spark, path, day("2025-06-10"), day("2025-07-05")) == 3
    left = bronze.read_bronze(spark, path).collect()
    assert sorted(r.stay_date_txt for r in left) == ["06/07/2025", "09/06/2025"]
    assert all(before[r.stay_date_txt] == r.ingest_seq for r in left)


@pytest.mark.parametrize("window", [JUNE, (day("2025-06-05"), day("2025-06-20"))])
def test_reload_twice_gives_the_same_table(spark, folder, raw, window):
    path = f"{folder}/bronze"
    bronze.land_batch(raw(*nights("02/06/2025", "10/06/2025", "31/02/2025", "01/07/2025")), path, "b1")
    batch = raw(*nights("10/06/2025", "11/06/2025", "x", "15/08/2025", booking_id=2))
    first = bronze.reload_window(spark, path, *window, batch, "b2")
    once = content(spark, path)
    inside = ["02/06/2025", "10/06/2025"] if window == JUNE else ["10/06/2025"]
    assert first == (len(inside), 4)
    assert [row for row in once if row[1] == 1] == sorted(
        (t, 1, "b1") for t in ["02/06/2025", "10/06/2025", "31/02/2025", "01/07/2025"] if t not in inside
    )
    bronze.reload_window(spark, path, *window, batch, "b2")
    assert content(spark, path) == once


def test_batch_landed_again_replaces_itself(spark, folder, raw):
    path = f"{folder}/bronze"
    bronze.land_batch(raw(*nights("01/06/2025", "01/07/2025", None)), path, "b1")
    bronze.land_batch(raw(*nights("02/06/2025", booking_id=9)), path, "b2")
    assert bronze.land_batch(raw(*nights("03/06/2025")), path, "b1") == 1
    assert content(spark, path) == [("02/06/2025", 9, "b2"), ("03/06/2025", 1, "b1")]


def test_arrival_order_does_not_depend_on_how_files_are_cut(spark, folder, raw):
    line = "{n},10,01/02/2025,9:05:00,12345678,NAME,,CH,,ana,7,1,R,P,USD,01/06/2025,101,A,1,10.5,10.5,2,0"
    for file in ("a", "b"):
        rows = [line.format(n=n) for n in range(200)]
        with open(f"{folder}/{file}.csv", "w", encoding="utf-8") as out:
            out.write("\n".join([",".join(schemas.RAW_COLUMNS), *rows]) + "\n")
    orders = []
    for cut in ("128m", "3k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
        spark.conf.set("spark.sql.files.minPartitionNum", "1" if cut == "128m" else "9")
        path = f"{folder}/bronze-{cut}"
        bronze.land_raw(spark, f"{folder}/*.csv", path, "b1")
        landed = bronze.read_bronze(spark, path)
        orders.append([r.booking_id for r in landed.orderBy(*schemas.ARRIVAL).collect()])
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert orders[0] == orders[1] == [*range(200), *range(200)]


def test_a_reload_that_breaks_off_leaves_the_table(spark, folder, raw, monkeypatch):
    path = f"{folder}/bronze"
    bronze.land_batch(raw(*nights("10/06/2025", "01/07/2025")), path, "b1")
    before = content(spark, path)

    def fail(*arguments):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(bronze, "publish", fail)
        with pytest.raises(OSError):
            bronze.reload_window(spark, path, *JUNE, raw(*nights("11/06/2025")), "b2")
    assert content(spark, path) == before
    assert bronze.reload_window(spark, path, *JUNE, raw(*nights("11/06/2025")), "b2") == (1, 1)


def test_vacuum_keeps_what_is_listed(spark, folder, raw):
    path = f"{folder}/bronze"
    for number in range(4):
        bronze.land_batch(raw(*nights(f"0{number + 1}/06/2025")), path, "b1")
    assert bronze.vacuum(spark, path, keep=1) > 0
    assert content(spark, path) == [("04/06/2025", 1, "b1")]


def test_bad_dates_are_split_off(raw):
    good, bad = bronze.normalise_dates(
        raw(*nights("1/2/2025", "31/02/2025", "", None, "garbage")), {"stay_date_txt": "stay_date"}
    )
    assert rows_of(good, "stay_date_txt", "stay_date") == [("1/2/2025", day("2025-02-01")), (None, None)]
    assert rows_of(bad, "stay_date_txt") == [("",), ("31/02/2025",), ("garbage",)]


def test_only_the_window_is_read(spark, folder, raw):
    path = f"{folder}/bronze"
    bronze.land_batch(raw(*nights("01/06/2025", "01/07/2025")), path, "b1")
    plan = bronze.read_bronze(spark, path).where(bronze._inside(*JUNE))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(stay_month" in plan


def test_master_needs_a_unique_key(spark, folder, table):
    frame = table("property_id int, name string", (1, "a"), (2, "b"))
    frame.write.csv(f"{folder}/good", header=True)
    frame.unionByName(frame.limit(1)).write.csv(f"{folder}/bad", header=True)
    schema = "property_id int, name string"
    assert load_master(spark, f"{folder}/good", schema, ["property_id"]).count() == 2
    with pytest.raises(DuplicateKey):
        load_master(spark, f"{folder}/bad", schema, ["property_id"])
