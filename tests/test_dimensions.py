import datetime as dt

from stayline.operators import dimensions
from stayline.vocabulary import CHANNEL_SEED, ROOM_TYPE_SEED
from tests.conftest import day, rows_of


def test_calendar_covers_fifteen_years(spark):
    days = dimensions.build_calendar(spark)
    assert days.count() == 5478
    sunday = days.where("date = DATE '2025-03-02'").head()
    assert tuple(sunday) == (
        day("2025-03-02"), 2025, 3, 2, 1, 0, "Sunday", "March", True, "Mar 2025", "Q1 2025", 202503,
    )
    assert days.where("is_weekend").count() == days.where("day_of_week in (0, 6)").count()


def test_calendar_in_another_language(spark):
    row = dimensions.build_calendar(spark, day("2025-01-04"), day("2025-01-04"), "es").head()
    assert (row.day_name, row.month_name, row.month_label) == ("Sábado", "Enero", "Ene 2025")


def test_channel_seed(spark):
    seed = dimensions.channel_dim(spark)
    assert seed.count() == 12 and seed.select("area").distinct().count() == 3
    assert seed.where("active").count() == 12 and seed.select("channel").distinct().count() == len(CHANNEL_SEED)


def test_agent_keeps_the_latest_spelling(spark, raw):
    lines = raw(
        dict(agent_name="ana ruiz", created_date_txt="01/03/2025", created_time_txt="9:05:00", channel="AGENCIAS"),
        dict(agent_name="ANA RUÍZ", created_date_txt="01/03/2025", created_time_txt="10:00:00", channel="WALKING"),
        dict(agent_name="undated", created_date_txt="x"),
        dict(agent_src_id=0), dict(agent_src_id=None), dict(agent_src_id=9, agent_name=None),
        dict(agent_src_id=5, agent_name="bo", channel="UNHEARD OF"),
    )
    agents = dimensions.build_agent_dim(lines, dimensions.channel_dim(spark), as_of=dt.datetime(2025, 1, 1))
    assert rows_of(agents) == [
        (1, 5, "Bo", "Sin clasificar", True, dt.datetime(2025, 1, 1)),
        (2, 7, "Ana Ruíz", "Hotel", True, dt.datetime(2025, 1, 1)),
    ]


def test_room_types_know_both_encodings(table):
    names = [name for name, _ in ROOM_TYPE_SEED] + ["~ENTRADA", "suite"]
    lines = table("room_type string", *[(n,) for n in names], (None,), ("SUITE",))
    types = {r.room_type: r.category for r in dimensions.build_room_type_dim(lines).collect()}
    assert len(types) == 12
    assert types["CABAÑA"] == types["CABA�A"] == "Habitacion"
    assert types["~CARPAS"] == "Carpa" and types["~ENTRADA"] == types["suite"] == "Otros"


def test_refresh_appends_only_new_members(table):
    dim = table("id long, name string, area string", (4, "b", "old"), (2, "x", "old"))
    found = table("name string, area string", ("x", "new"), ("a", "new"), ("c", "new"))
    assert rows_of(dimensions.refresh_dim(dim, found, "name", "id")) == [
        (2, "x", "old"), (4, "b", "old"), (5, "a", "new"), (6, "c", "new"),
    ]
    assert rows_of(dimensions.refresh_dim(dim.where("false"), found, "name", "id"), "id") == [(1,), (2,), (3,)]
