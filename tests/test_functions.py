import datetime as dt

from pyspark.sql import functions as F

from stayline.functions.dates import moment, month_bounds, parse_day, seconds_of_day, today_in
from stayline.functions.rules import not_unconfirmed_hold, percent, round2
from stayline.functions.text import country_of, given_names, mobile_number, title_case
from stayline.vocabulary import PMS
from tests.conftest import day


def evaluate(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in frame.orderBy("i").select(expression(F.col("x"))).collect()]


def test_title_case_starts_a_word_at_every_run_of_letters_and_digits(spark):
    texts = ["O'BRIEN PEREZ-LOPEZ", "maría  ÑUÑEZ", "room 2b", "", None, "--x"]
    assert evaluate(spark, texts, "string", title_case) == [
        "O'Brien Perez-Lopez", "María  Ñuñez", "Room 2b", "", None, "--X",
    ]


def test_country_needs_exactly_eight_digits(spark):
    ids = ["12345678", "1234567", "1234567A", "12345678\n", "123456789"]
    home, abroad = PMS.domestic, PMS.foreign
    assert evaluate(spark, ids, "string", country_of) == [home, abroad, abroad, abroad, abroad]


def test_mobile_number(spark):
    phones = ["987654321", "51987654321", "98765432", "n/a", None, "987654321\n", "52987654321"]
    assert evaluate(spark, phones, "string", mobile_number) == [
        "51987654321", "51987654321", None, None, None, None, None,
    ]


def test_given_names_are_the_third_and_fourth_word(spark):
    names = ["Perez Lopez Ana Maria", "Perez Ana", "Perez  Ana Maria"]
    assert evaluate(spark, names, "string", given_names) == ["Ana Maria", " ", "Ana Maria"]


def test_dates(spark):
    texts = ["1/2/2025", "01/02/2025", "31/02/2025", "", None, "2025-02-01", "x"]
    first = day("2025-02-01")
    assert evaluate(spark, texts, "string", parse_day) == [first, first, None, None, None, None, None]


def test_times(spark):
    texts = ["9:05:00", "10:00:00", "23:59", "24:00:00", "", None, "9:5"]
    assert evaluate(spark, texts, "string", seconds_of_day) == [32700, 36000, 86340, None, None, None, None]


def test_moment(spark):
    made = evaluate(spark, [32705, None], "int", lambda s: moment(F.lit(day("2025-02-01")), s))
    assert made == [dt.datetime(2025, 2, 1, 9, 5, 5), None]


def test_month_bounds():
    assert month_bounds(day("2024-12-31")) == (day("2024-12-01"), day("2025-01-01"))
    assert month_bounds(day("2024-02-10")) == (day("2024-02-01"), day("2024-03-01"))


def test_today_follows_the_zone():
    east, west = today_in("Pacific/Kiritimati"), today_in("Pacific/Pago_Pago")
    assert dt.timedelta(0) < east - west <= dt.timedelta(2)


def test_round2_rounds_half_away_from_zero(spark):
    assert evaluate(spark, [0.125, -0.125, 66.666, None], "double", round2) == [0.13, -0.13, 66.67, None]


def test_percent_is_null_safe(spark):
    assert evaluate(spark, [0, 3, None], "int", lambda w: percent(F.lit(2), w)) == [None, 66.67, None]


def test_hold_rule_is_three_valued(spark):
    paid, held = PMS.unpaid, PMS.held
    frame = spark.createDataFrame(
        [(1, paid, held), (2, paid, "Confirmado"), (3, None, held), (4, None, "Confirmado"), (5, "Pagado", held)],
        "i int, payment_status string, booking_status string",
    )
    assert sorted(r.i for r in frame.where(not_unconfirmed_hold()).collect()) == [2, 4, 5]
