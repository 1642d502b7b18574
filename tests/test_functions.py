import math

import pytest

from delaycast.functions.labels import delay_label
from delaycast.functions.missing import clean_decoded_json, fill_missing, is_missing, nan_to_null
from delaycast.functions.timeslot import minutes_of_day, minutes_of_day_text, slot_3hr, slot_3hr_compat
from tests.conftest import tuples

FIXED = {
    "2023-04-08 09:59": "2023-04-08 09:00:00",
    "2023-04-08 01:59": "2023-04-08 00:00:00",
    "2023-04-08 08:00": "2023-04-08 09:00:00",
    "2023-04-08 23:10": "2023-04-09 00:00:00",
    "2023-03-31 23:10": "2023-04-01 00:00:00",
    "2024-02-28 23:59": "2024-02-29 00:00:00",
    "2023-12-31 23:00": "2024-01-01 00:00:00",
    None: "",
}
COMPAT = {
    "2023-04-08 09:59": "2023-04-08 09:00:00",
    "2023-04-08 01:59": "2023-04-08 0:00:00",
    "2023-04-08 08:00": "2023-04-08 9:00:00",
    "2023-04-08 22:00": "2023-04-08 21:00:00",
    "2023-04-08 20:30": "2023-04-08 21:00:00",
    "2023-04-08 23:10": "2023-04-9 00:00:00",
    "2023-03-31 23:10": "2023-03-32 00:00:00",
    None: "",
}


def evaluate(spark, expression, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"t {dtype}")
    return [r[0] for r in df.selectExpr(f"{expression} AS x").collect()]


@pytest.mark.parametrize(("mode", "expected"), [(slot_3hr, FIXED), (slot_3hr_compat, COMPAT)])
def test_slot_cases(spark, mode, expected):
    assert evaluate(spark, mode("t"), list(expected)) == list(expected.values())


def test_slot_of_every_hour_from_text_and_timestamp(spark):
    texts = [f"2023-05-10 {h:02d}:30" for h in range(24)]
    nearest = [h - h % 3 if h % 3 < 2 else h + 1 for h in range(24)]
    expected = [f"2023-05-{10 + h // 24} {h % 24:02d}:00:00" for h in nearest]
    assert evaluate(spark, slot_3hr("t"), texts) == expected
    stamped = spark.createDataFrame([(t,) for t in texts], "s string").selectExpr("CAST(s AS TIMESTAMP_NTZ) AS t")
    assert [r[0] for r in stamped.selectExpr(slot_3hr("t")).collect()] == expected


def test_slot_ignores_daylight_saving(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on that local day.
        assert evaluate(spark, slot_3hr("t"), ["2023-03-12 02:30"]) == ["2023-03-12 03:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_malformed_time_has_no_slot(spark):
    assert evaluate(spark, slot_3hr("t"), ["soon", ""]) == ["", ""]


def test_minutes_of_day(spark):
    assert evaluate(spark, minutes_of_day_text("t"), ["2023-04-08 10:07", None, "x"]) == [607.0, 0.0, 0.0]
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-04-08 23:59:59' AS t UNION ALL SELECT NULL")
    assert sorted(r[0] for r in df.selectExpr(minutes_of_day("t")).collect()) == [0.0, 1439.0]


def test_delay_label(spark):
    assert evaluate(spark, delay_label("t"), [45.0, 45.1, None, 30.0], "double") == [0, 1, 0, 0]


def test_missing_and_fill(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), (None, math.nan, None), ("null", None, 3)], "s string, d double, i int"
    )
    flags = [tuple(r) for r in df.selectExpr(is_missing(df, "s"), is_missing(df, "d")).collect()]
    assert flags == [(False, False), (True, True), (False, True)]
    assert [tuple(r) for r in fill_missing(df, ["s", "d", "i"]).collect()] == [
        ("a", 1.0, 1),
        ("null", 0.0, 0),
        ("null", 0.0, 3),
    ]
    assert [r[0] for r in df.selectExpr(nan_to_null("d")).collect()] == [1.0, None, None]


def test_bare_nan_is_missing_but_airport_code_is_not(spark):
    message = '[{"arr_iata": "NAN", "dep_iata": NaN, "dep_weather_description": NaN, "duration": NaN},' \
        ' {"arr_iata": "NaN", "dep_iata": "5D", "dep_weather_description": "NaN", "duration": 2}]'
    schema = "array<struct<arr_iata: string, dep_iata: string, dep_weather_description: string, duration: double>>"
    rows = spark.createDataFrame([(message,)], "value string").selectExpr(f"inline(from_json(value, '{schema}'))")
    cleaned = clean_decoded_json(rows, ["dep_weather_description"])
    assert cleaned.columns == rows.columns
    assert tuples(cleaned) == tuples(
        spark.createDataFrame([("NAN", None, None, None), ("NaN", "5D", None, 2.0)], rows.schema)
    )
