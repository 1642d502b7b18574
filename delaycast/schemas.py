"""Explicit schemas. Nothing is inferred: codes such as ``5D`` would be read as numbers."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the two warehouse tables, in table order.
FLIGHT_COLUMNS = [
    "aircraft_icao", "airline_iata", "airline_icao", "arr_actual", "arr_actual_ts",
    "arr_actual_utc", "arr_baggage", "arr_city", "arr_delayed", "arr_estimated",
    "arr_estimated_ts", "arr_estimated_utc", "arr_gate", "arr_iata", "arr_icao",
    "arr_terminal", "arr_time", "arr_time_ts", "arr_time_utc", "arr_time_utc_3hr",
    "cs_airline_iata", "cs_flight_iata", "cs_flight_number", "delayed", "dep_actual",
    "dep_actual_ts", "dep_actual_utc", "dep_city", "dep_delayed", "dep_estimated",
    "dep_estimated_ts", "dep_estimated_utc", "dep_gate", "dep_iata", "dep_icao",
    "dep_terminal", "dep_time", "dep_time_ts", "dep_time_utc", "dep_time_utc_3hr",
    "duration", "flight_iata", "flight_icao", "flight_number", "outlier", "status",
]
WEATHER_COLUMNS = [
    "city", "clouds_all", "dt", "dt_txt", "main_feels_like", "main_grnd_level",
    "main_humidity", "main_pressure", "main_sea_level", "main_temp", "main_temp_kf",
    "main_temp_max", "main_temp_min", "pop", "sys_pod", "visibility",
    "weather_description", "weather_icon", "weather_id", "weather_main", "wind_deg",
    "wind_gust", "wind_speed",
]
# The two columns that identify a forecast; the other 21 are its payload.
WEATHER_KEYS = ["city", "dt_txt"]
WEATHER_PAYLOAD = [c for c in WEATHER_COLUMNS if c not in WEATHER_KEYS]
WEATHER_TEXT = ["city", "dt_txt", "sys_pod", "weather_description", "weather_icon", "weather_main"]

# What the pipeline adds to the feed, and the feed fields that may be absent.
DERIVED_FLIGHT_COLUMNS = ["outlier", "dep_time_utc_3hr", "arr_time_utc_3hr", "dep_city", "arr_city"]
OPTIONAL_FEED_COLUMNS = ["arr_actual", "arr_actual_ts", "arr_actual_utc"]

# Columns of a stream message and inputs of the delay model.
MESSAGE_COLUMNS = [
    "airline_iata", "arr_weather_description", "arr_iata", "dep_weather_description",
    "dep_iata", "dep_time_utc", "duration",
]
CATEGORICAL_FEATURES = ["airline_iata", "arr_desc", "arr_iata", "dep_desc", "dep_iata"]
NUMERIC_FEATURES = ["dep_time_float", "duration"]
METRIC_COLUMNS = ["precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc"]

_FLIGHT_TYPES = {
    "delayed": T.DoubleType(),
    "duration": T.DoubleType(),
    "outlier": T.IntegerType(),
    "dep_time_utc": T.TimestampNTZType(),
}


def _strings(names: list[str], special: dict[str, T.DataType] | None = None) -> T.StructType:
    special = special or {}
    return T.StructType([T.StructField(n, special.get(n, T.StringType()), True) for n in names])


FLIGHT_TABLE = _strings(FLIGHT_COLUMNS, _FLIGHT_TYPES)
WEATHER_TABLE = _strings(WEATHER_COLUMNS)
# The feed carries times as text; only delay and duration are numbers.
FLIGHT_RECORD = _strings(
    [c for c in FLIGHT_COLUMNS if c not in DERIVED_FLIGHT_COLUMNS],
    {"delayed": T.DoubleType(), "duration": T.DoubleType()},
)
DELAY_FEED = T.StructType([T.StructField("response", T.ArrayType(FLIGHT_RECORD), True)])

MESSAGE_RECORD = _strings(MESSAGE_COLUMNS, {"duration": T.DoubleType()})
AIRPORTS = _strings(["icao", "city"])
EVALUATION = T.StructType(
    [T.StructField("trial_id", T.IntegerType(), True)]
    + [T.StructField(m, T.DoubleType(), True) for m in METRIC_COLUMNS]
)

# One nested forecast entry: only the fields that end up in the weather table.
FORECAST_ENTRY = (
    "struct<dt: bigint,"
    " main: struct<temp: double, feels_like: double, temp_min: double, temp_max: double,"
    " pressure: double, sea_level: double, grnd_level: double, humidity: double, temp_kf: double>,"
    " weather: array<struct<id: int, main: string, description: string, icon: string>>,"
    " clouds: struct<all: int>,"
    " wind: struct<speed: double, deg: int, gust: double>,"
    " visibility: int, pop: double, sys: struct<pod: string>, dt_txt: string>"
)
FORECAST_FEED = f"city string, status int, list array<{FORECAST_ENTRY}>"
