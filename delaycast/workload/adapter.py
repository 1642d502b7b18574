"""Flights, airports and weather derived from the ``events`` and ``nation`` tables.

Every event is a flight; every (nation, slot) with a ``view`` or ``error`` event has a forecast.
Missing values are placed by fixed moduli because the tables hold none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaycast.functions.missing import replace_columns
from delaycast.functions.timeslot import slot_3hr
from delaycast.operators.lookup import left_lookup
from delaycast.operators.outliers import iqr_outlier_flag
from delaycast.operators.places import both_cities
from delaycast.operators.sizing import Sized, plan_bytes, settle_if_large
from delaycast.schemas import WEATHER_COLUMNS


# Schemas of the driver tables in use; given, so that opening a table reads no file footer.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _unless(divisor: int, value: str) -> str:
    """NULL for every event whose id the divisor divides."""
    return f"CASE WHEN event_id % {divisor} <> 0 THEN {value} END"


def minute_text(name: str) -> str:
    """``YYYY-MM-DD HH:MM``, the way the feeds spell times."""
    return f"substring(CAST({name} AS STRING), 1, 16)"


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delay feed with real timestamps."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS flight_id",
        f"{_unless(11, 'event_type')} AS airline_iata",
        "CAST(user_id % 25 AS STRING) AS dep_icao",
        "CAST((user_id + event_id) % 30 AS STRING) AS arr_icao",
        "CAST(user_id % 25 AS STRING) AS dep_iata",
        "CAST((user_id + event_id) % 30 AS STRING) AS arr_iata",
        f"{_unless(13, 'ts')} AS dep_time_utc",
        "ts + INTERVAL '2' HOUR AS arr_time_utc",
        f"{_unless(17, 'value')} AS delayed",
        f"{_unless(7, 'CAST(event_id % 300 AS DOUBLE)')} AS duration",
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with times as text, as schedules and messages carry them."""
    flights = raw_flights(spark, sf_dir)
    return replace_columns(flights, {c: minute_text(c) for c in ("dep_time_utc", "arr_time_utc")})


def with_slots(flights: DataFrame) -> DataFrame:
    return replace_columns(flights, {f"{role}_time_utc_3hr": slot_3hr(f"{role}_time_utc") for role in ("dep", "arr")})


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.selectExpr("CAST(n_nationkey AS STRING) AS icao", "n_name AS city")


def located_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with slots and cities."""
    return both_cities(with_slots(raw_flights(spark, sf_dir)), airports(spark, sf_dir))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with slots, cities and the outlier flag."""
    flagged = iqr_outlier_flag(raw_flights(spark, sf_dir), "delayed")
    return both_cities(with_slots(flagged), airports(spark, sf_dir))


# The 21 payload columns of a forecast over (first, last, low, high, mean, n, kind, dt_txt), each with
# the type the nested feed gives it.
FORECAST = {
    "clouds_all": "CAST(n % 101 AS INT)",
    # Seconds since 1970 by calendar arithmetic, whatever the session's time zone.
    "dt": "CAST(unix_date(CAST(substring(dt_txt, 1, 10) AS DATE)) AS BIGINT) * 86400"
    " + CAST(substring(dt_txt, 12, 2) AS BIGINT) * 3600",
    "main_feels_like": "low",
    "main_grnd_level": "CAST(last % 1000 AS DOUBLE)",
    "main_humidity": "CAST(n % 100 AS DOUBLE)",
    "main_pressure": "CAST(n AS DOUBLE)",
    "main_sea_level": "CAST(first % 1000 AS DOUBLE)",
    "main_temp": "mean",
    "main_temp_kf": "high - low",
    "main_temp_max": "high",
    "main_temp_min": "low",
    "pop": "CAST(n % 10 AS DOUBLE) / 10",
    "sys_pod": "CASE WHEN CAST(substring(dt_txt, 12, 2) AS INT) BETWEEN 6 AND 17 THEN 'd' ELSE 'n' END",
    "visibility": "CAST(last % 10000 AS INT)",
    "weather_description": "kind",
    "weather_icon": "concat(CAST(first % 50 AS STRING), 'd')",
    "weather_id": "CAST(first % 900 AS INT)",
    "weather_main": "upper(kind)",
    "wind_deg": "CAST(last % 360 AS INT)",
    "wind_gust": "high",
    "wind_speed": "low",
}


def _forecast_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("event_type IN ('view', 'error')")
    return events.selectExpr(
        "CAST(user_id % 25 AS STRING) AS station", f"{slot_3hr('ts')} AS dt_txt", "event_id", "event_type", "value"
    )


def _with_city(rows: DataFrame, spark: SparkSession, sf_dir: str, **replaced: str) -> DataFrame:
    found = left_lookup(rows, airports(spark, sf_dir), [("station", "icao")]).where("city IS NOT NULL")
    columns = {**FORECAST, **replaced, "city": "city", "dt_txt": "dt_txt"}
    return found.selectExpr(*[f"{columns[c]} AS {c}" for c in WEATHER_COLUMNS])


def weather(spark: SparkSession, sf_dir: str) -> Sized:
    """One forecast per (city, slot), the 23 columns of the weather table.

    Aggregated by station number before the city is looked up. The lookup adds no rows, so the
    aggregate bounds the size; a large one is written once for all joins that use it.
    """
    aggregates = (
        "min(event_id) AS first",
        "max(event_id) AS last",
        "min(value) AS low",
        "max(value) AS high",
        "round(avg(value), 6) AS mean",
        "count(*) AS n",
        # The smaller of the two kinds, as a flag: text minima would need a sort.
        "CASE WHEN bool_or(event_type = 'error') THEN 'error' ELSE 'view' END AS kind",
    )
    grouped = _forecast_events(spark, sf_dir).groupBy("station", "dt_txt").agg(*[F.expr(a) for a in aggregates])
    return settle_if_large(_with_city(grouped, spark, sf_dir), "weather", plan_bytes(grouped))


def weather_reissues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast per event: many per (city, slot), told apart by their time of issue."""
    single = _forecast_events(spark, sf_dir).selectExpr(
        "station", "dt_txt", "event_id AS first", "event_id AS last", "value AS low", "value AS high",
        "value AS mean", "1 AS n", "event_type AS kind",
    )
    return _with_city(single, spark, sf_dir, dt="first")
