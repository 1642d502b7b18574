"""Sources and sinks: each query writes the driver rows in a feed's form and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.operators.columns import conform, to_numeric
from delaycast.plans.batch import prepare_flights
from delaycast.schemas import (
    FLIGHT_COLUMNS,
    FLIGHT_RECORD,
    FLIGHT_TABLE,
    WEATHER_COLUMNS,
    WEATHER_TABLE,
    WEATHER_TEXT,
)
from delaycast.session import scratch_path
from delaycast.sinks.files import write_csv
from delaycast.sinks.topics import to_json_batches, to_json_rows, write_topic_files
from delaycast.sources.feeds import STATUS_OK, flatten_forecasts, read_delay_feed, read_forecasts, read_schedule
from delaycast.sources.tables import read_csv
from delaycast.workload import adapter
from delaycast.workload.oracle import FLIGHTS, RAW, WEATHER, minute_sql
from delaycast.workload.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

# The flight record with the adapter's row number.
KEYED_RECORD = T.StructType([T.StructField("flight_id", T.LongType()), *FLIGHT_RECORD.fields])
SCHEDULE_COLUMNS = [
    "flight_id", "airline_iata", "dep_icao", "arr_icao", "dep_iata", "arr_iata", "dep_time_utc", "arr_time_utc",
    "delayed", "duration",
]
SCHEDULE_SQL = f"""flight_id, airline_iata, dep_icao, arr_icao, dep_iata, arr_iata,
  {minute_sql('dep_time_utc')} AS dep_time_utc, {minute_sql('arr_time_utc')} AS arr_time_utc, delayed, duration"""


@query("json_scan_explode", f"WITH {RAW} SELECT {SCHEDULE_SQL} FROM raw")
def json_scan_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay feed: documents with a ``response`` array of flight records."""
    path = scratch_path(spark, "delay-feed")
    write_topic_files(to_json_batches(adapter.schedule(spark, sf_dir), field="response"), path)
    schema = T.StructType([T.StructField("response", T.ArrayType(KEYED_RECORD))])
    return read_delay_feed(spark, path, schema).select(*SCHEDULE_COLUMNS)


@query("schedule_scan", f"WITH {RAW} SELECT {SCHEDULE_SQL} FROM raw")
def schedule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight schedules: JSON arrays of flight records, one array per line."""
    path = scratch_path(spark, "schedule")
    write_topic_files(to_json_batches(adapter.schedule(spark, sf_dir)), path)
    return read_schedule(spark, path, KEYED_RECORD, multiline=False).select(*SCHEDULE_COLUMNS)


def forecast_documents(weather: DataFrame) -> DataFrame:
    """Nested forecast documents, one per city and five days, hence at most 40 entries each."""
    fields = {
        group: ", ".join(f"{c} AS `{c.split('_', 1)[1]}`" for c in WEATHER_COLUMNS if c.startswith(f"{group}_"))
        for group in ("main", "clouds", "wind", "sys", "weather")
    }
    nested = [f"struct({fields[group]}) AS {group}" for group in ("main", "clouds", "wind", "sys")]
    entry = f"struct(dt, {', '.join(nested)}, array(struct({fields['weather']})) AS weather, visibility, pop, dt_txt)"
    documents = weather.groupBy("city", F.expr("dt DIV (5 * 24 * 3600) AS window")).agg(
        F.expr(f"collect_list({entry}) AS list")
    )
    return documents.selectExpr("city", f"{STATUS_OK} AS status", "list")


@query("json_flatten", f"WITH {WEATHER} SELECT {', '.join(WEATHER_COLUMNS)} FROM weather")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast feed: nested documents per city, flattened to the weather table's columns."""
    path = scratch_path(spark, "forecasts")
    write_topic_files(to_json_rows(forecast_documents(adapter.weather(spark, sf_dir).frame)), path)
    return flatten_forecasts(read_forecasts(spark, path))


def _csv_flight_sql(name: str) -> str:
    known = {
        "airline_iata": "airline_iata", "dep_icao": "dep_icao", "arr_icao": "arr_icao", "dep_iata": "dep_iata",
        "arr_iata": "arr_iata", "delayed": "delayed", "duration": "duration", "outlier": "CAST(outlier AS INTEGER)",
        "dep_time_utc": "strftime(date_trunc('minute', dep_time_utc), '%Y-%m-%d %H:%M:%S')",
        "arr_time_utc": minute_sql("arr_time_utc"),
        # Empty text does not survive CSV.
        "dep_city": "nullif(dep_city, '')", "arr_city": "nullif(arr_city, '')",
        "dep_time_utc_3hr": "nullif(dep_time_utc_3hr, '')", "arr_time_utc_3hr": "nullif(arr_time_utc_3hr, '')",
    }
    return f"{known.get(name, 'CAST(NULL AS VARCHAR)')} AS {name}"


@query("csv_typed_scan", f"WITH {FLIGHTS} SELECT {', '.join(_csv_flight_sql(c) for c in FLIGHT_COLUMNS)} FROM flights")
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared flights as CSV, read back as the typed 46-column table."""
    path = scratch_path(spark, "flight-csv")
    prepared = prepare_flights(adapter.schedule(spark, sf_dir), adapter.airports(spark, sf_dir))
    write_csv(conform(prepared, FLIGHT_TABLE), path)
    table = read_csv(spark, path, FLIGHT_TABLE)
    return table.withColumn("dep_time_utc", F.expr("CAST(dep_time_utc AS STRING)"))


def _csv_weather_sql(name: str) -> str:
    return name if name in WEATHER_TEXT else f"CAST({name} AS DOUBLE) AS {name}"


@query("csv_weather_scan", f"WITH {WEATHER} SELECT {', '.join(_csv_weather_sql(c) for c in WEATHER_COLUMNS)} FROM weather")
def csv_weather_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather as CSV, read back as the 23-column text table, numbers then cast."""
    path = scratch_path(spark, "weather-csv")
    write_csv(conform(adapter.weather(spark, sf_dir).frame, WEATHER_TABLE), path)
    table = read_csv(spark, path, WEATHER_TABLE)
    return to_numeric(table, [c for c in WEATHER_COLUMNS if c not in WEATHER_TEXT])


_ROW = ["flight_id", "airline_iata", "dep_iata", "arr_iata", "dep_time_utc", "duration"]


@query("to_json_rows", f"""WITH {RAW}
SELECT CAST(json_object('flight_id', flight_id, 'airline_iata', airline_iata, 'dep_iata', dep_iata,
  'arr_iata', arr_iata, 'dep_time_utc', {minute_sql('dep_time_utc')}, 'duration', duration) AS VARCHAR) AS value
FROM raw""")
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per row, missing fields written as null."""
    return to_json_rows(adapter.schedule(spark, sf_dir).select(*_ROW), keep_nulls=True)
