"""Scalar functions, projections, lookups, weather joins and distincts over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from delaycast.functions.labels import delay_label
from delaycast.functions.missing import fill_missing, is_missing, replace_columns
from delaycast.functions.timeslot import minutes_of_day, minutes_of_day_text, slot_3hr, slot_3hr_compat
from delaycast.operators.bucketed import dual_role_bucketed, store_bucketed
from delaycast.operators.columns import ensure_columns, select_columns, sort_columns, to_numeric
from delaycast.operators.outliers import iqr_outlier_flag, quartiles
from delaycast.operators.places import (
    both_cities,
    distinct_cities,
    distinct_cities_first_seen,
    stacked_cities,
    weather_cities,
)
from delaycast.operators.running_quantiles import RunningQuantiles
from delaycast.operators.weather import dual_role_weather, role_keys, weather_join
from delaycast.plans.features import serving_features, training_set
from delaycast.schemas import MESSAGE_COLUMNS, OPTIONAL_FEED_COLUMNS, WEATHER_PAYLOAD
from delaycast.session import scratch_path
from delaycast.sources.feeds import decode_payloads, feed_filter, reject_counts
from delaycast.sources.landing import land, read_landed
from delaycast.workload import adapter
from delaycast.workload.oracle import (
    ARR_ON,
    ARR_ON_COMPAT,
    DEP_ON,
    FLIGHTS,
    RAW,
    joined,
    minute_sql,
    slot_sql,
    training_sql,
    with_both,
    with_flights,
)
from delaycast.workload.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query


# --- times and scalars ---------------------------------------------------------------------


@query("slot_3hr", f"""WITH {RAW}
SELECT flight_id, coalesce({slot_sql('dep_time_utc')}, '') AS dep_slot,
       coalesce({slot_sql('arr_time_utc')}, '') AS arr_slot FROM raw""")
def slot_3hr_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = adapter.raw_flights(spark, sf_dir)
    return flights.selectExpr(
        "flight_id", f"{slot_3hr('dep_time_utc')} AS dep_slot", f"{slot_3hr('arr_time_utc')} AS arr_slot"
    )


def _compat_sql(time: str) -> str:
    h, text = f"hour({time})", minute_sql(time)
    return f"""CASE WHEN {time} IS NULL THEN ''
      WHEN {h} % 3 = 0 THEN substr({text}, 1, 13) || ':00:00'
      WHEN {h} % 3 = 1 THEN substr({text}, 1, 11) || CAST({h} - 1 AS VARCHAR) || ':00:00'
      WHEN {h} = 23 THEN strftime({time}, '%Y-%m-') || CAST(day({time}) + 1 AS VARCHAR) || ' 00:00:00'
      ELSE substr({text}, 1, 11) || CAST({h} + 1 AS VARCHAR) || ':00:00' END"""


@query("slot_3hr_compat", f"""WITH {RAW}
SELECT flight_id, {_compat_sql('dep_time_utc')} AS dep_slot, {_compat_sql('arr_time_utc')} AS arr_slot FROM raw""")
def slot_3hr_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = adapter.schedule(spark, sf_dir)
    return flights.selectExpr(
        "flight_id",
        f"{slot_3hr_compat('dep_time_utc')} AS dep_slot",
        f"{slot_3hr_compat('arr_time_utc')} AS arr_slot",
    )


_MINUTES_SQL = f"""WITH {RAW}
SELECT flight_id, coalesce(CAST(hour(dep_time_utc) * 60 + minute(dep_time_utc) AS DOUBLE), 0) AS dep_time_float
FROM raw"""


@query("minutes_of_day", _MINUTES_SQL)
def minutes_of_day_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = adapter.raw_flights(spark, sf_dir)
    return flights.selectExpr("flight_id", f"{minutes_of_day('dep_time_utc')} AS dep_time_float")


@query("minutes_of_day_str", _MINUTES_SQL)
def minutes_of_day_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = adapter.schedule(spark, sf_dir)
    return flights.selectExpr("flight_id", f"{minutes_of_day_text('dep_time_utc')} AS dep_time_float")


@query("null_fill", f"""WITH {RAW}
SELECT flight_id, coalesce(airline_iata, 'null') AS airline_iata, coalesce(duration, 0) AS duration,
       coalesce(delayed, 0) AS delayed FROM raw""")
def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["airline_iata", "duration", "delayed"]
    return fill_missing(adapter.raw_flights(spark, sf_dir).select("flight_id", *columns), columns)


@query("missing_flags", f"""WITH {RAW}
SELECT flight_id, CAST(airline_iata IS NULL AS INTEGER) AS airline_missing,
       CAST(duration IS NULL AS INTEGER) AS duration_missing FROM raw""")
def missing_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = adapter.raw_flights(spark, sf_dir)
    flags = (("airline_missing", "airline_iata"), ("duration_missing", "duration"))
    return flights.selectExpr("flight_id", *[f"CAST({is_missing(flights, c)} AS INT) AS {name}" for name, c in flags])


@query("to_numeric", f"""WITH {RAW}
SELECT CAST(flight_id AS DOUBLE) AS flight_id, TRY_CAST(airline_iata AS DOUBLE) AS airline_iata,
       TRY_CAST(dep_iata AS DOUBLE) AS dep_iata, duration FROM raw""")
def to_numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_numeric(adapter.raw_flights(spark, sf_dir).select("flight_id", "airline_iata", "dep_iata", "duration"))


@query("json_extract", """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events""")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.table(spark, sf_dir, "events")
    return events.selectExpr("event_id", "from_json(props, 'k int').k AS k")


# --- projections and filters -----------------------------------------------------------------


@query("ensure_columns", f"""WITH {RAW}
SELECT CAST('' AS VARCHAR) AS arr_actual, CAST('' AS VARCHAR) AS arr_actual_ts,
       CAST('' AS VARCHAR) AS arr_actual_utc, airline_iata, flight_id FROM raw""")
def ensured_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = adapter.raw_flights(spark, sf_dir).select("flight_id", "airline_iata")
    return sort_columns(ensure_columns(flights, OPTIONAL_FEED_COLUMNS))


@query("sorted_columns", f"""WITH {RAW}
SELECT airline_iata, arr_iata, arr_icao, {minute_sql('arr_time_utc')} AS arr_time_utc, delayed, dep_iata, dep_icao,
       {minute_sql('dep_time_utc')} AS dep_time_utc, duration, flight_id FROM raw""")
def sorted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sort_columns(adapter.schedule(spark, sf_dir))


@query("select_features", joined(f"""f.airline_iata, a.weather_description AS arr_weather_description, f.arr_iata,
  d.weather_description AS dep_weather_description, f.dep_iata,
  {minute_sql('f.dep_time_utc')} AS dep_time_utc, f.duration"""))
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = adapter.located_flights(spark, sf_dir)
    wide = dual_role_weather(located, adapter.weather(spark, sf_dir))
    rows = replace_columns(wide, {"dep_time_utc": adapter.minute_text("dep_time_utc")})
    return select_columns(rows, MESSAGE_COLUMNS)


@query("delay_label", f"""WITH {RAW}
SELECT flight_id, delayed, CAST(CASE WHEN delayed > 45 THEN 1 ELSE 0 END AS INTEGER) AS target FROM raw""")
def delay_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = adapter.raw_flights(spark, sf_dir)
    return flights.selectExpr("flight_id", "delayed", f"{delay_label('delayed')} AS target")


@query("filter_non_outlier", with_flights("""SELECT flight_id, delayed, CAST(outlier AS INTEGER) AS outlier
FROM flights WHERE outlier = 0"""))
def filter_non_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = iqr_outlier_flag(adapter.raw_flights(spark, sf_dir), "delayed")
    return flagged.where("outlier = 0").select("flight_id", "delayed", "outlier")


@query("feed_filter", f"WITH {RAW} SELECT flight_id, dep_iata, delayed FROM raw WHERE delayed >= 30 AND dep_iata = '7'")
def feed_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_filter(adapter.raw_flights(spark, sf_dir), dep_iata="7").select("flight_id", "dep_iata", "delayed")


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """Flights landed in two deliveries; the second repeats a day of the first."""
    path = scratch_path(spark, "landed")
    flights = adapter.raw_flights(spark, sf_dir).select("flight_id", "dep_iata", "dep_time_utc", "delayed")
    land(flights.where("dep_time_utc IS NULL OR dep_time_utc < TIMESTAMP_NTZ '2024-01-16'"), path)
    land(flights.where("dep_time_utc >= TIMESTAMP_NTZ '2024-01-15'"), path)
    return path, flights.schema


@query("feed_filter_landed", f"WITH {RAW} SELECT flight_id, dep_iata, delayed FROM raw WHERE delayed >= 30 AND dep_iata = '7'")
def feed_filter_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the landed table, of which only the station's folders are read."""
    path, schema = _landed(spark, sf_dir)
    return read_landed(spark, path, schema, dep_iata="7").select("flight_id", "dep_iata", "delayed")


@query("feed_filter_stations", f"""WITH {RAW}
SELECT flight_id, dep_iata, delayed FROM raw
WHERE delayed >= 30 AND dep_iata IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_regionkey = 1)
  AND dep_time_utc >= TIMESTAMP '2024-01-10' AND dep_time_utc < TIMESTAMP '2024-01-21'""")
def feed_filter_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days of the stations that a table lists."""
    path, schema = _landed(spark, sf_dir)
    nation = adapter.table(spark, sf_dir, "nation").where("n_regionkey = 1")
    stations = nation.selectExpr("CAST(n_nationkey AS STRING) AS dep_iata")
    found = read_landed(spark, path, schema, "2024-01-10", "2024-01-20", stations=stations)
    return found.select("flight_id", "dep_iata", "delayed")


_PROPS = T.StructType([T.StructField("k", T.IntegerType())])
# Some answers fail and some bodies break off in the middle.
_ENVELOPES_SQL = """envelopes AS (
  SELECT event_id, CASE WHEN event_id % 19 = 0 THEN 404 ELSE 200 END AS status,
         CASE WHEN event_id % 23 = 0 THEN substr(props, 1, 4) ELSE props END AS body FROM events),
judged AS (
  SELECT event_id, CASE WHEN status <> 200 THEN 'status' WHEN NOT json_valid(body) THEN 'corrupt' ELSE 'ok' END
         AS verdict, body FROM envelopes)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.table(spark, sf_dir, "events")
    envelopes = events.selectExpr(
        "event_id",
        "CASE WHEN event_id % 19 = 0 THEN 404 ELSE 200 END AS status",
        "CASE WHEN event_id % 23 = 0 THEN substring(props, 1, 4) ELSE props END AS body",
    )
    return decode_payloads(envelopes, _PROPS, "event_id")


@query("reject_bad_payloads", f"""WITH {_ENVELOPES_SQL}
SELECT event_id, CAST(body->>'$.k' AS INTEGER) AS k FROM judged WHERE verdict = 'ok'""")
def reject_bad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = _judged(spark, sf_dir).where("verdict = 'ok'")
    return accepted.selectExpr("event_id", "payload.k AS k")


@query("payload_verdicts", f"WITH {_ENVELOPES_SQL} SELECT verdict, count(*) AS n FROM judged GROUP BY verdict")
def payload_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_judged(spark, sf_dir))


# --- lookups and weather joins -----------------------------------------------------------------


@query("city_lookup", with_flights("SELECT flight_id, dep_icao, arr_icao, dep_city, arr_city FROM flights"))
def city_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = both_cities(adapter.raw_flights(spark, sf_dir), adapter.airports(spark, sf_dir))
    return located.select("flight_id", "dep_icao", "arr_icao", "dep_city", "arr_city")


@query("city_lookup_spread", with_flights("SELECT flight_id, dep_city, arr_city FROM flights"))
def city_lookup_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the shuffle join that a dimension too large to broadcast gets."""
    located = both_cities(adapter.raw_flights(spark, sf_dir), adapter.airports(spark, sf_dir), limit=0)
    return located.select("flight_id", "dep_city", "arr_city")


@query("weather_dep_join", with_both(f"""
SELECT flight_id, dep_city, dep_time_utc_3hr, weather_description AS dep_weather_description,
  main_temp AS dep_main_temp FROM flights f LEFT JOIN weather d ON {DEP_ON}"""))
def weather_dep_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["weather_description", "main_temp"]
    located = adapter.located_flights(spark, sf_dir).select("flight_id", "dep_city", "dep_time_utc_3hr")
    return weather_join(located, adapter.weather(spark, sf_dir), "dep", columns)


@query("weather_arr_join", with_both(f"""
SELECT flight_id, arr_city, arr_time_utc_3hr, weather_description AS arr_weather_description,
  main_temp AS arr_main_temp FROM flights f LEFT JOIN weather a ON {ARR_ON}"""))
def weather_arr_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["weather_description", "main_temp"]
    located = adapter.located_flights(spark, sf_dir).select("flight_id", "arr_city", "arr_time_utc_3hr")
    return weather_join(located, adapter.weather(spark, sf_dir), "arr", columns)


_DESCRIPTIONS = """f.flight_id, d.weather_description AS dep_weather_description,
  a.weather_description AS arr_weather_description"""


def _descriptions(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    keys = [left for role in ("dep", "arr") for left, _ in role_keys(role)]
    located = adapter.located_flights(spark, sf_dir).select("flight_id", *keys)
    wide = dual_role_weather(located, adapter.weather(spark, sf_dir), ["weather_description"], **options)
    return wide.select("flight_id", "dep_weather_description", "arr_weather_description")


@query("weather_dual_role", joined(_DESCRIPTIONS))
def weather_dual_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _descriptions(spark, sf_dir)


@query("weather_dual_role_spread", joined(_DESCRIPTIONS))
def weather_dual_role_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the shuffle join that a weather table too large to broadcast gets."""
    return _descriptions(spark, sf_dir, limit=0)


@query("weather_dual_role_bucketed", joined(_DESCRIPTIONS))
def weather_dual_role_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from bucketed tables: the flights are moved once, for the arrival role."""
    keys = [left for role in ("dep", "arr") for left, _ in role_keys(role)]
    flights = adapter.located_flights(spark, sf_dir).select("flight_id", *keys)
    tables = store_bucketed(flights, adapter.weather(spark, sf_dir), buckets=8)
    wide = dual_role_bucketed(spark, tables, ["weather_description"])
    return wide.select("flight_id", "dep_weather_description", "arr_weather_description")


@query("weather_join_compat", joined(_DESCRIPTIONS, ARR_ON_COMPAT))
def weather_join_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _descriptions(spark, sf_dir, compat=True)


_WIDE = ", ".join(f"{a}.{c} AS {p}_{c}" for a, p in (("d", "dep"), ("a", "arr")) for c in WEATHER_PAYLOAD)


@query("weather_dual_role_wide", joined(f"f.flight_id, {_WIDE}"))
def weather_dual_role_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = dual_role_weather(adapter.located_flights(spark, sf_dir), adapter.weather(spark, sf_dir))
    return wide.select("flight_id", *[f"{p}_{c}" for p in ("dep", "arr") for c in WEATHER_PAYLOAD])


@query("weather_join_latest", with_flights(f"""SELECT flight_id, w.event_type AS dep_weather_description, w.value AS dep_main_temp
FROM flights f LEFT JOIN (
  SELECT n_name AS city, {slot_sql('ts')} AS dt_txt, event_type, value,
         row_number() OVER (PARTITION BY n_name, {slot_sql('ts')} ORDER BY event_id DESC) AS newest
  FROM events JOIN nation ON user_id % 25 = n_nationkey WHERE event_type IN ('view', 'error')) w
ON f.dep_city = w.city AND f.dep_time_utc_3hr = w.dt_txt AND w.newest = 1"""))
def weather_join_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = adapter.located_flights(spark, sf_dir).select("flight_id", "dep_city", "dep_time_utc_3hr")
    reissued = adapter.weather_reissues(spark, sf_dir)
    columns = ["weather_description", "main_temp"]
    latest = weather_join(located, reissued, "dep", columns, dedupe=True)
    return latest.select("flight_id", "dep_weather_description", "dep_main_temp")


# --- distincts and unions --------------------------------------------------------------------


@query("union_cities", with_flights("SELECT dep_city AS city, 0 AS side FROM flights UNION ALL SELECT arr_city, 1 FROM flights"))
def union_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stacked_cities(adapter.located_flights(spark, sf_dir)).select("city", "side")


_STACKED = """stacked AS (
  SELECT dep_city AS city, 0 AS side, flight_id FROM flights UNION ALL SELECT arr_city, 1, flight_id FROM flights)"""


@query("distinct_cities", f"WITH {FLIGHTS}, {_STACKED} SELECT DISTINCT city FROM stacked")
def distinct_city_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_cities(adapter.located_flights(spark, sf_dir))


@query("weather_cities", f"WITH {FLIGHTS}, {_STACKED} SELECT DISTINCT city FROM stacked WHERE city <> ''")
def weather_city_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_cities(adapter.located_flights(spark, sf_dir))


@query("distinct_cities_first_seen", f"""WITH {FLIGHTS}, {_STACKED}
SELECT city, CAST(side AS INTEGER) AS side, flight_id AS first_key FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY side, flight_id) AS nth FROM stacked) WHERE nth = 1""")
def distinct_cities_by_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_cities_first_seen(adapter.located_flights(spark, sf_dir), "flight_id")


# --- outliers ---------------------------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return replace_columns(df, {c: f"round({c}, {digits})" for c in columns})


@query("quartiles", f"""WITH {RAW}
SELECT round(quantile_cont(delayed, 0.25), 6) AS q1, round(quantile_cont(delayed, 0.75), 6) AS q3
FROM raw""")
def delay_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quartiles(adapter.raw_flights(spark, sf_dir), "delayed"), "q1", "q3")


@query("quartiles_bracketed", """SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem""")
def price_quartiles_bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route for columns with too many distinct values for one buffer."""
    prices = adapter.table(spark, sf_dir, "lineitem")
    return _rounded(quartiles(prices, "l_extendedprice", distinct_limit=1000), "q1", "q3")


def _delays_by_day(spark: SparkSession, sf_dir: str) -> RunningQuantiles:
    """Three days' worth of delays, the second given twice."""
    flights = adapter.raw_flights(spark, sf_dir)
    running = RunningQuantiles(spark, scratch_path(spark, "running-quantiles"), distinct_limit=200)
    for day in ("0", "1", "2", "1"):
        running.add(day, flights.where(f"flight_id % 3 = {day}"), "delayed")
    return running


@query("quartiles_incremental", f"""WITH {RAW}
SELECT round(quantile_cont(delayed, 0.25), 6) AS q1, round(quantile_cont(delayed, 0.75), 6) AS q3
FROM raw""")
def quartiles_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of days that were taken up one after the other."""
    found = _delays_by_day(spark, sf_dir).quartiles()
    return _rounded(spark.createDataFrame([found], "q1 double, q3 double"), "q1", "q3")


@query("iqr_outlier_flag_incremental", with_flights("SELECT flight_id, CAST(outlier AS INTEGER) AS outlier FROM flights"))
def iqr_outliers_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag by a fence that does not read the history again."""
    flagged = _delays_by_day(spark, sf_dir).flag(adapter.raw_flights(spark, sf_dir), "delayed")
    return flagged.select("flight_id", "outlier")


@query("iqr_outlier_flag", with_flights("SELECT flight_id, delayed, CAST(outlier AS INTEGER) AS outlier FROM flights"))
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = iqr_outlier_flag(adapter.raw_flights(spark, sf_dir), "delayed")
    return flagged.select("flight_id", "delayed", "outlier")


@query("iqr_outlier_flag_documents", """SELECT doc_id, n_chars, CAST(CASE WHEN n_chars > (SELECT q[2] + 1.5 * (q[2] - q[1]) FROM (
  SELECT quantile_cont(CAST(n_chars AS DOUBLE), [0.25, 0.75]) AS q FROM documents)) THEN 1 ELSE 0 END AS INTEGER)
  AS outlier FROM documents""")
def iqr_outliers_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return iqr_outlier_flag(documents, "n_chars")


# --- feature sets -------------------------------------------------------------------------------


@query("training_set", training_sql("f.flight_id,"))
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set(adapter.flights(spark, sf_dir), adapter.weather(spark, sf_dir), keys=["flight_id"])


@query("training_set_compat", training_sql("f.flight_id,", ARR_ON_COMPAT))
def training_rows_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights, weather = adapter.flights(spark, sf_dir), adapter.weather(spark, sf_dir)
    return training_set(flights, weather, compat=True, keys=["flight_id"])


@query("serving_features", joined(f"""f.flight_id, coalesce(f.airline_iata, 'null') AS airline_iata,
  coalesce(a.weather_description, 'null') AS arr_desc, f.arr_iata,
  coalesce(d.weather_description, 'null') AS dep_desc, f.dep_iata,
  coalesce(CAST(hour(f.dep_time_utc) * 60 + minute(f.dep_time_utc) AS DOUBLE), 0) AS dep_time_float,
  coalesce(f.duration, 0) AS duration"""))
def serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = adapter.located_flights(spark, sf_dir)
    wide = dual_role_weather(located, adapter.weather(spark, sf_dir), ["weather_description"])
    rows = replace_columns(wide, {"dep_time_utc": adapter.minute_text("dep_time_utc")})
    return serving_features(rows.select("flight_id", *MESSAGE_COLUMNS)).select(
        "flight_id", "airline_iata", "arr_desc", "arr_iata", "dep_desc", "dep_iata", "dep_time_float", "duration"
    )
