"""The adapter's tables as common table expressions for the SQL oracle."""

from __future__ import annotations


def slot_sql(time: str) -> str:
    shift = f"CASE hour({time}) % 3 WHEN 0 THEN 0 WHEN 1 THEN -1 ELSE 1 END"
    return f"strftime(date_trunc('hour', {time}) + to_hours({shift}), '%Y-%m-%d %H:%M:%S')"


def minute_sql(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%d %H:%M')"


RAW = """raw AS (
  SELECT event_id AS flight_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS airline_iata,
         CAST(user_id % 25 AS VARCHAR) AS dep_icao,
         CAST((user_id + event_id) % 30 AS VARCHAR) AS arr_icao,
         CAST(user_id % 25 AS VARCHAR) AS dep_iata,
         CAST((user_id + event_id) % 30 AS VARCHAR) AS arr_iata,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS dep_time_utc,
         ts + INTERVAL 2 HOURS AS arr_time_utc,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS delayed,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 300 AS DOUBLE) END AS duration
  FROM events)"""

FLIGHTS = f"""{RAW},
fence AS (
  SELECT q[2] + 1.5 * (q[2] - q[1]) AS top
  FROM (SELECT quantile_cont(delayed, [0.25, 0.75]) AS q FROM raw)),
flights AS (
  SELECT r.*, coalesce(d.n_name, '') AS dep_city, coalesce(a.n_name, '') AS arr_city,
         coalesce({slot_sql('dep_time_utc')}, '') AS dep_time_utc_3hr,
         coalesce({slot_sql('arr_time_utc')}, '') AS arr_time_utc_3hr,
         CASE WHEN r.delayed > (SELECT top FROM fence) THEN 1 ELSE 0 END AS outlier
  FROM raw r
  LEFT JOIN nation d ON r.dep_icao = CAST(d.n_nationkey AS VARCHAR)
  LEFT JOIN nation a ON r.arr_icao = CAST(a.n_nationkey AS VARCHAR))"""

WEATHER = f"""slots AS (
  SELECT n_name AS city, {slot_sql('ts')} AS dt_txt, min(event_id) AS first_id, max(event_id) AS last_id,
         min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean, count(*) AS n,
         min(event_type) AS kind
  FROM events JOIN nation ON user_id % 25 = n_nationkey
  WHERE event_type IN ('view', 'error')
  GROUP BY 1, 2),
weather AS (
  SELECT city, dt_txt,
         CAST(n % 101 AS INTEGER) AS clouds_all,
         CAST(epoch(CAST(dt_txt AS TIMESTAMP)) AS BIGINT) AS dt,
         low AS main_feels_like,
         CAST(last_id % 1000 AS DOUBLE) AS main_grnd_level,
         CAST(n % 100 AS DOUBLE) AS main_humidity,
         CAST(n AS DOUBLE) AS main_pressure,
         CAST(first_id % 1000 AS DOUBLE) AS main_sea_level,
         mean AS main_temp,
         high - low AS main_temp_kf,
         high AS main_temp_max,
         low AS main_temp_min,
         CAST(n % 10 AS DOUBLE) / 10 AS pop,
         CASE WHEN hour(CAST(dt_txt AS TIMESTAMP)) BETWEEN 6 AND 17 THEN 'd' ELSE 'n' END AS sys_pod,
         CAST(last_id % 10000 AS INTEGER) AS visibility,
         kind AS weather_description,
         CAST(first_id % 50 AS VARCHAR) || 'd' AS weather_icon,
         CAST(first_id % 900 AS INTEGER) AS weather_id,
         upper(kind) AS weather_main,
         CAST(last_id % 360 AS INTEGER) AS wind_deg,
         high AS wind_gust,
         low AS wind_speed
  FROM slots)"""


def with_flights(body: str) -> str:
    return f"WITH {FLIGHTS}\n{body}"


def with_both(body: str) -> str:
    return f"WITH {FLIGHTS},\n{WEATHER}\n{body}"


DEP_ON = "f.dep_city = d.city AND f.dep_time_utc_3hr = d.dt_txt"
ARR_ON = "f.arr_city = a.city AND f.arr_time_utc_3hr = a.dt_txt"
ARR_ON_COMPAT = "f.dep_city = a.city AND f.dep_time_utc_3hr = a.dt_txt"


def joined(columns: str, arrival: str = ARR_ON, where: str = "") -> str:
    return with_both(
        f"SELECT {columns} FROM flights f LEFT JOIN weather d ON {DEP_ON} LEFT JOIN weather a ON {arrival} {where}"
    )


def training_sql(columns: str = "", arrival: str = ARR_ON) -> str:
    return joined(
        f"""{columns}
  coalesce(f.airline_iata, 'null') AS airline_iata, coalesce(f.dep_iata, 'null') AS dep_iata,
  coalesce(f.arr_iata, 'null') AS arr_iata, coalesce(f.duration, 0) AS duration,
  coalesce(CAST(hour(f.dep_time_utc) * 60 + minute(f.dep_time_utc) AS DOUBLE), 0) AS dep_time_float,
  coalesce(d.weather_description, 'null') AS dep_desc, coalesce(a.weather_description, 'null') AS arr_desc,
  CAST(CASE WHEN f.delayed > 45 THEN 1 ELSE 0 END AS INTEGER) AS target""",
        arrival,
        "WHERE f.outlier = 0",
    )
