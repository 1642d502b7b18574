"""Flights and weather stored in matching buckets, so that joining both roles moves the flights once.

Weather lies in buckets of its key and is never shuffled again. Flights lie in buckets of their
departure key, so the departure join moves nothing; the arrival join sends the flights to the
buckets of the weather, the only exchange. Keys that hold more than their share of the flights are
split when the tables are written: a flight's copy number is part of its bucket, and such a key's
weather is there once for each copy.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaycast.operators.lookup import hot_keys
from delaycast.operators.sizing import Sized, settle, sized
from delaycast.operators.weather import ARRIVAL, DEPARTURE, role_keys
from delaycast.schemas import WEATHER_KEYS
from delaycast.session import scratch_path

_COPY = {DEPARTURE: "_dep_copy", ARRIVAL: "_arr_copy"}
_WEATHER_COPY = "_copy"


class Bucketed(NamedTuple):
    """Names of the two tables in the session's catalog, and their number of buckets."""

    flights: str
    weather: str
    buckets: int


def _store(df: DataFrame, name: str, keys: list[str], buckets: int) -> str:
    """Write ``df`` as a table of one sorted file per bucket in the shared folder."""
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", scratch_path(df.sparkSession, name)).saveAsTable(table)
    return table


def _with_copy(flights: DataFrame, hot: DataFrame, role: str) -> DataFrame:
    """The copy number that a flight's key and the flight itself give it; 0 for keys that are not split."""
    pairs = role_keys(role)
    matching = " AND ".join(f"`{flight}` <=> _hot.`{key}`" for flight, key in pairs)
    spread = f"pmod(xxhash64(spark_partition_id(), {', '.join(f'`{c}`' for c in flights.columns)}), coalesce(_copies, 1))"
    joined = flights.join(F.broadcast(hot).alias("_hot"), F.expr(matching), "left")
    kept = [F.col(f"`{c}`") for c in flights.columns]
    return joined.select(*kept, F.expr(f"CAST({spread} AS INT)").alias(_COPY[role]))


def store_bucketed(flights: DataFrame, weather: DataFrame | Sized, buckets: int | None = None) -> Bucketed:
    """Write both tables; ``buckets`` defaults to the session's shuffle partitions.

    Done once after an ingest; any number of joins follow. Hot keys of both roles are found from
    counts, and there are fewer of them than buckets.
    """
    spark = flights.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = None
    for role in (DEPARTURE, ARRIVAL):
        pairs = role_keys(role)
        found = hot_keys(flights, [flight for flight, _ in pairs], buckets).withColumnsRenamed(dict(pairs))
        hot = found if hot is None else hot.unionByName(found)
    hot = hot.groupBy(*WEATHER_KEYS).agg(F.max("__copies").alias("_copies"))
    hot = settle(hot, "hot-keys").frame
    placed = _with_copy(_with_copy(flights, hot, DEPARTURE), hot, ARRIVAL)
    departure = [flight for flight, _ in role_keys(DEPARTURE)]
    stored_flights = _store(placed, "flights_bucketed", [*departure, _COPY[DEPARTURE]], buckets)
    copied = sized(weather).frame.join(F.broadcast(hot), WEATHER_KEYS, "left")
    copied = copied.withColumn(_WEATHER_COPY, F.expr("explode(sequence(0, coalesce(_copies, 1) - 1))")).drop("_copies")
    stored_weather = _store(copied, "weather_bucketed", [*WEATHER_KEYS, _WEATHER_COPY], buckets)
    return Bucketed(stored_flights, stored_weather, buckets)


def _role_join(flights: DataFrame, weather: DataFrame, role: str, columns: list[str]) -> DataFrame:
    keys = [*role_keys(role), (_COPY[role], _WEATHER_COPY)]
    side = weather.select(*[key for _, key in keys], *[F.col(f"`{c}`").alias(f"{role}_{c}") for c in columns])
    named = {key: f"_{role}_{key}" for _, key in keys}
    side = side.withColumnsRenamed(named)
    on = " AND ".join(f"`{flight}` = `{named[key]}`" for flight, key in keys)
    return flights.join(side.hint("merge"), F.expr(on), "left").drop(*named.values())


def dual_role_bucketed(spark: SparkSession, tables: Bucketed, columns: list[str] | None = None) -> DataFrame:
    """Both roles' weather on each stored flight, as ``dual_role_weather`` gives it."""
    flights, weather = spark.table(tables.flights), spark.table(tables.weather)
    if columns is None:
        columns = [c for c in weather.columns if c not in (*WEATHER_KEYS, _WEATHER_COPY)]
    departed = _role_join(flights, weather, DEPARTURE, columns)
    return _role_join(departed, weather, ARRIVAL, columns).drop(*_COPY.values())
