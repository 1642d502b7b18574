"""Flights landed by departure day and station, so that a day or a station is read without the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.functions.labels import FEED_MINIMUM_DELAY
from delaycast.operators.lookup import hot_keys
from delaycast.sources.feeds import feed_filter

DAY, STATION = "dep_day", "dep_iata"


def departure_day(time: str = "dep_time_utc") -> str:
    """SQL: the day of a departure as text, from a timestamp or from text that begins with it."""
    return f"substring(CAST({time} AS STRING), 1, 10)"


def land(flights: DataFrame, path: str) -> None:
    """Write flights by day and station; the days and stations that occur replace what they had.

    A station's flights of a day go to one file, unless they are more than a task's share: then they
    are spread over as many files as that asks for. Flights without a time or station have folders of
    their own.
    """
    tasks = int(flights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dated = flights.withColumn(DAY, F.expr(departure_day()))
    keys = {DAY: "_day", STATION: "_station"}
    hot = F.broadcast(hot_keys(dated, list(keys), tasks).withColumnsRenamed(keys))
    matching = " AND ".join(f"`{a}` <=> `{b}`" for a, b in keys.items())
    spread = f"pmod(xxhash64({', '.join(f'`{c}`' for c in dated.columns)}), coalesce(__copies, 1))"
    placed = dated.join(hot, F.expr(matching), "left").withColumn("_part", F.expr(spread)).drop(*keys.values(), "__copies")
    writer = placed.repartition(tasks, DAY, STATION, "_part").drop("_part").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(DAY, STATION).parquet(path)


def read_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first_day: str | None = None,
    last_day: str | None = None,
    dep_iata: str | None = None,
    stations: DataFrame | None = None,
    minimum: float | None = FEED_MINIMUM_DELAY,
) -> DataFrame:
    """Landed flights of some days and of one station or of a table of ``stations`` (``dep_iata``).

    Days and a station become partition filters. A table of stations prunes at run time: its values
    are found first, and only their folders are listed for reading. ``schema`` is that of the flights;
    the day comes in as one more column.
    """
    whole = T.StructType([*[f for f in schema if f.name not in (DAY, STATION)], T.StructField(DAY, T.StringType())])
    whole = whole.add(STATION, T.StringType())
    flights = spark.read.schema(whole).parquet(path)
    if first_day is not None:
        flights = flights.where(F.col(DAY) >= first_day)
    if last_day is not None:
        flights = flights.where(F.col(DAY) <= last_day)
    if stations is not None:
        flights = flights.join(stations.select(STATION).distinct(), STATION, "left_semi")
    return feed_filter(flights, dep_iata, minimum)
