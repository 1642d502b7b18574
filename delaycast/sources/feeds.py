"""Landed JSON feeds: delayed flights, flight schedules and weather forecasts.

Feeds are read as one JSON document per line by default, which Spark can split; ``multiline``
reads files that hold a single pretty-printed document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.functions.labels import FEED_MINIMUM_DELAY
from delaycast.schemas import DELAY_FEED, FLIGHT_RECORD, FORECAST_FEED, WEATHER_COLUMNS

# Fixed value: the answer status that counts as success.
STATUS_OK = 200


def read_delay_feed(
    spark: SparkSession, path: str, schema: T.StructType = DELAY_FEED, multiline: bool = False
) -> DataFrame:
    """Rows of the ``response`` array of each document."""
    documents = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return documents.select(F.explode("response").alias("r")).select("r.*")


def read_schedule(
    spark: SparkSession, path: str, schema: T.StructType = FLIGHT_RECORD, multiline: bool = True
) -> DataFrame:
    """Records of a flight-schedule file: a JSON array of objects (or, per line, one of either)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def feed_filter(flights: DataFrame, dep_iata: str | None = None, minimum: float | None = FEED_MINIMUM_DELAY) -> DataFrame:
    """The predicates the services apply at their end: minimum delay and departure airport."""
    if minimum is not None:
        flights = flights.where(f"delayed >= {minimum}")
    if dep_iata is not None:
        flights = flights.where(F.col("dep_iata") == dep_iata)
    return flights


def decode_payloads(envelopes: DataFrame, schema: T.StructType, *carry: str) -> DataFrame:
    """Envelopes (``status``, ``body``) -> carried columns, ``payload``, ``verdict``.

    The verdict is ``ok``, ``status`` (answer not successful) or ``corrupt`` (body is no JSON).
    """
    corrupt = "_corrupt_record"
    # A malformed object decodes to a struct of NULLs, so the parser is asked to keep its text.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    decoded = F.from_json("body", T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]), options)
    judged = envelopes.select(*carry, "status", decoded.alias("payload"))
    verdict = f"""CASE WHEN status IS NULL OR status <> {STATUS_OK} THEN 'status'
      WHEN payload IS NULL OR payload.{corrupt} IS NOT NULL THEN 'corrupt' ELSE 'ok' END AS verdict"""
    return judged.select(*carry, F.col("payload").dropFields(corrupt).alias("payload"), F.expr(verdict))


def reject_counts(decoded: DataFrame) -> DataFrame:
    """How many payloads there were of each verdict."""
    return decoded.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def read_forecasts(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Landed forecast documents: ``city``, ``status`` and the nested ``list``."""
    return spark.read.schema(FORECAST_FEED).option("multiLine", multiline).json(path)


def flatten_forecasts(documents: DataFrame) -> DataFrame:
    """Successful forecast documents -> one flat row per entry, columns of the weather table.

    Values keep the feed's types; absent objects, fields and an empty ``weather`` array give NULL.
    """
    entries = documents.where(f"status = {STATUS_OK}").selectExpr("city", "explode(list) AS e")
    return entries.selectExpr(*[f"{_entry_field(name)} AS {name}" for name in WEATHER_COLUMNS])


def _entry_field(name: str) -> str:
    """Where a weather column sits in a nested entry: ``<object>_<field>`` except for a few."""
    if name == "city":
        return "city"
    if name in ("dt", "dt_txt", "visibility", "pop"):
        return f"e.{name}"
    group, field = name.split("_", 1)
    return f"get(e.weather, 0).{field}" if group == "weather" else f"e.{group}.{field}"
