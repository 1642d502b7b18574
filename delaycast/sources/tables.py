"""Typed CSV and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from delaycast.schemas import AIRPORTS


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header under an explicit schema; an empty field is NULL.

    Quotes inside a field are doubled. Files stay splittable unless fields may contain line
    breaks (``multiline``).
    """
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
    return reader.option("multiLine", multiline).csv(path)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """The airport dimension: a CSV with the columns ``icao`` and ``city``, one row per code."""
    return read_csv(spark, path, AIRPORTS)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogued table or view by name."""
    return spark.table(name)


def read_metrics(spark: SparkSession, name: str) -> list[dict]:
    """The evaluation table on the driver: one row per tuning trial, a handful."""
    return [row.asDict() for row in spark.table(name).orderBy("trial_id").collect()]
