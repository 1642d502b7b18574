"""What the operators of this package share: batch limits, a bounded memo, stable fractions of rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaycast.session import scratch_path

# Rows and bytes of one Arrow batch. Texts reach 100,000 characters and more, so the row limit of
# 10,000 that Spark starts with is too much for a worker.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def bound_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to a size that long texts cannot outgrow."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; -1 for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus, F.lit(-1))


class Memo(dict):
    """A bounded memo of a pure function: ``memo[key]`` computes what it does not hold.

    Two generations of ``limit`` entries: when the young one is full it becomes the old one, and
    what is asked for again moves back. It holds time down, never results.
    """

    def __init__(self, compute: Callable, limit: int, longest: int | None = None) -> None:
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, key):
        if self.longest is not None and len(key) > self.longest:
            return self.compute(key)
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
