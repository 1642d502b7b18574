"""How large a lookup side is, decided before a join strategy is chosen."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from delaycast.session import scratch_path


class Sized(NamedTuple):
    """A frame together with an upper bound of its size in bytes."""

    frame: DataFrame
    size: int


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan; runs no job.

    Exact for file scans, never below the input for filters and aggregates, and far too high for
    inner joins (it multiplies the sides), so it errs on the side of not broadcasting.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast threshold in bytes (-1 turns broadcasting off)."""
    conf = spark._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def sized(df: DataFrame | Sized) -> Sized:
    return df if isinstance(df, Sized) else Sized(df, plan_bytes(df))


def fits_broadcast(side: Sized, limit: int | None = None) -> bool:
    bound = broadcast_limit(side.frame.sparkSession) if limit is None else limit
    return side.size <= bound


def settle(df: DataFrame, name: str) -> Sized:
    """Write a derived frame to the shared scratch folder and read it back.

    The result has a known size, is computed once however often it is joined, and survives the
    loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return sized(spark.read.schema(df.schema).parquet(path))


def settle_if_large(df: DataFrame, name: str, bound: int | None = None, limit: int | None = None) -> Sized:
    """Keep ``df`` lazy when its bound already allows broadcasting it, else settle it.

    ``bound`` overrides the plan estimate where the caller knows a tighter one, such as the size
    of an aggregate before a many-to-one join.
    """
    side = Sized(df, plan_bytes(df) if bound is None else bound)
    return side if fits_broadcast(side, limit) else settle(df, name)
