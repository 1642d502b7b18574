"""Exact percentiles kept day by day, without reading the history again.

A day is stored as counts of its values, ordered by ranges of values that are the same for every day,
with one sum for each range. Days only add up: the sums tell in which range a wanted rank lies, and only
that range's counts are read. A day that is given again replaces itself.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaycast.functions.missing import nan_to_null
from delaycast.operators.order_stats import DISTINCT_LIMIT
from delaycast.operators.outliers import FENCE_RANGES, QUARTILES
from delaycast.sinks.commits import CommitLog

# Ranges between a number and its double, and cells into which a range with many values is cut.
RANGES_PER_DOUBLING, CELLS = 16, 512

_COUNTS = "v double, n bigint, range int"


def value_range(v: str) -> str:
    """SQL: the number of a value's range; it never falls as values grow."""
    size = f"CAST(floor(log2(1 + abs({v})) * {RANGES_PER_DOUBLING}) AS INT)"
    return f"CASE WHEN {v} < 0 THEN -{size} - 1 ELSE {size} END"


class RunningQuantiles:
    """Value counts of one measure by day below ``root``; null and NaN do not count, infinities do."""

    def __init__(self, spark: SparkSession, root: str, distinct_limit: int = DISTINCT_LIMIT) -> None:
        self.spark, self.root, self.limit = spark, root.rstrip("/"), distinct_limit
        self.log = CommitLog(spark, f"{self.root}/log")

    def add(self, day: str, df: DataFrame, column: str) -> int:
        """Take up a day's rows; returns the number of the commit. Only this day's rows are read."""
        values = df.selectExpr(f"CAST({nan_to_null(column)} AS DOUBLE) + 0D AS v").where("v IS NOT NULL")
        counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        finite = "CASE WHEN abs(v) < double('infinity') THEN " + value_range("v")
        in_range = f"{finite} WHEN v > 0 THEN 1000000 ELSE -1000000 END"
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        # Files hold neighbouring ranges, so that a reader of one range skips all others.
        ranged = counts.selectExpr("v", "n", f"{in_range} AS range").repartitionByRange("range", "v")
        ranged.sortWithinPartitions("range", "v").write.parquet(f"{folder}/counts")
        sums = self._counts([folder]).groupBy("range").agg(F.sum("n").alias("n"))
        sums.coalesce(1).write.parquet(f"{folder}/sums")  # some ten thousand ranges at most
        while True:
            newest = self.log.latest()
            number, days = (newest[0], newest[1]["days"]) if newest else (0, {})
            if self.log.put(number + 1, {"days": days | {day: folder}}):
                return number + 1

    def _counts(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(_COUNTS).parquet(*[f"{folder}/counts" for folder in folders])

    def percentiles(self, probabilities: list[float]) -> list[float | None]:
        """Exact percentiles over all days, with linear interpolation; None without values."""
        newest = self.log.latest()
        folders = list(newest[1]["days"].values()) if newest else []
        if not folders:
            return [None] * len(probabilities)
        sums = self.spark.read.schema("range int, n bigint").parquet(*[f"{folder}/sums" for folder in folders])
        by_range = sums.groupBy("range").agg(F.sum("n").alias("n")).collect()  # one row for each range
        total = sum(row.n for row in by_range)
        if not total:
            return [None] * len(probabilities)
        ranks = sorted({r for p in probabilities for r in self._ranks(p, total)})
        places: dict[int, list[tuple[int, int]]] = {}
        before, ordered = 0, iter(sorted((row["range"], row.n) for row in by_range))
        number, held = next(ordered)
        for rank in ranks:
            while rank >= before + held:
                before += held
                number, held = next(ordered)
            places.setdefault(number, []).append((rank, rank - before))
        found: dict[int, float] = {}
        for number, wanted in places.items():
            counts = self._counts(folders).where(f"range = {number}").groupBy("v").agg(F.sum("n").alias("n"))
            values = order_statistics(counts, [inside for _, inside in wanted], self.limit)
            found |= dict(zip([rank for rank, _ in wanted], values))
        out = []
        for p in probabilities:
            position = (total - 1) * p
            low, high = (found[r] for r in self._ranks(p, total))
            share = position - math.floor(position)
            out.append(low if low == high or not share else low + (high - low) * share)
        return out

    @staticmethod
    def _ranks(p: float, total: int) -> tuple[int, int]:
        first = math.floor((total - 1) * p)
        return first, min(first + 1, total - 1)

    def quartiles(self) -> tuple[float | None, float | None]:
        first, third = self.percentiles(QUARTILES)
        return first, third

    def flag(self, df: DataFrame, column: str, flag: str = "outlier") -> DataFrame:
        """Add ``flag`` = 1 above the upper fence of all days, else 0; as ``iqr_outlier_flag`` without its scan."""
        first, third = self.quartiles()
        if first is None:
            return df.withColumn(flag, F.lit(0))
        fence = third + FENCE_RANGES * (third - first)
        return df.withColumn(flag, F.when(F.expr(nan_to_null(column)) > F.lit(fence), 1).otherwise(0))


def order_statistics(counts: DataFrame, ranks: list[int], limit: int) -> list[float]:
    """The values of the given 0-based ranks from (v, n) with distinct ``v``.

    While more values than ``limit`` may hold a rank, the span they lie in is cut into cells of one
    width and only the cell with the rank is kept; each round is one aggregation of the counts.
    """
    out = []
    for rank in ranks:
        inside, before = counts, 0
        while True:
            span = inside.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("distinct")).first()
            width = (span.high - span.low) / CELLS
            if span.distinct <= limit or not 0 < width < math.inf:
                break
            cell = f"CAST(least({CELLS - 1}, floor((v - {span.low!r}D) / {width!r}D)) AS INT)"
            cells = sorted(inside.groupBy(F.expr(cell).alias("cell")).agg(F.sum("n").alias("n")).collect())
            for number, n in cells:
                if rank < before + n:
                    break
                before += n
            if len(cells) == 1:
                break
            inside = inside.where(f"{cell} = {number}")
        upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))  # few values are left
        ranked = inside.withColumn("upto", upto).where(F.col("upto") + before > rank)
        out.append(ranked.agg(F.min("v")).first()[0])
    return out
