"""Exact global percentiles without gathering the values anywhere."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaycast.functions.missing import nan_to_null

# Distinct values that one aggregation buffer may hold.
DISTINCT_LIMIT = 1_000_000
# Cells of the quantile grid that narrows a bracket, and the sketch's relative accuracy.
GRID = 500
ACCURACY = 10_000


def exact_percentiles(
    df: DataFrame, column: str, probabilities: list[float], distinct_limit: int = DISTINCT_LIMIT
) -> DataFrame:
    """One row ``p0, p1, ...``: exact percentiles with linear interpolation; NULL and NaN ignored.

    A ``percentile`` keeps every distinct value in one buffer, so it is used only when a distinct
    count says they are few, and on value counts, so that one task never receives more than the
    distinct values. Otherwise each percentile's two neighbouring order statistics are bracketed
    ever more narrowly, a scan per round, until few values remain.
    """
    values = df.selectExpr(f"{nan_to_null(column)} AS v").where("v IS NOT NULL")
    size = values.selectExpr("count(*) AS n", "approx_count_distinct(v) AS d").first()
    if size.d <= distinct_limit:
        counts = values.groupBy("v").agg(F.expr("count(*) AS n"))
        wanted = ", ".join(f"{float(p)}D" for p in probabilities)
        found = counts.selectExpr(f"percentile(v, array({wanted}), n) AS p")
        return found.selectExpr(*[f"p[{i}] AS p{i}" for i in range(len(probabilities))])
    exact = _bracketed_percentiles(values, size.n, probabilities, distinct_limit)
    schema = ", ".join(f"p{i} double" for i in range(len(exact)))
    return df.sparkSession.createDataFrame([tuple(exact)], schema)


@dataclass
class _Bracket:
    """Value range known to hold the order statistics ``rank`` and ``rank + 1`` (0-based)."""

    rank: int
    fraction: float
    low: float | None = None
    high: float | None = None

    def holds(self) -> str:
        bounds = [f"v >= DOUBLE('{self.low!r}')"] if self.low is not None else []
        bounds += [f"v <= DOUBLE('{self.high!r}')"] if self.high is not None else []
        return " AND ".join(bounds) or "true"

    def below(self) -> str:
        return "false" if self.low is None else f"v < DOUBLE('{self.low!r}')"


def _bracketed_percentiles(values: DataFrame, n: int, probabilities: list[float], limit: int) -> list[float]:
    brackets = []
    for p in probabilities:
        position = (n - 1) * p
        rank = math.floor(position)
        brackets.append(_Bracket(rank, position - rank))
    results: dict[int, float] = {}
    while len(results) < len(brackets):
        open_ones = [(i, b) for i, b in enumerate(brackets) if i not in results]
        aggregates = []
        cells = f"array({', '.join(f'{k / GRID!r}D' for k in range(GRID + 1))})"
        for i, b in open_ones:
            inside = f"CASE WHEN {b.holds()} THEN v END"
            aggregates += [
                f"count_if({b.below()}) AS below{i}",
                f"count({inside}) AS inside{i}",
                f"approx_count_distinct({inside}) AS distinct{i}",
                f"percentile_approx({inside}, {cells}, {ACCURACY}) AS grid{i}",
            ]
        row = values.selectExpr(*aggregates).first()
        for i, b in open_ones:
            before, inside, grid = row[f"below{i}"], row[f"inside{i}"], row[f"grid{i}"]
            rank = b.rank - before
            # Sketch error and rounding, in ranks: the neighbours lie within this of their place.
            slack = 2 + inside / ACCURACY
            first = math.floor((rank - slack) / inside * GRID)
            last = math.ceil((rank + 1 + slack) / inside * GRID)
            # An end that reaches the grid's border keeps its old, exact bound.
            low = grid[first] if first > 0 else b.low
            high = grid[last] if last < GRID else b.high
            if row[f"distinct{i}"] <= limit or (low, high) == (b.low, b.high):
                results[i] = _interpolate(values.where(b.holds()), rank, b.fraction)
            else:
                b.low, b.high = low, high
    return [results[i] for i in range(len(brackets))]


def _interpolate(values: DataFrame, rank: int, fraction: float) -> float:
    """Interpolate between order statistics ``rank`` and ``rank + 1`` of a few distinct values."""
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    # The bracket was narrowed until its distinct values fit one task.
    upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("upto", upto).agg(
        F.min(F.when(F.col("upto") > rank, F.col("v"))).alias("lower"),
        F.min(F.when(F.col("upto") > rank + 1, F.col("v"))).alias("upper"),
    )
    row = found.first()
    upper = row.lower if row.upper is None else row.upper
    return row.lower + (upper - row.lower) * fraction
