"""Upper-fence outlier flag against global quartiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.functions.missing import nan_to_null
from delaycast.operators.order_stats import DISTINCT_LIMIT, exact_percentiles

# The quartiles and how many interquartile ranges the fence lies above the upper one.
QUARTILES = [0.25, 0.75]
FENCE_RANGES = 1.5


def quartiles(df: DataFrame, column: str, distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """One row ``q1, q3``."""
    return exact_percentiles(df, column, QUARTILES, distinct_limit).toDF("q1", "q3")


def iqr_outlier_flag(
    df: DataFrame, column: str, flag: str = "outlier", distinct_limit: int = DISTINCT_LIMIT
) -> DataFrame:
    """Add ``flag`` = 1 where the value lies strictly above the fence, else 0 (also when missing).

    The fence enters as a scalar subquery: it is computed once and then a constant, so the rows
    are neither joined nor shuffled.
    """
    fence = (
        quartiles(df, column, distinct_limit)
        .selectExpr(f"q3 + {FENCE_RANGES}D * (q3 - q1) AS fence")
        .scalar()
    )
    return df.withColumn(flag, F.when(F.expr(nan_to_null(column)) > fence, 1).otherwise(0))
