"""Token numbers by frequency, built and applied without passing the tokens through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.operators.lookup import left_lookup
from delaycast.operators.sizing import Sized, settle

# Spark numbers the rows of a partition in the lower bits of an id, the partition above them.
_ROW_BITS = 33


def build_dictionary(df: DataFrame, column: str) -> Sized:
    """(token, index) of a column: the most frequent token is 0, equal ones go in the order of their text.

    Counts are sorted over ranges of (count, token), and a token's index is its place in its range
    plus the tokens of the ranges before. Only the sizes of the ranges reach the driver. Null is no
    token.
    """
    counts = df.where(f"`{column}` IS NOT NULL").groupBy(F.col(f"`{column}`").cast("string").alias("token"))
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("token")]
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranged.select("token", F.monotonically_increasing_id().alias("place")), "dictionary").frame
    part = f"shiftright(place, {_ROW_BITS})"
    sizes = placed.groupBy(F.expr(part).alias("part")).agg(F.count(F.lit(1)).alias("size")).orderBy("part").collect()
    cases, before = [], 0
    for row in sizes:  # one for each range
        cases.append(f"WHEN {row.part} THEN {before}L")
        before += row["size"]
    offset = f"CASE {part} {' '.join(cases)} END" if cases else "0L"
    inside = f"place & {(1 << _ROW_BITS) - 1}L"
    return settle(placed.selectExpr("token", f"{offset} + ({inside}) AS index"), "dictionary-index")


def encode_tokens(df: DataFrame, column: str, dictionary: Sized, into: str, limit: int | None = None) -> DataFrame:
    """Add ``into``: the index of the column's token, null for null and unknown tokens.

    The dictionary is broadcast within the bound; beyond it both sides meet by token, with frequent
    tokens spread over several tasks.
    """
    named = Sized(dictionary.frame.selectExpr("token AS __token", f"index AS `{into}`"), dictionary.size)
    return left_lookup(df, named, [(column, "__token")], limit)
