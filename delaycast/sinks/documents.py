"""Scored rows delivered per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch to its own folder; a replayed batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
