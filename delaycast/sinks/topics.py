"""Rows as JSON messages, singly or in batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.sources.topics import TOPIC

# Rows per message: keeps a message of full flight records below a broker's usual 1 MB.
BATCH_ROWS = 200


def to_json_rows(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """One JSON object per row in the column ``value``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value"))


def to_json_batches(df: DataFrame, rows: int = BATCH_ROWS, field: str | None = None) -> DataFrame:
    """Messages that each carry a JSON array of at most ``rows`` rows, every row in one message.

    The rows become JSON natively; a task then strings its own rows together as they come. Nothing
    is shuffled, no batch grows with a key, and a retried task only replaces its own messages.
    ``field`` wraps the array into an object under that name.
    """
    opening, closing = ("[", "]") if field is None else (f'{{"{field}":[', "]}")

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            lines = part["value"].tolist()
            messages = [opening + ",".join(lines[i : i + rows]) + closing for i in range(0, len(lines), rows)]
            yield pd.DataFrame({"value": messages})

    return to_json_rows(df).mapInPandas(batches, "value string")


def write_topic(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Publish ``value`` to a Kafka topic (needs the Kafka connector on the cluster)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_topic_files(messages: DataFrame, path: str) -> None:
    """Publish ``value`` as message files, one message per line."""
    messages.select("value").write.mode("append").text(path)
