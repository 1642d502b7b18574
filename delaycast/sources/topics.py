"""Message topics. Every reader yields a string column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the topic flights are published to.
TOPIC = "data-streams"


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC, **options: str) -> DataFrame:
    """Stream of a Kafka topic from its latest offset (needs the Kafka connector on the cluster)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "latest").options(**options)
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def read_topic_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Stream of message files, one message per line: the same column without a broker."""
    return spark.readStream.options(**options).text(path)
