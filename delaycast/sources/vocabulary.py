"""Vocabulary files: one token per line, one file per categorical feature."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from delaycast.schemas import CATEGORICAL_FEATURES


def read_vocabulary(spark: SparkSession, path: str) -> list[str]:
    """The tokens of one file in file order. A vocabulary is part of a model and fits the driver."""
    # wholetext keeps a file's own line order, whatever its splits.
    files = spark.read.option("wholetext", True).text(path)
    lines = files.select(F.posexplode(F.split("value", "\r?\n")).alias("i", "token")).orderBy("i")
    return [row.token for row in lines.where("token <> ''").collect()]


def vocabulary_indexer(spark: SparkSession, folder: str, features: list[str] | None = None) -> PipelineModel:
    """Indexers over stored vocabularies; an unseen token gets the index after a feature's last."""
    # One indexer per feature: a joint one would pad all vocabularies to the longest.
    return PipelineModel(
        stages=[
            StringIndexerModel.from_labels(
                read_vocabulary(spark, f"{folder}/{name}.txt"),
                inputCol=name,
                outputCol=f"{name}_index",
                handleInvalid="keep",
            )
            for name in features or CATEGORICAL_FEATURES
        ]
    )


def write_vocabularies(indexer: StringIndexerModel, spark: SparkSession, folder: str) -> None:
    """Store a trained indexer's vocabularies in the same form."""
    for name, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        tokens = spark.createDataFrame([(token,) for token in labels], "value string")
        tokens.coalesce(1).write.mode("overwrite").text(f"{folder}/{name}.txt")
