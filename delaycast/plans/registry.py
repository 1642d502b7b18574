"""Versioned models on a shared file system.

A version is saved into a folder of its own and then announced by a numbered commit, so a
reader never meets a half-written model and a running stream never loses the one it uses.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from delaycast.sinks.commits import CommitLog


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root.rstrip('/')}/versions")


def latest_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and folder of the newest announced model, if there is any."""
    newest = _log(spark, root).latest()
    return None if newest is None else (newest[0], newest[1]["path"])


def publish_model(spark: SparkSession, model: PipelineModel, root: str) -> int:
    """Save a model and announce it as the next version; of two at once, each gets a number of its own."""
    path = f"{root.rstrip('/')}/models/{uuid.uuid4().hex}"
    model.write().save(path)
    return _log(spark, root).append({"path": path})


class LatestModel:
    """The newest published model; loaded again only when a newer one was announced."""

    def __init__(self, root: str):
        self.root = root
        self.version: int | None = None
        self._model: PipelineModel | None = None

    def get(self, spark: SparkSession) -> PipelineModel:
        newest = latest_version(spark, self.root)
        if newest is None:
            raise LookupError(f"no model published under {self.root}")
        if newest[0] != self.version:
            self._model = PipelineModel.load(newest[1])
            self.version = newest[0]
        return self._model
