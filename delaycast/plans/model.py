"""Split, class weights, training, random search, evaluation and scoring of the delay model."""

from __future__ import annotations

import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.operators.metrics import PROMOTE, classifier_metrics, metric_gate
from delaycast.operators.sizing import Sized, settle
from delaycast.schemas import CATEGORICAL_FEATURES, METRIC_COLUMNS, NUMERIC_FEATURES

# Training settings of the delay model.
EVAL_PERCENT = 20
MAX_ITERATIONS = 30
TRIALS = 5
PENALTY_RANGE = (0.0, 10.0)
LABEL = "target"

INDEXED = [f"{name}_index" for name in CATEGORICAL_FEATURES]
ENCODED = [f"{name}_vector" for name in CATEGORICAL_FEATURES]
# Added on the way to a probability; dropped from scored rows.
WORKING_COLUMNS = [*INDEXED, *ENCODED, "features", "rawPrediction", "probability", "prediction"]


def hash_percent(*keys: str) -> str:
    """SQL number 0..99 of the row key alone, so a row's side of a split never depends on partitioning."""
    key = ", ".join(f"CAST(`{k}` AS STRING)" for k in keys)
    return f"CAST(conv(substring(md5(concat_ws('|', {key})), 1, 8), 16, 10) AS BIGINT) % 100"


def train_eval_split(df: DataFrame, *keys: str, percent: int = EVAL_PERCENT, name: str = "split") -> DataFrame:
    """Add the column ``split``: ``eval`` for about ``percent`` of the keys, else ``train``."""
    return df.selectExpr("*", f"CASE WHEN {hash_percent(*keys)} < {percent} THEN 'eval' ELSE 'train' END AS {name}")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """``label, n, weight`` with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.expr("count(*) AS n"))
    # One row per class from here on.
    return counts.selectExpr(label, "n", "sum(n) OVER () / count(*) OVER () / n AS weight")


def label_counts(df: DataFrame, label: str = LABEL) -> dict[int, int]:
    """Rows of each value of a 0/1 label."""
    counts = df.where(f"{label} IN (0, 1)").groupBy(label).agg(F.expr("count(*) AS n"))
    return {row[label]: row["n"] for row in counts.collect()}


def with_class_weight(
    df: DataFrame, counts: dict[int, int], label: str = LABEL, name: str = "weight"
) -> DataFrame:
    """Attach the weight of a 0/1 label to every row, as constants rather than by a join."""
    balanced = sum(counts.values()) / max(len(counts), 1)
    cases = " ".join(f"WHEN {label} = {value} THEN {balanced / n!r}D" for value, n in counts.items())
    return df.selectExpr("*", f"CASE {cases} END AS {name}")


def encoding_stages() -> list:
    """Index categories by frequency, one-hot encode them and assemble all model inputs.

    A token not seen in training gets an index of its own instead of failing the row.
    """
    return [
        StringIndexer(
            inputCols=CATEGORICAL_FEATURES, outputCols=INDEXED, handleInvalid="keep", stringOrderType="frequencyDesc"
        ),
        OneHotEncoder(inputCols=INDEXED, outputCols=ENCODED, dropLast=False),
        VectorAssembler(inputCols=[*ENCODED, *NUMERIC_FEATURES], outputCol="features"),
    ]


class Penalty(NamedTuple):
    """Strengths of the absolute and the squared coefficient penalty, unscaled by row count."""

    l1: float
    l2: float

    def estimator(self, rows: int) -> LogisticRegression:
        """Spark averages the loss over the weight sum, hence the division by the rows."""
        total = self.l1 + self.l2
        return LogisticRegression(
            featuresCol="features",
            labelCol=LABEL,
            weightCol="weight",
            maxIter=MAX_ITERATIONS,
            regParam=total / rows if rows else 0.0,
            elasticNetParam=self.l1 / total if total else 0.0,
        )


def draw_penalties(trials: int = TRIALS, seed: int = 0) -> list[Penalty]:
    """Random-search points, the same for the same seed."""
    draw = random.Random(seed)
    return [Penalty(draw.uniform(*PENALTY_RANGE), draw.uniform(*PENALTY_RANGE)) for _ in range(trials)]


class Trained(NamedTuple):
    models: list[PipelineModel]
    evaluation: DataFrame


def fit_trials(training: DataFrame | Sized, keys: list[str], penalties: list[Penalty]) -> Trained:
    """Fit one model per penalty on the train side and evaluate all on the eval side.

    The narrow training set is written once (unless it comes settled), so its joins are not
    repeated. The encoded train
    side stays in the executors' memory and on their disks while the fits, which run side by side,
    iterate over it; lost blocks are recomputed from the written table. All models score the eval
    side in one pass.
    """
    training = (training if isinstance(training, Sized) else settle(training, "training-set")).frame
    split = train_eval_split(training, *keys)
    train = split.where("split = 'train'").drop("split", *keys)
    held_out = split.where("split = 'eval'").drop("split", *keys)

    encoder = Pipeline(stages=encoding_stages()).fit(train)
    counts = label_counts(train)
    encoded = with_class_weight(encoder.transform(train), counts).select("features", LABEL, "weight")
    encoded = encoded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = _fit_all(encoded, [penalty.estimator(sum(counts.values())) for penalty in penalties])
    finally:
        encoded.unpersist()

    models = [PipelineModel(stages=[*encoder.stages, fit]) for fit in fits]
    evaluation = evaluate_trials(encoder.transform(held_out), fits)
    return Trained(models, evaluation)


def _fit_all(encoded: DataFrame, estimators: list[LogisticRegression]) -> list[Model]:
    """Fit the trials at the same time: one fit's short jobs leave most executors idle."""
    fit = inheritable_thread_target(encoded.sparkSession)(lambda estimator: estimator.fit(encoded))
    with ThreadPool(len(estimators)) as pool:
        return pool.map(fit, estimators)


def evaluate_trials(encoded: DataFrame, fits: list[Model]) -> DataFrame:
    """One evaluation row per fitted trial, numbered from 1, all trials scored in one pass."""
    scored = encoded.select("features", LABEL)
    for fit in fits:
        name = f"p{fit.uid}"
        scored = fit.transform(scored).withColumn(name, vector_to_array("probability")[1])
        scored = scored.drop("rawPrediction", "probability", "prediction")
    trials = ", ".join(f"struct({i} AS trial_id, p{fit.uid} AS score)" for i, fit in enumerate(fits, 1))
    stacked = scored.selectExpr(LABEL, f"inline(array({trials}))")
    return classifier_metrics(stacked, LABEL, "score", ["trial_id"]).select("trial_id", *METRIC_COLUMNS)


def train_logistic(training: DataFrame | Sized, keys: list[str], penalty: Penalty = Penalty(1.0, 1.0)) -> Trained:
    """A single fit with its evaluation."""
    return fit_trials(training, keys, [penalty])


def tune(
    training: DataFrame | Sized,
    keys: list[str],
    trials: int = TRIALS,
    seed: int = 0,
    fit: Callable[[DataFrame | Sized, list[str], list[Penalty]], Trained] = fit_trials,
) -> Trained:
    """Random search over the penalties; ``fit`` trains and evaluates one model for each."""
    return fit(training, keys, draw_penalties(trials, seed))


def choose_model(models: list[PipelineModel], evaluation: DataFrame) -> PipelineModel | None:
    """The best trial's model when it passes the gate, else nothing."""
    best = metric_gate(evaluation).first()
    return models[best.trial_id - 1] if best is not None and best.branch == PROMOTE else None


def score(model: PipelineModel, rows: DataFrame, name: str = "delay_prob") -> DataFrame:
    """All input columns plus the probability of a late flight; works on batch and stream alike."""
    scored = model.transform(rows).withColumn(name, vector_to_array("probability")[1])
    return scored.drop(*WORKING_COLUMNS)


def linear_probability(weights: dict[str, float], intercept: float) -> str:
    """SQL probability under fixed coefficients of numeric columns."""
    margin = " + ".join([f"{intercept!r}D", *[f"{weight!r}D * `{column}`" for column, weight in weights.items()]])
    return f"1D / (1D + exp(-({margin})))"
