"""Training at a constant learning rate: proximal gradient descent over distributed rows.

The objective is that of the other fits: the mean weighted log loss plus ``l1 / rows`` times the
absolute coefficients and ``l2 / (2 rows)`` times their squares, the intercept free. Each step is one
pass: every task sums the gradients of its rows, the sums meet by coefficient, and the new
coefficients, no more than the vocabularies have tokens, go to the tasks of the next step. All trials
take their steps in the same passes. Numbers are brought to mean 0 and deviation 1 for the steps, so
that one rate suits them all; the model holds coefficients of the columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame

from delaycast.operators.metrics import classifier_metrics
from delaycast.operators.sizing import Sized, settle
from delaycast.plans.linear_model import LinearModel, numbering
from delaycast.plans.model import (
    INDEXED,
    LABEL,
    MAX_ITERATIONS,
    Penalty,
    Trained,
    encoding_stages,
    label_counts,
    train_eval_split,
    with_class_weight,
)
from delaycast.schemas import CATEGORICAL_FEATURES, METRIC_COLUMNS, NUMERIC_FEATURES

# Fixed value: the learning rate of the delay model.
LEARN_RATE = 0.2

_SUMS = "place int, total double"


class Layout(NamedTuple):
    """Where each coefficient stands: tokens of one category after the other, numbers, the intercept."""

    labels: list[list[str]]
    means: list[float]
    deviations: list[float]

    @property
    def starts(self) -> list[int]:
        return np.cumsum([0, *map(len, self.labels)]).tolist()

    @property
    def width(self) -> int:
        return self.starts[-1] + len(self.means) + 1

    def model(self, coefficients: np.ndarray) -> LinearModel:
        starts, first_number = self.starts, self.starts[-1]
        tokens = {
            name: dict(zip(labels, coefficients[start : start + len(labels)].tolist()))
            for name, labels, start in zip(CATEGORICAL_FEATURES, self.labels, starts)
        }
        slopes = coefficients[first_number:-1] / np.array(self.deviations)
        intercept = float(coefficients[-1] - slopes @ np.array(self.means))
        return LinearModel(intercept, dict(zip(NUMERIC_FEATURES, slopes.tolist())), tokens)


def layout_of(train: DataFrame, indexer: StringIndexerModel) -> Layout:
    """Vocabularies by frequency, and mean and deviation of each number (1 where it does not vary)."""
    parts = [f"{f}({name}) AS {f}_{name}" for name in NUMERIC_FEATURES for f in ("avg", "stddev_samp")]
    found = train.selectExpr(*parts).first()
    means = [float(found[f"avg_{name}"] or 0.0) for name in NUMERIC_FEATURES]
    deviations = [float(found[f"stddev_samp_{name}"] or 0.0) or 1.0 for name in NUMERIC_FEATURES]
    return Layout([list(labels) for labels in indexer.labelsArray], means, deviations)


def gradient_sums(
    batches: Iterator[pa.RecordBatch], layout: Layout, coefficients: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The task's sums of weighted gradients: one row for each trial and coefficient that moves.

    Rows are (token numbers, numbers, label, weight); ``coefficients`` has one row per trial.
    """
    trials, width = coefficients.shape
    totals = np.zeros((trials, width))
    categories, starts, first_number = len(layout.labels), layout.starts, layout.starts[-1]
    means, deviations = np.array(layout.means)[:, None], np.array(layout.deviations)[:, None]
    for batch in batches:
        columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
        places = [column.astype(np.int64) + start for column, start in zip(columns[:categories], starts)]
        numbers = (np.array(columns[categories:-2], dtype=float) - means) / deviations
        label, weight = columns[-2], columns[-1]
        for trial in range(trials):
            own = coefficients[trial]
            margin = own[-1] + own[first_number:-1] @ numbers
            for place in places:
                margin += own[place]
            residual = weight * (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - label)
            for place in places:
                totals[trial] += np.bincount(place, residual, minlength=width)
            totals[trial, first_number:-1] += numbers @ residual
            totals[trial, -1] += residual.sum()
    moved = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(moved, pa.int32()), pa.array(totals.ravel()[moved], pa.float64())], ["place", "total"]
    )


def descend(
    encoded: DataFrame, layout: Layout, rows: int, total_weight: float, penalties: list[Penalty], steps: int, rate: float
) -> np.ndarray:
    """The coefficients of each trial after ``steps`` proximal gradient steps from zero."""
    context = encoded.sparkSession.sparkContext
    coefficients = np.zeros((len(penalties), layout.width))
    shrink = np.array([[p.l1 / rows] for p in penalties])
    decay = np.array([[p.l2 / rows] for p in penalties])
    for _ in range(steps):
        shared = context.broadcast(coefficients)
        sums = encoded.mapInArrow(lambda batches: gradient_sums(batches, layout, shared.value), _SUMS)
        gradient = np.zeros(coefficients.size)
        for row in sums.groupBy("place").sum("total").collect():  # one row per coefficient
            gradient[row[0]] = row[1]
        gradient = gradient.reshape(coefficients.shape) / total_weight
        ahead = coefficients[:, :-1] * (1 - rate * decay) - rate * gradient[:, :-1]
        intercept = coefficients[:, -1:] - rate * gradient[:, -1:]
        ahead = np.sign(ahead) * np.maximum(np.abs(ahead) - rate * shrink, 0.0)
        coefficients = np.hstack([ahead, intercept])
        shared.unpersist()
    return coefficients


class Descended(NamedTuple):
    layout: Layout
    coefficients: np.ndarray


def fit_coefficients(
    train: DataFrame, penalties: list[Penalty], steps: int = MAX_ITERATIONS, rate: float = LEARN_RATE
) -> Descended:
    """Coefficients for each penalty from training rows of features and label.

    The token numbers stay in the executors' memory and on their disks between the steps; lost
    blocks are computed again from ``train``. Rows whose label is not 0 or 1 take no part. Without rows
    all coefficients are zero.
    """
    train = train.where(f"{LABEL} IN (0, 1)")
    indexer = encoding_stages()[0].fit(train)
    layout, counts = layout_of(train, indexer), label_counts(train)
    rows = sum(counts.values())
    if not rows:
        return Descended(layout, np.zeros((len(penalties), layout.width)))
    numbered = with_class_weight(indexer.transform(train), counts)
    columns = [f"CAST({name} AS INT) AS {name}" for name in INDEXED]
    columns += [f"CAST({name} AS DOUBLE) AS {name}" for name in (*NUMERIC_FEATURES, LABEL, "weight")]
    encoded = numbered.selectExpr(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Balanced weights sum to the number of rows.
        return Descended(layout, descend(encoded, layout, rows, float(rows), penalties, steps, rate))
    finally:
        encoded.unpersist()


def fit_at_constant_rate(
    training: DataFrame | Sized,
    keys: list[str],
    penalties: list[Penalty],
    steps: int = MAX_ITERATIONS,
    rate: float = LEARN_RATE,
) -> Trained:
    """As ``fit_trials``, by steps of one rate: a model per penalty, all evaluated on the eval side."""
    training = (training if isinstance(training, Sized) else settle(training, "training-set")).frame
    split = train_eval_split(training, *keys)
    found = fit_coefficients(split.where("split = 'train'").drop("split", *keys), penalties, steps, rate)
    linear = [found.layout.model(row) for row in found.coefficients]
    evaluation = evaluate_linear(split.where("split = 'eval'").drop("split", *keys), found.layout, linear)
    return Trained([model.pipeline() for model in linear], evaluation)


def evaluate_linear(rows: DataFrame, layout: Layout, models: list[LinearModel]) -> DataFrame:
    """One evaluation row per model, numbered from 1; all models score the rows in one pass."""
    index = dict(zip(CATEGORICAL_FEATURES, INDEXED))
    numbered = rows
    for stage in numbering(dict(zip(CATEGORICAL_FEATURES, layout.labels)), index):
        numbered = stage.transform(numbered)
    scores = [f"struct({i} AS trial_id, 1D / (1D + exp(-({m.margin(index)}))) AS score)" for i, m in enumerate(models, 1)]
    stacked = numbered.selectExpr(LABEL, f"inline(array({', '.join(scores)}))")
    return classifier_metrics(stacked, LABEL, "score", ["trial_id"]).select("trial_id", *METRIC_COLUMNS)
