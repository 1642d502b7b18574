"""Steps at a constant rate against plain numpy, and the models that they give."""

import numpy as np
import pytest

from delaycast.plans import model
from delaycast.plans.linear_model import LinearModel
from delaycast.plans.proximal import fit_at_constant_rate, fit_coefficients
from delaycast.plans.registry import LatestModel, publish_model
from delaycast.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from tests.test_model import SCHEMA, training_rows


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame(training_rows(), SCHEMA)


def plain_steps(rows, penalty, steps, rate):
    """(feature, token) -> coefficient by dense numpy over all rows."""
    names = [(c, t) for c in CATEGORICAL_FEATURES for t in sorted({r[c] for r in rows})]
    numbers = np.array([[r[c] for r in rows] for c in NUMERIC_FEATURES], dtype=float)
    spread = numbers.std(axis=1, ddof=1)
    dense = np.array([[float(r[c] == t) for c, t in names] for r in rows])
    x = np.hstack([dense, ((numbers.T - numbers.mean(axis=1)) / spread), np.ones((len(rows), 1))])
    y = np.array([r["target"] for r in rows], dtype=float)
    weight = np.where(y == 1, len(y) / 2 / y.sum(), len(y) / 2 / (1 - y).sum())
    w = np.zeros(x.shape[1])
    free = np.arange(x.shape[1]) == x.shape[1] - 1
    for _ in range(steps):
        gradient = x.T @ (weight * (1 / (1 + np.exp(-x @ w)) - y)) / len(y)
        moved = w - rate * (gradient + np.where(free, 0, penalty.l2 / len(y)) * w)
        w = np.where(free, moved, np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty.l1 / len(y), 0))
    out = dict(zip(names, w))
    slopes = w[len(names) : -1] / spread
    out |= {(c, ""): s for c, s in zip(NUMERIC_FEATURES, slopes)}
    return out | {("intercept", ""): w[-1] - slopes @ numbers.mean(axis=1)}


def flat(linear):
    out = {("intercept", ""): linear.intercept} | {(c, ""): v for c, v in linear.numeric.items()}
    return out | {(c, t): v for c, tokens in linear.tokens.items() for t, v in tokens.items()}


@pytest.mark.parametrize("partitions", [1, 5])
def test_steps_equal_numpy(training, partitions):
    penalties = [model.Penalty(0.0, 0.0), model.Penalty(9.0, 4.0), model.Penalty(60.0, 0.0)]
    found = fit_coefficients(training.drop("id").repartition(partitions), penalties, steps=12)
    rows = [r.asDict() for r in training.collect()]
    for penalty, coefficients in zip(penalties, found.coefficients):
        assert flat(found.layout.model(coefficients)) == pytest.approx(plain_steps(rows, penalty, 12, 0.2), abs=1e-9)
    assert (found.coefficients[2] == 0).sum() > (found.coefficients[1] == 0).sum()  # the absolute penalty sets to zero


def test_edge_rows(spark, training):
    none = fit_coefficients(training.drop("id").limit(0), [model.Penalty(1.0, 1.0)])
    assert not none.coefficients.any()
    one_class = fit_coefficients(training.drop("id").where("target = 1"), [model.Penalty(1.0, 1.0)], steps=3)
    assert one_class.layout.model(one_class.coefficients[0]).intercept > 0
    extra = training.drop("id").unionByName(training.drop("id").selectExpr("* EXCEPT (target)", "7 AS target"))
    same = fit_coefficients(extra, [model.Penalty(1.0, 1.0)], steps=2)
    wanted = fit_coefficients(training.drop("id"), [model.Penalty(1.0, 1.0)], steps=2)
    assert flat(same.layout.model(same.coefficients[0])) == pytest.approx(flat(wanted.layout.model(wanted.coefficients[0])))


def test_trials_evaluate_publish_and_score(spark, training, folder):
    tuned = model.tune(training, ["id"], trials=2, seed=1, fit=fit_at_constant_rate)
    rows = tuned.evaluation.orderBy("trial_id").collect()
    assert [r.trial_id for r in rows] == [1, 2] and all(r.roc_auc > 0.8 for r in rows)
    publish_model(spark, tuned.models[0], folder)
    scored = model.score(LatestModel(folder).get(spark), training)
    assert scored.columns == [*training.columns, "delay_prob"]
    held_out = model.train_eval_split(scored, "id").where("split = 'eval'").collect()
    hits = sum((r.delay_prob >= 0.5) == (r.target == 1) for r in held_out) / len(held_out)
    assert hits == pytest.approx(rows[0].accuracy)


def test_tokens_with_quotes_and_unknown_ones(spark, folder):
    odd = "a'b\\\"c; -- \n"
    linear = LinearModel(0.5, {"x": 2.0}, {"t": {odd: 1.25, "": -3.0}, "u": {str(i): i / 10 for i in range(300)}})
    rows = [(odd, "7", 1.0), ("", "299", 0.0), ("unknown", "unknown", -1.0)]
    df = spark.createDataFrame(rows, "t string, u string, x double")
    publish_model(spark, linear.pipeline(), folder)
    scored = model.score(LatestModel(folder).get(spark), df)
    assert scored.columns == ["t", "u", "x", "delay_prob"]
    margins = {odd: 0.5 + 2 + 1.25 + 0.7, "": 0.5 - 3 + 29.9, "unknown": 0.5 - 2}
    for r in scored.collect():
        assert r.delay_prob == pytest.approx(1 / (1 + np.exp(-margins[r.t])))

