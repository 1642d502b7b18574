"""Binary-classifier metrics, the best trial and its quality gate."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.functions.labels import GATE_LEVEL
from delaycast.operators.sizing import plan_bytes, settle_if_large

# Names of the two outcomes of the gate.
PROMOTE = "export_model"
KEEP = "do_nothing"

THRESHOLD = 0.5
# Probabilities are kept this far from 0 and 1 in the log loss.
LOG_EPSILON = 1e-15
# Score groups whose input is below this size are recomputed rather than written between two uses.
RECOMPUTE_BYTES = 32 * 1024 * 1024


def classifier_metrics(
    df: DataFrame, label: str, score: str, by: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Precision, recall, accuracy, f1, log loss and exact ROC-AUC of scores, per group or overall.

    ``by`` columns must be few-valued (a trial number, a split name) and never NULL.

    Every metric is a function of the (score, positives, negatives) counts, so rows are reduced to
    those first and read no further. The area is the tie-corrected rank statistic: scores are cut
    into ranges of even size, negatives are counted below each score within its range, and the
    few range totals then shift whole ranges. No window ever spans all scores.
    """
    by = by or []
    partition = ", ".join([*by, "range"])
    clipped = f"greatest(least(score, {1 - LOG_EPSILON!r}D), {LOG_EPSILON!r}D)"
    in_range = f"PARTITION BY {partition} ORDER BY score ROWS UNBOUNDED PRECEDING"
    won = f"pos * (sum(neg) OVER ({in_range}) - neg / 2) AS won"
    ranges = (
        _score_ranges(_score_groups(df, label, score, by), "score")
        .selectExpr("*", won)
        .groupBy(*by, "range")
        .agg(
            F.expr("sum(pos) AS pos"),
            F.expr("sum(neg) AS neg"),
            F.expr("sum(won) AS won"),
            F.expr(f"sum(CASE WHEN score >= {threshold}D THEN pos ELSE 0D END) AS tp"),
            F.expr(f"sum(CASE WHEN score >= {threshold}D THEN neg ELSE 0D END) AS fp"),
            F.expr(f"sum(-pos * ln({clipped}) - neg * ln(1D - {clipped})) AS loss"),
        )
    )
    # One row per range from here on.
    lower = f"{'PARTITION BY ' + ', '.join(by) if by else ''} ORDER BY range ROWS UNBOUNDED PRECEDING"
    shifted = ranges.selectExpr(
        *by, "pos", "neg", "tp", "fp", "loss", f"won + pos * (sum(neg) OVER ({lower}) - neg) AS won"
    )
    sums = shifted.groupBy(*by).agg(*[F.expr(f"sum({c}) AS {c}") for c in ("pos", "neg", "won", "tp", "fp", "loss")])
    return sums.selectExpr(
        *by,
        "try_divide(tp, tp + fp) AS precision",
        "try_divide(tp, pos) AS recall",
        "try_divide(tp + neg - fp, pos + neg) AS accuracy",
        "try_divide(2 * tp, tp + fp + pos) AS f1_score",
        "try_divide(loss, pos + neg) AS log_loss",
        "try_divide(won, pos * neg) AS roc_auc",
    )


def _score_groups(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle."""
    # Rows without a label or score count nothing rather than being filtered: a filter would
    # evaluate the score expression a second time.
    valid = "label IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)"
    scored = df.selectExpr(*by, f"CAST(`{label}` AS INT) AS label", f"CAST(`{score}` AS DOUBLE) AS score").selectExpr(
        *by,
        f"CASE WHEN {valid} THEN score ELSE 0D END AS score",
        f"CASE WHEN {valid} AND label = 1 THEN 1D ELSE 0D END AS pos",
        f"CASE WHEN {valid} AND label <> 1 THEN 1D ELSE 0D END AS neg",
    )
    groups = scored.groupBy(*by, "score").agg(F.expr("sum(pos) AS pos"), F.expr("sum(neg) AS neg"))
    return settle_if_large(groups, "score-groups", plan_bytes(scored), RECOMPUTE_BYTES).frame


def _score_ranges(groups: DataFrame, score: str) -> DataFrame:
    """Add ``range``, a number that grows with the score. Any boundaries give the same result."""
    count = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = groups.approxQuantile(score, [i / count for i in range(1, count)], 1 / (4 * count)) if count > 1 else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        return groups.withColumn("range", F.lit(0.0))
    return Bucketizer(inputCol=score, outputCol="range", splits=splits).transform(groups)


def best_trial(evaluation: DataFrame) -> DataFrame:
    """The row with the largest ROC-AUC; the lowest trial number wins ties, missing areas lose."""
    return evaluation.orderBy(F.expr("roc_auc").desc_nulls_last(), "trial_id").limit(1)


def metric_gate(evaluation: DataFrame, level: float = GATE_LEVEL) -> DataFrame:
    """The best trial with ``branch``: promote when precision, recall and f1 all exceed the level."""
    passed = " AND ".join(f"{metric} > {level}D" for metric in ("precision", "recall", "f1_score"))
    return best_trial(evaluation).selectExpr("*", f"CASE WHEN {passed} THEN '{PROMOTE}' ELSE '{KEEP}' END AS branch")
