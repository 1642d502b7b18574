"""Metrics, gate, split, encoding, training and scoring over the driver tables."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession

from delaycast.functions.labels import delay_label
from delaycast.functions.missing import replace_columns
from delaycast.operators.metrics import best_trial, classifier_metrics, metric_gate
from delaycast.operators.outliers import iqr_outlier_flag
from delaycast.operators.sizing import settle
from delaycast.plans import model, proximal
from delaycast.plans.dictionary import build_dictionary, encode_tokens
from delaycast.plans.features import training_set
from delaycast.plans.linear_model import LinearModel
from delaycast.plans.registry import LatestModel, publish_model
from delaycast.schemas import CATEGORICAL_FEATURES, METRIC_COLUMNS, NUMERIC_FEATURES
from delaycast.session import scratch_path
from delaycast.workload import adapter
from delaycast.workload.oracle import FLIGHTS, RAW, training_sql
from delaycast.workload.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

# --- metrics of a fixed score, one "trial" per user group ------------------------------------------

_SCORED_SQL = """scored AS (
  SELECT CAST(user_id % 5 + 1 AS INTEGER) AS trial_id, CASE WHEN value > 45 THEN 1 ELSE 0 END AS y,
         (value + 3 * CAST(props->>'$.k' AS INTEGER)) / (value + 3 * CAST(props->>'$.k' AS INTEGER) + 150) AS p
  FROM events)"""


def _metrics_sql(group: str) -> str:
    by = f"{group}, " if group else ""
    partition = f"PARTITION BY {group}" if group else ""
    tied = f"PARTITION BY {by}p"
    tail = f"GROUP BY {group}" if group else ""
    return f"""{_SCORED_SQL},
ranked AS (
  SELECT *, rank() OVER ({partition} ORDER BY p) + (count(*) OVER ({tied}) - 1) / 2.0 AS midrank FROM scored),
counted AS (
  SELECT {by} CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS n1, CAST(sum(1 - y) AS DOUBLE) AS n0,
         CAST(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
         CAST(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS flagged,
         CAST(sum(CASE WHEN (p >= 0.5) = (y = 1) THEN 1 ELSE 0 END) AS DOUBLE) AS hits,
         avg(-(CASE WHEN y = 1 THEN ln(greatest(least(p, 1 - 1e-15), 1e-15))
               ELSE ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)) END)) AS loss,
         CAST(sum(CASE WHEN y = 1 THEN midrank ELSE 0 END) AS DOUBLE) AS positive_ranks
  FROM ranked {tail}),
evaluation AS (
  SELECT {by} round(tp / flagged, 6) AS "precision", round(tp / n1, 6) AS recall, round(hits / n, 6) AS accuracy,
         round(2 * tp / (flagged + n1), 6) AS f1_score, round(loss, 6) AS log_loss,
         round((positive_ranks - n1 * (n1 + 1) / 2) / (n0 * n1), 6) AS roc_auc
  FROM counted)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.table(spark, sf_dir, "events")
    raised = events.selectExpr("user_id", "value", "value + 3 * from_json(props, 'k int').k AS raised")
    return raised.selectExpr(
        "CAST(user_id % 5 + 1 AS INT) AS trial_id", f"{delay_label('value')} AS y", "raised / (raised + 150) AS p"
    )


def _rounded(df: DataFrame) -> DataFrame:
    return replace_columns(df, {m: f"round({m}, 6)" for m in METRIC_COLUMNS})


def _evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(classifier_metrics(_scored(spark, sf_dir), "y", "p", ["trial_id"]))


@query("classifier_metrics", f"WITH {_metrics_sql('')} SELECT * FROM evaluation")
def overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(classifier_metrics(_scored(spark, sf_dir), "y", "p"))


@query("trial_metrics", f"WITH {_metrics_sql('trial_id')} SELECT * FROM evaluation")
def trial_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation(spark, sf_dir)


_BEST = "ORDER BY roc_auc DESC NULLS LAST, trial_id LIMIT 1"


@query("argmax_row", f"WITH {_metrics_sql('trial_id')} SELECT * FROM evaluation {_BEST}")
def argmax_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_trial(_evaluation(spark, sf_dir))


@query("metric_gate", f"""WITH {_metrics_sql('trial_id')}
SELECT *, CASE WHEN "precision" > 0.65 AND recall > 0.65 AND f1_score > 0.65 THEN 'export_model' ELSE 'do_nothing' END
  AS branch FROM evaluation {_BEST}""")
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_gate(_evaluation(spark, sf_dir))


# --- training inputs -----------------------------------------------------------------------------


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set with its row key."""
    return training_set(adapter.flights(spark, sf_dir), adapter.weather(spark, sf_dir), keys=["flight_id"])


@query("class_weights", f"""WITH {FLIGHTS},
targets AS (SELECT CASE WHEN delayed > 45 THEN 1 ELSE 0 END AS target FROM flights WHERE outlier = 0)
SELECT CAST(target AS INTEGER) AS target, count(*) AS n,
       round((SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT target) FROM targets) / count(*), 9) AS weight
FROM targets GROUP BY target""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = iqr_outlier_flag(adapter.raw_flights(spark, sf_dir), "delayed").where("outlier = 0")
    weights = model.class_weights(flights.selectExpr(f"{delay_label('delayed')} AS target"))
    return replace_columns(weights, {"weight": "round(weight, 9)"})


@query("train_eval_split", f"""WITH {RAW}
SELECT flight_id, CASE WHEN CAST('0x' || substr(md5(CAST(flight_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20
  THEN 'eval' ELSE 'train' END AS split FROM raw""")
def train_eval_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.train_eval_split(adapter.raw_flights(spark, sf_dir).select("flight_id"), "flight_id")


def _vocabulary_sql(name: str) -> str:
    return f"""{name}_vocabulary AS (
  SELECT {name} AS token, CAST(row_number() OVER (ORDER BY count(*) DESC, {name}) - 1 AS DOUBLE) AS i
  FROM training GROUP BY {name})"""


_VOCAB_SQL = f"""WITH training AS ({training_sql('f.flight_id,')}),
{', '.join(_vocabulary_sql(c) for c in CATEGORICAL_FEATURES)}
SELECT t.flight_id, {', '.join(f'{c}_vocabulary.i AS {c}_index' for c in CATEGORICAL_FEATURES)}
FROM training t {' '.join(f'JOIN {c}_vocabulary ON t.{c} = {c}_vocabulary.token' for c in CATEGORICAL_FEATURES)}"""


@query("vocab_encode", _VOCAB_SQL)
def vocab_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = settle(_training(spark, sf_dir), "training-set").frame
    indexer: StringIndexer = model.encoding_stages()[0]
    encoded = indexer.fit(training).transform(training)
    # The index columns carry the vocabulary as metadata; a plain cast leaves it behind.
    return encoded.selectExpr("flight_id", *[f"CAST({c} AS DOUBLE) AS {c}" for c in model.INDEXED])


@query("vocab_encode_distributed", _VOCAB_SQL)
def vocab_encode_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers from dictionaries that never pass through the driver, joined by token."""
    encoded = settle(_training(spark, sf_dir), "training-set").frame
    for column in CATEGORICAL_FEATURES:
        encoded = encode_tokens(encoded, column, build_dictionary(encoded, column), f"{column}_index")
    return encoded.selectExpr("flight_id", *[f"CAST({c} AS DOUBLE) AS {c}" for c in model.INDEXED])


# --- models ----------------------------------------------------------------------------------------

_PENALTY = model.Penalty(4.0, 2.0)


def _descent_sql(penalty: model.Penalty, steps: int, rate: float) -> str:
    """Coefficients after ``steps`` proximal steps, each step spelled out."""
    stacked = [f"SELECT flight_id, '{c}' AS feature, {c} AS token, 1e0 AS x FROM train" for c in CATEGORICAL_FEATURES]
    for c in NUMERIC_FEATURES:
        scaled = f"({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_samp({c}) FROM train)"
        stacked.append(f"SELECT flight_id, '{c}', '', {scaled} FROM train")
    stacked.append("SELECT flight_id, 'intercept', '', 1e0 FROM train")
    chain = []
    for k in range(1, steps + 1):
        chain.append(f"""r{k} AS MATERIALIZED (
  SELECT flight_id, any_value(weight) * (1 / (1 + exp(-sum(w * x))) - any_value(target)) AS r
  FROM inputs JOIN w{k - 1} USING (place) JOIN train USING (flight_id) GROUP BY flight_id),
w{k} AS MATERIALIZED (
  SELECT place, CASE WHEN free THEN w - {rate} * g ELSE sign(a) * greatest(abs(a) - {rate * penalty.l1} / n, 0) END AS w
  FROM (SELECT place, w, free, n, g, w * (1 - {rate * penalty.l2} / n) - {rate} * g AS a
        FROM (SELECT place, sum(r * x) / (SELECT count(*) FROM train) AS g FROM inputs JOIN r{k} USING (flight_id) GROUP BY place)
        JOIN w{k - 1} USING (place) JOIN places USING (place), (SELECT count(*) AS n FROM train)))""")
    slopes = " + ".join(
        f"(SELECT w FROM w{steps} JOIN places USING (place) WHERE feature = '{c}') * (SELECT avg({c}) / stddev_samp({c}) FROM train)"
        for c in NUMERIC_FEATURES
    )
    scales = " ".join(f"WHEN '{c}' THEN w / (SELECT stddev_samp({c}) FROM train)" for c in NUMERIC_FEATURES)
    return f"""WITH training AS ({training_sql('f.flight_id,')}),
learnt AS (
  SELECT *, count(*) OVER () / (2e0 * count(*) OVER (PARTITION BY target)) AS weight FROM training
  WHERE CAST('0x' || substr(md5(CAST(flight_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 20),
train AS MATERIALIZED (SELECT * FROM learnt),
stacked AS MATERIALIZED ({' UNION ALL '.join(stacked)}),
places AS MATERIALIZED (
  SELECT feature, token, feature = 'intercept' AS free, row_number() OVER (ORDER BY feature, token) AS place
  FROM stacked GROUP BY feature, token),
inputs AS MATERIALIZED (SELECT flight_id, place, x FROM stacked JOIN places USING (feature, token)),
w0 AS (SELECT place, 0e0 AS w FROM places),
{', '.join(chain)}
SELECT feature, token, round(CASE feature WHEN 'intercept' THEN w - ({slopes}) {scales} ELSE w END, 6) + 0 AS coefficient
FROM w{steps} JOIN places USING (place)"""


@query("train_logistic_constant_rate", _descent_sql(_PENALTY, model.MAX_ITERATIONS, proximal.LEARN_RATE))
def train_logistic_constant_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients after the fixed number of steps at the fixed rate, on the train side."""
    training = settle(_training(spark, sf_dir), "training-set").frame
    train = model.train_eval_split(training, "flight_id").where("split = 'train'").drop("split", "flight_id")
    found = proximal.fit_coefficients(train, [_PENALTY])
    linear = found.layout.model(found.coefficients[0])
    rows = [("intercept", "", linear.intercept), *[(name, "", c) for name, c in linear.numeric.items()]]
    rows += [(name, token, c) for name, tokens in linear.tokens.items() for token, c in tokens.items()]
    coefficients = spark.createDataFrame(rows, "feature string, token string, coefficient double")
    return replace_columns(coefficients, {"coefficient": "round(coefficient, 6) + 0D"})


@query("tune_constant_rate")
def tune_constant_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows of the random search, all trials at the fixed rate."""
    return model.tune(_training(spark, sf_dir), ["flight_id"], fit=proximal.fit_at_constant_rate).evaluation


# A model with set coefficients: a number, tokens by rule, tokens of which some are unknown to it.
SET_MODEL = LinearModel(
    -0.3,
    {"duration": -0.002, "dep_time_float": 0.0007},
    {"dep_iata": {str(i): (i % 7 - 3) / 10 for i in range(25)}, "dep_desc": {"null": 0.4, "view": -0.25}},
)


def set_model_sql(duration: str, minutes: str, dep_iata: str, dep_desc: str) -> str:
    return f"""round(1 / (1 + exp(-(-0.3e0 - 0.002e0 * {duration} + 0.0007e0 * {minutes}
    + (CAST({dep_iata} AS INTEGER) % 7 - 3) / 10e0
    + CASE {dep_desc} WHEN 'null' THEN 0.4e0 WHEN 'view' THEN -0.25e0 ELSE 0 END))), 9) AS delay_prob"""


def published_set_model(spark: SparkSession) -> LatestModel:
    """A registry whose newest version is the set model."""
    root = scratch_path(spark, "models")
    publish_model(spark, SET_MODEL._replace(intercept=5.0).pipeline(), root)
    publish_model(spark, SET_MODEL.pipeline(), root)
    return LatestModel(root)


@query("score_batch_set_model", f"""WITH training AS ({training_sql('f.flight_id,')})
SELECT flight_id, {set_model_sql('duration', 'dep_time_float', 'dep_iata', 'dep_desc')} FROM training""")
def score_batch_set_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All training rows scored with the newest model of a registry, whose coefficients are known."""
    scored = model.score(published_set_model(spark).get(spark), _training(spark, sf_dir))
    return scored.selectExpr("flight_id", "round(delay_prob, 9) AS delay_prob")



@query("train_logistic")
def train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation row of a single fit."""
    return model.train_logistic(_training(spark, sf_dir), ["flight_id"]).evaluation


@query("tune_trials")
def tune_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows of the random search."""
    return model.tune(_training(spark, sf_dir), ["flight_id"]).evaluation


@query("score_batch")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All training rows with the probability a model trained on them gives."""
    training = settle(_training(spark, sf_dir), "training-set")
    fitted = model.train_logistic(training, ["flight_id"]).models[0]
    return model.score(fitted, training.frame)


# Fixed coefficients of the linear score below.
_WEIGHTS = {"duration": -0.004, "dep_time_float": 0.001}
_INTERCEPT = -0.25


@query("score_linear", f"""WITH training AS ({training_sql('f.flight_id,')})
SELECT flight_id, duration, dep_time_float,
       round(1 / (1 + exp(-(-0.25e0 + -0.004e0 * duration + 0.001e0 * dep_time_float))), 9) AS delay_prob FROM training""")
def score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    probability = model.linear_probability(_WEIGHTS, _INTERCEPT)
    rows = _training(spark, sf_dir).select("flight_id", "duration", "dep_time_float")
    return rows.selectExpr("*", f"round({probability}, 9) AS delay_prob")
