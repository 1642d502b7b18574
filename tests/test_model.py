import random

import pytest
from pyspark.ml import PipelineModel

from delaycast.plans import model
from delaycast.plans.features import serving_features, training_set
from delaycast.plans.registry import LatestModel, latest_version, publish_model
from delaycast.schemas import CATEGORICAL_FEATURES, METRIC_COLUMNS, WEATHER_TABLE
from tests.conftest import tuples


def training_rows(n=600, seed=5):
    """Flights of airline AA in snow are late; the rest mostly are not."""
    generator = random.Random(seed)
    rows = []
    for i in range(n):
        airline, desc = generator.choice(["AA", "5D", "null"]), generator.choice(["snow", "clear sky"])
        late = int(generator.random() < (0.95 if airline == "AA" and desc == "snow" else 0.05))
        rows.append((i, airline, generator.choice(["MIA", "NAN"]), generator.choice(["LHR", "JFK"]),
                     float(generator.randint(30, 300)), float(generator.randint(0, 1439)), desc, "clear sky", late))
    return rows


SCHEMA = (
    "id int, airline_iata string, dep_iata string, arr_iata string, duration double, dep_time_float double,"
    " dep_desc string, arr_desc string, target int"
)


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame(training_rows(), SCHEMA)


@pytest.fixture(scope="module")
def tuned(training):
    return model.tune(training, ["id"], trials=2, seed=1)


def test_split_depends_on_the_key_only(spark, training):
    one = model.train_eval_split(training.coalesce(1), "id").select("id", "split")
    many = model.train_eval_split(training.repartition(8), "id").select("id", "split")
    assert tuples(one) == tuples(many)
    share = one.where("split = 'eval'").count() / 600
    assert 0.15 < share < 0.25


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "target int")
    weights = {r.target: (r.n, r.weight) for r in model.class_weights(df).collect()}
    assert weights == {0: (6, 8 / 12), 1: (2, 2.0)}
    counts = model.label_counts(df)
    attached = {r.target: r.weight for r in model.with_class_weight(df, counts).distinct().collect()}
    assert attached == {0: pytest.approx(8 / 12), 1: 2.0}


def test_penalties_repeat_and_scale():
    assert model.draw_penalties(5, 3) == model.draw_penalties(5, 3)
    assert all(0 <= p <= 10 for pair in model.draw_penalties(50, 1) for p in pair)
    estimator = model.Penalty(3.0, 1.0).estimator(200)
    assert estimator.getRegParam() == pytest.approx(0.02) and estimator.getElasticNetParam() == pytest.approx(0.75)
    assert estimator.getMaxIter() == 30
    assert model.Penalty(0.0, 0.0).estimator(10).getElasticNetParam() == 0.0


def test_trials_are_evaluated(tuned):
    rows = tuned.evaluation.orderBy("trial_id").collect()
    assert [r.trial_id for r in rows] == [1, 2]
    assert tuned.evaluation.columns == ["trial_id", *METRIC_COLUMNS]
    assert all(r.roc_auc > 0.8 for r in rows)
    chosen = model.choose_model(tuned.models, tuned.evaluation)
    best = max(rows, key=lambda r: (r.roc_auc, -r.trial_id))
    passed = min(best.precision, best.recall, best.f1_score) > 0.65
    assert (chosen is tuned.models[best.trial_id - 1]) if passed else chosen is None


def test_scores_are_probabilities_and_survive_saving(spark, tuned, training, folder):
    scored = model.score(tuned.models[0], training)
    assert scored.columns == [*training.columns, "delay_prob"]
    before = {r.id: r.delay_prob for r in scored.collect()}
    assert all(0 <= p <= 1 for p in before.values())
    tuned.models[0].write().overwrite().save(f"{folder}/model")
    loaded = PipelineModel.load(f"{folder}/model")
    after = {r.id: r.delay_prob for r in model.score(loaded, training.repartition(8)).collect()}
    assert before == pytest.approx(after)


def test_unseen_tokens_still_score(spark, tuned):
    row = (1, "ZZ", "XXX", "YYY", 60.0, 600.0, "tornado", "null", 0)
    scored = model.score(tuned.models[0], spark.createDataFrame([row], SCHEMA)).first()
    assert 0 <= scored.delay_prob <= 1


def test_partitioning_does_not_change_the_fit(training):
    penalty = [model.Penalty(0.5, 0.5)]
    one = model.fit_trials(training.coalesce(1), ["id"], penalty).evaluation.first()
    many = model.fit_trials(training.repartition(8), ["id"], penalty).evaluation.first()
    assert tuple(one) == pytest.approx(tuple(many), abs=1e-6)


def test_linear_probability(spark):
    df = spark.createDataFrame([(2.0,), (0.0,)], "x double")
    values = [r[0] for r in df.selectExpr(model.linear_probability({"x": 1.5}, -3.0)).collect()]
    assert values == [0.5, pytest.approx(0.04742587)]


def test_registry_versions(spark, tuned, folder):
    latest = LatestModel(folder)
    with pytest.raises(LookupError):
        latest.get(spark)
    assert latest_version(spark, folder) is None
    assert publish_model(spark, tuned.models[0], folder) == 1
    first = latest.get(spark)
    assert latest.get(spark) is first and latest.version == 1
    assert publish_model(spark, tuned.models[1], folder) == 2
    assert latest.get(spark) is not first and latest.version == 2


FLIGHT = (
    "airline_iata string, dep_iata string, arr_iata string, duration double, dep_time_utc timestamp_ntz, delayed double,"
    " outlier int, dep_city string, arr_city string, dep_time_utc_3hr string, arr_time_utc_3hr string"
)


def test_training_and_serving_agree(spark):
    """The same flight gives the same features on both paths, missing values included."""
    flights = spark.sql(
        "SELECT * FROM VALUES"
        " ('5D', 'MIA', 'NAN', 80D, TIMESTAMP_NTZ'2023-04-08 09:59:30', 46D, 0, 'Miami', '', '2023-04-08 09:00:00', ''),"
        " (NULL, NULL, NULL, NULL, NULL, NULL, 0, '', '', '', ''),"
        " ('AA', 'MIA', 'LHR', 1D, NULL, 500D, 1, '', '', '', ''),"
        " ('AA', 'MIA', 'LHR', 1D, NULL, 500D, NULL, '', '', '', '')"
        " AS t(airline_iata, dep_iata, arr_iata, duration, dep_time_utc, delayed, outlier, dep_city, arr_city,"
        " dep_time_utc_3hr, arr_time_utc_3hr)"
    )
    weather = spark.createDataFrame(
        [("Miami", "2023-04-08 09:00:00", "snow")], "city string, dt_txt string, weather_description string"
    )
    trained = training_set(flights, weather)
    assert tuples(trained) == tuples(
        spark.createDataFrame(
            [("5D", "MIA", "NAN", 80.0, 599.0, "snow", "null", 1), ("null", "null", "null", 0.0, 0.0, "null", "null", 0)],
            trained.schema,
        )
    )
    messages = spark.createDataFrame(
        [("5D", None, "NAN", "snow", "MIA", "2023-04-08 09:59", 80.0), (None, None, None, None, None, None, None)],
        "airline_iata string, arr_weather_description string, arr_iata string, dep_weather_description string,"
        " dep_iata string, dep_time_utc string, duration double",
    )
    served = serving_features(messages)
    shared = [*CATEGORICAL_FEATURES, "dep_time_float", "duration"]
    assert tuples(served.select(shared)) == tuples(trained.select(shared))
    filled = served.where("dep_time_utc IS NULL").first()
    assert (filled.dep_weather_description, filled.arr_weather_description) == ("null", "null")


def test_training_columns_are_pruned(spark, folder):
    """Only the description leaves the weather scan, and outliers are dropped below the joins."""
    spark.createDataFrame([], WEATHER_TABLE).write.parquet(f"{folder}/weather")
    spark.createDataFrame([], FLIGHT).write.parquet(f"{folder}/flights")
    trained = training_set(spark.read.parquet(f"{folder}/flights"), spark.read.parquet(f"{folder}/weather"))
    plan = trained._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    weather_scans = [s for s in scans if "weather_description" in s]
    assert len(weather_scans) == 2 and all("main_temp" not in s for s in weather_scans)
    assert any("EqualTo(outlier,0)" in s for s in scans)
