import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from delaycast.operators.columns import conform, ensure_columns, prefix_columns, select_columns, sort_columns, to_numeric
from delaycast.operators.lookup import hot_keys, left_lookup
from delaycast.operators.metrics import best_trial, classifier_metrics, metric_gate
from delaycast.operators.order_stats import exact_percentiles
from delaycast.operators.outliers import iqr_outlier_flag, quartiles
from delaycast.operators.places import (
    both_cities,
    city_lookup,
    distinct_cities,
    distinct_cities_first_seen,
    stacked_cities,
    weather_cities,
)
from delaycast.operators.sizing import Sized, settle, settle_if_large, sized
from delaycast.operators.weather import dual_role_weather, latest_weather, weather_join
from delaycast.schemas import WEATHER_PAYLOAD, WEATHER_TABLE
from tests.conftest import tuples

# --- columns -----------------------------------------------------------------------------------


def test_column_shaping(spark):
    df = spark.createDataFrame([("1", "x")], "b string, a string")
    assert sort_columns(df).columns == ["a", "b"]
    assert select_columns(df, ["a"]).columns == ["a"]
    assert prefix_columns(df, "dep_", ["a"]).columns == ["b", "dep_a"]
    wide = ensure_columns(df, ["a", "arr_actual"])
    assert wide.columns == ["b", "a", "arr_actual"] and wide.first().arr_actual == ""
    assert ensure_columns(df, ["a"]).columns == df.columns


def test_conform_casts_adds_and_drops(spark):
    df = spark.createDataFrame([("ace", 7, True)], "city string, dt bigint, other boolean")
    out = conform(df, WEATHER_TABLE)
    assert out.columns == [f.name for f in WEATHER_TABLE]
    assert {f.dataType.simpleString() for f in out.schema} == {"string"}
    row = out.first()
    assert (row.city, row.dt, row.dt_txt) == ("ace", "7", None)


def test_to_numeric_turns_text_into_null(spark):
    df = spark.createDataFrame([("1.5", "x", ""), ("-2", None, "3")], "a string, b string, c string")
    assert tuples(to_numeric(df)) == sorted([(1.5, None, None), (-2.0, None, 3.0)], key=repr)
    assert to_numeric(df, ["a"]).schema["b"].dataType.simpleString() == "string"


# --- lookups ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame([("KMIA", "Miami"), ("EGLL", "London")], "icao string, city string")


@pytest.mark.parametrize("limit", [None, -1])
def test_unknown_airport_gives_empty_city(spark, airports, limit):
    df = spark.createDataFrame([("KMIA",), ("ZZZZ",), (None,)], "dep_icao string")
    found = city_lookup(df, airports, "dep_icao", "dep_city", limit)
    assert tuples(found) == [("KMIA", "Miami"), ("ZZZZ", ""), (None, "")]


def skewed_facts(spark):
    """A third of the rows share a key, another third are exact copies of one row."""
    n = 3000
    return spark.range(n).selectExpr(
        f"CASE WHEN id < {n // 3} THEN 'hot' WHEN id < {2 * n // 3} THEN 'copy' WHEN id % 7 = 0 THEN NULL"
        " ELSE concat('k', id % 50) END AS k",
        f"CASE WHEN id BETWEEN {n // 3} AND {2 * n // 3 - 1} THEN -1 ELSE id END AS v",
    )


def test_spread_join_equals_broadcast_join_under_skew(spark):
    facts = skewed_facts(spark)
    dimension = spark.createDataFrame(
        [("hot", 1), ("copy", 2), ("copy", 3), ("unused", 4), *[(f"k{i}", 10 + i) for i in range(0, 50, 2)]],
        "k2 string, w int",
    )
    plain = left_lookup(facts, dimension, [("k", "k2")])
    spread = left_lookup(facts, dimension, [("k", "k2")], limit=-1)
    assert spread.columns == plain.columns == ["k", "v", "w"]
    assert tuples(spread) == tuples(plain)
    assert spread.where("k = 'copy'").count() == 2000


def test_hot_keys_are_few_and_their_copies_bounded(spark):
    facts = skewed_facts(spark)
    tasks = 16
    hot = hot_keys(facts, ["k"], tasks).collect()
    assert {r.k for r in hot} == {"hot", "copy"}
    assert sum(r["__copies"] for r in hot) <= 2 * tasks


def test_spread_join_splits_the_hot_key(spark):
    facts = skewed_facts(spark).repartition(8)
    dimension = spark.createDataFrame([("hot", 1), ("copy", 2)], "k2 string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = left_lookup(facts, dimension, [("k", "k2")], limit=-1).withColumn("part", F.spark_partition_id())
        for key in ("hot", "copy"):
            parts = joined.where(F.col("k") == key).groupBy("part").count().collect()
            assert len(parts) > 2 and max(r["count"] for r in parts) < 800
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_settle_keeps_rows_and_measures_them(spark):
    df = spark.range(100).selectExpr("id", "CAST(id % 3 AS STRING) AS k")
    settled = settle(df, "test")
    assert isinstance(settled, Sized) and 0 < settled.size < 100_000
    assert tuples(settled.frame) == tuples(df)
    assert settle_if_large(df, "test", bound=10).frame is df
    assert settle_if_large(df, "test", bound=10, limit=5).frame is not df
    assert sized(settled) is settled


# --- weather -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def weather(spark):
    rows = [
        ("Miami", "2023-04-08 09:00:00", "100", "clear sky", "20.5"),
        ("London", "2023-04-08 12:00:00", "100", "light rain", "9.0"),
        ("London", "2023-04-08 12:00:00", "99", "few clouds", "8.0"),
        ("Miami", "2023-04-08 12:00:00", "100", "snow", "1.0"),
    ]
    return spark.createDataFrame(
        rows, "city string, dt_txt string, dt string, weather_description string, main_temp string"
    )


@pytest.fixture(scope="module")
def located(spark):
    rows = [
        (1, "Miami", "London", "2023-04-08 09:00:00", "2023-04-08 12:00:00"),
        (2, "Miami", "", "2023-04-08 12:00:00", "2023-04-08 15:00:00"),
        (3, "", "Miami", "", "2023-04-08 09:00:00"),
    ]
    return spark.createDataFrame(
        rows,
        "id int, dep_city string, arr_city string, dep_time_utc_3hr string, arr_time_utc_3hr string",
    )


@pytest.mark.parametrize("limit", [None, -1])
def test_both_roles_with_fan_out(located, weather, limit):
    wide = dual_role_weather(located, weather, ["weather_description"], limit=limit)
    rows = tuples(wide.select("id", "dep_weather_description", "arr_weather_description"))
    assert rows == sorted(
        [(1, "clear sky", "light rain"), (1, "clear sky", "few clouds"), (2, "snow", None), (3, None, "clear sky")],
        key=repr,
    )


def test_dedupe_keeps_the_latest_issue(located, weather):
    wide = dual_role_weather(located, weather, ["weather_description"], dedupe=True)
    rows = tuples(wide.select("id", "dep_weather_description", "arr_weather_description"))
    assert rows == [(1, "clear sky", "light rain"), (2, "snow", None), (3, None, "clear sky")]


def test_issue_times_compare_as_numbers(weather):
    assert latest_weather(weather).where("city = 'London'").first().weather_description == "light rain"


def test_compat_joins_arrival_weather_on_departure_keys(located, weather):
    wide = dual_role_weather(located, weather, ["weather_description"], compat=True)
    assert wide.where("NOT dep_weather_description <=> arr_weather_description").count() == 0
    assert wide.count() == 3


def test_payload_is_prefixed_by_name(spark, located):
    empty = spark.createDataFrame([], WEATHER_TABLE)
    wide = weather_join(located, empty, "arr")
    assert wide.columns == located.columns + [f"arr_{c}" for c in sorted(WEATHER_PAYLOAD)]
    assert len(WEATHER_PAYLOAD) == 21


def test_null_keys_never_match(spark, weather):
    facts = spark.createDataFrame([(None, None)], "dep_city string, dep_time_utc_3hr string")
    extra = weather.unionByName(spark.createDataFrame([(None, None, "1", "x", "1")], weather.schema))
    for limit in (None, -1):
        joined = weather_join(facts, extra, "dep", ["weather_description"], limit=limit)
        assert joined.first().dep_weather_description is None


# --- cities ------------------------------------------------------------------------------------


def test_first_seen_order_is_departures_then_arrivals(spark):
    generator = random.Random(3)
    pairs = [(i, generator.choice("ABCD"), generator.choice("CDEFG")) for i in range(60)]
    df = spark.createDataFrame(pairs, "id bigint, dep_city string, arr_city string").repartition(7)
    expected = list(dict.fromkeys([p[1] for p in pairs] + [p[2] for p in pairs]))
    seen = distinct_cities_first_seen(df, "id").orderBy("side", "first_key").collect()
    assert [r.city for r in seen] == expected
    assert {r.city for r in distinct_cities(df).collect()} == set(expected)
    assert stacked_cities(df).count() == 120


def test_unknown_city_is_not_looked_up(spark, airports):
    flights = spark.createDataFrame([("KMIA", "ZZZZ"), ("EGLL", "KMIA")], "dep_icao string, arr_icao string")
    located = both_cities(flights, airports)
    assert {r.city for r in distinct_cities(located).collect()} == {"Miami", "London", ""}
    assert {r.city for r in weather_cities(located).collect()} == {"Miami", "London"}


# --- order statistics and outliers -----------------------------------------------------------------


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


@pytest.mark.parametrize("extra", [[], [None], [float("nan")], [None, float("nan")]])
def test_quartiles_ignore_missing(spark, extra):
    assert tuple(quartiles(doubles(spark, [1.0, 2.0, 3.0, 10.0] + extra), "x").first()) == (1.75, 4.75)


SETS = {
    "spread": list(np.random.default_rng(1).normal(size=4000)),
    "one value holds a third": [5.0] * 1500 + list(np.random.default_rng(2).uniform(0, 10, 3000)),
    "mostly copies": [1.0] * 2000 + [2.0] * 2000 + [float(i) for i in range(200)],
    "long tail": list(np.random.default_rng(3).pareto(1.0, 3000)),
    "negative zero and infinity": [-0.0, 0.0, float("inf"), float("-inf")] + [float(i) for i in range(-40, 40)],
    "two": [1.0, 2.0],
    "one": [7.0],
}


@pytest.mark.parametrize("name", SETS)
def test_bracketed_percentiles_equal_numpy(spark, name):
    values = [float(v) for v in SETS[name]]
    probabilities = [0.25, 0.5, 0.75]
    expected = np.percentile(values, [100 * p for p in probabilities])
    for limit in (5, 1_000_000):
        found = exact_percentiles(doubles(spark, values), "x", probabilities, distinct_limit=limit).first()
        np.testing.assert_allclose(tuple(found), expected, rtol=1e-12)


def test_fence_is_upper_strict_and_null_safe(spark):
    # Quartiles 2 and 4, fence 7.
    values = [1.0, 2.0, 3.0, 4.0, 7.0]
    q1, q3 = np.percentile(values, [25, 75])
    assert q3 + 1.5 * (q3 - q1) == 7.0
    flagged = {r.x: r.outlier for r in iqr_outlier_flag(doubles(spark, values), "x").collect()}
    assert flagged == {v: 0 for v in values}
    more = iqr_outlier_flag(doubles(spark, values + [-100.0, None]), "x").collect()
    assert all(r.outlier == 0 for r in more if r.x is None or r.x < 0)
    tail = iqr_outlier_flag(doubles(spark, [1.0, 2.0, 3.0, 4.0, 50.0]), "x").collect()
    assert {r.x for r in tail if r.outlier == 1} == {50.0}


# --- metrics -----------------------------------------------------------------------------------


@pytest.mark.parametrize("digits", [1, 6])
def test_metrics_equal_brute_force(spark, digits):
    generator = random.Random(digits)
    rows = []
    for trial in (1, 2):
        for _ in range(400):
            y = generator.random() < 0.3
            rows.append((trial, int(y), round(min(max(generator.gauss(0.45 + 0.2 * y, 0.2), 0.0), 1.0), digits)))
    df = spark.createDataFrame(rows, "trial_id int, y int, p double").repartition(5)
    found = {r.trial_id: r for r in classifier_metrics(df, "y", "p", ["trial_id"]).collect()}
    for trial in (1, 2):
        own = [(y, p) for t, y, p in rows if t == trial]
        positives = [p for y, p in own if y]
        negatives = [p for y, p in own if not y]
        pairs = sum((a > b) + (a == b) / 2 for a in positives for b in negatives)
        tp = sum(p >= 0.5 for p in positives)
        fp = sum(p >= 0.5 for p in negatives)
        r = found[trial]
        assert r.roc_auc == pytest.approx(pairs / len(positives) / len(negatives), abs=1e-12)
        assert r.precision == pytest.approx(tp / (tp + fp))
        assert r.recall == pytest.approx(tp / len(positives))
        assert r.accuracy == pytest.approx((tp + len(negatives) - fp) / len(own))
        assert r.f1_score == pytest.approx(2 * tp / (tp + fp + len(positives)))
        clip = [(y, min(max(p, 1e-15), 1 - 1e-15)) for y, p in own]
        loss = -np.mean([np.log(p) if y else np.log(1 - p) for y, p in clip])
        assert r.log_loss == pytest.approx(loss)
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
        one = df.where(F.col("trial_id") == trial).withColumn("y", F.col("y").cast("double"))
        assert r.roc_auc == pytest.approx(evaluator.evaluate(one), abs=1e-6)


def test_metrics_without_one_class_or_prediction(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (None, 0.9), (1, None)], "y int, p double")
    row = classifier_metrics(df, "y", "p").first()
    assert (row.precision, row.recall, row.roc_auc) == (None, 0.0, None)


def evaluation(spark, *rows):
    return spark.createDataFrame(rows, "trial_id int, precision double, recall double, f1_score double, roc_auc double")


def test_gate_looks_at_the_best_trial_only(spark):
    good = (2, 0.66, 0.66, 0.66, 0.9)
    assert metric_gate(evaluation(spark, (1, 0.1, 0.1, 0.1, 0.8), good)).first().branch == "export_model"
    assert metric_gate(evaluation(spark, (1, 0.1, 0.1, 0.1, 0.95), good)).first().branch == "do_nothing"
    assert metric_gate(evaluation(spark, (1, 0.66, 0.65, 0.66, 0.9))).first().branch == "do_nothing"
    assert metric_gate(evaluation(spark, (1, None, 0.7, 0.7, 0.9))).first().branch == "do_nothing"


def test_best_trial_ties_and_missing(spark):
    rows = [(3, 0.7, 0.7, 0.7, 0.9), (2, 0.7, 0.7, 0.7, 0.9), (1, 0.7, 0.7, 0.7, None)]
    assert best_trial(evaluation(spark, *rows)).first().trial_id == 2
