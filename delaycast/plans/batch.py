"""The daily batch: feeds to tables, training, evaluation, gate, promotion."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from delaycast.functions.missing import replace_columns
from delaycast.functions.timeslot import slot_3hr, slot_3hr_compat
from delaycast.operators.columns import conform, ensure_columns, sort_columns
from delaycast.operators.outliers import iqr_outlier_flag
from delaycast.operators.places import both_cities, weather_cities
from delaycast.operators.sizing import Sized
from delaycast.plans.features import training_set
from delaycast.plans.model import TRIALS, Trained, choose_model, fit_trials, tune
from delaycast.plans.registry import publish_model
from delaycast.schemas import FLIGHT_TABLE, OPTIONAL_FEED_COLUMNS, WEATHER_TABLE
from delaycast.sinks.files import replace_table, write_csv
from delaycast.sources.feeds import flatten_forecasts, read_delay_feed, read_forecasts
from delaycast.sources.tables import read_csv, read_table


def prepare_flights(feed: DataFrame, airports: DataFrame | Sized, compat: bool = False) -> DataFrame:
    """Outlier flag, forecast slots and cities on the raw delay feed, columns in table order."""
    slot = slot_3hr_compat if compat else slot_3hr
    flagged = iqr_outlier_flag(feed, "delayed")
    slotted = replace_columns(flagged, {f"{role}_time_utc_3hr": slot(f"{role}_time_utc") for role in ("dep", "arr")})
    located = both_cities(slotted, airports)
    return sort_columns(ensure_columns(located, OPTIONAL_FEED_COLUMNS))


@dataclass
class BatchResult:
    evaluation: DataFrame
    cities: DataFrame
    version: int | None


def run_batch(
    spark: SparkSession,
    delay_feed: str,
    forecasts: str,
    airports: DataFrame,
    out: str,
    model_root: str,
    keys: list[str],
    trials: int = TRIALS,
    seed: int = 0,
    multiline: bool = False,
    compat: bool = False,
    fit: Callable[..., Trained] = fit_trials,
) -> BatchResult:
    """Ingest both feeds into CSV tables, train on them, evaluate, and promote a good model.

    ``keys`` identify a flight in the feed (for the train/eval split). Returns the evaluation,
    the cities whose weather the next ingest should cover, and the promoted version, if any.
    ``fit`` trains the trials; ``proximal.fit_at_constant_rate`` does so at the fixed learning rate.
    """
    flights = prepare_flights(read_delay_feed(spark, delay_feed, multiline=multiline), airports, compat)
    write_csv(flights, f"{out}/flight_delay")
    weather = sort_columns(flatten_forecasts(read_forecasts(spark, forecasts, multiline)))
    write_csv(conform(weather, WEATHER_TABLE), f"{out}/weather_data")

    flight_table = read_csv(spark, f"{out}/flight_delay", FLIGHT_TABLE)
    weather_table = read_csv(spark, f"{out}/weather_data", WEATHER_TABLE)
    trained = tune(training_set(flight_table, weather_table, compat, keys), keys, trials, seed, fit)
    replace_table(trained.evaluation, "evaluation", out)
    evaluation = read_table(spark, "evaluation")
    model = choose_model(trained.models, evaluation)
    version = None if model is None else publish_model(spark, model, model_root)
    return BatchResult(evaluation, weather_cities(flight_table), version)
