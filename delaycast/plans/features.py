"""The one feature projection that training and serving share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from delaycast.functions.labels import delay_label
from delaycast.functions.missing import filled, replace_columns
from delaycast.functions.timeslot import minutes_of_day, minutes_of_day_text
from delaycast.operators.sizing import Sized
from delaycast.operators.weather import ARRIVAL, DEPARTURE, dual_role_weather, role_keys
from delaycast.schemas import MESSAGE_COLUMNS

# Which weather column of each role becomes which feature.
DESCRIPTIONS = {"dep_desc": "dep_weather_description", "arr_desc": "arr_weather_description"}


def feature_expression(df: DataFrame, name: str) -> str:
    """One model input as SQL over weather-joined rows or stream messages."""
    if name == "dep_time_float":
        is_text = isinstance(df.schema["dep_time_utc"].dataType, T.StringType)
        return minutes_of_day_text("dep_time_utc") if is_text else minutes_of_day("dep_time_utc")
    return filled(df, DESCRIPTIONS.get(name, name))


# The training table's feature columns, in table order, and the flight columns
# they and the label are made from.
TRAINING_FEATURES = [
    "airline_iata", "dep_iata", "arr_iata", "duration", "dep_time_float", "dep_desc", "arr_desc",
]
TRAINING_INPUTS = ["airline_iata", "dep_iata", "arr_iata", "duration", "dep_time_utc", "delayed"]


def training_set(
    flights: DataFrame,
    weather: DataFrame | Sized,
    compat: bool = False,
    keys: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Features and ``target`` of the flights that are no outliers.

    Only the columns in use enter the joins, and the filter runs below both. ``keys``
    are carried along for splitting. ``compat`` joins the arrival weather on departure keys.
    """
    join_keys = [left for role in (DEPARTURE, ARRIVAL) for left, _ in role_keys(role)]
    needed = [*(keys or []), *TRAINING_INPUTS, *join_keys]
    kept = flights.where("outlier = 0").select(*dict.fromkeys(needed))
    joined = dual_role_weather(kept, weather, ["weather_description"], compat=compat, limit=limit)
    return joined.selectExpr(
        *(keys or []),
        *[f"{feature_expression(joined, name)} AS {name}" for name in TRAINING_FEATURES],
        f"{delay_label('delayed')} AS target",
    )


def serving_features(rows: DataFrame) -> DataFrame:
    """Stream rows -> their cleaned message columns plus the model inputs that differ from them.

    Missing text becomes the null token and a missing duration 0, as in training.
    """
    cleaned = {c: filled(rows, c) for c in MESSAGE_COLUMNS if c != "dep_time_utc"}
    derived = {c: feature_expression(rows, c) for c in ("dep_time_float", "arr_desc", "dep_desc")}
    return replace_columns(rows, {**cleaned, **derived})
