"""Weather joined to flights in the departure and the arrival role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.operators.lookup import Splits, left_lookup
from delaycast.operators.sizing import Sized, plan_bytes, settle_if_large, sized
from delaycast.schemas import WEATHER_KEYS

DEPARTURE = "dep"
ARRIVAL = "arr"


def role_keys(role: str) -> list[tuple[str, str]]:
    """Flight key columns of a role, paired with the weather table's keys."""
    return [(f"{role}_city", "city"), (f"{role}_time_utc_3hr", "dt_txt")]


def latest_weather(weather: DataFrame) -> DataFrame:
    """One row per (city, slot): the one issued last (largest ``dt``).

    Issue times are compared as numbers; equal ones fall back to the other columns, so the choice
    is repeatable. ``max`` over a struct is combined before the shuffle, so a slot with very many
    copies never gathers in one task.
    """
    payload = [c for c in weather.columns if c not in WEATHER_KEYS]
    issued = "TRY_CAST(CAST(dt AS STRING) AS BIGINT)"
    best = F.expr(f"max(struct({issued} AS __issued, {', '.join(payload)})) AS __best")
    latest = weather.groupBy(*WEATHER_KEYS).agg(best)
    return latest.selectExpr(*WEATHER_KEYS, *[f"__best.{c} AS {c}" for c in payload])


def latest_only(weather: DataFrame | Sized, columns: list[str] | None = None) -> Sized:
    """``latest_weather`` of the columns in use; a large table is reduced once and written."""
    side = sized(weather)
    frame = side.frame
    if columns is not None:
        frame = frame.select(*dict.fromkeys([*WEATHER_KEYS, "dt", *columns]))
    return settle_if_large(latest_weather(frame), "latest-weather", side.size)


def weather_join(
    flights: DataFrame,
    weather: DataFrame | Sized,
    role: str,
    columns: list[str] | None = None,
    keys_of: str | None = None,
    dedupe: bool = False,
    limit: int | None = None,
    profile: DataFrame | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Left join of weather in one role; its payload comes in prefixed with the role.

    ``columns`` limits the payload. ``keys_of`` takes the flight keys of another role (the
    compatibility mode joins arrival weather on the departure keys). Duplicate weather rows fan
    out as in SQL unless ``dedupe`` keeps only the latest.
    """
    side = latest_only(weather, columns) if dedupe else sized(weather)
    frame = side.frame
    payload = [c for c in frame.columns if c not in WEATHER_KEYS] if columns is None else columns
    frame = frame.selectExpr(*WEATHER_KEYS, *[f"`{c}` AS `{role}_{c}`" for c in payload])
    # Two upper bounds: the table's own, and the plan's with only the chosen columns.
    size = min(side.size, plan_bytes(frame))
    return left_lookup(flights, Sized(frame, size), role_keys(keys_of or role), limit, profile, splits)


def dual_role_weather(
    flights: DataFrame,
    weather: DataFrame | Sized,
    columns: list[str] | None = None,
    compat: bool = False,
    dedupe: bool = False,
    limit: int | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Departure and arrival weather on each flight, from one weather table.

    ``compat`` looks the arrival weather up by the departure city and slot, to reproduce training
    sets made that way; the default uses the arrival keys, as serving does.
    """
    side = latest_only(weather, columns) if dedupe else sized(weather)
    departed = weather_join(flights, side, DEPARTURE, columns, limit=limit, splits=splits)
    keys_of = DEPARTURE if compat else ARRIVAL
    return weather_join(departed, side, ARRIVAL, columns, keys_of, limit=limit, profile=flights, splits=splits)
