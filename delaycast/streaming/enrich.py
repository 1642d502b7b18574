"""Flight schedules enriched with cities and weather of both roles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delaycast.functions.missing import replace_columns
from delaycast.functions.timeslot import slot_3hr
from delaycast.operators.lookup import Splits
from delaycast.operators.places import both_cities
from delaycast.operators.sizing import Sized
from delaycast.operators.weather import ARRIVAL, DEPARTURE, dual_role_weather, role_keys

# The key columns of each join below, as they stand in its result.
ENRICH_KEYS = [
    ("dep_icao",),
    ("arr_icao",),
    *[tuple(flight for flight, _ in role_keys(role)) for role in (DEPARTURE, ARRIVAL)],
]


def enrich_schedule(
    schedule: DataFrame,
    airports: DataFrame | Sized,
    weather: DataFrame | Sized,
    columns: list[str] | None = None,
    limit: int | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Slots, cities and prefixed weather on each flight; stateless, so batch or stream.

    On a stream the dimensions are static; restart or use ``foreachBatch`` to take up new ones.
    In ``foreachBatch``, ``splits`` (of ``HotKeys`` over ``ENRICH_KEYS``) spares counting the batch's keys.
    """
    slots = {f"{role}_time_utc_3hr": slot_3hr(f"{role}_time_utc") for role in ("dep", "arr")}
    slotted = replace_columns(schedule, slots)
    located = both_cities(slotted, airports, limit, splits)
    return dual_role_weather(located, weather, columns, limit=limit, splits=splits)
