"""City lookup and the distinct cities of both flight ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.operators.lookup import Splits, left_lookup
from delaycast.operators.sizing import Sized, sized


def city_lookup(
    flights: DataFrame,
    airports: DataFrame | Sized,
    icao: str,
    city: str,
    limit: int | None = None,
    profile: DataFrame | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Add the airport's city under the name ``city``; an unknown code gives ``''``.

    ``airports`` has one row per code (columns ``icao``, ``city``).
    """
    side = sized(airports)
    found = side.frame.selectExpr("icao", "city AS __city")
    joined = left_lookup(flights, Sized(found, side.size), [(icao, "icao")], limit, profile, splits)
    return joined.withColumn(city, F.expr("coalesce(__city, '')")).drop("__city")


def both_cities(
    flights: DataFrame, airports: DataFrame | Sized, limit: int | None = None, splits: Splits | None = None
) -> DataFrame:
    """``dep_city`` and ``arr_city`` from the one airport dimension."""
    side = sized(airports)
    departed = city_lookup(flights, side, "dep_icao", "dep_city", limit, splits=splits)
    return city_lookup(departed, side, "arr_icao", "arr_city", limit, profile=flights, splits=splits)


def stacked_cities(flights: DataFrame, *carry: str) -> DataFrame:
    """Bag union of both city columns: one row per flight end, ``side`` 0 = departure, 1 = arrival.

    Both ends leave in one pass over the flights rather than a union of two scans.
    """
    ends = "inline(array(struct(0 AS side, dep_city AS city), struct(1 AS side, arr_city AS city)))"
    return flights.selectExpr(*carry, ends)


def distinct_cities(flights: DataFrame) -> DataFrame:
    """Each city once, in no particular order. Routes are made distinct before they are stacked."""
    return stacked_cities(flights.select("dep_city", "arr_city").distinct()).select("city").distinct()


def distinct_cities_first_seen(flights: DataFrame, row_key: str) -> DataFrame:
    """Each city once with where it first occurs: departures by row key first, then arrivals.

    Sorting by ``(side, first_key)`` gives the order of first occurrence. Flights are reduced to
    routes before the two ends are stacked.
    """
    routes = flights.groupBy("dep_city", "arr_city").agg(F.min(row_key).alias("key"))
    cities = stacked_cities(routes, "key").groupBy("city").agg(
        F.expr("min(key) FILTER (WHERE side = 0) AS departure"),
        F.expr("min(key) FILTER (WHERE side = 1) AS arrival"),
    )
    return cities.selectExpr(
        "city",
        "CASE WHEN departure IS NOT NULL THEN 0 ELSE 1 END AS side",
        "coalesce(departure, arrival) AS first_key",
    )


def weather_cities(flights: DataFrame) -> DataFrame:
    """The cities to look weather up for: the distinct ones without the unknown city."""
    return distinct_cities(flights).where("city <> ''")
