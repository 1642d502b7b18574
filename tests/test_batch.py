import json
import random
from pathlib import Path

import pytest

from delaycast.plans.batch import prepare_flights, run_batch
from delaycast.plans.model import fit_trials
from delaycast.plans.proximal import fit_at_constant_rate
from delaycast.plans.registry import LatestModel
from delaycast.schemas import FLIGHT_RECORD, OPTIONAL_FEED_COLUMNS
from delaycast.sources.tables import read_metrics


def flight(generator, i):
    """Snow at departure makes a flight late, with few exceptions."""
    hour = generator.choice([0, 3, 6, 9, 12, 15])
    snow = hour in (3, 9, 15)
    late = generator.random() < (0.97 if snow else 0.03)
    return {
        "flight_number": str(i), "airline_iata": generator.choice(["5D", "AA"]), "dep_iata": "MIA", "arr_iata": "NAN",
        "dep_icao": "KMIA", "arr_icao": "EGLL" if i % 5 else "ZZZZ", "duration": generator.randint(60, 90),
        "delayed": generator.randint(46, 60) if late else generator.randint(30, 45),
        "dep_time_utc": f"2023-04-08 {hour:02d}:20", "arr_time_utc": f"2023-04-08 {hour + 2:02d}:00",
    }


def forecast(city):
    entries = [
        {"dt": h, "dt_txt": f"2023-04-08 {h:02d}:00:00",
         "weather": [{"description": "snow" if h in (3, 9, 15) else "clear sky"}]}
        for h in range(0, 24, 3)
    ]
    return {"city": city, "status": 200, "list": entries}


@pytest.mark.parametrize("fit", [fit_trials, fit_at_constant_rate])
def test_daily_batch_promotes_a_good_model(spark, folder, fit):
    generator = random.Random(11)
    flights = [flight(generator, i) for i in range(400)]
    (Path(folder) / "delays.json").write_text(json.dumps({"response": flights}))
    (Path(folder) / "forecasts.json").write_text("\n".join(json.dumps(forecast(c)) for c in ("Miami", "London")))
    airports = spark.createDataFrame([("KMIA", "Miami"), ("EGLL", "London")], "icao string, city string")
    result = run_batch(
        spark, f"{folder}/delays.json", f"{folder}/forecasts.json", airports, f"{folder}/out", f"{folder}/models",
        keys=["flight_number"], trials=2, fit=fit,
    )
    assert {r.city for r in result.cities.collect()} == {"Miami", "London"}
    rows = read_metrics(spark, "evaluation")
    assert [r["trial_id"] for r in rows] == [1, 2] and rows[0]["roc_auc"] > 0.9
    assert result.version == 1
    latest = LatestModel(f"{folder}/models")
    assert latest.get(spark) is not None and latest.version == 1
    spark.sql("DROP VIEW evaluation")


def test_prepared_flights(spark):
    feed = spark.createDataFrame(
        [("KMIA", "ZZZZ", "2023-04-08 23:10", "2023-03-31 23:10", 31.0)],
        "dep_icao string, arr_icao string, dep_time_utc string, arr_time_utc string, delayed double",
    )
    airports = spark.createDataFrame([("KMIA", "Miami")], "icao string, city string")
    prepared = prepare_flights(feed, airports)
    assert prepared.columns == sorted([*feed.columns, *OPTIONAL_FEED_COLUMNS, "outlier", "dep_city", "arr_city",
                                       "dep_time_utc_3hr", "arr_time_utc_3hr"])
    row = prepared.first()
    assert (row.dep_city, row.arr_city, row.outlier, row.arr_actual) == ("Miami", "", 0, "")
    assert (row.dep_time_utc_3hr, row.arr_time_utc_3hr) == ("2023-04-09 00:00:00", "2023-04-01 00:00:00")
    compat = prepare_flights(feed, airports, compat=True).first()
    assert (compat.dep_time_utc_3hr, compat.arr_time_utc_3hr) == ("2023-04-9 00:00:00", "2023-03-32 00:00:00")
    assert len(FLIGHT_RECORD) == 41
