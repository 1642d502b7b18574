import json
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel

from delaycast.plans import model
from delaycast.plans.registry import LatestModel, publish_model
from delaycast.schemas import AIRPORTS, FLIGHT_RECORD, MESSAGE_COLUMNS
from delaycast.sinks.topics import write_topic_files
from delaycast.sources.topics import read_topic_files
from delaycast.streaming.enrich import enrich_schedule
from delaycast.streaming.messages import message_counts, message_rows
from delaycast.streaming.pipelines import publish_schedules, score_messages, scored_documents, start
from delaycast.workload.streams import drain
from tests.conftest import tuples
from tests.test_model import SCHEMA, training_rows

GOOD = [
    {"airline_iata": "AA", "arr_iata": "LHR", "dep_iata": "NAN", "dep_time_utc": "2023-04-08 09:59", "duration": 80,
     "dep_weather_description": "snow", "arr_weather_description": "clear sky", "status": "scheduled"},
    {"airline_iata": "5D", "arr_iata": "JFK", "dep_iata": "MIA", "dep_time_utc": None, "duration": None},
]
NAN = '[{"airline_iata": "5D", "dep_weather_description": NaN, "arr_weather_description": NaN, "duration": NaN}]'
MESSAGES = [json.dumps(GOOD), NAN, "not json", json.dumps(GOOD[0]), "[]"]


def publish(folder, name, lines):
    Path(folder).mkdir(exist_ok=True)
    (Path(folder) / name).write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def fitted(spark):
    training = spark.createDataFrame(training_rows(300), SCHEMA)
    return model.fit_trials(training, ["id"], [model.Penalty(0.1, 0.1), model.Penalty(9.0, 9.0)]).models


def test_messages_decode_batches_single_rows_and_nan(spark):
    messages = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    rows = message_rows(messages)
    assert rows.columns == MESSAGE_COLUMNS and rows.count() == 4
    nan = rows.where("airline_iata = '5D' AND arr_iata IS NULL").first()
    assert (nan.dep_weather_description, nan.arr_weather_description, nan.duration) == (None, None, None)
    assert rows.where("dep_iata = 'NAN'").count() == 2
    assert tuple(message_counts(messages).first()) == (5, 1, 4)


def test_stream_equals_batch(spark, folder):
    publish(f"{folder}/topic", "a.txt", MESSAGES)
    streamed = drain(message_rows(read_topic_files(spark, f"{folder}/topic")), "test-parsed")
    assert tuples(streamed) == tuples(message_rows(spark.read.text(f"{folder}/topic")))


def test_enriched_stream_equals_batch(spark, folder):
    flights = [
        {"flight_iata": "AA1", "dep_icao": "KMIA", "arr_icao": "EGLL", "dep_time_utc": "2023-04-08 08:10",
         "arr_time_utc": "2023-04-08 16:00"},
        {"flight_iata": "AA2", "dep_icao": "ZZZZ", "arr_icao": "KMIA", "dep_time_utc": None,
         "arr_time_utc": "2023-04-08 10:59"},
    ]
    publish(f"{folder}/topic", "a.txt", [json.dumps(flights)])
    airports = spark.createDataFrame([("KMIA", "Miami"), ("EGLL", "London")], "icao string, city string")
    weather = spark.createDataFrame(
        [("Miami", "2023-04-08 09:00:00", "snow"), ("London", "2023-04-08 15:00:00", "mist")],
        "city string, dt_txt string, weather_description string",
    )

    def enrich(messages, limit=None):
        return enrich_schedule(message_rows(messages, FLIGHT_RECORD), airports, weather, limit=limit).select(
            "flight_iata", "dep_city", "arr_city", "dep_time_utc_3hr", "arr_time_utc_3hr",
            "dep_weather_description", "arr_weather_description",
        )

    stream = read_topic_files(spark, f"{folder}/topic")
    streamed = drain(enrich(stream), "test-enriched")
    assert tuples(drain(enrich(stream, limit=-1), "test-enriched-spread")) == tuples(streamed)
    assert tuples(streamed) == tuples(enrich(spark.read.text(f"{folder}/topic"))) == [
        ("AA1", "Miami", "London", "2023-04-08 09:00:00", "2023-04-08 15:00:00", "snow", "mist"),
        ("AA2", "", "Miami", "", "2023-04-08 09:00:00", None, "snow"),
    ]


def test_scored_stream_delivers_once_and_takes_up_new_models(spark, folder, fitted):
    topic, out, root = f"{folder}/topic", f"{folder}/out", f"{folder}/models"
    publish_model(spark, fitted[0], root)
    deliver = scored_documents(LatestModel(root), f"{out}/rows", rejects=f"{out}/counts")
    publish(topic, "a.txt", MESSAGES)
    start(read_topic_files(spark, topic), deliver, f"{out}/checkpoint").awaitTermination()

    messages = spark.read.text(topic)
    expected = score_messages(fitted[0], messages)
    assert expected.columns == [*MESSAGE_COLUMNS, "delay_prob"]
    schema = expected.schema
    assert tuples(spark.read.schema(schema).parquet(f"{out}/rows/batch_id=0")) == tuples(expected)
    assert tuple(spark.read.parquet(f"{out}/counts/batch_id=0").first()) == (5, 1, 4)

    # A batch that runs again replaces its own rows.
    deliver(messages, 0)
    assert spark.read.parquet(f"{out}/rows/batch_id=0").count() == 4

    publish_model(spark, fitted[1], root)
    publish(topic, "b.txt", [json.dumps(GOOD)])
    start(read_topic_files(spark, topic), deliver, f"{out}/checkpoint").awaitTermination()
    second = spark.read.schema(schema).parquet(f"{out}/rows/batch_id=1")
    fresh = spark.createDataFrame([(json.dumps(GOOD),)], "value string")
    assert tuples(second) == tuples(score_messages(fitted[1], fresh)) != tuples(score_messages(fitted[0], fresh))
    assert isinstance(fitted[0], PipelineModel)


def test_producer_publishes_what_the_consumer_reads(spark, folder):
    flights = [
        {"airline_iata": "6E", "dep_icao": "KMIA", "dep_iata": "MIA", "dep_time_utc": "2023-04-08 08:10", "duration": 60},
        {"airline_iata": "2F", "dep_icao": "ZZZZ", "arr_icao": "KMIA", "arr_time_utc": "2023-04-08 09:00"},
    ]
    publish(f"{folder}/in", "a.json", [json.dumps(flights)])
    schedules = spark.readStream.schema(FLIGHT_RECORD).json(f"{folder}/in")
    airports = spark.createDataFrame([("KMIA", "Miami")], AIRPORTS)
    weather = spark.createDataFrame(
        [("Miami", "2023-04-08 09:00:00", "snow")], "city string, dt_txt string, weather_description string"
    )
    publish_schedules(
        schedules, lambda: airports, lambda: weather, lambda m: write_topic_files(m, f"{folder}/topic"),
        f"{folder}/checkpoint", every=None,
    ).awaitTermination()
    rows = message_rows(spark.read.text(f"{folder}/topic"))
    assert tuples(rows) == sorted([
        ("6E", None, None, "snow", "MIA", "2023-04-08 08:10", 60.0), ("2F", "snow", None, None, None, None, None),
    ], key=repr)
