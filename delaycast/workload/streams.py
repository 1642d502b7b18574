"""Streams over messages made from the driver tables, run until everything available is processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.functions.missing import replace_columns
from delaycast.operators.weather import dual_role_weather
from delaycast.plans.features import serving_features, training_set
from delaycast.plans.model import linear_probability, train_logistic
from delaycast.plans.registry import LatestModel, publish_model
from delaycast.schemas import FORECAST_FEED, MESSAGE_COLUMNS, MESSAGE_RECORD, WEATHER_COLUMNS
from delaycast.session import scratch_path
from delaycast.sinks.documents import write_batch
from delaycast.sinks.keyed import KeyedDocuments
from delaycast.sinks.topics import to_json_batches, to_json_rows, write_topic_files
from delaycast.sources.feeds import flatten_forecasts
from delaycast.sources.polling import read_snapshots
from delaycast.sources.topics import read_topic_files
from delaycast.streaming.dead_letters import DeadLetters
from delaycast.streaming.enrich import ENRICH_KEYS, enrich_schedule
from delaycast.streaming.hot_keys import HotKeys
from delaycast.streaming.messages import message_rows
from delaycast.streaming.pipelines import keyed_documents, scored_documents, start
from delaycast.workload import adapter
from delaycast.workload.feeds import KEYED_RECORD, forecast_documents
from delaycast.workload.learning import published_set_model, set_model_sql
from delaycast.workload.oracle import WEATHER, joined, minute_sql
from delaycast.workload.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

KEYED_MESSAGE = T.StructType([T.StructField("flight_id", T.LongType()), *MESSAGE_RECORD.fields])


def topic_of(df: DataFrame, name: str) -> DataFrame:
    """Publish rows as message files and open them as a stream."""
    path = scratch_path(df.sparkSession, name)
    write_topic_files(to_json_batches(df), path)
    return read_topic_files(df.sparkSession, path)


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there into files; the rows it delivered."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def enriched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the producer side publishes: the message columns, times as text."""
    located = adapter.located_flights(spark, sf_dir)
    wide = dual_role_weather(located, adapter.weather(spark, sf_dir), ["weather_description"])
    rows = replace_columns(wide, {"dep_time_utc": adapter.minute_text("dep_time_utc")})
    return rows.select("flight_id", *MESSAGE_COLUMNS)


@query("stream_parse_explode", joined(f"""f.flight_id, f.airline_iata, a.weather_description AS arr_weather_description,
  f.arr_iata, d.weather_description AS dep_weather_description, f.dep_iata,
  {minute_sql('f.dep_time_utc')} AS dep_time_utc, f.duration"""))
def stream_parse_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = topic_of(enriched_rows(spark, sf_dir), "messages")
    return drain(message_rows(messages, KEYED_MESSAGE), "parsed")


_ENRICHED = joined("""f.flight_id, f.dep_city, f.arr_city, f.dep_time_utc_3hr, f.arr_time_utc_3hr,
  d.weather_description AS dep_weather_description, d.main_temp AS dep_main_temp,
  a.weather_description AS arr_weather_description, a.main_temp AS arr_main_temp""")


@query("stream_enrich", _ENRICHED)
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    schedules = message_rows(topic_of(adapter.schedule(spark, sf_dir), "schedules"), KEYED_RECORD)
    columns = ["weather_description", "main_temp"]
    weather = adapter.weather(spark, sf_dir)
    enriched = enrich_schedule(schedules, adapter.airports(spark, sf_dir), weather, columns)
    added = [f"{role}_{c}" for role in ("dep", "arr") for c in ("city", "time_utc_3hr", *columns)]
    return drain(enriched.select("flight_id", *added), "enriched")


@query("stream_enrich_carried", _ENRICHED)
def stream_enrich_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_enrich``, in several micro-batches, by shuffle joins whose hot keys earlier batches tell."""
    path, out = scratch_path(spark, "schedules"), scratch_path(spark, "carried")
    # Some files at any size, so that there are batches to carry something between.
    write_topic_files(to_json_batches(adapter.schedule(spark, sf_dir).repartition(3)), path)
    airports, weather = adapter.airports(spark, sf_dir), adapter.weather(spark, sf_dir)
    columns = ["weather_description", "main_temp"]
    hot = HotKeys(spark, f"{out}/summaries", ENRICH_KEYS)
    added = [f"{role}_{c}" for role in ("dep", "arr") for c in ("city", "time_utc_3hr", *columns)]

    def deliver(batch: DataFrame, batch_id: int) -> None:
        schedules = message_rows(batch, KEYED_RECORD)
        hot.deliver(
            batch_id,
            lambda splits: enrich_schedule(schedules, airports, weather, columns, limit=-1, splits=splits),
            lambda enriched: write_batch(enriched.select("flight_id", *added), batch_id, f"{out}/rows"),
        )

    messages = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    start(messages, deliver, f"{out}/checkpoint").awaitTermination()
    rows = enrich_schedule(message_rows(spark.read.text(path), KEYED_RECORD), airports, weather, columns)
    return spark.read.schema(rows.select("flight_id", *added).schema).parquet(f"{out}/rows/batch_id=*")


@query("stream_score_linear", joined("""f.flight_id,
  round(1 / (1 + exp(-(-0.25e0 + -0.004e0 * coalesce(f.duration, 0) + 0.001e0
    * coalesce(CAST(hour(f.dep_time_utc) * 60 + minute(f.dep_time_utc) AS DOUBLE), 0)))), 9) AS delay_prob,
  coalesce(d.weather_description, 'null') AS dep_desc, coalesce(a.weather_description, 'null') AS arr_desc"""))
def stream_score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to features to a fixed linear score, all inside the stream."""
    messages = topic_of(enriched_rows(spark, sf_dir), "messages")
    features = serving_features(message_rows(messages, KEYED_MESSAGE))
    probability = linear_probability({"duration": -0.004, "dep_time_float": 0.001}, -0.25)
    scored = features.selectExpr("flight_id", f"round({probability}, 9) AS delay_prob", "dep_desc", "arr_desc")
    return drain(scored, "linear")


@query("stream_score")
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages scored per micro-batch with the newest published model, delivered by batch."""
    training = training_set(adapter.flights(spark, sf_dir), adapter.weather(spark, sf_dir), keys=["flight_id"])
    root = scratch_path(spark, "models")
    publish_model(spark, train_logistic(training, ["flight_id"]).models[0], root)
    messages = topic_of(enriched_rows(spark, sf_dir), "messages")
    out = scratch_path(spark, "scored")
    deliver = scored_documents(LatestModel(root), f"{out}/rows", KEYED_MESSAGE, f"{out}/counts")
    start(messages, deliver, f"{out}/checkpoint").awaitTermination()
    scored = T.StructType([*KEYED_MESSAGE.fields, T.StructField("delay_prob", T.DoubleType())])
    return spark.read.schema(scored).parquet(f"{out}/rows/batch_id=*")


_SET_SCORE = set_model_sql(
    "coalesce(f.duration, 0)",
    "coalesce(CAST(hour(f.dep_time_utc) * 60 + minute(f.dep_time_utc) AS DOUBLE), 0)",
    "f.dep_iata",
    "coalesce(d.weather_description, 'null')",
)


@query("stream_score_set_model", joined(f"f.flight_id, {_SET_SCORE}"))
def stream_score_set_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_score``, with a published model whose coefficients are known."""
    messages = topic_of(enriched_rows(spark, sf_dir), "messages")
    out = scratch_path(spark, "scored")
    deliver = scored_documents(published_set_model(spark), f"{out}/rows", KEYED_MESSAGE)
    start(messages, deliver, f"{out}/checkpoint").awaitTermination()
    rows = spark.read.schema("flight_id bigint, delay_prob double").parquet(f"{out}/rows/batch_id=*")
    return rows.selectExpr("flight_id", "round(delay_prob, 9) AS delay_prob")


_ROUTE = ["airline_iata", "dep_iata", "arr_iata"]


@query("stream_upsert_documents", joined(
    f"""f.flight_id, coalesce(f.airline_iata, 'null') AS airline_iata, f.dep_iata, f.arr_iata, {_SET_SCORE}""",
    where="QUALIFY row_number() OVER (PARTITION BY f.airline_iata, f.dep_iata, f.arr_iata ORDER BY f.flight_id DESC) = 1",
))
def stream_upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored document per route, its newest flight, though every message is delivered twice."""
    messages = topic_of(enriched_rows(spark, sf_dir), "messages")
    out = scratch_path(spark, "routes")
    models = published_set_model(spark)
    store = KeyedDocuments(spark, f"{out}/documents", _ROUTE, ["flight_id"], buckets=8)
    for stream in ("first", "again"):
        deliver = keyed_documents(models, store, KEYED_MESSAGE, stream)
        start(messages, deliver, f"{out}/{stream}").awaitTermination()
    return store.read().selectExpr("flight_id", *_ROUTE, "round(delay_prob, 9) AS delay_prob")


@query("poll_forecasts", f"WITH {WEATHER} SELECT {', '.join(WEATHER_COLUMNS)} FROM weather")
def poll_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts polled in three answers; the query stops after two and goes on from its checkpoint."""
    out = scratch_path(spark, "polled")
    documents = forecast_documents(adapter.weather(spark, sf_dir).frame)
    answers = documents.selectExpr("*", "pmod(xxhash64(city), 3) AS answer")
    for landed in ((0, 1), (2,)):
        for number in landed:
            write_topic_files(to_json_rows(answers.where(f"answer = {number}").drop("answer")), f"{out}/answers/{number:04d}")
        polled = read_snapshots(spark, f"{out}/answers")
        forecasts = flatten_forecasts(polled.select(F.from_json("value", FORECAST_FEED).alias("d")).select("d.*"))
        writer = forecasts.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
        writer.trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return spark.read.schema(forecasts.schema).parquet(f"{out}/rows")


@query("replay_rejects", """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k,
  CASE WHEN event_id % 23 = 0 THEN 'replay' ELSE 'stream' END AS delivered
FROM events WHERE event_id % 29 <> 0""")
def replay_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some break off: those are kept, mended and delivered once; some stay unreadable."""
    props = "concat('{\"event_id\":', event_id, ',\"k\":', from_json(props, 'k int').k)"
    cut = f"CASE WHEN event_id % 29 = 0 THEN '?' WHEN event_id % 23 = 0 THEN {props} ELSE concat({props}, '}}') END"
    path, out = scratch_path(spark, "cut-messages"), scratch_path(spark, "replayed")
    write_topic_files(adapter.table(spark, sf_dir, "events").selectExpr(f"{cut} AS value"), path)
    record = T.StructType().add("event_id", T.LongType()).add("k", T.IntegerType())
    letters = DeadLetters(spark, f"{out}/letters", record)

    def delivery(kind: str):
        return lambda messages, number: write_batch(message_rows(messages, record), number, f"{out}/{kind}")

    start(read_topic_files(spark, path), letters.beside(delivery("stream")), f"{out}/checkpoint").awaitTermination()
    for _ in range(2):  # the second finds nothing that it could mend
        letters.replay(F.concat("value", F.lit("}")), delivery("replay"))
    rows = [
        spark.read.schema(record).parquet(f"{out}/{kind}/batch_id=*").selectExpr("*", f"'{kind}' AS delivered")
        for kind in ("stream", "replay")
    ]
    return rows[0].unionByName(rows[1])
