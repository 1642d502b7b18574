"""Hot keys carried between micro-batches."""

import json
from collections import Counter
from pathlib import Path

from hypothesis import given
from hypothesis import strategies as st

from delaycast.operators.lookup import left_lookup
from delaycast.schemas import AIRPORTS, FLIGHT_RECORD
from delaycast.sinks.topics import write_topic_files
from delaycast.streaming.enrich import ENRICH_KEYS
from delaycast.streaming.hot_keys import HotKeys, Summary
from delaycast.streaming.messages import message_rows
from delaycast.streaming.pipelines import publish_schedules, start
from tests.conftest import tuples

KEYS = [("station",)]


@given(st.lists(st.lists(st.integers(0, 30), max_size=60), max_size=8), st.integers(1, 6), st.sampled_from([1.0, 0.5]))
def test_summaries_miss_no_frequent_key(batches, capacity, decay):
    summary, exact, total = Summary(), Counter(), 0.0
    for batch in batches:
        summary = summary.merged(len(batch), dict(Counter(batch)), capacity, decay)
        exact = Counter({key: n * decay for key, n in exact.items()})
        exact.update(Counter(batch))
        total = total * decay + len(batch)
    assert len(summary.counts) <= capacity and abs(summary.total - total) < 1e-9
    for key, count in exact.items():
        kept = summary.counts.get(key, 0.0)
        assert kept <= count + 1e-9 and count - kept <= total / (capacity + 1) + 1e-9
    assert len(summary.copies(4)) < 4 or not summary.counts


def stations(spark, hot, first, rows=4000):
    station = f"CASE WHEN id % 10 < 6 THEN '{hot}' WHEN id % 10 = 9 THEN NULL ELSE concat('s', id % 997) END"
    return spark.range(first, first + rows).selectExpr("id", f"{station} AS station")


def test_skewed_stream_spreads_its_hot_keys(spark, folder):
    """The second batch is split without counting; tasks get even shares and rows stay right."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for number, hot in enumerate(["a", "a", "b", "b"]):
            stations(spark, hot, number * 4000).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        names = [("a", "Aa"), ("b", "Bb"), *[(f"s{i}", f"city {i}") for i in range(0, 997, 2)]]
        dimension = spark.createDataFrame(names, "station string, city string")
        hot = HotKeys(spark, f"{folder}/summaries", KEYS)
        shares, splits = {}, {}

        def deliver(batch, batch_id):
            def build(found):
                splits[batch_id] = found
                return left_lookup(batch, dimension, [("station", "station")], limit=-1, splits=found)

            def write(joined):
                joined.selectExpr("*", "spark_partition_id() AS task").write.parquet(f"{folder}/out/{batch_id}")

            hot.deliver(batch_id, build, write)
            written = spark.read.parquet(f"{folder}/out/{batch_id}")
            sizes = [r["count"] for r in written.groupBy("task").count().collect()]
            shares[batch_id] = max(sizes) / sum(sizes)

        stream = spark.readStream.schema("id bigint, station string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        start(stream, deliver, f"{folder}/checkpoint").awaitTermination()
        assert splits[0] is None
        assert sorted(splits[1][KEYS[0]].values()) == [2, 10]  # null keys and the hot one
        assert sorted(splits[3][KEYS[0]].values()) == [2, 5, 6]  # the faded one and the new one, too
        assert all(share < 0.4 for n, share in shares.items() if n != 2), shares
        expected = spark.read.parquet(f"{folder}/in").join(dimension, "station", "left").select("id", "station", "city")
        written = spark.read.parquet(*[f"{folder}/out/{n}" for n in range(4)]).select("id", "station", "city")
        assert tuples(written) == tuples(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_replayed_empty_and_unlike_batches(spark, folder):
    hot = HotKeys(spark, f"{folder}/summaries", KEYS)
    batch = stations(spark, "a", 0)
    for _ in range(2):  # the second is a replay
        assert hot.splits(0) is None
        hot.deliver(0, lambda splits: batch, lambda df: df.write.format("noop").mode("overwrite").save())
        assert hot.log.numbers() == [1]
    first = hot.before(1)
    assert first[KEYS[0]].total == 4000
    empty = batch.limit(0)
    hot.deliver(1, lambda splits: empty, lambda df: df.write.format("noop").mode("overwrite").save())
    assert hot.before(2)[KEYS[0]] == first[KEYS[0]].merged(0, {}, hot.capacity, hot.decay)
    assert hot.splits(2) == hot.splits(1)

    # Hashes of unlike types differ, so such a join counts its own keys.
    facts = spark.range(100).selectExpr("int(id % 3) AS key", "id")
    dimension = spark.createDataFrame([(i, str(i)) for i in range(2)], "key bigint, name string")
    joined = left_lookup(facts, dimension, [("key", "key")], limit=-1, splits={("key",): {1: 4}})
    assert joined.where("name = string(key)").count() == 67 and joined.count() == 100


def test_publishing_with_carried_keys_equals_publishing_without(spark, folder):
    flights = [{"airline_iata": f"{i:02d}", "dep_icao": "KMIA" if i % 3 else "EGLL", "dep_time_utc": "2023-04-08 08:10"} for i in range(40)]
    Path(f"{folder}/in").mkdir()
    for number in range(3):
        Path(f"{folder}/in/{number}.json").write_text(json.dumps(flights[number * 12 : number * 12 + 14]))
    airports = spark.createDataFrame([("KMIA", "Miami"), ("EGLL", "London")], AIRPORTS)
    weather = spark.createDataFrame(
        [("Miami", "2023-04-08 09:00:00", "snow")], "city string, dt_txt string, weather_description string"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, hot in (("plain", None), ("carried", HotKeys(spark, f"{folder}/summaries", ENRICH_KEYS))):
            schedules = spark.readStream.schema(FLIGHT_RECORD).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
            publish_schedules(
                schedules, lambda: airports, lambda: weather,
                lambda m, name=name: write_topic_files(m, f"{folder}/{name}"), f"{folder}/{name}-checkpoint", every=None, hot=hot,
            ).awaitTermination()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    carried = tuples(message_rows(spark.read.text(f"{folder}/carried")))
    assert carried == tuples(message_rows(spark.read.text(f"{folder}/plain"))) and len(carried) == 42
    assert hot.log.numbers() == [1, 2, 3] and hot.splits(3)[("dep_icao",)]
