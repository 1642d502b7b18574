import json
import pytest
from pathlib import Path

from pyspark.ml.feature import StringIndexer
from pyspark.sql import types as T

from delaycast.schemas import FLIGHT_TABLE, OPTIONAL_FEED_COLUMNS, WEATHER_COLUMNS, WEATHER_TABLE
from delaycast.sinks.files import replace_table, write_csv
from delaycast.sinks.topics import to_json_batches, to_json_rows
from delaycast.sources.feeds import (
    decode_payloads,
    feed_filter,
    flatten_forecasts,
    read_delay_feed,
    read_forecasts,
    read_schedule,
    reject_counts,
)
from delaycast.sources.tables import read_csv, read_metrics, read_table
from delaycast.sources.vocabulary import read_vocabulary, vocabulary_indexer, write_vocabularies
from tests.conftest import tuples

RECORDS = [
    {"airline_iata": "5D", "dep_iata": "NAN", "delayed": 31, "dep_time_utc": "2023-04-08 09:59", "duration": None},
    {"airline_iata": "2F", "dep_iata": "MIA", "delayed": 50.5, "extra": {"ignored": 1}},
]


def write(folder, name, text):
    path = Path(folder) / name
    path.write_text(text)
    return str(path)


def test_delay_feed_pretty_printed_and_per_line(spark, folder):
    pretty = write(folder, "pretty.json", json.dumps({"response": RECORDS, "request": {}}, indent=2))
    lines = write(folder, "lines.json", "\n".join(json.dumps({"response": [r]}) for r in RECORDS))
    for path, multiline in ((pretty, True), (lines, False)):
        feed = read_delay_feed(spark, path, multiline=multiline)
        rows = sorted(feed.select("airline_iata", "dep_iata", "delayed", "duration", "arr_iata").collect())
        assert rows == [("2F", "MIA", 50.5, None, None), ("5D", "NAN", 31.0, None, None)]


def test_schedule_array_file(spark, folder):
    path = write(folder, "schedules.json", json.dumps(RECORDS, indent=1))
    rows = read_schedule(spark, path)
    assert rows.count() == 2 and rows.schema["airline_iata"].dataType == T.StringType()


def test_feed_filter_is_inclusive(spark):
    df = spark.createDataFrame([(30.0, "MIA"), (29.9, "MIA"), (99.0, "LHR"), (None, "MIA")], "delayed double, dep_iata string")
    assert tuples(feed_filter(df)) == [(30.0, "MIA"), (99.0, "LHR")]
    assert tuples(feed_filter(df, "MIA")) == [(30.0, "MIA")]
    assert feed_filter(df, "MIA", minimum=None).count() == 3


ENTRY = {
    "dt": 1680944400,
    "main": {"temp": 289.1, "feels_like": 288, "temp_min": 287.5, "temp_max": 290, "pressure": 1015,
             "sea_level": 1015, "grnd_level": 1010, "humidity": 60, "temp_kf": -0.5},
    "weather": [{"id": 801, "main": "Clouds", "description": "few clouds", "icon": "02d"}, {"id": 1}],
    "clouds": {"all": 20},
    "wind": {"speed": 3.5, "deg": 120, "gust": 5.1},
    "visibility": 10000,
    "pop": 0.2,
    "sys": {"pod": "d"},
    "dt_txt": "2023-04-08 09:00:00",
}


def test_forecasts_flatten_with_missing_parts(spark, folder):
    sparse = {"dt": 5, "weather": [], "main": {"temp": 1.0}, "dt_txt": "2023-04-08 12:00:00"}
    documents = [
        {"city": "Miami", "status": 200, "list": [ENTRY, sparse]},
        {"city": "Nowhere", "status": 404, "list": [ENTRY]},
        {"city": "Empty", "status": 200, "list": []},
    ]
    path = write(folder, "forecasts.json", "\n".join(json.dumps(d) for d in documents))
    flat = flatten_forecasts(read_forecasts(spark, path))
    assert flat.columns == WEATHER_COLUMNS
    full, partial = flat.orderBy("dt_txt").collect()
    assert full.asDict() == {
        "city": "Miami", "dt": 1680944400, "dt_txt": "2023-04-08 09:00:00", "visibility": 10000, "pop": 0.2,
        "clouds_all": 20, "sys_pod": "d", "wind_speed": 3.5, "wind_deg": 120, "wind_gust": 5.1,
        "weather_id": 801, "weather_main": "Clouds", "weather_description": "few clouds", "weather_icon": "02d",
        **{f"main_{k}": float(v) for k, v in ENTRY["main"].items()},
    }
    assert (partial.main_temp, partial.weather_description, partial.wind_speed, partial.sys_pod) == (1.0, None, None, None)


def test_bad_payloads_are_counted(spark):
    envelopes = spark.createDataFrame(
        [(1, 200, '{"k": 1}'), (2, 404, '{"k": 2}'), (3, 200, '{"k": '), (4, 200, None), (5, None, "{}"), (6, 200, "{}")],
        "id int, status int, body string",
    )
    decoded = decode_payloads(envelopes, T.StructType([T.StructField("k", T.IntegerType())]), "id")
    verdicts = {r.id: (r.verdict, r.payload.k if r.payload else None) for r in decoded.collect()}
    assert verdicts[1] == ("ok", 1) and verdicts[6] == ("ok", None)
    assert {i for i, v in verdicts.items() if v[0] == "status"} == {2, 5}
    assert {i for i, v in verdicts.items() if v[0] == "corrupt"} == {3, 4}
    assert tuples(reject_counts(decoded)) == [("corrupt", 2), ("ok", 2), ("status", 2)]


def test_csv_is_typed_and_keeps_codes(spark, folder):
    text = (
        "airline_iata,city,delayed\n"
        '5D,"a ""quoted"", city",31\n'
        '2F,"",\n'
        "NAN,x,45.5\n"
    )
    schema = T.StructType([
        T.StructField("airline_iata", T.StringType()), T.StructField("city", T.StringType()),
        T.StructField("delayed", T.DoubleType()),
    ])
    rows = read_csv(spark, write(folder, "in.csv", text), schema).collect()
    assert [tuple(r) for r in rows] == [("5D", 'a "quoted", city', 31.0), ("2F", None, None), ("NAN", "x", 45.5)]
    df = spark.createDataFrame(rows, schema)
    write_csv(df, f"{folder}/out")
    write_csv(df, f"{folder}/out")
    assert tuples(read_csv(spark, f"{folder}/out", schema)) == tuples(df)
    with pytest.raises(Exception, match="broken off"):
        write_csv(df.selectExpr("CAST(raise_error('broken off') AS STRING) AS code"), f"{folder}/out")
    yesterday = read_csv(spark, f"{folder}/out", schema)
    assert tuples(yesterday) == tuples(df)
    write_csv(yesterday.unionByName(df), f"{folder}/out")  # reads what it replaces
    assert read_csv(spark, f"{folder}/out", schema).count() == 2 * df.count()


def test_flight_table_reads_the_feeds_time_text(spark, folder):
    names = [f.name for f in FLIGHT_TABLE]
    values = {"dep_time_utc": "2023-04-08 09:59", "delayed": "31", "outlier": "0", "arr_time_utc": "2023-04-08 11:00"}
    text = ",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n"
    row = read_csv(spark, write(folder, "flights.csv", text), FLIGHT_TABLE).first()
    assert (str(row.dep_time_utc), row.delayed, row.outlier, row.arr_time_utc) == (
        "2023-04-08 09:59:00", 31.0, 0, "2023-04-08 11:00",
    )
    assert len(names) == 46 and len(WEATHER_TABLE) == 23 and set(OPTIONAL_FEED_COLUMNS) < set(names)


def test_replaced_table_may_read_itself(spark, folder):
    df = spark.createDataFrame([(1, 0.5)], "trial_id int, roc_auc double")
    replace_table(df, "evaluation_test", folder)
    raised = read_table(spark, "evaluation_test").selectExpr("trial_id + 1 AS trial_id", "roc_auc")
    replace_table(raised, "evaluation_test", folder)
    assert read_metrics(spark, "evaluation_test") == [{"trial_id": 2, "roc_auc": 0.5}]
    spark.sql("DROP VIEW evaluation_test")


def test_json_rows(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert to_json_rows(df).first().value == '{"a":1}'
    assert to_json_rows(df, keep_nulls=True).first().value == '{"a":1,"b":null}'


def test_json_batches_are_bounded_and_whole(spark):
    df = spark.range(0, 1000, 1, 3)
    batches = [json.loads(r.value) for r in to_json_batches(df, rows=64).collect()]
    assert max(len(b) for b in batches) <= 64
    assert sorted(row["id"] for b in batches for row in b) == list(range(1000))
    wrapped = json.loads(to_json_batches(df, rows=64, field="response").first().value)
    assert list(wrapped) == ["response"]


def test_vocabulary_files(spark, folder):
    tokens = {"airline_iata": ["6E", "null", "NAN", "5D"], "dep_desc": ["few clouds", "null"]}
    for name, lines in tokens.items():
        write(folder, f"{name}.txt", "\n".join(lines) + "\n")
    assert read_vocabulary(spark, f"{folder}/airline_iata.txt") == tokens["airline_iata"]
    indexer = vocabulary_indexer(spark, folder, list(tokens))
    df = spark.createDataFrame([("5D", "null"), ("unseen", "snow"), ("6E", "few clouds")], "airline_iata string, dep_desc string")
    rows = indexer.transform(df).select("airline_iata_index", "dep_desc_index").collect()
    assert [tuple(r) for r in rows] == [(3.0, 1.0), (4.0, 2.0), (0.0, 0.0)]
    fitted = StringIndexer(inputCols=["airline_iata", "dep_desc"], outputCols=["a", "b"]).fit(df.union(df.limit(1)))
    write_vocabularies(fitted, spark, f"{folder}/copy")
    assert read_vocabulary(spark, f"{folder}/copy/airline_iata.txt") == ["5D", "6E", "unseen"]


def test_a_cluster_needs_a_shared_scratch_folder():
    from types import SimpleNamespace

    from delaycast.session import scratch_path

    conf = {}
    session = SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        scratch_path(session, "x")
    conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert scratch_path(session, "x").startswith("hdfs://shared/delaycast/x-")
