"""Bucketed joins, running quantiles, dictionaries, landed partitions and dead letters."""

import math
import os
import random
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.operators.bucketed import dual_role_bucketed, store_bucketed
from delaycast.operators.outliers import iqr_outlier_flag
from delaycast.operators.running_quantiles import RunningQuantiles, value_range
from delaycast.operators.weather import dual_role_weather
from delaycast.plans.dictionary import build_dictionary, encode_tokens
from delaycast.sinks.documents import write_batch
from delaycast.sources.landing import land, read_landed
from delaycast.streaming.dead_letters import DeadLetters
from delaycast.streaming.messages import message_rows
from tests.conftest import tuples


def plan_of(df):
    return df._jdf.queryExecution().toString()


# --- bucketed joins ---------------------------------------------------------------------------------

FLIGHTS = "id int, dep_city string, dep_time_utc_3hr string, arr_city string, arr_time_utc_3hr string, extra string"


def flights_and_weather(spark, hot=0):
    chance = random.Random(3)
    cities, slots = ["Miami", "London", "Oslo", "", None], [f"2024-01-01 {h:02d}:00:00" for h in range(0, 24, 3)]
    pick = lambda: (chance.choice(cities), chance.choice(slots))
    rows = [(i, *pick(), *pick(), "x") for i in range(400)]
    rows += [(1000, "Oslo", slots[0], "Miami", slots[1], "copy")] * hot  # one key, copies of one row
    weather = [(c, s, f"{c} at {s}", float(i)) for i, (c, s) in enumerate((c, s) for c in cities[:3] for s in slots[:6])]
    weather.append(("Oslo", slots[0], "issued again", -1.0))  # a duplicate fans out
    return (
        spark.createDataFrame(rows, FLIGHTS).repartition(3),
        spark.createDataFrame(weather, "city string, dt_txt string, weather_description string, main_temp double"),
    )


@pytest.mark.parametrize("hot", [0, 900])
def test_bucketed_roles_move_the_flights_once(spark, hot):
    flights, weather = flights_and_weather(spark, hot)
    stored = store_bucketed(flights, weather, buckets=4)
    joined = dual_role_bucketed(spark, stored)
    wanted = dual_role_weather(flights, weather)
    assert tuples(joined.select(*wanted.columns)) == tuples(wanted)
    plan = re.split("== Physical Plan ==", joined._jdf.queryExecution().toString())[1]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Broadcast" not in plan
    copies = spark.table(stored.flights).where("dep_city = 'Oslo'").select("_dep_copy").distinct().count()
    assert copies > 1 if hot else copies == 1
    narrow = dual_role_bucketed(spark, stored, ["main_temp"])
    assert [c for c in narrow.columns if "_main_" in c or "weather" in c] == ["dep_main_temp", "arr_main_temp"]
    for table in stored[:2]:
        spark.sql(f"DROP TABLE {table}")


# --- running quantiles --------------------------------------------------------------------------------


def test_ranges_never_fall(spark):
    chance = random.Random(1)
    values = sorted({chance.uniform(-1, 1) * 10 ** chance.randint(-12, 300) for _ in range(4000)} | {0.0, 5e-324, 1.7e308})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r.range for r in df.selectExpr("v", f"{value_range('v')} AS range").orderBy("v").collect()]
    assert found == sorted(found)


@pytest.mark.parametrize("limit", [12, 1_000_000])
def test_days_add_up_to_the_whole(spark, folder, limit):
    chance = random.Random(limit)
    days = {f"2024-01-0{d}": [chance.choice([chance.gauss(40, 15), 45.0, -3.5, float(chance.randint(0, 9))]) for _ in range(n)]
            for d, n in ((1, 300), (2, 1), (3, 150), (4, 0))}
    running = RunningQuantiles(spark, folder, limit)
    assert running.percentiles([0.5]) == [None] and running.quartiles() == (None, None)
    seen = []
    for day, values in days.items():
        df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "x double")
        running.add(day, spark.createDataFrame([(9e9,)], "x double"), "x")  # replaced by what comes again
        running.add(day, df, "x")
        seen += values
        assert running.percentiles([0, 0.25, 0.75]) == pytest.approx(np.quantile(seen, [0, 0.25, 0.75]).tolist(), rel=1e-12)
    whole = spark.createDataFrame([(v,) for v in [*seen, None, 1e9]], "x double")
    base = spark.createDataFrame([(v,) for v in seen], "x double")
    fence = iqr_outlier_flag(base, "x").where("outlier = 1").count()
    flagged = running.flag(whole, "x")
    assert flagged.where("outlier = 1").count() == fence + 1 and flagged.where("x IS NULL AND outlier = 0").count() == 1


def test_infinities_and_one_value(spark, folder):
    running = RunningQuantiles(spark, folder)
    running.add("a", spark.createDataFrame([(math.inf,), (-math.inf,), (-0.0,), (0.0,)], "x double"), "x")
    assert running.percentiles([0, 1]) == [-math.inf, math.inf] and running.percentiles([0.5]) == [0.0]
    one = RunningQuantiles(spark, f"{folder}/one")
    one.add("a", spark.createDataFrame([(7,)] * 5, "x int"), "x")
    assert one.percentiles([0, 0.3, 1]) == [7.0] * 3 and statistics.median([7.0]) == 7.0


# --- dictionaries ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [None, 0])
def test_indices_follow_frequency_over_many_ranges(spark, limit):
    chance = random.Random(9)
    tokens = [f"t{int(chance.paretovariate(0.7)) % 3000}" for _ in range(6000)] + ["hot"] * 3000 + ["", "é"] + [None] * 5
    df = spark.createDataFrame([(t, 1) for t in tokens], "t string, index int").repartition(5)
    kept = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        dictionary = build_dictionary(df, "t")
        found = {r.token: r["index"] for r in dictionary.frame.collect()}
        encoded = tuples(encode_tokens(df, "t", dictionary, "n", limit).select("t", "n").distinct())
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    counts = {t: tokens.count(t) for t in set(tokens) - {None}}
    wanted = {t: i for i, t in enumerate(sorted(counts, key=lambda t: (-counts[t], t)))}
    assert found == wanted
    assert encoded == sorted([*wanted.items(), (None, None)], key=repr)
    assert build_dictionary(df.limit(0), "t").frame.count() == 0


# --- landed partitions ------------------------------------------------------------------------------------

LANDED = "id int, dep_iata string, dep_time_utc string, delayed double"


def test_landed_days_and_stations_are_pruned(spark, folder):
    stations = ["MIA", "JFK", "7", None]
    rows = [(i, stations[i % 4], None if i % 11 == 0 else f"2024-01-{1 + i % 5:02d} 10:00", float(i % 90)) for i in range(300)]
    rows += [(1000 + i, "HOT", "2024-01-03 05:00", 50.0) for i in range(600)]
    df = spark.createDataFrame(rows, LANDED)
    land(df, folder)
    assert len([f for f in os.listdir(f"{folder}/dep_day=2024-01-03/dep_iata=HOT") if f.endswith(".parquet")]) > 1
    schema = df.schema
    found = read_landed(spark, folder, schema, "2024-01-02", "2024-01-04", "7", minimum=None)
    wanted = [r for r in rows if r[1] == "7" and r[2] and "2024-01-02" <= r[2][:10] <= "2024-01-04"]
    assert tuples(found.select("id", "dep_iata", "dep_time_utc", "delayed")) == sorted(wanted, key=repr)
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(found))[1]
    assert "dep_day" in filters and "dep_iata" in filters
    listed = spark.createDataFrame([("MIA",), ("HOT",), ("HOT",), (None,)], "dep_iata string")
    by_table = read_landed(spark, folder, schema, stations=listed)
    assert by_table.count() == sum(r[1] in ("MIA", "HOT") and r[3] >= 30 for r in rows)
    whole = read_landed(spark, folder, schema, minimum=None)
    assert tuples(whole.select("id")) == sorted([(r[0],) for r in rows], key=repr)


def test_a_day_that_lands_again_replaces_itself(spark, folder):
    land(spark.createDataFrame([(1, "A", "2024-01-01 01:00", 40.0), (2, "B", "2024-01-01 01:00", 40.0)], LANDED), folder)
    again = spark.createDataFrame([(3, "A", "2024-01-01 02:00", 40.0)], LANDED)
    land(again, folder)
    assert tuples(read_landed(spark, folder, again.schema).select("id")) == [(2,), (3,)]


# --- dead letters -------------------------------------------------------------------------------------------

RECORD = T.StructType().add("k", T.IntegerType()).add("t", T.StringType())


def test_bad_messages_are_kept_and_delivered_once(spark, folder):
    letters = DeadLetters(spark, folder, RECORD)
    assert letters.open_letters().count() == 0 and letters.replay(F.col("value"), lambda *_: None) is None
    good, cut = '{"k":1,"t":"a"}', '{"k":2,"t":"b"'
    values = [good, f"[{good},{good}]", cut, cut, "", None, "no json", '{"k":3']
    batch = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, place int")
    rows = []
    run = letters.beside(lambda messages, number: rows.extend(message_rows(messages, RECORD).collect()))
    run(batch, 5)
    run(batch, 5)  # the batch runs again: its letters replace themselves
    assert len(rows) == 6
    kept = {(r.reason, r.value): r.copies for r in letters.letters().collect()}
    assert kept == {("corrupt", cut): 2, ("empty", ""): 1, ("missing", None): 1, ("corrupt", "no json"): 1, ("corrupt", '{"k":3'): 1}

    def broken(messages, number):
        raise OSError("delivery broke off")

    mend = F.concat("value", F.lit("}"))
    with pytest.raises(OSError):
        letters.replay(mend, broken)
    out = f"{folder}/out"
    deliver = lambda messages, number: write_batch(message_rows(messages, RECORD), number, out)
    assert letters.replay(mend, deliver) is None  # the one that broke off was finished, and no more can be mended
    delivered = spark.read.schema(RECORD).parquet(f"{out}/batch_id=*")
    assert tuples(delivered) == [(2, "b"), (2, "b"), (3, None)]
    assert {r.value for r in letters.open_letters().collect()} == {"", None, "no json"}
    assert letters.resume(deliver) == [] and letters.replay(F.lit(good), deliver) == 2
    assert letters.open_letters().count() == 0 and letters.replayed().count() == 5


def test_origins_tell_letters_apart(spark, folder):
    letters = DeadLetters(spark, folder, RECORD)
    batch = spark.createDataFrame([("x", 1), ("x", 2), ("x", 2)], "value string, place int")
    letters.keep(batch, 0, origin="place")
    assert {(r.origin, r.copies) for r in letters.letters().collect()} == {("1", 1), ("2", 2)}
