"""Numbered commits, snapshot tables, keyed documents and the model registry under races and replays."""

import os
import random
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from delaycast.plans.linear_model import LinearModel
from delaycast.plans.registry import LatestModel, publish_model
from delaycast.sinks.commits import CommitLog, Conflict, SnapshotTable
from delaycast.sinks.files import replace_table
from delaycast.sinks.keyed import KeyedDocuments, newest_per_key
from delaycast.streaming.pipelines import start
from tests.conftest import tuples


def test_one_writer_gets_a_number(spark, folder):
    logs = [CommitLog(spark, f"{folder}/log") for _ in range(8)]
    assert logs[0].latest() is None
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: logs[i].put(1, {"by": i}), range(8)))
        assert sum(won) == 1 and logs[0].read(1) == {"by": won.index(True)}
        numbers = list(pool.map(lambda i: logs[i].append({"by": i}), range(8)))
    assert sorted(numbers) == list(range(2, 10)) == logs[0].numbers()[1:]
    assert not [name for name in os.listdir(f"{folder}/log") if name.startswith(".") and not name.endswith(".crc")]


def test_two_publishers_get_two_versions(spark, folder):
    models = [LinearModel(float(i), {"x": 1.0}, {}).pipeline() for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda m: publish_model(spark, m, folder), models))
    assert sorted(versions) == [1, 2, 3, 4]
    latest = LatestModel(folder)
    assert latest.get(spark) is not None and latest.version == 4


def test_snapshots(spark, folder):
    table = SnapshotTable(spark, folder)
    with pytest.raises(LookupError):
        table.read()
    first, second = (spark.createDataFrame([(i, "a")], "n int, t string") for i in (1, 2))
    assert table.replace(first, after=0) == 1
    with pytest.raises(Conflict):
        table.replace(second, after=0)
    assert table.replace(table.read().selectExpr("n + 10 AS n", "t")) == 2  # reads the version it replaces
    assert tuples(table.read()) == [(11, "a")] and tuples(table.read(1)) == [(1, "a")]
    assert table.version_at(table.record(1)["at"]) == 1
    with pytest.raises(LookupError):
        table.version_at(table.record(1)["at"] - 1)
    assert table.replace(second.limit(0)) == 3 and table.read().count() == 0
    assert table.expire(keep=2) == [1]
    with pytest.raises(LookupError):
        table.read(1)
    assert len(os.listdir(f"{folder}/data")) == 2 and tuples(table.read(2)) == [(11, "a")]


def test_replaced_tables_leave_no_old_folders(spark, folder):
    for i in range(7):
        replace_table(spark.createDataFrame([(i,)], "n int"), "kept_versions", folder, keep=2)
    assert tuples(spark.table("kept_versions")) == [(6,)]
    assert len(os.listdir(f"{folder}/kept_versions/data")) == 2
    spark.sql("DROP VIEW kept_versions")


SCHEMA = "k string, g int, at int, v string"


def merged(rows):
    """key -> newest row by plain Python; rows come with distinct times per key."""
    out = {}
    for row in rows:
        key = row[:2]
        if key not in out or row[2] > out[key][2]:
            out[key] = row
    return sorted(out.values(), key=repr)


def test_batches_leave_one_newest_document(spark, folder):
    chance = random.Random(2)
    store = KeyedDocuments(spark, folder, ["k", "g"], ["at"], buckets=8)
    with pytest.raises(LookupError):
        store.read()
    seen, at = [], list(range(400))
    chance.shuffle(at)  # late documents come after newer ones
    for batch_id in range(4):
        rows = [(chance.choice(["a", "b", None, "hot"]), chance.randint(0, 9), t, f"v{t}") for t in at[batch_id * 100 :][:100]]
        rows += rows[:30]  # repeated rows
        assert store.upsert(spark.createDataFrame(rows, SCHEMA).repartition(3), batch_id) == batch_id + 1
        seen += rows
        assert tuples(store.read()) == merged(seen)
        assert store.upsert(spark.createDataFrame(rows, SCHEMA), batch_id) is None  # replayed
    assert tuples(store.read(2)) == merged(seen[:260])
    store.expire(keep=1)
    assert tuples(store.read()) == merged(seen)


def test_only_touched_buckets_are_rewritten(spark, folder):
    store = KeyedDocuments(spark, folder, ["k"], ["at"], buckets=16)
    store.upsert(spark.createDataFrame([(str(i), 0, 0, "x") for i in range(200)], SCHEMA), 0)
    before = store.log.read(1)["folders"]
    store.upsert(spark.createDataFrame([("7", 0, 1, "y")], SCHEMA), 1)
    after = store.log.read(2)["folders"]
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert store.upsert(spark.createDataFrame([], SCHEMA), 2) == 3 and store.read().count() == 200
    wider = spark.createDataFrame([("8", 0, 1, "z", 5)], SCHEMA + ", extra int")
    store.upsert(wider, 3)
    assert {(r.k, r.v, r.extra) for r in store.read().where("k IN ('7', '8', '9')").collect()} == {
        ("7", "y", None), ("8", "z", 5), ("9", "x", None)
    }


def test_two_writers_lose_nothing(spark, folder):
    def write(i):
        rows = [(f"{i}-{j}", 0, 0, "x") for j in range(20)] + [("shared", 0, i, f"v{i}")]
        return KeyedDocuments(spark, folder, ["k"], ["at"], buckets=4).upsert(spark.createDataFrame(rows, SCHEMA), 0, f"s{i}")

    with ThreadPoolExecutor(3) as pool:
        assert sorted(pool.map(write, range(3))) == [1, 2, 3]
    found = KeyedDocuments(spark, folder, ["k"], ["at"]).read()
    assert found.count() == 61 and found.where("k = 'shared'").first().v == "v2"


def test_stream_sends_keys_again(spark, folder):
    landed = Path(folder) / "in"
    landed.mkdir()
    store = KeyedDocuments(spark, f"{folder}/store", ["k"], ["at"], buckets=4)
    for at in range(3):
        (landed / f"{at}.json").write_text("".join(f'{{"k":"{k}","at":{at},"v":"{k}{at}"}}\n' for k in "abcd"[: 4 - at]))
        stream = spark.readStream.schema("k string, at int, v string").json(str(landed))
        start(stream, store.foreach_batch(lambda batch: batch.where("k IS NOT NULL")), f"{folder}/checkpoint").awaitTermination()
    assert tuples(store.read()) == [("a", 2, "a2"), ("b", 2, "b2"), ("c", 1, "c1"), ("d", 0, "d0")]
    assert store.log.numbers() == [1, 2, 3]


def test_newest_per_key_breaks_ties_alike(spark):
    rows = [("a", 0, 1, v) for v in "xyz"]
    found = {tuples(newest_per_key(spark.createDataFrame(r, SCHEMA).repartition(n), ["k"], ["at"]))[0]
             for r in (rows, rows[::-1]) for n in (1, 3)}
    assert len(found) == 1
