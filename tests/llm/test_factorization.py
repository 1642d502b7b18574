"""The linear-time score, the held-out split and held-out accuracy."""

import math
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from delaycast.llm import factorization as fm
from delaycast.llm.labelled import labelled_sample


def test_score_equals_all_pairs():
    chance = np.random.default_rng(1)
    size, rank = 64 + fm.STATISTICS, 3
    machine = fm.Machine(
        0.3, chance.normal(size=size), chance.normal(size=(size, rank)), chance.normal(size=fm.STATISTICS), np.full(fm.STATISTICS, 0.7)
    )
    for count in (0, 1, 9):
        numbers = chance.choice(64, count, replace=False)
        dense = chance.normal(size=fm.STATISTICS)
        x = np.zeros(size)
        x[numbers] = 1 / math.sqrt(max(1, count))
        x[64:] = (dense - machine.center) / machine.spread
        pairs = sum(machine.factors[i] @ machine.factors[j] * x[i] * x[j] for i in range(size) for j in range(i))
        assert machine.logit(numbers, dense) == pytest.approx(0.3 + machine.linear @ x + pairs)


def test_fit_learns_an_interaction_of_words():
    # Label 1 if exactly one of the two words is there: no linear model can.
    rows = [
        {"numbers": [n for n, there in ((1, a), (2, b)) if there] + [3 + k % 5], "dense": [0.0] * fm.STATISTICS, "label": a ^ b, "weight": 1.0}
        for k in range(100)
        for a in (0, 1)
        for b in (0, 1)
    ]
    machine = fm.fit_machine(rows, fm.MachineParameters(bits=6, steps=300, rate=0.05))
    right = [(machine.logit(np.array(r["numbers"]), np.zeros(fm.STATISTICS)) > 0) == bool(r["label"]) for r in rows]
    assert np.mean(right) > 0.95


def test_held_out_accuracy_and_split(spark):
    found = {r.doc_id: r for r in contract.queries()["op6_factorization_machine"](spark, contract.SMOKE_DIR.replace("0.001", "0.01")).collect()}
    labels = spark.read.parquet(contract.SMOKE_DIR.replace("0.001", "0.01") + "/labels.parquet").collect()
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in found.items())
    assert all(r.predicted == int(r.score >= 0.7) for r in found.values())
    held = [(found[r.doc_id], r.quality) for r in labels if found[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.95


def test_sample_is_bounded_and_leaves_held_out_labels_alone(spark):
    documents = spark.createDataFrame([(i, f"t{i}", 2) for i in range(200)], "doc_id long, text string, n_chars long")
    labels = [(i, i % 10 > 0) for i in range(200)] + [(3, True), (None, True)]
    labels = spark.createDataFrame([(i, int(q)) for i, q in labels], "doc_id long, quality int")
    rows = labelled_sample(documents, labels, "quality", 4, 2, 30, ["text"]).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in rows)
    for label in (0, 1):
        own = [r for r in rows if r.label == label]
        known = [i for i in range(200) if int(i % 10 > 0) == label and zlib.crc32(str(i).encode()) % 4 != 2]
        assert len(own) == min(30, len(known)) and sum(r.weight for r in own) == pytest.approx(len(known))


def test_edge_rows_and_missing_labels(spark):
    rows = [(1, None, None), (2, "", 0), (None, "a b", 3), (3, "word " * 30000, None), (3, "word " * 30000, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "'x' AS score")
    labels = spark.createDataFrame([(7, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        machine = fm.train_quality(documents, some)
        scores = [r.s for r in documents.select(fm.quality_score(documents, machine).alias("s")).collect()]
        assert len(set(scores)) == 1 and 0 < scores[0] < 1
    assert documents.limit(0).select(fm.quality_score(documents, machine)).count() == 0


def test_sample_has_one_row_an_id(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, "a smaller text")] * 3000 + [(8, "text 8")] * 500 + [(None, "x")] * 5
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 3 + [(None, 1)], "doc_id long, quality int")
    found = labelled_sample(documents, labels, "quality", 4, 2, 1000, ["text"]).collect()
    ids = [r.doc_id for r in found]
    assert len(ids) == len(set(ids)) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40))
    assert all(r.label == r.doc_id % 2 and r.weight == 1.0 for r in found)
    assert {r.doc_id: r.text for r in found}.get(7, "a smaller text") == "a smaller text"
