"""Gradients, windows and scores against plain computation; held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from delaycast.llm import gated_recurrent as gr

SMALL = gr.NetworkParameters(window=5, stride=2, hidden=3, attention=2)


def small_network(seed=0):
    network = gr.new_network(SMALL, 0.1)
    chance = np.random.default_rng(seed)
    return gr.Network(*(w.astype(np.float64) for w in network))._replace(
        words=chance.normal(size=network.words.shape), grams=chance.normal(size=network.grams.shape)
    )


def plain_logit(inputs, network):
    """The network word by word, for one window."""
    h = SMALL.hidden
    gates = inputs @ network.inward + network.offset
    states = np.zeros((len(inputs), 2 * h))
    for side in (0, 1):
        columns = [slice((2 * g + side) * h, (2 * g + side + 1) * h) for g in range(3)]
        own = slice(side * h, (side + 1) * h)
        state = np.zeros(h)
        for t in range(len(inputs)) if side == 0 else range(len(inputs) - 1, -1, -1):
            inner = [state @ network.recurrent[own, c] for c in columns]
            update = 1 / (1 + np.exp(-(gates[t, columns[0]] + inner[0])))
            reset = 1 / (1 + np.exp(-(gates[t, columns[1]] + inner[1])))
            candidate = np.tanh(gates[t, columns[2]] + reset * inner[2])
            state = update * state + (1 - update) * candidate
            states[t, own] = state
    scores = np.tanh(states @ network.attend + network.attend_offset) @ network.query
    weights = np.exp(scores) / np.exp(scores).sum()
    return weights @ states @ network.out + network.out_offset[0]


def test_gradients_equal_differences():
    network, chance = small_network(), np.random.default_rng(0)
    inputs = chance.normal(size=(7, gr.INPUTS))
    index, mask = chance.integers(0, 7, (4, 5)), np.ones((4, 5))
    mask[1, 3:] = 0
    labels, weights = np.array([0, 1, 1, 0.0]), np.array([1, 2, 1, 0.5])

    def loss():
        states = gr.recurrence(inputs @ network.inward + network.offset, index, mask, network)
        logits = gr.pooled(states, mask, network)[0]
        return float((weights * (np.log1p(np.exp(-np.abs(logits))) + np.maximum(logits, 0) - labels * logits)).mean())

    found, d_inputs = gr.gradients(index, mask, inputs, labels, weights, network)
    for values, slope in [*zip(network[2:], found), (inputs, d_inputs)]:
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        before, sides = values[at], []
        for step in (1e-3, -1e-3):
            values[at] = before + step
            sides.append(loss())
        values[at] = before
        assert slope[at] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=2e-3)


def test_word_buckets_are_those_of_each_word_alone():
    words = ["a", "the", "(theatre),", "...", "é", "中文字", "x" * 40, "😀y"]
    whole = gr.word_buckets(words)
    assert whole.lengths.tolist() == [1, 2, 6, 2, 1, 2, 39, 1]
    for i, word in enumerate(words):
        alone, taken = gr.word_buckets([word]), whole.take(np.array([i]))
        assert alone.words.tolist() == taken.words.tolist() and alone.grams.tolist() == taken.grams.tolist()


@pytest.mark.parametrize("chunk", [8, 50_000])
def test_score_is_the_highest_of_all_windows(monkeypatch, chunk):
    monkeypatch.setattr(gr, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(gr, "TABLE_WORDS", 20)
    network, chance = small_network(1), random.Random(1)
    evidence = (np.zeros(gr.WORD_BUCKETS), np.zeros(gr.GRAM_BUCKETS))
    scorer = gr.Scorer(gr.Model(network, evidence, 0.25), SMALL)
    texts = [" ".join(chance.choice("alpha beta gamma delta eps zeta".split()) for _ in range(n)) for n in (1, 2, 5, 6, 7, 8, 23, 60)]
    found = scorer.scores(iter([*texts, "", None, " \n"]))
    assert found[-3:] == [0.25] * 3
    for text, score in zip(texts, found):
        words = text.split()
        inputs = gr.inputs_of(gr.word_buckets(words), network, evidence)
        starts = {*range(0, max(1, len(words) - 4), 2), max(0, len(words) - 5)}
        best = max(plain_logit(inputs[a : a + 5], network) for a in starts)
        assert score == pytest.approx(1 / (1 + np.exp(-best)), abs=1e-4)


def made_up(chance, i):
    toxic = chance.random() < 0.3
    words = [chance.choice("the of and house river stone green walks sings".split()) + chance.choice(["", "er", "s"]) for _ in range(chance.randint(3, 120))]
    if toxic:
        words[chance.randrange(len(words))] = chance.choice(["grotidiot", "idiotly", "scummy", "scum"])
    return i, " ".join(words), int(toxic)


def test_held_out_accuracy_on_words_and_parts_of_words(spark):
    chance = random.Random(8)
    rows = [made_up(chance, i) for i in range(900)]
    documents = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    parameters = gr.NetworkParameters(steps=300)
    model = gr.train_toxicity(documents, labels, parameters)
    scores = {r.doc_id: r.s for r in documents.select("doc_id", gr.toxicity_score(documents, model, parameters).alias("s")).collect()}
    held = [(scores[i] >= 0.7, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 200 and np.mean([p == bool(y) for p, y in held]) > 0.95


def test_edge_rows_and_missing_labels(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "word " * 60000), (3, "word " * 60000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS label", "0 AS weight")
    labels = spark.createDataFrame([(3, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        model = gr.train_toxicity(documents, some)
        scores = [r.s for r in documents.select(gr.toxicity_score(documents, model).alias("s")).collect()]
        assert len(set(scores)) == 1 and 0 < scores[0] < 1
    assert documents.limit(0).select(gr.toxicity_score(documents, model)).count() == 0


def test_query_scores_all_documents(spark):
    found = contract.queries()["op3_gated_recurrent"](spark, contract.SMOKE_DIR).collect()
    assert len(found) == 200
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
