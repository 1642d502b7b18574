"""Pattern spans against plain search; beliefs against enumeration; what repetition adds."""

import hashlib
import random
import re
import time
from itertools import product

import numpy as np
import pytest

import __spark_entry__ as contract
from delaycast.llm import skip_chain as sc


def plain_luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(sum(map(int, str(v))) for v in doubled) % 10 == 0


def plain_spans(text):
    """The base patterns over the whole text, as stated."""
    text = text or ""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and plain_luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


PIECES = ["a.b+c@d-e.fg.h", "x@y", "@z.w", "p@q.r_s@t.u", "é@b.c", "1.2.3.4", "256.1.1.1", "001.02.3.4.5", "4111 1111 1111 1111", "4111111111111112",
          "4041894974608795", "+1 (988) 555-2485", "+12", "+1..2.3(4)-5 6 7 8", " ", " ", "\n", "7", "-", ".", "٣", "@", "word", "+", "0" * 400 + ".1.1.1"]


def test_pattern_spans_equal_plain_search():
    chance = random.Random(2)
    for _ in range(4000):
        text = "".join(chance.choice(PIECES) for _ in range(chance.randint(0, 8)))
        assert sc.base_spans(text) == plain_spans(text), text


def test_beliefs_equal_enumeration_on_a_tree():
    chance = np.random.default_rng(3)
    field = sc.Field(chance.normal(size=(sc.WEIGHTS, sc.LABELS)), *(chance.normal(size=(sc.LABELS, sc.LABELS)) for _ in range(3)))
    field.skip[:] = (field.skip + field.skip.T) / 2
    _, tokens = sc.describe("mail 12 345 6789x off 77 now 98765 and 98765")
    assert [t["joined"] for t in tokens] == [False, True, True, False, False, False] and tokens[5]["links"] == [4]
    graph, ones = sc.Graph([tokens]), np.ones(6)
    unary = graph.unary(field, ones, ones)
    sums = np.zeros((6, sc.LABELS))
    for labels in product(range(sc.LABELS), repeat=6):
        score = sum(unary[i, y] for i, y in enumerate(labels))
        score += field.chain[labels[0], labels[1]] + field.chain[labels[1], labels[2]] + field.skip[labels[4], labels[5]]
        for i, y in enumerate(labels):
            sums[i, y] += np.exp(score)
    beliefs, _ = graph.beliefs(unary, field, 60)
    assert beliefs == pytest.approx(sums / sums.sum(axis=1, keepdims=True), abs=1e-4)


def test_evidence_reaches_fifty_repetitions():
    field = sc.Field(np.zeros((sc.WEIGHTS, 5)), np.zeros((5, 5)), np.zeros((5, 5)), 8 * np.eye(5))
    graph = sc.Graph([sc.describe("call 5550199 now " * 50)[1]])
    assert graph.size == 50 and len(graph.left) == 49
    unary = np.zeros((50, 5))
    unary[0, 4] = 20  # plain in the first place only
    keep = (np.exp(8) - 1) / (np.exp(8) + 4)  # share of the evidence that a link carries on
    beliefs, _ = graph.beliefs(unary, field, sc.FieldParameters().rounds)
    assert beliefs[:, 4] == pytest.approx([0.2 + 0.8 * keep**i for i in range(50)], abs=1e-3)
    assert beliefs[-1, 4] >= sc.FieldParameters().belief


def test_fixed_neighbours_count_as_label_zero():
    field = sc.Field(np.zeros((sc.WEIGHTS, 5)), np.zeros((5, 5)), np.arange(25.0).reshape(5, 5), np.zeros((5, 5)))
    graph = sc.Graph([sc.describe("a 1 b 2 3 c")[1]])
    rows = graph.unary(field, np.ones(3), np.ones(3))
    assert rows.tolist() == [[y + 5 * y for y in range(5)], list(range(5)), [5 * y for y in range(5)]]


def phones(chance, count):
    return [f"+1 ({chance.randint(200, 999)}) 555-{chance.randint(1000, 9999)}" for _ in range(count)]


def test_repetition_adds_spans_and_clean_text_stays_clean(spark):
    chance = random.Random(6)
    numbers = phones(chance, 120)
    rows = [(i, f"She wrote to {n} and to user{i}@mail.example.com from 10.0.0.{i % 250} in 2021, version 2.0 of it.", "p") for i, n in enumerate(numbers)]
    rows += [(1000, f"Call {numbers[0]} today.\n{'plain words ' * 3000}\nOr reach {numbers[0][3:]} later.", "p")]
    rows += [(1001, "Version 2.0 of 2021 has 12 parts.", None), (None, None, ""), (1002, "", ""), (0, rows[0][1], "p"), (1003, "7 " * 20000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = sc.personal_spans(df).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    added = {r.doc_id: [(sc.KINDS[s.kind], texts[r.doc_id][s.start : s.stop]) for s in r.added] for r in found}
    assert added.pop(1000) == [("phone", numbers[0][3:])]
    assert not any(added.values())
    for r in found:
        assert [tuple(s) for s in r.base] == plain_spans(texts[r.doc_id])
    assert sc.digest_columns(sc.personal_spans(df.limit(0))).count() == 0


def test_query_against_brute_force(spark):
    found = contract.queries()["op8_skip_chain"](spark, contract.SMOKE_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for row in found:
        spans = plain_spans(texts[row.doc_id])
        written = [f"{sc.KINDS[k]}:{a}:{b}" for k, a, b in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(row.spans.split(",")) | {""}
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == i for k, *_ in spans) for i in range(4))
    assert any(r.spans for r in found)


PLAIN_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_ip_search_from_run_starts_equals_plain_search():
    chance = random.Random(21)
    for _ in range(20_000):
        text = "".join(chance.choices("019..  x-+@", k=chance.randint(0, 24)))
        assert [m.span() for m in sc.IP.finditer(text)] == [m.span() for m in PLAIN_IP.finditer(text)], text


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1.2.3.4" + "5" * 1_000_000, "a" * 1_000_000, "+1" * 300_000, "1 " * 200_000 + "x"])
def test_long_runs_take_seconds(text):
    started = time.perf_counter()
    sc.base_spans(text)
    assert time.perf_counter() - started < 10


def test_documents_do_not_depend_on_their_neighbours():
    chance = random.Random(6)
    words = ["call", "mail", "555 1234", "a@b.cd", "10.0.0.1", "id77", "4711 4711", "+49 30 123456", "see", "x9"]
    documents = [sc.describe(" ".join(chance.choices(words, k=chance.randint(1, 40))))[1] for _ in range(40)]
    field = sc.fit_field(documents, sc.FieldParameters(epochs=15))
    field = field._replace(chain=field.chain * 3, skip=field.skip * 3)  # loops that take many rounds

    def beliefs(some):
        graph = sc.Graph(some)
        ones = np.ones(graph.size)
        return graph.beliefs(graph.unary(field, ones, ones), field, 10)[0]

    together = beliefs(documents)
    alone = np.concatenate([beliefs([d]) for d in documents])
    assert np.abs(together - alone).max() < 1e-12
