"""Spelling groups against plain edit distances, and the machine against enumeration."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from delaycast.llm import queries
from delaycast.llm.spelling import Machine, SpellingParameters, count_words, near_words, spelling_groups

SF_DIR = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, parameters, slip):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if slip and h % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= parameters.min_length and n >= parameters.min_count}


def plain_groups(counts, factor):
    rows = {}
    for word, n in counts.items():
        near = [(m, other) for other, m in counts.items() if one_edit(word, other)]
        most = max((m for m, _ in near), default=0)
        form = min(other for m, other in near if m == most) if most >= factor * n else None
        rows[word] = [form, n, len(near), most if form else None]
    out = set()
    for word, (form, n, n_near, form_n) in rows.items():
        root = word
        while rows[root][0]:
            root = rows[root][0]
        out.add((word, form, root, n, n_near, form_n))
    return out


def grouped(spark, counts, parameters):
    frame = spark.createDataFrame(list(counts.items()) or [("", 0)], "word string, n long")
    frame = frame if counts else frame.limit(0)
    rows = spelling_groups(frame, parameters).select("word", "form", "root", "n", "n_near", "form_n").collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


def test_machine_is_minimal_and_composes():
    chance = random.Random(1)
    words = sorted({"".join(chance.choices("abc", k=5)) for _ in range(120)})
    shorter = sorted({"".join(chance.choices("abc", k=4)) for _ in range(60)})
    machine = Machine()
    whole, less = machine.accept(words), machine.accept(shorter)
    assert list(machine.words(whole)) == words
    languages = [frozenset(machine.words(state)) for state in range(len(machine.arcs))]
    assert len(set(languages)) == len(languages)  # no two states accept the same
    pairs = [(frozenset((a, b)) if same else (a, b)) for a, b, same in machine.one_edit(whole, less, "")]
    wanted = {frozenset(p) for p in itertools.combinations(words, 2) if one_edit(*p)}
    wanted |= {(a, b) for a in words for b in shorter if one_edit(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == wanted


@pytest.mark.parametrize("largest_group", [4096, 3])
def test_groups_against_brute_force(spark, largest_group):
    chance = random.Random(5)
    counts = {}
    for _ in range(250):  # a third share long parts, so keys are hot and split
        counts["".join(chance.choices("abé", k=chance.randint(1, 7)))] = chance.randint(1, 60)
        counts["samestart" + "".join(chance.choices("ab", k=chance.randint(0, 5)))] = chance.randint(1, 60)
        counts["".join(chance.choices("xy", k=3)) + "sameend"] = chance.choice([1, 2, 4])
    parameters = SpellingParameters(min_length=1, min_count=1, largest_group=largest_group)
    assert grouped(spark, counts, parameters) == plain_groups(counts, parameters.factor)


def test_each_pair_comes_once_in_both_directions(spark):
    words = ["a" * k for k in range(1, 9)] + ["aab", "aba", "baa", "abba", "aabb"]
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = [(r.word, r.near) for r in near_words(frame, 2).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_chains_ties_and_long_words(spark):
    long = "lo" + "ng" * 20_000
    counts = {"chain": 400, "chaim": 200, "chaimx": 90, "chainmx": 40, "tiedb": 9, "tieda": 9, "tiedx": 2}
    counts |= {long: 9, long[1:]: 3, long[:-1] + "h": 4, "a" * 30_000: 8, "a" * 29_999: 3}
    parameters = SpellingParameters()
    assert grouped(spark, counts, parameters) == plain_groups(counts, parameters.factor)


def test_empty(spark):
    assert grouped(spark, {}, SpellingParameters()) == set()
    documents = spark.createDataFrame([], "doc_id long, text string")
    assert count_words(documents, SpellingParameters(), slip=97).count() == 0


def test_counts(spark):
    texts = ["Words wörds ÀÉÎÕÜ words.", None, "", "Ünter WORDS words2words x", "words " * 400, "y" * 70_000 + " words"]
    rows = [(None if i == 3 else i * 31, t) for i, t in enumerate(texts)] * 3
    parameters = SpellingParameters()
    documents = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    for slip in (None, 2):
        found = {r.word: r.n for r in count_words(documents, parameters, slip).collect()}
        assert found == plain_counts(rows, parameters, slip)


def test_query_counts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {r.word: r.n for r in count_words(documents, queries.SPELLING, queries.SLIP).collect()}
    assert found == plain_counts(rows, queries.SPELLING, queries.SLIP)
