"""Tiles, leaks and decontamination against plain search."""

import random

import pytest

import __spark_entry__ as contract
from delaycast.llm import string_tiling as st


def longest_match(item, text, item_marks, text_marks):
    best = (0, 0, 0)
    for a in range(len(item)):
        for b in range(len(text)):
            n = 0
            while (
                a + n < len(item) and b + n < len(text) and item[a + n] == text[b + n] >= 0
                and not item_marks[a + n] and not text_marks[b + n]
            ):
                n += 1
            best = max(best, (n, -a, -b))
    return best[0], -best[1], -best[2]


def plain_tiles(item, text, min_match):
    """Greedy string tiling word for word: the longest unmarked match, until none is long enough."""
    item_marks, text_marks, out = [False] * len(item), [False] * len(text), []
    while True:
        n, a, b = longest_match(item, text, item_marks, text_marks)
        if n < min_match:
            return out
        out.append((a, b, n))
        for k in range(n):
            item_marks[a + k] = text_marks[b + k] = True


@pytest.mark.parametrize("letters", [2, 5, 40])
def test_tiles(letters):
    chance = random.Random(letters)
    for _ in range(60):
        item = [chance.randrange(letters) for _ in range(chance.randint(0, 40))]
        cuts = sorted(chance.randint(0, len(item)) for _ in range(4))
        parts = [item[i:j] for i, j in zip([0, *cuts], [*cuts, len(item)])]
        chance.shuffle(parts)
        text = sum(parts, []) + [-1] + [chance.randrange(letters) for _ in range(15)]
        found = st.tile(item, text, 3)
        item_marks, text_marks = [False] * len(item), [t < 0 for t in text]
        for a, b, n in found:
            assert n >= 3 and item[a : a + n] == text[b : b + n]
            assert not any(item_marks[a : a + n]) and not any(text_marks[b : b + n])
            item_marks[a : a + n] = text_marks[b : b + n] = [True] * n
        assert longest_match(item, text, item_marks, text_marks)[0] < 3
        expected = plain_tiles(item, text, 3)
        assert max((n for *_, n in found), default=0) == max((n for *_, n in expected), default=0)
        if letters == 40:  # no ties between matches, so no freedom of choice
            assert sorted(n for *_, n in found) == sorted(n for *_, n in expected)


def test_running_hashes_equal_those_of_all_windows():
    import numpy as np

    ids = [random.Random(1).randrange(9) for _ in range(50)]
    expected = st.window_hashes(np.array(ids), 7).tolist()
    assert [v for _, v in st.running_hashes(ids, [False] * 50, 7)] == expected


ITEM = "One two, three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def test_leaks_and_edge_rows(spark):
    words = ITEM.split()
    reordered = " ".join(words[10:] + ["between"] + words[5:10] + ["x"] + words[:5])
    rows = [
        (1, "before " + ITEM.upper() + " after", 0.5), (2, reordered, 0.1), (3, " ".join(words[:6]), 0.2),
        (4, None, 0.0), (5, "", 0.0), (None, ITEM, 0.0), (1, "before " + ITEM.upper() + " after", 0.5),
        (6, "filler " * 40000 + ITEM, 0.0), (7, " ".join(reversed(words)), 0.0), (8, "short item", 0.0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, coverage double")
    items = [(10, ITEM), (11, "short item"), (12, None), (None, ITEM), (13, "a b c d e f g h"), (10, "other text of the same id here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((str(r.doc_id), r.item_id, r.covered, r.tiles) for r in st.leaked_items(df, benchmark).collect())
    assert found == [("1", 10, 15, 1), ("1", 10, 15, 1), ("2", 10, 15, 3), ("6", 10, 15, 1), ("None", 10, 15, 1)]
    # Blocks of one item each give the same.
    small = st.TilingParameters(block_chars=20)
    blocks = st.leaked_items(df, benchmark, small)
    assert sorted((str(r.doc_id), r.item_id, r.covered, r.tiles) for r in blocks.collect()) == found
    for parameters in (st.TilingParameters(), small):
        clean = st.decontaminate(df, benchmark, parameters)
        assert clean.columns == df.columns
        assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 7, 8]
    assert st.leaked_items(df.limit(0), benchmark).count() == 0
    assert st.decontaminate(df, benchmark.limit(0)).count() == len(rows)


def test_query_against_brute_force(spark):
    documents = spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet").collect()
    benchmark = spark.read.parquet(f"{contract.SMOKE_DIR}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id): r.covered for r in contract.queries()["op4_string_tiling"](spark, contract.SMOKE_DIR).collect()}
    expected = set()
    for doc in documents:
        own = st.tokens(doc.text)
        seeds = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        for item in benchmark:
            tokens = st.tokens(item.text)
            held = {k for i in range(len(tokens) - 4) if tuple(tokens[i : i + 5]) in seeds for k in range(i, i + 5)}
            if len(held) < 0.5 * len(tokens):  # tiles cannot cover more than the shared seeds do
                continue
            if sum(n for *_, n in st.tile([hash(t) % 2**40 for t in tokens], [hash(t) % 2**40 for t in own], 5)) >= 0.5 * len(tokens):
                expected.add((doc.doc_id, item.item_id))
    assert set(found) == expected and expected
