"""Hard negatives against plain scores of all pairs, and the bounds of the tree."""

import math

import numpy as np
import pyarrow as pa
import pytest

from delaycast.llm import anchor_tree
from delaycast.llm.anchor_tree import MiningParameters, mine_negatives, near_groups, scaled_vectors, spanning_tree, sweep

SCHEMA = "vec_id long, embedding array<double>, label int, rank int"


def plain(rows, parameters=MiningParameters(), anchor=lambda i: i % 10 == 0):
    usable = []
    for vec_id, vector, label, *_ in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, label, [math.floor(parameters.scale * x) for x in vector]))
    out = set()
    for a, label, v in {r[0]: r for r in sorted(usable, reverse=True) if anchor(r[0])}.values():
        def first(keep, size):
            best = {}
            for i, other, w in usable:
                s = sum(x * y for x, y in zip(v, w))
                if keep(i, other, s):
                    best[i] = max(s, best.get(i, s))
            return sorted(best.items(), key=lambda x: (-x[1], x[0]))[:size]

        for p, ps in first(lambda i, other, s: other == label and i != a, parameters.positives):
            def fits(i, other, s):
                return other != label and parameters.low * ps <= 100 * s <= parameters.high * ps

            for rank, (n, ns) in enumerate(first(fits, parameters.negatives), 1):
                out.add((a, p, rank, n, ps, ns))
    return out


def mined(spark, rows, parameters=MiningParameters(), partitions=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = [tuple(r) for r in mine_negatives(frame, "vec_id % 10 = 0", parameters).select(*names).collect()]
    assert len(found) == len(set(found))
    return set(found)


def clustered(seed, count, width=6, labels=3):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(5, width))
    vectors = centres[chance.integers(0, 5, count)] + 0.2 * chance.normal(size=(count, width))
    return [(i, v.tolist(), int(chance.integers(0, labels)), 0) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("block,tree", [(4096, 1024), (16, 4)])
def test_against_all_pairs(spark, monkeypatch, block, tree):
    rows = clustered(1, 300)
    monkeypatch.setattr(anchor_tree, "BLOCK_ROWS", block)
    monkeypatch.setattr(anchor_tree, "TREE_ANCHORS", tree)
    parts = mined(spark, rows)
    assert parts == plain(rows) and parts
    assert mined(spark, rows, MiningParameters(round_anchors=7)) == parts


def test_edge_rows(spark):
    rows = clustered(2, 60)
    rows += [(None, rows[0][1], 1, 0), (61, None, 1, 0), (62, rows[0][1], None, 0), (63, [float("nan")] * 6, 1, 0)]
    rows += [(64, [1.0, None], 1, 0), (65, [float("inf")], 2, 0), (66, [], 1, 0), (67, [0.5], 1, 0), (70, [1.5] * 9, 2, 0)]
    rows += [rows[5]] * 40 + [rows[10]] * 3  # repeated rows, one of them an anchor
    rows += [(7, rows[20][1], 0, 0), (20, rows[3][1], 2, 0)]  # other rows of known ids
    rows += [(200 + i, rows[30][1], i % 2, 0) for i in range(30)]  # ties
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows[:1]) == set()
    assert mined(spark, []) == set()
    assert mined(spark, [(i, [1.0, -float(i)], 4, 0) for i in range(30)]) == set()  # one label


def test_large_components(spark):
    chance = np.random.default_rng(4)
    rows = [(i, (chance.normal(size=4) * 3e6).tolist(), i % 2, 0) for i in range(50)]
    assert mined(spark, rows) == plain(rows)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, [1e30], 1, 0)])


def test_bounds_skip_rows_and_lose_none():
    chance = np.random.default_rng(7)
    vectors = np.floor(256 * np.array([r[1] for r in clustered(3, 80)]))
    tree = spanning_tree(np.arange(80), np.zeros(80), vectors)
    assert sorted(tree.ids.tolist()) == list(range(80))
    assert all(p < k for k, p in enumerate(tree.parents)) and tree.parents[0] == -1
    rows = np.floor(256 * chance.normal(size=(500, 6)))
    exact = rows @ tree.vectors.T
    seen = {}
    low, high = np.percentile(exact, [98, 99.5])
    everything = np.ones(500, bool)
    scored = sweep(tree, rows, lambda k: (everything, low, high), lambda k, at, s: seen.update({k: (at.tolist(), s.tolist())}))
    for k in range(80):
        at = np.flatnonzero((exact[:, k] >= low) & (exact[:, k] <= high))
        assert seen[k] == (at.tolist(), exact[at, k].tolist())
    assert scored < 0.5 * exact.size


def test_scaled_vectors_of_a_slice():
    column = pa.array([[9.0], [0.1, -0.1], None, [], [None], [1.0, 2.0, 3.0]], pa.list_(pa.float32())).slice(1)
    usable, rows = scaled_vectors(column, 256)
    assert usable.tolist() == [True, False, True, False, True]
    assert rows.tolist() == [[25, -26, 0], [0, 0, 0], [256, 512, 768]]


def test_groups_hold_all_rows(monkeypatch):
    monkeypatch.setattr(anchor_tree, "TREE_ANCHORS", 10)
    groups = near_groups(np.ones((95, 3)), np.arange(95))
    assert max(map(len, groups)) <= 10 and sorted(np.concatenate(groups).tolist()) == list(range(95))
