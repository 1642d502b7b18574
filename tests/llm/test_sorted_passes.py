"""Links and components of vectors against comparing all pairs."""

import math

import numpy as np
import pyarrow as pa

import __spark_entry__ as contract
from delaycast.llm import sorted_passes as sp


def plain(rows, cosine=0.98):
    """{row number: (links, component)} by comparing all pairs."""

    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    good = [i for i, r in enumerate(rows) if usable(r)]
    links = [0] * len(rows)
    by = {}
    for i in good:
        by.setdefault((rows[i][2], len(rows[i][1])), []).append(i)
    for members in by.values():
        x = np.array([rows[i][1] for i in members], float)
        norms = np.sqrt((x * x).sum(axis=1))
        hits = (x @ x.T) / (norms[:, None] * norms[None, :]) >= cosine
        for a, b in zip(*np.nonzero(hits)):
            if a < b:
                links[members[a]] += 1
                links[members[b]] += 1
                parent[max(top(members[a]), top(members[b]))] = min(top(members[a]), top(members[b]))
    lowest = {}
    for i in good:
        lowest[top(i)] = min(rows[i][0], lowest.get(top(i), rows[i][0]))
    return [(links[i], lowest[top(i)] if i in set(good) else rows[i][0]) for i in range(len(rows))]


def test_small_windows_chains_and_dense_groups(spark, monkeypatch):
    monkeypatch.setattr(sp, "COUNT_BLOCK", 16)
    chance = np.random.default_rng(1)
    rows = [(i, chance.normal(size=16).tolist(), int(i % 3)) for i in range(300)]
    center = chance.normal(size=16)
    rows += [(1000 + i, (center + chance.normal(size=16) * 0.07).tolist(), 1) for i in range(150)]  # dense, partly linked
    angle = np.linspace(0, 1.2, 12)  # a chain
    rows += [(2000 + i, [math.cos(a), math.sin(a)] + [0.0] * 14, 2) for i, a in enumerate(angle)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in sp.near_vectors(df, sp.PassParameters(window=16)).collect()}
    expected = plain(rows)
    assert len(found) == len(rows)
    for row, (links, component) in zip(rows, expected):
        assert found[row[0]] == (links, component, row[0] == component)


def test_similar_label_and_tie_runs(spark):
    """Planted pairs in a label whose vectors share a direction, and in one tight cluster of a label."""
    chance = np.random.default_rng(3)
    shared = chance.normal(size=32)
    shared /= np.linalg.norm(shared)

    def around(count, spread):
        away = chance.normal(size=(count, 32))
        away /= np.linalg.norm(away, axis=1, keepdims=True)
        return shared * math.sqrt(1 - spread) + away * math.sqrt(spread)

    similar, cluster = around(1500, 0.2), around(600, 0.05)
    twins = similar[:150] + chance.normal(size=(150, 32)) * 0.185 / math.sqrt(32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([similar, twins]))]
    rows += [(5000 + i, v.tolist(), 2) for i, v in enumerate(np.concatenate([cluster, chance.normal(size=(900, 32))]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in sp.near_vectors(df, sp.PassParameters(window=8)).collect()}
    expected = dict(zip((r[0] for r in rows), plain(rows)))
    linked = [i for i, e in expected.items() if e[0]]
    assert len(linked) >= 150
    assert sum(found[i] == expected[i] for i in linked) >= 0.99 * len(linked)


def test_sketches_keep_links_and_tell_others_apart():
    """Pairs at the threshold stay within the limit wherever the mean lies; vectors far apart do not."""
    chance = np.random.default_rng(9)
    for dimension, away in ((16, 0.0), (64, 0.6), (64, 0.9), (256, 0.97)):
        mean = chance.normal(size=dimension)
        mean *= away / np.linalg.norm(mean)
        first = chance.normal(size=(500, dimension))
        first = sp.directions(mean + math.sqrt(1 - away * away) * sp.directions(first))
        across = chance.normal(size=first.shape)
        across = sp.directions(across - (across * first).sum(axis=1, keepdims=True) * first)
        second = first * 0.98 + across * math.sqrt(1 - 0.98**2)
        centred = np.concatenate([first, second]) - mean
        words = sp.words_of(pa.array(sp.sketches(centred, 20), pa.binary()))
        near = sp.near_sketches(words, np.sqrt((centred * centred).sum(axis=1)), 0, 0.98)
        assert near[np.arange(500), np.arange(500, 1000)].all()
        assert (near == near.T).all() and not near.diagonal().any()
        if away < 0.9:
            assert near.sum() < 2 * 500 * 1.2


def test_groups_of_near_sketches():
    near = np.zeros((7, 7), bool)
    for a, b in ((0, 3), (3, 5), (1, 6), (2, 4)):
        near[a, b] = near[b, a] = True
    ids = np.array([9, 4, 7, 2, 7, 5, 1])  # 2 and 4 are rows of one id
    assert [g.tolist() for g in sp.sketch_groups(ids, near)] == [[2, 5, 9], [1, 4]]


def test_windows_reach_over_borders(spark):
    """One order of many partitions links all that stand within a window of each other."""
    rows = [(i, [math.cos(i / 50), math.sin(i / 50)], 1) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(
        "0 AS label", "2 AS dim", "cast(lpad(vec_id, 5, '0') as binary) AS path", "vec_id AS id", "embedding AS vector",
        "unhex(repeat('00', 32)) AS sketch", "0D AS radius"
    )
    before = sp.pass_orders
    sp.pass_orders = lambda vectors, parameters: (df.repartitionByRange(60, "path"), [])
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        links = sp.pass_links(df, sp.PassParameters(window=8)).collect()
    finally:
        sp.pass_orders = before
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    parent = list(range(150))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[top(a)] = top(b)
    assert len({top(i) for i in range(150)}) == 1


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 0.0], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0, 0.001], 1), (13, [-1.0, 0.0], 1), (14, [1.0, 0.0], 2), (15, [-0.0, 1.0], 2),
        (16, [0.0, 1.0], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' AS kept", "1 AS n_links")
    found = sorted(map(str, [(r.vec_id, r.n_links, r.component_id, r.kept) for r in sp.near_vectors(df).collect()]))
    expected = [(r[0], *e, r[0] == e[1]) for r, e in zip(rows, plain(rows))]
    assert found == sorted(map(str, expected))
    assert sp.near_vectors(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    folder = contract.SMOKE_DIR.replace("0.001", "0.1")
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id) for r in contract.queries()["op7_sorted_passes"](spark, folder).collect()}
    assert found == {r[0]: e for r, e in zip(rows, plain(rows))}
