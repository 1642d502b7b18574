"""Fingerprints and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as contract
from delaycast.llm import simhash as sh
from delaycast.llm.components import components


def plain_fingerprint(text, words=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall("[^\\x20\\x09-\\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots_of(points, distance):
    """Smallest index reachable for each point, by comparing all pairs."""
    parent = list(range(len(points)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= distance:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(points))]


def test_every_pair_within_the_distance_meets():
    chance = random.Random(1)
    for distance in range(4):
        masks = sh.half_radius_masks(distance, 3)

        def ball(point, masks=masks):
            return {int((np.uint64(point) & kept) ^ f | mark) for kept, mark, flips in masks for f in flips}

        for _ in range(60):
            a = b = chance.getrandbits(64)
            for bit in chance.sample(range(64), distance):
                b ^= 1 << bit
            assert ball(a) & ball(b)


@pytest.mark.parametrize("look_up", [50_000, 10])
def test_forest_connects_what_is_connected(monkeypatch, look_up):
    monkeypatch.setattr(sh, "LOOK_UP", look_up)
    chance = random.Random(2)
    points = sorted({sum(1 << b for b in chance.sample(range(24), 3)) for _ in range(120)})
    left, right = sh.forest(np.array(points, np.uint64), 3)
    pairs = [(int(a), int(b)) for a, b in zip(np.concatenate(left), np.concatenate(right))]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    groups = {p: {p} for p in points}
    for a, b in pairs:
        if groups[a] is not groups[b]:
            joined = groups[a] | groups[b]
            for p in joined:
                groups[p] = joined
    expected = roots_of(points, 3)
    for p, root in zip(points, expected):
        assert min(groups[p]) == points[root]


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_against_brute_force_with_edge_rows(spark):
    chance = random.Random(5)
    words = ["Alpha", "beta", "gamma", "delta", "Ünion", "x\ty", "eta\x0bzeta"]
    rows = [(i, " ".join(chance.choice(words) for _ in range(chance.randint(0, 9))), "s") for i in range(300)]
    base = [chance.choice(words) + str(i) for i in range(400)]
    for i in range(300, 420):  # near copies, most of them within a few bits of each other
        copy = list(base)
        copy[i - 300] = "changed"
        rows.append((i, " ".join(copy), "s"))
    rows += [(None, "alpha beta", "s"), (5000, None, "s"), (5001, "", None), (7, rows[7][1], "s"), (6000, "w " * 30000, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sh.simhash_components(df).collect()
    assert len(found) == len(rows)
    points = [plain_fingerprint(r[1]) for r in rows]
    assert sorted(r.fp % 2**64 for r in found) == sorted(points)
    roots = roots_of(points, 3)
    lowest = {}
    for row, root in zip(rows, roots):
        if row[0] is not None:
            lowest[root] = min(row[0], lowest.get(root, row[0]))
    expected = sorted((str(r[0]), lowest[root]) for r, root in zip(rows, roots))
    assert sorted((str(r.doc_id), r.component_id) for r in found) == expected
    kept = sh.keep_one_each(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(lowest.values())
    assert sh.keep_one_each(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet").collect()
    found = {r.doc_id: r for r in contract.queries()["op5_simhash"](spark, contract.SMOKE_DIR).collect()}
    points = [plain_fingerprint(r.text) for r in rows]
    lowest = {}
    roots = roots_of(points, 3)
    for row, root in zip(rows, roots):
        lowest[root] = min(row.doc_id, lowest.get(root, row.doc_id))
    assert len(found) == len(rows)
    for row, point, root in zip(rows, points, roots):
        assert (found[row.doc_id].fingerprint, found[row.doc_id].component_id) == (f"{point:016x}", lowest[root])
