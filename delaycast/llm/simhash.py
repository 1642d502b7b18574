"""SimHash near-duplicates by meeting in the middle.

Two fingerprints within a radius r have a common point halfway: every fingerprint emits all its
variants within r / 2, the variants are shuffled, and fingerprints that share one are verified. For
an odd r the half that is left over is an erased block: the bits are cut into blocks, and a variant
has (r - 1) / 2 bits flipped and one block blanked. Of the bits in which two fingerprints differ,
one lies in some block; with that block blanked at most r - 1 differ, which meet halfway. So no pair
within r is missed, for any number of blocks, and for r = 3 a fingerprint has 132 variants instead
of the 2,081 within distance 2.

Texts that repeat share one fingerprint, and only distinct fingerprints emit variants. Within a
bucket the links form a spanning forest, never all pairs: a node is compared with what is still
unconnected. A bucket holds at most as many fingerprints as its blanked bits and flips allow.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import bound_batches, fresh_name, settle
from delaycast.llm.components import components

BITS = 64
SEED = 42
# Shingles whose bits are counted at a time, and bucket sizes from which comparing changes.
COUNT_ROWS = 1 << 14
PAIRWISE, LOOK_UP = 32, 50_000


class SimHashParameters(NamedTuple):
    """``words`` a shingle, ``distance`` bits at most, ``blocks`` that an odd distance blanks in turn."""

    words: int = 3
    distance: int = 3
    blocks: int = 3


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """The fingerprint of UTF-8 text, unsigned; zero without words.

    A-Z is lower-cased, ASCII white space separates words, and a bit is set if it is set in more
    than half of the shingles' XXH64, repeats included.
    """
    found = (text or b"").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*[found[i:] for i in range(words)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNT_ROWS):
        part = hashes[at : at + COUNT_ROWS].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint_column(text: str, words: int = 3) -> Column:
    """The fingerprint of a text column as a signed long; null texts count as empty."""

    @F.arrow_udf("bigint")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = [fingerprint(v.as_py(), words) for v in batch]
            yield pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())

    return compute(F.col(f"`{text}`").cast("binary"))


def half_radius_masks(distance: int, blocks: int) -> list[tuple[np.uint64, np.uint64, np.ndarray]]:
    """(bits kept, mark, flips) for each block that is blanked; a mark sits in the blanked bits."""
    every = (1 << BITS) - 1
    if distance % 2 == 0:
        cuts = [(every, 0)]
    else:
        edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
        cuts = []
        for number, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
            blank = ((1 << (high - low)) - 1) << low
            cuts.append((every & ~blank, (number << low) & blank))
    out = []
    for kept, mark in cuts:
        free = [1 << b for b in range(BITS) if kept >> b & 1]
        flips = [sum(c) for n in range(distance // 2 + 1) for c in combinations(free, n)]
        out.append((np.uint64(kept), np.uint64(mark), np.array(flips, np.uint64)))
    return out


def _ball_masks(distance: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for n in range(1, distance + 1) for c in combinations(range(BITS), n)], np.uint64)


def forest(points: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect what is connected at ``distance`` among distinct sorted points."""
    left, right, ball = [], [], None
    rest = points
    while len(rest) > 1:
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            layer = queue.pop()
            for point in layer:
                if not len(rest):
                    break
                if len(rest) > LOOK_UP:
                    ball = _ball_masks(distance) if ball is None else ball
                    wanted = point ^ ball
                    at = np.searchsorted(rest, wanted)
                    at[at == len(rest)] = 0
                    near = np.zeros(len(rest), bool)
                    near[at[rest[at] == wanted]] = True
                else:
                    near = np.bitwise_count(rest ^ point) <= distance
                if near.any():
                    found = rest[near]
                    left.append(np.full(len(found), point))
                    right.append(found)
                    queue.append(found)
                    rest = rest[~near]
    return left, right


def bucket_links(keys: np.ndarray, points: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links inside runs of equal keys."""
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    large = sizes > PAIRWISE
    small = np.repeat(~large, sizes)
    run = np.repeat(np.arange(len(starts)), sizes)
    for step in range(1, int(sizes[~large].max(initial=1))):
        at = np.flatnonzero((run[step:] == run[:-step]) & small[step:])
        at = at[np.bitwise_count(points[at] ^ points[at + step]) <= distance]
        left.append(points[at])
        right.append(points[at + step])
    for start, size in zip(starts[large], sizes[large], strict=True):
        a, b = forest(np.unique(points[start : start + size]), distance)
        left += a
        right += b
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def near_pairs(points: DataFrame, parameters: SimHashParameters) -> DataFrame:
    """(a, b) links between distinct values of ``fp`` that connect all within the distance."""
    distance = parameters.distance
    masks = half_radius_masks(distance, parameters.blocks)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_points = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(all_points), 512):
                some = all_points[at : at + 512]
                keys = np.concatenate(
                    [(((some & kept)[:, None] ^ flips[None, :]) | mark).ravel() for kept, mark, flips in masks]
                )
                own = np.concatenate([np.repeat(some, len(flips)) for _, _, flips in masks])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(own.view(np.int64))], ["key", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, own = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(k: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
            a, b = bucket_links(k, p, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            own = np.concatenate([own, batch.column(1).to_numpy().view(np.uint64)])
            # The last run may go on in the next batch.
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if whole:
                yield links(keys[:whole], own[:whole])
                keys, own = keys[whole:], own[whole:]
        if len(keys):
            yield links(keys, own)

    variants = points.select("fp").mapInArrow(emit, "key long, fp long")
    met = variants.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(link, "a long, b long")


def simhash_components(
    df: DataFrame, parameters: SimHashParameters = SimHashParameters(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: doc_id, fp (signed long), component_id.

    component_id is the smallest id reachable over links of at most ``distance`` bits. Rows with
    equal fingerprints are linked, those without words among them. A row with a null id has the
    component of its text; ids do not have to be unique. Other columns are not looked at.
    """
    bound_batches(df.sparkSession)
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprint_column(text, parameters.words).alias("fp"))
    rows = settle(rows, "fingerprints")
    points = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "points")
    roots = components(near_pairs(points, parameters), "simhash")
    placed = points.join(roots.selectExpr("node AS fp", "root"), "fp", "left").selectExpr(
        "fp", "first_id", "coalesce(root, fp) AS root"
    )
    placed = settle(placed, "placed")
    lowest = settle(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "lowest")
    by_point = placed.join(lowest, "root").select("fp", "component_id")
    return rows.join(by_point, "fp").select("doc_id", "fp", "component_id")


def keep_one_each(
    df: DataFrame, parameters: SimHashParameters = SimHashParameters(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``df`` whose id is the smallest of its component; all columns stay.

    Repeated rows of that id all stay; rows with a null id stay only if no row of their component
    has an id.
    """
    found = simhash_components(df, parameters, doc_id, text)
    name = fresh_name(df, "kept")
    kept = found.where("doc_id <=> component_id").select(F.col("doc_id").alias(name)).distinct()
    return df.join(kept, F.col(f"`{doc_id}`").eqNullSafe(F.col(name)), "left_semi")
