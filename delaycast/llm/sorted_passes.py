"""Near-duplicate vectors by sorted projection passes.

A pass concatenates the signs of random projections to a hash and orders the vectors of a label by
it, so that close vectors tend to stand close together. Every vector is compared with a bounded window
of its neighbours, and links at or above the threshold are kept. With other projections other
neighbours meet, and the links of all passes are united.

The projections go through the mean direction of all vectors of the label. How many passes a label gets
follows from its row count n and its spread around the mean: to share a window, about log2(n / window)
signs have to agree, and the spread tells with what chance a sign of a pair at the threshold does. The
passes suffice for such a pair to be missed with probability ``miss``; ``passes`` is the least. Where
windows would compare as much as comparing all pairs, all pairs are compared, in blocks. A hash has a few
bits more than cut n vectors to windows if the cuts are even. Vectors that tie on it in a run longer than
the window, as a cluster does, are a group of their own: with their own mean and further bits, and
further passes if their spread asks for them, until no such run is left. Only runs so
narrow that all their vectors must link stay as they are. Windows reach over the borders of partitions.

The chance assumes that vectors lie around the mean evenly. It is a model and no guarantee: pairs of a
cluster can part on the bits that come before the cluster is a group of its own.

Equal vectors are taken together first. The orders move no vectors but sketches of them: the signs of
``SKETCH_BITS`` further projections through the label's mean, and the distance from it. From two distances
follows the widest angle at the mean that vectors of a link can have, and from that how many bits differ at
most; the limit lies five standard deviations above what the angle lets expect, so a link at the threshold is
passed over in less than one of a million cases. What a window's near sketches connect is a group, of two windows
at most. Equal groups of several passes are taken once, their vectors are fetched by id and compared exactly.
The links that a group hands on form a spanning forest, so m vectors hand on m links and not m * m. All links lie inside the
components that the passes unite; how many a vector has is then counted exactly within its component,
in blocks, whether or not a pass had compared the two.

Rows are told the result of their vector by 128 bits of hashes of it, so vectors move no further time. Two of
n different vectors of a label share them with a chance of about n * n / 2^129.

Vectors link only within a label and a dimension. Rows with a null label or id, and vectors that are
null, empty, zero or hold null or non-finite components, link with nothing. Repeated rows count as
further vectors; vectors that share an id share a component. Columns beside the three are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import bound_batches, settle
from delaycast.llm.components import components

# Most bits that a pass adds at a time, and by how many they exceed log2(n / window).
HASH_BITS, SPARE_BITS = 32, 2
# Bits of a sketch, and by how many standard deviations more than expected may differ.
SKETCH_BITS, DEVIATIONS = 256, 5
# Vectors in a block where all pairs are compared, and in the smallest that a component is cut into.
COUNT_BLOCK, LEAST_BLOCK = 1024, 64
GROUP = ["label", "dim", "path"]
# Two hashes of a vector with different seeds.
VECTOR_KEYS = ["key_a", "key_b"]


class PassParameters(NamedTuple):
    """Cosine from which vectors link; least passes; neighbours on either side (``window`` to twice as many);
    chance to miss a pair at the threshold, from which further passes follow."""

    cosine: float = 0.98
    passes: int = 12
    window: int = 256
    seed: int = 20
    miss: float = 0.001


@lru_cache(maxsize=256)
def projections(dimension: int, seed: int, level: int, number: int) -> np.ndarray:
    """Random directions for the bits of one pass; the same everywhere."""
    return np.random.default_rng([seed, dimension, level, number]).normal(size=(dimension, HASH_BITS))


def pass_hashes(centred: np.ndarray, seed: int, level: int, number: int) -> np.ndarray:
    """One hash for each vector, its first projection in the highest bit."""
    signs = (centred @ projections(centred.shape[1], seed, level, number)) > 0
    return signs @ (1 << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64))


def directions(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of a and b have at least that cosine."""
    norms = np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))[None, :]
    return (a @ b.T) / norms >= cosine


def link_forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a square matrix."""
    left, out = np.ones(len(links), bool), []
    for start in np.flatnonzero(links.sum(axis=1) > 1):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(links[at] & left)
            left[found] = False
            out += [(at, int(f)) for f in found]
            queue += found.tolist()
    return out


@lru_cache(maxsize=64)
def sketch_projections(dimension: int, seed: int) -> np.ndarray:
    """Random directions for the bits of a sketch, other ones than those of the passes."""
    return np.random.default_rng([seed, dimension, 0, 0, SKETCH_BITS]).normal(size=(dimension, SKETCH_BITS))


def sketches(centred: np.ndarray, seed: int) -> list[bytes]:
    signs = (centred @ sketch_projections(centred.shape[1], seed)) > 0
    return [row.tobytes() for row in np.packbits(signs, axis=1)]


def bits_apart(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Most bits in which sketches at these distances from the mean differ if their vectors link."""
    turn = (a * a + b * b - 2 * (1 - cosine)) / np.maximum(2 * a * b, 1e-30)
    share = np.arccos(np.clip(turn, -1, 1)) / np.pi
    mean = SKETCH_BITS * share
    return np.where(share < 0.5, mean + DEVIATIONS * np.sqrt(mean * (1 - share) + 1), SKETCH_BITS)


def near_sketches(words: np.ndarray, radii: np.ndarray, known: int, cosine: float) -> np.ndarray:
    """Square matrix of the sketches that may belong to a link; the first ``known`` met each other before."""
    apart = np.zeros((len(words) - known, len(words)), np.uint16)
    for word in words.T:
        apart += np.bitwise_count(word[known:, None] ^ word[None, :])
    least = radii.min(keepdims=True)  # no distance allows more bits than the smallest
    first, second = np.nonzero(apart <= bits_apart(least, least, cosine))
    fits = apart[first, second] <= bits_apart(radii[first + known], radii[second], cosine)
    near = np.zeros((len(words), len(words)), bool)
    near[first[fits] + known, second[fits]] = True
    np.fill_diagonal(near, False)
    return near | near.T


def sketch_groups(ids: np.ndarray, near: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted ids of every group of two or more that near sketches connect."""
    left = near.any(axis=1)
    while left.any():
        group, found = np.zeros(len(near), bool), np.zeros(len(near), bool)
        found[left.argmax()] = True
        while found.any():
            group |= found
            found = near[found].any(axis=0) & ~group
        left &= ~group
        members = np.unique(ids[group])
        if len(members) > 1:
            yield members


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys of a sorted stream, in pieces that end where a batch ends."""
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        starts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            yield batch.slice(a, b - a)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """All rows with equal keys of a sorted stream, as one batch."""
    held, parts = None, []
    for part in groups(batches, keys):
        key = tuple(part.column(c)[0].as_py() for c in keys)
        if key != held and parts:
            yield pa.concat_batches(parts)
            parts = []
        held = key
        parts.append(part)
    if parts:
        yield pa.concat_batches(parts)


def group_means(rows: DataFrame) -> DataFrame:
    """(label, dim, path, n, centre): the mean direction of each group of rows, from all of them."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups([batch], ["dim"]):
                index: dict = {}
                keys = zip(*(part.column(c).to_pylist() for c in GROUP), strict=True)
                numbers = [index.setdefault(k, len(index)) for k in keys]
                total = np.zeros((len(index), part.column("dim")[0].as_py()))
                np.add.at(total, numbers, directions(matrix(part.column("vector"))))
                columns = [pa.array(c, part.schema.field(n).type) for n, c in zip(GROUP, zip(*index, strict=True), strict=True)]
                columns += [pa.array(np.bincount(numbers)), pa.array(list(total), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, [*GROUP, "n", "sums"])

    label = rows.schema["label"].dataType.simpleString()
    partial = rows.select(*GROUP, "vector").mapInArrow(sums, f"label {label}, dim int, path binary, n long, sums array<double>")
    places = partial.select(*GROUP, "n", F.posexplode("sums").alias("place", "x"))
    means = places.groupBy(*GROUP, "place").agg(F.sum("n").alias("n"), (F.sum("x") / F.sum("n")).alias("x"))
    means = means.groupBy(*GROUP).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "x"))).alias("c"))
    return means.selectExpr(*GROUP, "n", "transform(c, p -> p.x) AS centre")


def with_passes(means: DataFrame, level: int, parameters: PassParameters) -> DataFrame:
    """Adds ``passes``, after which a pair at the threshold is missed with chance ``miss``; 0 where all pairs are to be compared.

    The spread is the mean squared distance of the group's directions from their mean.
    """
    window, least = parameters.window, parameters.passes
    steps = {
        "spread": "greatest(1 - aggregate(centre, 0D, (s, x) -> s + x * x), 1e-12)",
        "agree": f"1 - acos(greatest(0D, least(1D, 1 - {1 - parameters.cosine!r}D / spread))) / pi()",
        "meet": f"power(agree, log2(n / {window}D))",
        "needed": f"CASE WHEN n <= {window} OR meet >= 1 - 1e-12 THEN 1L "
        f"ELSE greatest(1L, ceil({math.log(parameters.miss)!r}D / log1p(-meet))) END",
        "least": f"IF(n > {window}, {least}L, 1L)",
    }
    if level:  # other passes have such runs, too; a quarter of them is taken to hold a pair together
        steps |= {"needed": f"({steps['needed']})", "least": "1L"}
        steps["needed"] = f"ceil(4 * {steps['needed']} / {least}D)"
    steps["passes"] = f"int(IF(needed > least AND needed * {2 * window} >= n, 0L, greatest(least, needed)))"
    steps["bits"] = f"int(least({HASH_BITS}, {SPARE_BITS} + greatest(1, ceil(log2(n / {window}D)))))"
    out = means
    for name, step in steps.items():
        out = out.withColumn(name, F.expr(step))
    return out.select(*means.columns, "passes", "bits")


def deal(rows: DataFrame, level: int, parameters: PassParameters) -> DataFrame:
    """Rows (label, dim, path, id, vector, centre, passes, bits) once for each pass, which ``path`` goes on with.

    The first level adds sketch and radius, the distance from the label's mean; others hand them on.
    """
    kept = ["id", "vector", "sketch", "radius"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, ["dim"]):
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                centred = directions(matrix(part.column("vector"))) - matrix(part.column("centre"))
                if not level:
                    part = part.append_column("sketch", pa.array(sketches(centred, parameters.seed), pa.binary()))
                    part = part.append_column("radius", pa.array(np.sqrt((centred * centred).sum(axis=1))))
                passes = part.column("passes").to_numpy()
                unused = HASH_BITS - part.column("bits").to_numpy().astype(np.int64)
                for number in range(passes.max()):
                    some = np.flatnonzero(passes > number)
                    hashes = pass_hashes(centred[some], parameters.seed, level, number)
                    hashes = (hashes >> unused[some] << unused[some]).tolist()
                    taken, start = part.take(pa.array(some)), number.to_bytes(4)
                    paths = [p + start + h.to_bytes(HASH_BITS // 8) for p, h in zip(taken.column("path").to_pylist(), hashes, strict=True)]
                    columns = [taken.column("label"), taken.column("dim"), pa.array(paths, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*columns, *(taken.column(c) for c in kept)], [*GROUP, *kept])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("label", "vector")}
    known = kept if level else kept[:2]
    return rows.select(*GROUP, *known, "centre", "passes", "bits").mapInArrow(
        spread, f"label {kinds['label']}, dim int, path binary, id long, vector {kinds['vector']}, sketch binary, radius double"
    )


def pass_orders(vectors: DataFrame, parameters: PassParameters) -> tuple[DataFrame, list[DataFrame]]:
    """Sketches in the orders of the passes, by ``path``; and groups of vectors in which all pairs are to be compared."""
    ordered = [*GROUP, "id", "sketch", "radius"]
    rows = vectors.select("label", "dim", F.expr("X''").alias("path"), "id", "vector")
    means, level, done, whole = group_means(rows), 0, None, []
    while True:
        means = settle(with_passes(means, level, parameters), "pass_groups")
        if means.where("passes = 0").limit(1).count():
            whole.append(rows.join(means.where("passes = 0").select(*GROUP, "n"), GROUP))
        dealt = deal(rows.join(means.where("passes > 0"), GROUP), level, parameters)
        runs = dealt.groupBy(*GROUP).agg(F.count("*").alias("n")).where(f"n > {parameters.window}")
        runs = settle(runs.select(*GROUP), "tie_runs")
        if not runs.limit(1).count():
            last = dealt.select(*ordered)
            return last if done is None else done.unionByName(last), whole
        tied = settle(dealt.join(runs, GROUP), "tied")
        # All directions of n stand within sqrt(n * spread) of their mean: below this bound all of them link.
        narrow = f"n * (1 - aggregate(centre, 0D, (s, x) -> s + x * x)) <= greatest({(1 - parameters.cosine) / 2!r}D, n * 1e-12D)"
        means = settle(group_means(tied).where(f"NOT ({narrow})"), "tie_means")
        rows, level = tied, level + 1
        left = dealt.select(*ordered).join(means.select(*GROUP), GROUP, "left_anti")
        done = left if done is None else done.unionByName(left)
        rows = rows.join(means.select(*GROUP), GROUP, "left_semi")


def whole_links(rows: DataFrame, cosine: float) -> DataFrame:
    """(a, b): links that connect what links in each group (label, dim, path, n), all pairs by blocks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in whole_groups(batches, [*GROUP, "first", "second"]):
            vectors = matrix(block.column("vector"))
            yield pairs(block.column("id").to_numpy(), link_forest(linked(vectors, vectors, cosine)))

    placed = rows.withColumn("blocks", F.expr(f"int(ceil(n / {COUNT_BLOCK}D))"))
    placed = placed.withColumn("block", F.expr("int(pmod(xxhash64(id, vector), blocks))"))
    met = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).selectExpr(
        *GROUP, "least(block, other) AS first", "greatest(block, other) AS second", "id", "vector"
    )
    keys = [*GROUP, "first", "second"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long")


def pairs(ids: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array(ids[[f[side] for f in found]] if found else [], pa.int64()) for side in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def words_of(column: pa.Array) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def group_rows(found: list[np.ndarray], label: pa.Scalar, dim: int) -> pa.RecordBatch:
    """(label, dim, key, ids) of groups; equal groups have equal keys."""
    keys = [blake2b(g.tobytes(), digest_size=16).digest() for g in found]
    labels = pa.array([label.as_py()] * len(found), label.type)
    columns = [labels, pa.array([dim] * len(found), pa.int32()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["label", "dim", "key", "ids"])


def border_groups(compared: DataFrame, parameters: PassParameters) -> DataFrame:
    """(label, dim, key, ids): groups from the last window of a partition and the first of what follows it."""
    ends = compared.where("tail").groupBy("part").agg(F.max("at").alias("at")).collect()  # one row a partition
    sizes = sorted((r["part"], r["at"] + 1) for r in ends)
    reach = []
    for i, (border, _) in enumerate(sizes):
        offset = 0
        for part, size in sizes[i + 1 :]:
            if offset >= parameters.window:
                break
            reach.append((part, offset, border))
            offset += size
    reached = compared.sparkSession.createDataFrame(reach, "part int, offset long, border int")
    heads = compared.where("NOT tail").join(F.broadcast(reached), "part").where(f"at + offset < {parameters.window}")
    columns = ["border", "label", "dim", "side", "id", "sketch", "radius"]
    both = heads.withColumn("side", F.lit(1)).select(*columns).unionByName(
        compared.where("tail").selectExpr("part AS border", "0 AS side", "*").select(*columns)
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in whole_groups(batches, ["border", "label", "dim"]):
            ids, words, radii = (block.column("id").to_numpy(), words_of(block.column("sketch")), block.column("radius").to_numpy())
            before = int((block.column("side").to_numpy() == 0).sum())
            if 0 < before < len(ids):
                found = list(sketch_groups(ids, near_sketches(words, radii, before, parameters.cosine)))
                yield group_rows(found, block.column("label")[0], block.column("dim")[0].as_py())

    order = ["border", "label", "dim", "side"]
    label = compared.schema["label"].dataType.simpleString()
    return both.repartition("border").sortWithinPartitions(*order).mapInArrow(
        compare, f"label {label}, dim int, key binary, ids array<long>"
    )


def window_groups(ordered: DataFrame, parameters: PassParameters) -> DataFrame:
    """(label, dim, key, ids): the groups of all windows of the orders, each once, also over partitions' borders."""
    cosine, window = parameters.cosine, parameters.window

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, known = None, 0
        ids, words, radii = np.zeros(0, np.int64), np.zeros((0, SKETCH_BITS // 64), np.uint64), np.zeros(0)
        number, at, tail = TaskContext.get().partitionId(), 0, []
        names = ["label", "dim", "key", "ids", "part", "at", "tail", "id", "sketch", "radius"]

        def met(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, words, radii, known
            while len(ids) - known >= (1 if final else window):
                size = min(len(ids), known + window)
                near = near_sketches(words[:size], radii[:size], known, cosine)
                found = group_rows(list(sketch_groups(ids[:size], near)), *group)
                kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.float64()]
                yield pa.RecordBatch.from_arrays([*found.columns, *(pa.nulls(found.num_rows, k) for k in kinds)], names)
                ids, words, radii = ids[known:], words[known:], radii[known:]
                known = size - known

        def border(batch: pa.RecordBatch, first: int, last: bool) -> pa.RecordBatch:
            n = batch.num_rows
            columns = [batch.column("label"), batch.column("dim"), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64()))]
            columns += [pa.array([number] * n, pa.int32()), pa.array(range(first, first + n), pa.int64()), pa.array([last] * n)]
            return pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in names[7:])], names)

        for batch in batches:
            if at < window:
                yield border(batch.slice(0, window - at), at, False)
            at += batch.num_rows
            tail.append(batch)
            while sum(b.num_rows for b in tail[1:]) >= window:
                tail.pop(0)
            for part in groups([batch], ["label", "dim"]):
                key = (part.column("label")[0], part.column("dim")[0].as_py())
                if key != group:
                    yield from met(True)
                    group, known = key, 0
                    ids, words, radii = ids[:0], words[:0], radii[:0]
                ids = np.concatenate([ids, part.column("id").to_numpy()])
                words = np.concatenate([words, words_of(part.column("sketch"))])
                radii = np.concatenate([radii, part.column("radius").to_numpy()])
                yield from met(False)
        yield from met(True)
        first = at - sum(b.num_rows for b in tail)
        for batch in tail:
            skipped = min(batch.num_rows, max(0, at - window - first))
            yield border(batch.slice(skipped), first + skipped, True)
            first += batch.num_rows

    label = ordered.schema["label"].dataType.simpleString()
    order, result = [*GROUP, "id"], ["label", "dim", "key", "ids"]
    compared = ordered.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        compare,
        f"label {label}, dim int, key binary, ids array<long>, part int, at long, tail boolean, id long, sketch binary, radius double",
    )
    compared = settle(compared, "compared")
    found = compared.where("part IS NULL").select(*result).unionByName(border_groups(compared, parameters))
    return found.groupBy(*result[:3]).agg(F.first("ids").alias("ids"))


def pass_links(vectors: DataFrame, parameters: PassParameters) -> DataFrame:
    """(a, b): links that connect what the passes' windows link, of vectors (id, label, dim, vector)."""
    ordered, whole = pass_orders(vectors, parameters)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in whole_groups(batches, ["label", "dim", "key"]):
            rows = matrix(block.column("vector"))
            yield pairs(block.column("id").to_numpy(), link_forest(linked(rows, rows, parameters.cosine)))

    members = window_groups(ordered, parameters).select("label", "dim", "key", F.explode("ids").alias("id"))
    fetched = members.join(vectors.select("label", "dim", "id", "vector"), ["label", "dim", "id"])
    order = ["label", "dim", "key"]
    found = fetched.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "a long, b long")
    for rows in whole:
        found = found.unionByName(whole_links(rows, parameters.cosine))
    return found


def _count_in_blocks(cosine: float) -> Callable:
    """Counts links in pairs of blocks; rows come sorted by component, pair of blocks and side."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, parts = ["root", "dim", "first", "second"], None, []

        def counted() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            block = pa.Table.from_batches(parts).combine_chunks()
            rows, side = matrix(block.column("vector").chunk(0)), block.column("side").to_numpy()
            copies, ids = block.column("copies").to_numpy(), block.column("id").to_numpy()
            sums = np.zeros(len(ids), np.int64)
            own, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if held[2] == held[3]:  # a block with itself
                hits = linked(rows, rows, cosine)
                np.fill_diagonal(hits, False)
                sums = hits @ copies
            else:
                hits = linked(rows[own], rows[other], cosine)
                sums[own], sums[other] = hits @ copies[other], copies[own] @ hits
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums, pa.int64())], ["id", "n"])

        for part in groups(batches, keys):
            key = tuple(part.column(c)[0].as_py() for c in keys)
            if key != held:
                yield from counted()
                held, parts = key, []
            parts.append(part)
        yield from counted()

    return count


def link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """(id, n): vectors linked to each member (id, root, dim, copies, vector), all pairs of a component by blocks.

    A block holds a partition's share of the members within the two bounds, so that one component's pairs of
    blocks spread over the tasks however few vectors there are.
    """
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = min(COUNT_BLOCK, max(LEAST_BLOCK, members.count() // tasks))
    sizes = members.groupBy("root", "dim").agg(F.count("*").alias("size")).where("size > 1")
    sizes = settle(sizes, "component_sizes")
    placed = members.join(sizes, ["root", "dim"]).withColumn("blocks", F.expr(f"int(ceil(size / {block}D))"))
    placed = placed.withColumn("block", F.expr("int(pmod(xxhash64(id), blocks))"))
    met = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).selectExpr(
        "root", "dim", "least(block, other) AS first", "greatest(block, other) AS second",
        "int(block > other) AS side", "id", "copies", "vector",
    )
    keys = ["root", "dim", "first", "second"]
    sums = met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_count_in_blocks(cosine), "id long, n long")
    return sums.groupBy("id").agg(F.sum("n").alias("n"))


def near_vectors(
    df: DataFrame,
    parameters: PassParameters = PassParameters(),
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    ``component_id`` is the smallest id reachable by links. A row with a null id has a null component
    and is kept.
    """
    bound_batches(df.sparkSession)
    rows = df.select(
        F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{embedding}`").alias("vector")
    )
    finite = "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    usable = f"id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND {finite} AND exists(vector, x -> x <> 0)"
    rows = rows.withColumn("usable", F.coalesce(F.expr(usable), F.lit(False)))
    distinct = rows.where("usable").groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    vector_keys = [F.expr("xxhash64(vector)").alias(VECTOR_KEYS[0]), F.expr("xxhash64(1, vector)").alias(VECTOR_KEYS[1])]
    distinct = settle(distinct.select("id", "label", F.expr("size(vector) AS dim"), "copies", "vector", *vector_keys), "vectors")
    roots = components(pass_links(distinct, parameters), "vectors")
    members = settle(
        distinct.join(roots.selectExpr("node AS id", "root"), "id").select("id", "root", "dim", "copies", "vector"), "members"
    )
    counts = link_counts(members, parameters.cosine)
    known = distinct.select("id", "label", "copies", *VECTOR_KEYS).join(counts, "id", "left").join(
        roots.selectExpr("node AS id", "root"), "id", "left"
    )
    known = settle(
        known.selectExpr("label", *VECTOR_KEYS, "coalesce(root, id) AS root", "coalesce(n, 0L) + copies - 1 AS links"), "linked"
    )
    told = rows.where("usable").select("id", "label", *vector_keys)
    placed = told.join(known, ["label", *VECTOR_KEYS]).selectExpr("id", "links", "root")
    single = rows.where("NOT usable").selectExpr("id", "0L AS links", "id AS root")
    return placed.unionByName(single).selectExpr(
        "id AS vec_id", "links AS n_links", "root AS component_id", "id <=> root AS kept"
    )


def oracle(cosine: float) -> str:
    """SQL for the result over ``embeddings``, comparing all pairs of a label; ids must be unique."""
    return f"""
    WITH RECURSIVE parts AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
    norms AS (SELECT vec_id, sqrt(sum(x * x)) AS norm FROM parts GROUP BY vec_id
        HAVING count(*) = count(CASE WHEN isfinite(x) THEN 1 END) AND count(CASE WHEN x <> 0 THEN 1 END) > 0),
    sized AS (SELECT e.vec_id, e.label, CAST(e.embedding AS DOUBLE[]) AS v, n.norm
        FROM embeddings e JOIN norms n ON e.vec_id = n.vec_id WHERE e.label IS NOT NULL),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.v) = len(b.v) WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= {cosine}),
    reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
    lowest AS (SELECT a, min(b) AS low FROM reached GROUP BY a)
    SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.low AS component_id, e.vec_id = l.low AS kept
    FROM embeddings e JOIN lowest l ON e.vec_id = l.a LEFT JOIN counts c ON e.vec_id = c.a"""
