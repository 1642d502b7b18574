"""Hard negatives by score bounds along spanning trees of the anchors.

Anchors are put in groups, and each group gets a minimum spanning tree. Every task scores the root
of a tree against its candidates exactly. From parent to child the score of a candidate can change
by no more than the length of the edge times the candidate's norm, so the parent's score, or the
parent's bounds, plus or minus that product bound the child's. Only candidates whose bounds overlap
the window in which a score can still count are scored again; the others pass their bounds on.

The window of an anchor's positives is all that reaches the least of the best it has found. The
windows of its negatives are ``low`` to ``high`` hundredths of its positives' scores, from below
raised to the least of the best found within. Negatives need the positives of all rows, so the
candidates are read twice. They stay where they are: a round sends one bounded block of trees to
the tasks, and each task returns at most its best rows for an anchor and positive.

Rows: those with a null id or label, a null vector, or a component that is null or not finite take
no part. Vectors of unequal length count as ended by zeros, an empty one as zero. Ties go to the
smaller id. Of several rows with one id the best score in a list counts, and an anchor's row is the
one with the smallest label, then vector. Empty tables, anchors without positives and positives
without negatives give no rows. Columns other than those named are not read. Scores are exact
integers; a vector whose scaled squares sum to 2^63 or more is an error, since its scores fit in no
64-bit number.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaycast.llm.common import bound_batches, settle

# Candidates that a task bounds at a time, and anchors of a tree. Both together limit the bounds
# that a task holds to 64 MB, in a tree whose every node has a child.
BLOCK_ROWS, TREE_ANCHORS = 4096, 1024
EXACT = float(1 << 53)

POSITIVE_TYPE = "anchor_id bigint, positive_id bigint, positive_score bigint"
NEGATIVE_TYPE = f"{POSITIVE_TYPE}, negative_id bigint, negative_score bigint"


@dataclass(frozen=True)
class MiningParameters:
    """How many positives and negatives, the window in hundredths, and the anchors of one round."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    round_anchors: int = 16_384


@dataclass
class Tree:
    """Anchors in the order of their tree: a row's parent comes before it, with the edge's length."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray


def scaled_vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """A mask of the usable rows, and their floored multiples as whole floats, ended by zeros."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    inside = np.arange(lengths.max(initial=0)) < lengths[:, None]
    rows = np.zeros(inside.shape)
    rows[inside] = values
    rows = np.floor(scale * rows[usable])
    if not (np.einsum("ij,ij->i", rows, rows) < float(1 << 63)).all():
        raise ValueError("a vector's scores do not fit in 64 bits")
    return usable, rows


def fitted(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows cut or ended by zeros to ``width`` components."""
    return np.ascontiguousarray(np.pad(rows[:, :width], ((0, 0), (0, max(0, width - rows.shape[1])))))


def usable_rows(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and scaled vectors of the usable rows of (id, label, vector), by batch."""
    for batch in batches:
        usable, rows = scaled_vectors(batch.column(2), scale)
        ids, labels = (pc.fill_null(batch.column(at), 0).to_numpy(zero_copy_only=False) for at in (0, 1))
        for at in (0, 1):
            usable_here = batch.column(at).is_valid().to_numpy(zero_copy_only=False)[usable]
            rows, usable[usable] = rows[usable_here], usable_here
        if len(rows):
            yield ids[usable], labels[usable], rows


def blocks(batches: Iterator[pa.RecordBatch], scale: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The usable rows in blocks of about ``BLOCK_ROWS``, all of one width."""
    held: list[tuple] = []
    for ids, labels, rows in usable_rows(batches, scale):
        held.append((ids, labels, fitted(rows, width)))
        if sum(len(part[0]) for part in held) >= BLOCK_ROWS:
            yield tuple(np.concatenate(parts) for parts in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(parts) for parts in zip(*held))


def spanning_tree(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    """The minimum spanning tree from the anchor nearest to the mean, in the order in which anchors join it."""
    count = len(ids)
    squares = np.einsum("ij,ij->i", vectors, vectors)
    nearest, parent, place = np.full(count, np.inf), np.full(count, -1), np.zeros(count, np.int64)
    outside, order = np.ones(count, bool), []
    at = int(np.argmin(squares - 2 * (vectors @ vectors.mean(axis=0))))
    while True:
        place[at], outside[at] = len(order), False
        order.append(at)
        if len(order) == count:
            break
        apart = squares + squares[at] - 2 * (vectors @ vectors[at])
        closer = outside & (apart < nearest)
        nearest[closer], parent[closer] = apart[closer], at
        at = int(np.argmin(np.where(outside, nearest, np.inf)))
    ordered, parents = vectors[order], np.where(parent[order] < 0, -1, place[parent[order]])
    edges = np.zeros(count)
    edges[1:] = np.linalg.norm(ordered[1:] - ordered[parents[1:]], axis=1)
    return Tree(ids[order], labels[order], ordered, parents, edges)


def near_groups(vectors: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Rows in groups of at most ``TREE_ANCHORS``, halved along the direction in which they spread most."""
    if len(rows) <= TREE_ANCHORS:
        return [rows]
    spread = vectors[rows] - vectors[rows].mean(axis=0)
    direction = np.ones(vectors.shape[1])
    for _ in range(8):
        direction = spread.T @ (spread @ direction)
        direction /= np.linalg.norm(direction) or 1.0
    order = np.argsort(spread @ direction, kind="stable")
    half = len(rows) // 2
    return near_groups(vectors, rows[order[:half]]) + near_groups(vectors, rows[order[half:]])


def sweep(
    tree: Tree,
    rows: np.ndarray,
    wanted: Callable[[int], tuple[np.ndarray, float, float] | None],
    found: Callable[[int, np.ndarray, np.ndarray], None],
) -> int:
    """Bound the scores of a block down a tree and rescore what overlaps; the number of rows rescored.

    ``wanted(k)`` gives the rows that anchor k may take and the window of scores that count, or
    None; ``found(k, at, scores)`` gets the places and exact scores of all rows that may lie in it.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    sizes = np.sqrt(np.einsum("ij,ij->i", tree.vectors, tree.vectors))
    exact_floats = norms.max(initial=0) * sizes.max(initial=0) < EXACT
    children = np.bincount(tree.parents[1:], minlength=len(sizes))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    whole = None if exact_floats else rows.astype(np.int64)
    scored = 0
    for k, parent in enumerate(tree.parents.tolist()):
        need = wanted(k)
        if parent < 0:
            low = high = None
            at = np.arange(len(rows))
        else:
            low, high = bounds[parent]
            # The slack covers rounding of the edge, of the product and of scores beyond 2^53.
            width = norms * (tree.edges[k] * (1 + 1e-9) + 1e-12 * sizes[k]) + 1
            low, high = low - width, high + width
            children[parent] -= 1
            if not children[parent]:
                del bounds[parent]
            at = np.flatnonzero(need[0] & (high >= need[1]) & (low <= need[2])) if need else np.zeros(0, np.int64)
        vector = tree.vectors[k]
        if not exact_floats:
            scores = whole[at] @ vector.astype(np.int64)
        elif 2 * len(at) > len(rows):
            scores = (rows @ vector)[at].astype(np.int64)
        else:
            scores = (rows[at] @ vector).astype(np.int64)
        scored += len(at)
        if low is None:
            low, high = scores.astype(float), scores.astype(float)
        else:
            low[at] = high[at] = scores
        if children[k]:
            bounds[k] = low, high
        if need:
            inside = need[0][at] & (scores >= need[1]) & (scores <= need[2])
            found(k, at[inside], scores[inside])
    return scored


class Best:
    """The best ``size`` scores with distinct ids, ties to the smaller id."""

    def __init__(self, size: int, low: float = -np.inf, high: float = np.inf) -> None:
        self.size, self.low, self.high = size, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        if not inside.any():
            return
        ids, scores = np.concatenate([self.ids, ids[inside]]), np.concatenate([self.scores, scores[inside]])
        taken, seen = [], set()
        for at in np.lexsort((ids, -scores)).tolist():
            if ids[at] not in seen:
                seen.add(ids[at])
                taken.append(at)
                if len(taken) == self.size:
                    self.low = scores[at]
                    break
        self.ids, self.scores = ids[taken], scores[taken]


def _record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    columns = [pa.array([row[at] for row in rows], pa.int64()) for at in range(len(names))]
    return pa.RecordBatch.from_arrays(columns, names)


def best_positives(
    batches: Iterator[pa.RecordBatch], trees: list[Tree], parameters: MiningParameters
) -> Iterator[pa.RecordBatch]:
    """The task's best rows of each anchor's label."""
    best = [[Best(parameters.positives) for _ in tree.ids] for tree in trees]
    for ids, labels, rows in blocks(batches, parameters.scale, trees[0].vectors.shape[1]):
        for tree, lists in zip(trees, best):

            def wanted(k):
                return (labels == tree.labels[k]) & (ids != tree.ids[k]), lists[k].low, np.inf

            sweep(tree, rows, wanted, lambda k, at, scores: lists[k].add(ids[at], scores))
    for tree, lists in zip(trees, best):
        out = [(a, i, s) for a, b in zip(tree.ids.tolist(), lists) for i, s in zip(b.ids.tolist(), b.scores.tolist())]
        yield _record(out, POSITIVE_TYPE)


def best_negatives(
    batches: Iterator[pa.RecordBatch],
    trees: list[Tree],
    positives: dict[int, list[tuple[int, int]]],
    parameters: MiningParameters,
) -> Iterator[pa.RecordBatch]:
    """The task's best rows of other labels within the window of each anchor's positives."""
    best = []
    for tree in trees:
        lists = []
        for anchor in tree.ids.tolist():
            windows = [(-(-parameters.low * s // 100), parameters.high * s // 100) for _, s in positives.get(anchor, [])]
            lists.append([Best(parameters.negatives, low, high) if low <= high else None for low, high in windows])
        best.append(lists)
    for ids, labels, rows in blocks(batches, parameters.scale, trees[0].vectors.shape[1]):
        for tree, lists in zip(trees, best):

            def wanted(k):
                open_lists = [b for b in lists[k] if b is not None]
                if not open_lists:
                    return None
                return labels != tree.labels[k], min(b.low for b in open_lists), max(b.high for b in open_lists)

            def found(k, at, scores):
                for b in lists[k]:
                    if b is not None:
                        b.add(ids[at], scores)

            sweep(tree, rows, wanted, found)
    for tree, lists in zip(trees, best):
        out = []
        for anchor, found_lists in zip(tree.ids.tolist(), lists):
            for (positive, score), b in zip(positives.get(anchor, []), found_lists):
                if b is not None:
                    out += [(anchor, positive, score, i, s) for i, s in zip(b.ids.tolist(), b.scores.tolist())]
        yield _record(out, NEGATIVE_TYPE)


def grow_trees(anchors: DataFrame, scale: int) -> list[Tree]:
    """The spanning trees of one round's anchors (id, label, vector), grown in one task; all of one width."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(usable_rows(batches, scale))
        if not parts:
            return
        width = max(rows.shape[1] for _, _, rows in parts)
        ids, labels, rows = (np.concatenate(c) for c in zip(*((i, label, fitted(r, width)) for i, label, r in parts)))
        order = np.argsort(ids, kind="stable")
        for group in near_groups(rows, order):
            tree = pickle.dumps(spanning_tree(ids[group], labels[group], rows[group]), protocol=5)
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.binary())], ["tree"])

    grown = anchors.repartition(1).mapInArrow(grow, "tree binary").collect()
    return [pickle.loads(row.tree) for row in grown]


def _first(found: DataFrame, keys: list[str], found_id: str, score: str, size: int) -> DataFrame:
    """The first ``size`` rows of each key with their ``rank``; of an id's rows the best score."""
    distinct = found.groupBy(*keys, found_id).agg(F.max(score).alias(score))
    ranked = Window.partitionBy(*keys).orderBy(F.col(score).desc(), found_id)
    return distinct.withColumn("rank", F.row_number().over(ranked)).where(f"rank <= {size}")


def mine_negatives(
    vectors: DataFrame,
    anchors: str,
    parameters: MiningParameters = MiningParameters(),
    row_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """Hard negatives of the rows for which the SQL condition ``anchors`` holds, against all rows.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Anchors go
    through in rounds of about ``round_anchors`` by a hash of the id; a round's trees and positives
    pass the driver, so this parameter bounds them.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    columns = [F.col(f"`{row_id}`").cast("long"), F.col(f"`{label}`").cast("long"), F.col(f"`{vector}`")]
    rows = vectors.select(*(c.alias(name) for c, name in zip(columns, ("row_id", "row_label", "row_vector"))))
    chosen = vectors.where(anchors).select(*(c.alias(name) for c, name in zip(columns, rows.columns)))
    chosen = chosen.where("row_id IS NOT NULL AND row_label IS NOT NULL AND row_vector IS NOT NULL")
    finite = "NOT exists(row_vector, x -> x IS NULL OR isnan(x) OR abs(CAST(x AS double)) = double('infinity'))"
    one_each = chosen.where(finite).groupBy("row_id").agg(F.min(F.struct("row_label", "row_vector")).alias("one"))
    one_each = settle(one_each.select("row_id", "one.*"), "anchors")
    rounds = -(-one_each.count() // parameters.round_anchors)
    mined = [
        _mine_round(rows, one_each.where(f"pmod(xxhash64(row_id), {rounds}) = {r}"), parameters) for r in range(rounds)
    ]
    if len(mined) > 1:
        mined = [settle(part, "negatives") for part in mined]
    if not mined:
        return spark.createDataFrame([], f"{POSITIVE_TYPE}, rank int, negative_id bigint, negative_score bigint")
    result = mined[0]
    for part in mined[1:]:
        result = result.unionByName(part)
    return result


def _mine_round(rows: DataFrame, anchors: DataFrame, parameters: MiningParameters) -> DataFrame:
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(grow_trees(anchors, parameters.scale))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return best_positives(batches, shared.value, parameters) if shared.value else iter(())

    found = rows.mapInArrow(first_pass, POSITIVE_TYPE)
    found = _first(found, ["anchor_id"], "positive_id", "positive_score", parameters.positives)
    listed: dict[int, list[tuple[int, int]]] = {}
    for row in found.collect():  # at most ``positives`` for each anchor of the round
        listed.setdefault(row.anchor_id, []).append((row.positive_id, row.positive_score))
    known = context.broadcast(listed)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return best_negatives(batches, shared.value, known.value, parameters) if known.value else iter(())

    negatives = rows.mapInArrow(second_pass, NEGATIVE_TYPE)
    keys = ["anchor_id", "positive_id", "positive_score"]
    ranked = _first(negatives, keys, "negative_id", "negative_score", parameters.negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle(parameters: MiningParameters) -> str:
    """SQL for the registered query: all scores of the anchors."""
    p = parameters
    return f"""
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({p.scale} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
        CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= {p.positives}
)
SELECT anchor_id, positive_id, positive_score, row_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, row_id) AS INT) AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {p.low} * positive_score <= 100 * score AND 100 * score <= {p.high} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, row_id) <= {p.negatives}
"""
