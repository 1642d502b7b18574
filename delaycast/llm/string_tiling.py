"""Benchmark decontamination by greedy string tiling.

Tokens are lower-cased word-character runs. Documents and test items are joined on shared seeds, the
hashes of ``min_match`` tokens in a row. For the pairs that this leaves, tiling marks the longest
match of unmarked tokens again and again, found by running Karp-Rabin hashes over windows of a
length that shrinks from long matches to ``min_match``. Tiles do not overlap in either text, so a
passage whose parts were reordered is covered as well as one that was copied whole. An item is
leaked into a document if its tiles cover at least ``coverage`` of the item. Every changed word costs
a copy up to ``min_match`` tokens of tiles on either side, so half of the item is asked for: copies
with one word in ten replaced reach it, while texts that share no passage stay below a quarter.

The test items are the small side. They are taken in blocks of at most ``block_chars`` characters
(more only for a single longer item), each sent to the tasks once, and every block is held against all
documents, in whole texts. So one block serves a benchmark of any usual size, nothing is shuffled, and
no frequent seed meets in one task.

Null and empty texts leak nothing, and items with fewer than ``min_match`` tokens mark nothing. Every
row is judged by itself: repeated rows and null ids get the same answer as any other. Items with a
null id are ignored; items of the same id are separate texts.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import bound_batches, settle

TOKENS = re.compile(r"\w+")
BASE = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1
LEAK_TYPE = "array<struct<item_id: bigint, words: int, covered: int, tiles: int>>"


class TilingParameters(NamedTuple):
    """``min_match`` tokens a tile, ``coverage`` of the item from which it counts as leaked."""

    min_match: int = 5
    coverage: float = 0.5
    block_chars: int = 8_000_000


class Leak(NamedTuple):
    item_id: int
    words: int
    covered: int
    tiles: int


def tokens(text: str | None) -> list[str]:
    return TOKENS.findall((text or "").lower())


def window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` ids, all windows at once."""
    count = len(ids) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    numbers = ids.astype(np.uint64) + np.uint64(1)
    out = np.zeros(count, np.uint64)
    for at in range(length):
        out = out * np.uint64(BASE) + numbers[at : at + count]
    return out


def running_hashes(ids: list[int], marked: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(start, hash) of each window of unmarked ids, each hash from the one before."""
    top = pow(BASE, length - 1, WORD + 1)
    value = size = 0
    for at, token in enumerate(ids):
        if marked[at]:
            value = size = 0
            continue
        if size == length:
            value = value - (ids[at - length] + 1) * top
        else:
            size += 1
        value = (value * BASE + token + 1) & WORD
        if size == length:
            yield at - length + 1, value


def tile(item: list[int], text: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in item, start in text, length), the longest first.

    In both sequences a negative id matches nothing.
    """
    item_marks, text_marks = [t < 0 for t in item], [t < 0 for t in text]
    tiles, length = [], max(min_match, min(len(item), 32))

    def reach(a: int, b: int) -> int:
        size = 0
        while (
            a + size < len(item)
            and b + size < len(text)
            and item[a + size] == text[b + size]
            and not item_marks[a + size]
            and not text_marks[b + size]
        ):
            size += 1
        return size

    while True:
        places = defaultdict(list)
        for start, value in running_hashes(text, text_marks, length):
            places[value].append(start)
        # Matches by size; a window inside a match that was found is not listed again.
        matches, seen = defaultdict(list), {}
        for a, value in running_hashes(item, item_marks, length):
            for b in places.get(value, ()):
                if seen.get(b - a, -1) > a:
                    continue
                size = reach(a, b)
                if size >= length:
                    seen[b - a] = a + size
                    matches[size].append((a, b))
        while matches:
            size = max(matches)
            for a, b in matches.pop(size):
                free = min(reach(a, b), size)
                if free == size:
                    for k in range(size):
                        item_marks[a + k] = text_marks[b + k] = True
                    tiles.append((a, b, size))
                    continue
                # A longer tile took part of it; what is left may still be long enough.
                k = 0
                while k < size:
                    left = min(reach(a + k, b + k), size - k)
                    if left >= length:
                        matches[left].append((a + k, b + k))
                    k += left + 1
        if length == min_match:
            return tiles
        length = max(min_match, length // 2)


class Vocabulary(dict):
    """Token numbers; -1 for a token that no item has."""

    def __missing__(self, token: str) -> int:
        return -1


class Benchmark:
    """A block of test items, indexed by the hashes of their seeds."""

    def __init__(self, items: list[tuple[int, str]], parameters: TilingParameters) -> None:
        self.parameters = parameters
        self.vocabulary = Vocabulary()
        self.item_ids, self.items = [], []
        hashes, owners, starts = [], [], []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens(text)]
            if len(ids) < parameters.min_match:
                continue
            found = window_hashes(np.array(ids, np.int64), parameters.min_match)
            hashes.append(found)
            owners.append(np.full(len(found), len(self.items)))
            starts.append(np.arange(len(found)))
            self.item_ids.append(item_id)
            self.items.append(ids)
        none = np.zeros(0, np.int64)
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.owners = np.concatenate([none, *owners])[order]
        self.starts = np.concatenate([none, *starts])[order]
        self.lengths = np.array([len(i) for i in self.items], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])

    def leaks(self, text: str | None) -> list[Leak]:
        """The items that the text leaks, in the order of the block."""
        length, share = self.parameters.min_match, self.parameters.coverage
        found = tokens(text)
        if len(found) < length or not len(self.hashes):
            return []
        ids = np.fromiter(map(self.vocabulary.__getitem__, found), np.int64, len(found))
        unknown = np.cumsum(np.concatenate([[0], ids < 0]))
        whole = np.flatnonzero(unknown[length:] == unknown[:-length])
        if not len(whole):
            return []
        wanted = window_hashes(ids, length)[whole]
        low = np.searchsorted(self.hashes, wanted, "left")
        counts = np.searchsorted(self.hashes, wanted, "right") - low
        whole, low, counts = whole[counts > 0], low[counts > 0], counts[counts > 0]
        if not len(whole):
            return []
        # An upper bound of the coverage: the item's tokens that lie in any shared seed.
        entries = np.unique(np.concatenate([np.arange(a, a + n) for a, n in {(int(a), int(n)) for a, n in zip(low, counts)}]))
        touched = np.zeros(self.offsets[-1] + 1, np.int64)
        first = self.offsets[self.owners[entries]] + self.starts[entries]
        np.add.at(touched, first, 1)
        np.add.at(touched, first + length, -1)
        covered = np.add.reduceat(np.cumsum(touched)[:-1] > 0, self.offsets[:-1], dtype=np.int64)
        candidates = np.flatnonzero(covered >= share * self.lengths)
        if not len(candidates):
            return []
        # Only tokens in shared seeds can be in a tile; gaps become one token that matches nothing.
        inside = np.zeros(len(ids) + 1, np.int64)
        np.add.at(inside, whole, 1)
        np.add.at(inside, whole + length, -1)
        kept = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
        gaps = np.flatnonzero(np.diff(kept) > 1) + 1
        shared = np.insert(ids[kept], gaps, -1).tolist()
        out = []
        for number in candidates:
            item = self.items[number]
            tiles = tile(item, shared, length)
            size = sum(n for _, _, n in tiles)
            if size >= share * len(item):
                out.append(Leak(self.item_ids[number], len(item), size, len(tiles)))
        return out


_indexes: dict[tuple, Benchmark] = {}


def _worker_index(key: tuple, shared: Broadcast, parameters: TilingParameters) -> Benchmark:
    """This worker's index of a block, built once; only the last block's is kept."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Benchmark(shared.value, parameters)
    return _indexes[key]


def _leak_column(shared: Broadcast, parameters: TilingParameters, text: str) -> Column:
    key = (uuid.uuid4().hex, parameters)

    @F.arrow_udf(LEAK_TYPE)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = _worker_index(key, shared, parameters)
        kind = pa.list_(
            pa.struct([("item_id", pa.int64()), ("words", pa.int32()), ("covered", pa.int32()), ("tiles", pa.int32())])
        )
        for batch in batches:
            rows = [[leak._asdict() for leak in index.leaks(v.as_py())] for v in batch]
            yield pa.array(rows, kind)

    return find(F.col(f"`{text}`"))


def item_blocks(benchmark: DataFrame, parameters: TilingParameters, item_id: str, text: str) -> Iterator[Broadcast]:
    """The test items in blocks of at most ``block_chars`` characters, each sent to the tasks."""
    context = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text"))
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(size // parameters.block_chars) + 1
    if blocks == 1:
        yield context.broadcast([tuple(r) for r in items.collect()])
        return
    # Items in the order of a hash; a block ends before it would grow past its bound.
    block, chars = [], 0
    for row in items.orderBy(F.xxhash64("item_id", "text"), "item_id").toLocalIterator():
        if block and chars + len(row.text) > parameters.block_chars:
            yield context.broadcast(block)
            block, chars = [], 0
        block.append(tuple(row))
        chars += len(row.text)
    yield context.broadcast(block)


def leaked_items(
    df: DataFrame,
    benchmark: DataFrame,
    parameters: TilingParameters = TilingParameters(),
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per row of ``df`` and item that it leaks: doc_id, item_id, words, covered, tiles, coverage."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = None
    for shared in item_blocks(benchmark, parameters, item_id, item_text):
        leaks = rows.select("doc_id", F.explode(_leak_column(shared, parameters, "text")).alias("leak"))
        if found is not None:
            leaks = settle(leaks, "leaks")
        found = leaks if found is None else found.unionByName(leaks)
    return found.select("doc_id", "leak.*", (F.col("leak.covered") / F.col("leak.words")).alias("coverage"))


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    parameters: TilingParameters = TilingParameters(),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``df`` that leak no item; all columns stay."""
    bound_batches(df.sparkSession)
    passes = 0
    for shared in item_blocks(benchmark, parameters, item_id, item_text):
        df = settle(df, "clean") if passes else df
        df = df.where(F.size(_leak_column(shared, parameters, text)) == 0)
        passes += 1
    return df
