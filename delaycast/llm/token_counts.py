"""Token counts by a whole-token shortcut for a SentencePiece BPE model.

A text falls into pre-tokens that no merge crosses: a word with the space marks before it, a run
of space marks, a newline. Before any text is read, merging is run on every string of the
vocabulary by itself. Those that end as one token are proven: wherever such a string is a whole
pre-token it counts one, found by a set look-up. Only the other pre-tokens are merged, and only
their counts are kept, in a bounded memo.

The proof is needed since not every vocabulary string is reached by merging: the best pairs inside
it may lead elsewhere. Merging takes the pair of best score, the leftmost of equal ones, until no
neighbours form a piece. Characters that the vocabulary lacks count one for each UTF-8 byte.

Rows: a null text counts as empty, with no bytes and no tokens. Every row is counted by itself, so
repeated rows, ties and null ids do not matter; an empty table gives an empty result. Texts of any
length are counted whole: long pre-tokens are merged with a heap in n log n steps. Columns of the
names that are added are replaced; all others stay.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import Memo, bound_batches, fresh_name
from delaycast.llm.piece_encoding import SPACE, Vocabulary, read_model

# A line with runs of spaces or with space marks of its own is cut by the pattern.
ODD = re.compile(f"  |^ | $|{SPACE}")
MARKED = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Entries of a worker's memo of merged pre-tokens, the longest one worth an entry, and the length
# beyond which merging uses a heap.
MEMO_ENTRIES, MEMO_CHARS, HEAP_FROM = 300_000, 48, 32

COUNT_TYPE = "struct<n_tokens: bigint, n_direct: bigint>"


class Counter:
    """Counts tokens with one vocabulary; ``whole`` are the pre-tokens proven to be one token."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.order = {piece: vocabulary.order[token] for piece, token in vocabulary.ids.items()}
        proven = {piece for piece in self.order if self.merged(piece) == [piece]}
        # Keys are pre-tokens as a text has them: after one space, or at the start of a line.
        self.whole = {p[1:] for p in proven if p[0] == SPACE and p[1:] and SPACE not in p[1:]}
        self.bare = {p for p in proven if p[0] != SPACE}
        self.after_space = Memo(lambda word: self.size(SPACE + word), MEMO_ENTRIES, MEMO_CHARS)
        self.other = Memo(self.size, MEMO_ENTRIES // 10, MEMO_CHARS)

    def merged(self, unit: str) -> list[str]:
        """The symbols that merging leaves of a pre-token."""
        return self._merged_by_scan(unit) if len(unit) <= HEAP_FROM else self._merged_by_heap(unit)

    def _merged_by_scan(self, unit: str) -> list[str]:
        order, row, never = self.order, list(unit), float("inf")
        ranks = [order.get(a + b, never) for a, b in zip(row, row[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            row[at : at + 2] = [row[at] + row[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = order.get(row[at - 1] + row[at], never)
            if at < len(ranks):
                ranks[at] = order.get(row[at] + row[at + 1], never)
        return row

    def _merged_by_heap(self, unit: str) -> list[str]:
        order, row, size = self.order, list(unit), len(unit)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        due = [(order[p], i, len(p)) for i in range(size - 1) if (p := unit[i : i + 2]) in order]
        heapq.heapify(due)

        def offer(left: int) -> None:
            right = after[left]
            if right < size and (rank := order.get(row[left] + row[right])) is not None:
                heapq.heappush(due, (rank, left, len(row[left]) + len(row[right])))

        while due:
            _, left, length = heapq.heappop(due)
            right = after[left]
            # One of the two may have merged since; a symbol that went has length 0.
            if not row[left] or right >= size or len(row[left]) + len(row[right]) != length:
                continue
            row[left] += row[right]
            row[right] = ""
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [symbol for symbol in row if symbol]

    def size(self, unit: str) -> int:
        """Tokens of one pre-token; what no piece covers counts its bytes."""
        order = self.order
        return sum(1 if symbol in order else len(symbol.encode()) for symbol in self.merged(unit))

    def _odd_line(self, marked: str) -> tuple[int, int]:
        tokens = direct = 0
        for unit in MARKED.findall(marked):
            if unit[0] == SPACE and unit[1:] in self.whole:
                direct += 1
            else:
                tokens += self.other[unit]
        return tokens + direct, direct

    def count(self, text: str) -> tuple[int, int]:
        """Tokens of a text, and how many pre-tokens were counted without merging."""
        if not text:
            return 0, 0
        whole, lines = self.whole, text.split("\n")
        tokens, direct = len(lines) - 1, 0  # every newline is one byte token
        for number, line in enumerate(lines):
            if ODD.search(line):
                line = line.replace(" ", SPACE)
                found, plain = self._odd_line(line if number else SPACE + line)
                tokens += found
                direct += plain
                continue
            if number:
                first, _, line = line.partition(" ")
                if first in self.bare:
                    tokens += 1
                    direct += 1
                elif first:
                    tokens += self.other[first]
                if not line:
                    continue
            elif not line:  # the mark before the text stands alone
                tokens += self.other[SPACE]
                continue
            words = line.split(" ")
            rest = [word for word in words if word not in whole]
            tokens += len(words) - len(rest) + sum(map(self.after_space.__getitem__, rest))
            direct += len(words) - len(rest)
        return tokens, direct


_counters: dict[str, Counter] = {}


def worker_counter(key: str, model: bytes) -> Counter:
    """This worker's counter for a model, built once."""
    if key not in _counters:
        _counters[key] = Counter(Vocabulary(model))
    return _counters[key]


def with_counts(df: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """Add n_bytes, n_tokens, over_limit (more than ``limit`` tokens) and n_direct of ``text``.

    ``n_direct`` tells how many pre-tokens counted without merging. One pass over the texts where
    they lie: no shuffle.
    """
    bound_batches(df.sparkSession)
    key, model = read_model(model_path)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(COUNT_TYPE)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = worker_counter(key, shared.value)
        for batch in batches:
            found = [counter.count(value.as_py() or "") for value in batch]
            columns = [pa.array([f[at] for f in found], pa.int64()) for at in (0, 1)]
            yield pa.StructArray.from_arrays(columns, ["n_tokens", "n_direct"])

    source = F.col(f"`{text}`")
    names = ("n_bytes", "n_tokens", "over_limit", "n_direct")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    packed = fresh_name(df, "counted")
    size = fresh_name(df, "size")
    bytes_of = F.coalesce(F.octet_length(source), F.lit(0)).cast("long")
    return df.select(*kept, bytes_of.alias(size), counted(source).alias(packed)).select(
        *kept,
        F.col(size).alias("n_bytes"),
        F.col(f"{packed}.n_tokens"),
        (F.col(f"{packed}.n_tokens") > limit).alias("over_limit"),
        F.col(f"{packed}.n_direct"),
    )
