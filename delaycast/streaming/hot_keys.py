"""Hot keys of a stream, learnt from its micro-batches and carried from one to the next.

Splitting a key needs to know beforehand that it is hot. Counting a batch first would run it twice, so
each batch is split by what the batches before it held. Once a batch is written, a frequent-items sketch
of every key set is taken from its finished rows, which are kept for that long, in one pass without a
shuffle; the largest counts are merged into a summary of bounded size. Older batches fade by ``decay``. A merge adds counts, subtracts the first count that
has no room from all and drops what is not positive (Misra-Gries), so a summary of c keys misses none that
holds more than 1/(c + 1) of the faded rows, apart from what the sketch of a batch itself leaves out.

Summaries decide only how evenly rows spread; the join is right with any of them. The first batch, which
has no summary, is counted. A key that becomes hot is split one batch later.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from delaycast.operators.lookup import Splits, key_hash
from delaycast.sinks.commits import CommitLog

# Keys of a summary for each task, keys a sketch tracks for each key of a summary, summaries kept for a replay.
KEYS_PER_TASK, TRACKED_PER_KEY, KEPT = 8, 16, 16


class Summary(NamedTuple):
    """Faded row count, and the hashes of the most frequent keys with a lower bound of their counts."""

    total: float = 0.0
    counts: dict[int, float] = {}

    def merged(self, total: float, counts: dict[int, float], capacity: int, decay: float) -> Summary:
        """This summary faded, with another batch's rows added."""
        joint = {key: count * decay for key, count in self.counts.items()}
        for key, count in counts.items():
            joint[key] = joint.get(key, 0.0) + count
        ranked = sorted(joint.items(), key=lambda entry: (-entry[1], entry[0]))
        spill = ranked[capacity][1] if len(ranked) > capacity else 0.0
        return Summary(self.total * decay + total, {key: count - spill for key, count in ranked[:capacity] if count > spill})

    def copies(self, tasks: int) -> dict[int, int]:
        """Into how many copies each key with more than 1/tasks of the rows is split; fewer keys than tasks."""
        shares = {key: count * tasks / self.total for key, count in self.counts.items()} if self.total else {}
        return {key: math.ceil(share) for key, share in shares.items() if share > 1}


class HotKeys:
    """Summaries of the key sets ``keys`` of one stream, kept by batch below ``root``.

    A batch that runs again is split by the same summary and changes none. ``root`` belongs to one
    checkpoint: a stream that starts anew takes a new one. ``tasks`` defaults to the session's shuffle
    partitions.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: list[tuple[str, ...]], tasks: int | None = None, decay: float = 0.5
    ) -> None:
        self.log = CommitLog(spark, root)
        self.keys, self.decay = keys, decay
        self.tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.capacity = KEYS_PER_TASK * self.tasks

    def before(self, batch_id: int) -> dict[tuple[str, ...], Summary] | None:
        """The summaries that the batches before this one left; None when there are none."""
        numbers = [number for number in self.log.numbers() if number <= batch_id]
        if not numbers:
            return None
        held = self.log.read(numbers[-1])["summaries"]
        return {tuple(names): Summary(total, {int(k): n for k, n in counts}) for names, total, counts in held}

    def splits(self, batch_id: int) -> Splits | None:
        """How a batch's keys are split; None to count them."""
        summaries = self.before(batch_id)
        return None if summaries is None else {names: s.copies(self.tasks) for names, s in summaries.items()}

    def deliver(
        self,
        batch_id: int,
        build: Callable[[Splits | None], DataFrame],
        write: Callable[[DataFrame], None],
    ) -> None:
        """Write what ``build`` makes of the batch with these splits, and learn from its rows.

        The built frame has the columns of all key sets.
        """
        built = build(self.splits(batch_id)).persist(StorageLevel.MEMORY_AND_DISK)
        write(built)
        tracked = TRACKED_PER_KEY * self.capacity
        sketches = [
            F.expr(f"approx_top_k({key_hash(names)}, {self.capacity}, {tracked})").alias(f"top_{i}")
            for i, names in enumerate(self.keys)
        ]
        self.record(batch_id, built.agg(F.count(F.lit(1)).alias("total"), *sketches).first())
        built.unpersist()

    def record(self, batch_id: int, found: Row) -> None:
        """Commit the summaries up to and with this batch, unless they are there already."""
        earlier = self.before(batch_id) or {}
        summaries = []
        for i, names in enumerate(self.keys):
            counts = {entry["item"]: float(entry["count"]) for entry in found[f"top_{i}"] or []}
            summary = earlier.get(names, Summary()).merged(found["total"], counts, self.capacity, self.decay)
            summaries.append([list(names), summary.total, list(summary.counts.items())])
        self.log.put(batch_id + 1, {"summaries": summaries})
        for number in self.log.numbers():
            if number <= batch_id + 1 - KEPT:
                self.log.remove(number)
