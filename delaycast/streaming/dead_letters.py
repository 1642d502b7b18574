"""Messages that could not be decoded: kept with their batch and reason, and delivered once when mended."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from delaycast.schemas import MESSAGE_RECORD
from delaycast.sinks.commits import CommitLog
from delaycast.sinks.documents import write_batch
from delaycast.streaming.messages import decode_messages

# What a letter holds beside the message; ``origin`` is where the source had it, where that is known.
LETTER = "letter_id string, batch_id bigint, origin string, reason string, value string, copies bigint"


def bad_messages(messages: DataFrame, batch_id: int, record: T.StructType = MESSAGE_RECORD, origin: str = "NULL") -> DataFrame:
    """A letter for each message of a batch that gives no rows, with the number of its copies.

    The reason is ``missing`` (no text), ``empty``, or ``corrupt`` (no JSON of such rows). ``origin`` is
    an SQL expression of the source's columns, such as a partition and offset.
    """
    judged = decode_messages(messages.selectExpr("value", f"CAST({origin} AS STRING) AS origin"), record, "origin")
    bad = judged.where("rows IS NULL").selectExpr(
        "origin",
        "CASE WHEN value IS NULL THEN 'missing' WHEN trim(value) = '' THEN 'empty' ELSE 'corrupt' END AS reason",
        "value",
    )
    grouped = bad.groupBy("origin", "reason", "value").agg(F.count(F.lit(1)).alias("copies"))
    key = f"sha2(concat_ws('|', '{batch_id}', coalesce(origin, ''), reason, coalesce(value, '')), 256) AS letter_id"
    return grouped.selectExpr(key, f"{batch_id}L AS batch_id", "origin", "reason", "value", "copies")


class DeadLetters:
    """Letters below ``root`` and the replays that delivered some of them.

    A batch that runs again replaces its own letters. A replay is chosen and committed before it is
    delivered, under a number that the delivery gets as its batch id, so a replay that broke off is
    delivered again under the same number, and no letter is in two replays.
    """

    def __init__(self, spark: SparkSession, root: str, record: T.StructType = MESSAGE_RECORD) -> None:
        self.spark, self.root, self.record = spark, root.rstrip("/"), record
        self.chosen = CommitLog(spark, f"{self.root}/chosen")
        self.done = CommitLog(spark, f"{self.root}/done")

    def keep(self, batch: DataFrame, batch_id: int, origin: str = "NULL") -> None:
        """Store the bad messages of a batch."""
        write_batch(bad_messages(batch, batch_id, self.record, origin), batch_id, f"{self.root}/letters")

    def beside(self, deliver: Callable[[DataFrame, int], None], origin: str = "NULL") -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function: keep the bad messages, deliver the others."""

        def run(batch: DataFrame, batch_id: int) -> None:
            self.keep(batch, batch_id, origin)
            deliver(batch, batch_id)

        return run

    def letters(self) -> DataFrame:
        try:
            return self.spark.read.schema(LETTER).parquet(f"{self.root}/letters")
        except AnalysisException:
            return self.spark.createDataFrame([], LETTER)

    def replayed(self) -> DataFrame:
        """Letters that a replay has taken up, as mended, with its number."""
        found = None
        for number in self.chosen.numbers():
            part = self.spark.read.schema(LETTER).parquet(self.chosen.read(number)["path"])
            part = part.withColumn("replay", F.lit(number).cast("long"))
            found = part if found is None else found.unionByName(part)
        return found if found is not None else self.spark.createDataFrame([], f"{LETTER}, replay bigint")

    def open_letters(self) -> DataFrame:
        """Letters that no replay has taken up."""
        return self.letters().join(self.replayed().select("letter_id"), "letter_id", "left_anti")

    def replay(self, mend: Column, deliver: Callable[[DataFrame, int], None]) -> int | None:
        """Deliver the open letters whose text ``mend`` makes readable; the replay's number, None if there are none.

        ``deliver`` gets messages and the number; like any delivery of a batch it must replace what
        it wrote under that number before. Replays that broke off are finished first.
        """
        self.resume(deliver)
        mended = self.open_letters().withColumn("value", mend)
        readable = decode_messages(mended, self.record, "letter_id").where("rows IS NOT NULL").select("letter_id")
        path = f"{self.root}/mended/{uuid.uuid4().hex}"
        mended.join(readable, "letter_id", "left_semi").select(*[c.split()[0] for c in LETTER.split(", ")]).write.parquet(path)
        if self.spark.read.schema(LETTER).parquet(path).isEmpty():
            return None
        number = max(self.chosen.numbers(), default=0) + 1
        if not self.chosen.put(number, {"path": path}):
            return self.replay(mend, deliver)  # another replay came first; it may have taken the same letters
        self._deliver(number, deliver)
        return number

    def resume(self, deliver: Callable[[DataFrame, int], None]) -> list[int]:
        """Deliver the replays that were chosen but not finished."""
        open_ones = sorted(set(self.chosen.numbers()) - set(self.done.numbers()))
        for number in open_ones:
            self._deliver(number, deliver)
        return open_ones

    def _deliver(self, number: int, deliver: Callable[[DataFrame, int], None]) -> None:
        letters = self.spark.read.schema(LETTER).parquet(self.chosen.read(number)["path"])
        deliver(letters.selectExpr("value", "explode(sequence(1L, copies))").select("value"), number)
        self.done.put(number, {})
