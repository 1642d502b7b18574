"""One document per key: micro-batches merged into hash buckets, with a commit for each batch."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.operators.sizing import settle
from delaycast.sinks.commits import CommitLog

# Buckets of a new store. A batch rewrites the buckets that its keys fall into.
BUCKETS = 64


def newest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """The row of each key with the largest ``newest`` columns; of equal ones that with the largest hash.

    Rows are reduced before they meet, so a key may have any number of them.
    """
    columns = ", ".join(f"`{c}`" for c in df.columns)
    order = ", ".join(f"`{c}`" for c in newest)
    latest = F.expr(f"max_by(struct({columns}), struct({order}, xxhash64(to_json(struct({columns})))))")
    return df.groupBy(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]).agg(latest.alias("_row")).select("_row.*")


class KeyedDocuments:
    """Documents below ``root`` by ``keys``; of several with one key the one with the largest ``newest`` stays.

    A commit lists the folder of each bucket. A batch reads and rewrites only the buckets that its
    keys fall into, and takes all other folders over, so readers see a batch whole or not at all.
    A late document does not replace a newer one. Columns that come up later are null in earlier
    documents. Null keys are a key like any other.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: list[str], newest: list[str], buckets: int = BUCKETS
    ) -> None:
        self.spark, self.root, self.keys, self.newest = spark, root.rstrip("/"), keys, newest
        self.log = CommitLog(spark, f"{self.root}/log")
        self.buckets = buckets

    def upsert(self, batch: DataFrame, batch_id: int, stream: str = "") -> int | None:
        """Merge a batch and commit it; None when a commit of ``stream`` has this batch already."""
        changes = None
        while True:
            newest = self.log.latest()
            number, base = newest if newest else (0, {"folders": {}, "schema": None, "buckets": self.buckets, "batches": {}})
            if base["batches"].get(stream, -1) >= batch_id:
                return None
            if changes is None:
                bucket = f"CAST(pmod(xxhash64({', '.join(f'`{k}`' for k in self.keys)}), {base['buckets']}) AS INT) AS _bucket"
                changes = settle(newest_per_key(batch, self.keys, self.newest).selectExpr("*", bucket), "changes").frame
                touched = sorted(row[0] for row in changes.select("_bucket").distinct().collect())
            merged = changes
            held = {str(b): base["folders"][str(b)] for b in touched if str(b) in base["folders"]}
            if held:
                existing = self._open(held, base["schema"]).selectExpr("*", bucket)
                together = existing.unionByName(changes, allowMissingColumns=True)
                merged = newest_per_key(together, self.keys, self.newest)
            folder = f"{self.root}/data/{uuid.uuid4().hex}"
            if touched:
                files = merged.repartition(F.col("_bucket")).write.partitionBy("_bucket")
                files.parquet(folder)
            record = {
                "folders": base["folders"] | {str(b): folder for b in touched},
                "schema": merged.drop("_bucket").schema.json() if touched else base["schema"],
                "buckets": base["buckets"],
                "batches": base["batches"] | {stream: batch_id},
                "at": time.time(),
            }
            if self.log.put(number + 1, record):
                return number + 1
            if touched:  # another writer came first: merge with what it left
                self.log.remove_folder(folder)

    def foreach_batch(self, make: Callable[[DataFrame], DataFrame] = lambda batch: batch, stream: str = ""):
        """A ``foreachBatch`` function that upserts ``make`` of each batch."""

        def deliver(batch: DataFrame, batch_id: int) -> None:
            self.upsert(make(batch), batch_id, stream)

        return deliver

    def _open(self, folders: dict[str, str], schema: str) -> DataFrame:
        paths = [f"{folder}/_bucket={bucket}" for bucket, folder in folders.items()]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """All documents as of the newest commit, or of a given one."""
        if version is None:
            newest = self.log.latest()
            if newest is None:
                raise LookupError(f"no documents below {self.root}")
            record = newest[1]
        else:
            record = self.log.read(version)
        if not record["folders"]:
            raise LookupError(f"no documents below {self.root}")
        return self._open(record["folders"], record["schema"])

    def expire(self, keep: int) -> None:
        """Forget all commits but the newest ``keep``, and the folders that only they list."""
        numbers = self.log.numbers()
        old, kept = numbers[: -max(keep, 1)], numbers[-max(keep, 1) :]
        listed = {folder for number in old for folder in self.log.read(number)["folders"].values()}
        needed = {folder for number in kept for folder in self.log.read(number)["folders"].values()}
        for number in old:
            self.log.remove(number)
        for folder in sorted(listed - needed):
            self.log.remove_folder(folder)
