"""A bounded, repeatable sample of labelled texts, and fitting on it inside one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import crc_remainder


def labelled_sample(
    documents: DataFrame, labels: DataFrame, target: str, modulus: int, held_out: int, per_class: int, columns: list[str]
) -> DataFrame:
    """At most ``per_class`` labelled rows of each class, with ``label`` and ``weight``.

    Rows whose crc32 remainder is ``held_out`` never get in. The ids with the smallest hashes are
    taken, so the sample does not depend on partitions. A weight is the number of labelled rows
    that a sampled row stands for, so the classes keep their shares. Labels other than 0 and 1,
    and null ids, are left out; of several labels for one id the larger counts. The sample is
    bounded by ``per_class``, so it is sent to the documents, which stay where they are. Of several
    documents with one id the one with the smallest columns is taken, reduced where they lie, so the
    bound holds however often an id repeats.
    """
    usable = labels.select("doc_id", F.col(target).cast("int").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL")
    usable = usable.where(crc_remainder("doc_id", modulus) != held_out).groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r.label: r.n for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label, n in sorted(counts.items()):
        some = usable.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        some = some.withColumn("weight", F.lit(n / min(n, per_class)))
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None:
        chosen = usable.withColumn("weight", F.lit(1.0))
    chosen = chosen.selectExpr("doc_id AS _id", "label", "weight")
    texts = documents.select("doc_id", *columns)  # other columns may have the names used here
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    first = found.groupBy("doc_id").agg(F.min(F.struct("label", "weight", *columns)).alias("_first"))
    return first.select("doc_id", *[F.col(f"_first.{c}").alias(c) for c in ("label", "weight", *columns)])


def fit_in_task(sample: DataFrame, fit: Callable[[list[dict]], object]) -> bytes:
    """Run ``fit`` on the rows of a bounded frame in one task, in the order of ids; the pickled result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda r: r["doc_id"])
        blob = pickle.dumps(fit(rows), protocol=5)
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").first()
    return bytes(found.model) if found else pickle.dumps(fit([]), protocol=5)  # Spark runs no task on no rows
