"""A training corpus from raw documents: classify, deduplicate lines and documents, decontaminate, encode.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Its result is
written as Parquet to the shared folder and read again as the next stage's ``docs``, so a lost
executor costs no more than part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaycast.llm.common import fresh_name, settle, table
from delaycast.llm.factorization import MachineParameters, quality_score, train_quality
from delaycast.llm.line_dedup import dedup_lines
from delaycast.llm.piece_encoding import with_digests
from delaycast.llm.queries import LINE_DEDUP, tokenizer_path
from delaycast.llm.simhash import SimHashParameters, keep_one_each
from delaycast.llm.string_tiling import decontaminate
from delaycast.workload.registry import Registry

QUALITY = MachineParameters()
NEAR = SimHashParameters(words=3, distance=3)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose quality score is below the machine's threshold.

    Where the labels give less than two classes to learn from, scores tell nothing and all stay.
    """
    machine = train_quality(docs, table(spark, sf_dir, "labels"), QUALITY)
    if not machine.learnt:
        return docs
    return docs.where(quality_score(docs, machine, QUALITY) >= QUALITY.threshold)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; ``n_chars`` follows the text."""
    removed = fresh_name(docs, "removed")
    shorter = dedup_lines(docs, LINE_DEDUP, removed=removed)
    length = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return shorter.withColumn("n_chars", length).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates keep the document with the smallest id."""
    return keep_one_each(docs, NEAR)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that leak a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with their count and digest and that of the decoded text."""
    return with_digests(docs, tokenizer_path(), ids="ids").drop("text")


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("sentencepiece_encoding", encode),
]

# Two stages learn or tile, which SQL cannot express; the tests hold each stage against brute force.
ORACLE_SQL = None

REGISTRY = Registry()


@REGISTRY.query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
