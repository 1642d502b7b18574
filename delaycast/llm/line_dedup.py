"""Deletion of repeated runs of lines, by a suffix array over line-ID sequences.

Every line gets an ID, and the suffixes of all documents' ID sequences are sorted by prefix
doubling: the rank of a suffix by 2k lines follows from the ranks by k lines of itself and of the
suffix k lines on. A rank is the place in the suffix array at which the equal prefixes begin, found
by counting equal pairs, sorting the pairs by range and adding up the counts. The suffixes that
share their first l lines form an interval of longest common prefix l or more; the two ranks that
cover those l lines name it. In an interval whose run is long enough, all but the first suffix in
document order are later copies, and their lines go.

A line counts as one word and one more for every space. A run is long enough from ``min_words``
words on. As each line counts at least one, such a run has at most ``min_words`` lines, unless it is
a union of overlapping shorter ones. So sorting by the first power of two lines from ``min_words``
on is enough: longer maximal runs come out as unions, whole. Lines that occur once cannot be in a
repeated run and leave before the sorting.

Documents come in the order of their ids. A null text has no lines; an empty one has one empty line.
Rows with the same id and the same text are one document: they get the same decisions. Rows with a
null id have no place in the order: they stay as they are and are no copies. Documents stay even if
all their lines go; their text is then empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.llm.common import bound_batches, fresh_name, settle


class LineDedupParameters(NamedTuple):
    """``min_words``: words of a repeated run from which its later copies are deleted."""

    min_words: int = 8


def _lines(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, twin, at, line ID in two parts, words) of each line of the rows that have an id."""
    rows = df.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text")).where("doc IS NOT NULL")
    split = rows.select("doc", F.xxhash64("text").alias("twin"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return split.selectExpr(
        "doc",
        "twin",
        "at",
        "xxhash64(line) AS id",
        "hash(line) AS id2",
        "1 + length(line) - length(replace(line, ' ', '')) AS words",
    )


def start_ranks(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``keys`` and ``rank``: the sum of ``n`` over all smaller keys.

    The keys are sorted by range; each task adds up its own, and one total for each task goes
    through the driver.
    """
    spark = counts.sparkSession
    fields = ", ".join(f"{k} {dict(counts.dtypes)[k]}" for k in keys)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            sums = before + np.cumsum(n) - n
            before = int(sums[-1] + n[-1]) if len(n) else before
            columns = [batch.column(k) for k in keys] + [
                batch.column("n"),
                pa.array(sums, pa.int64()),
                pa.array(np.full(len(n), part), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "n", "before", "part"])

    ordered = counts.repartitionByRange(*keys).sortWithinPartitions(*keys)
    summed = settle(ordered.mapInArrow(add_up, f"{fields}, n long, before long, part int"), name)
    totals = sorted((r.part, r.n) for r in summed.groupBy("part").agg(F.sum("n").alias("n")).collect())
    starts, before = [], 0
    for part, n in totals:
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, "part int, offset long")
    return summed.join(F.broadcast(offsets), "part").select(*keys, (F.col("before") + F.col("offset")).alias("rank"))


def _beyond(column: str, lines: int) -> Column:
    """The column's value ``lines`` lines on in the same unbroken run; null past its end."""
    order = W.partitionBy("doc", "twin").orderBy("at")
    if not lines:
        return F.col(column)
    reached = F.lead("at", lines).over(order) == F.col("at") + lines
    return F.when(reached, F.lead(column, lines).over(order))


def suffix_ranks(df: DataFrame, depth: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, twin, at, words, rank1, rank2, rank4, ...) of the lines that occur more than once.

    ``rank`` with k is the suffix's place in the suffix array by its first k lines, for k up to ``depth``;
    equal prefixes share a place, and a suffix that ends earlier comes before those that go on.
    """
    lines = settle(_lines(df, doc_id, text), "lines")
    repeated = lines.groupBy("id", "id2").agg(F.count("*").alias("n")).where("n > 1")
    ranks = start_ranks(repeated, ["id", "id2"], "ranks1").withColumnRenamed("rank", "rank1")
    suffixes = lines.join(ranks, ["id", "id2"]).drop("id", "id2")
    suffixes = settle(suffixes.dropDuplicates(["doc", "twin", "at"]), "suffixes1")
    k = 1
    while k < depth:
        pairs = suffixes.withColumn("ahead", F.coalesce(_beyond(f"rank{k}", k), F.lit(-1)))
        counts = pairs.groupBy(f"rank{k}", "ahead").agg(F.count("*").alias("n"))
        ranks = start_ranks(counts, [f"rank{k}", "ahead"], f"ranks{2 * k}").withColumnRenamed("rank", f"rank{2 * k}")
        suffixes = settle(pairs.join(ranks, [f"rank{k}", "ahead"]).drop("ahead"), f"suffixes{2 * k}")
        k *= 2
    return suffixes


def _runs(suffixes: DataFrame, min_words: int) -> DataFrame:
    """(doc, twin, at, lines, head, tail): runs of enough words, by the two ranks that cover them.

    A run is listed if it would have too few words without its last line or without its first;
    every longer run is a union of such.
    """
    total, found = F.lit(0), []
    for lines in range(1, min_words + 1):
        words = _beyond("words", lines - 1)
        total = total + words
        whole = 1 << (lines.bit_length() - 1)
        found.append(
            F.when(
                (total >= min_words) & ((total - words < min_words) | (total - F.col("words") < min_words)),
                F.struct(
                    F.lit(lines).alias("lines"),
                    F.col(f"rank{whole}").alias("head"),
                    _beyond(f"rank{whole}", lines - whole).alias("tail"),
                ),
            )
        )
    listed = suffixes.select("doc", "twin", "at", F.array(*found).alias("runs"))
    return listed.select("doc", "twin", "at", F.explode(F.filter("runs", lambda r: r.isNotNull())).alias("run")).select(
        "doc", "twin", "at", "run.*"
    )


def deleted_lines(
    df: DataFrame, parameters: LineDedupParameters = LineDedupParameters(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, twin, gone): for each document that loses lines its id, text hash and sorted line numbers."""
    depth = 1
    while depth < parameters.min_words:
        depth *= 2
    suffixes = suffix_ranks(df, depth, doc_id, text)
    runs = settle(_runs(suffixes, parameters.min_words), "runs")
    intervals = runs.groupBy("lines", "head", "tail").agg(
        F.min(F.struct("doc", "twin", "at")).alias("first"), F.count("*").alias("size")
    )
    # Written first: between two exchanges adaptive execution can split the runs of a hot interval.
    intervals = settle(intervals.where("size > 1"), "intervals")
    copies = runs.join(intervals, ["lines", "head", "tail"]).where(
        F.struct("doc", "twin", "at") > F.col("first")
    )
    gone = copies.select("doc", "twin", F.explode(F.sequence("at", F.expr("at + lines - 1"))).alias("at"))
    return gone.groupBy("doc", "twin").agg(F.array_sort(F.collect_set("at")).alias("gone"))


@F.arrow_udf(T.StringType())
def _without(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, gone in texts:
        out = []
        for value, numbers in zip(text.to_pylist(), gone.to_pylist(), strict=True):
            if numbers is None:
                out.append(None)
                continue
            removed = set(numbers)
            out.append("\n".join(line for at, line in enumerate(value.split("\n")) if at not in removed))
        yield pa.array(out, pa.string())


def dedup_lines(
    df: DataFrame,
    parameters: LineDedupParameters = LineDedupParameters(),
    doc_id: str = "doc_id",
    text: str = "text",
    removed: str | None = None,
) -> DataFrame:
    """``df`` without the later copies of repeated runs: the same rows and columns, ``text`` shortened.

    ``removed`` names a column to add (or replace) with the number of lines that went.
    """
    bound_batches(df.sparkSession)
    gone = settle(deleted_lines(df, parameters, doc_id, text), "gone")
    names = [c for c in df.columns if c != removed]
    doc, twin, lines = (fresh_name(df, n) for n in ("doc", "twin", "gone"))
    marks = gone.selectExpr(f"doc AS {doc}", f"twin AS {twin}", f"gone AS {lines}")
    joined = df.join(marks, (F.col(f"`{doc_id}`") == F.col(doc)) & (F.xxhash64(f"`{text}`") == F.col(twin)), "left")
    # Only texts that lose lines go through Python.
    shorter = _without(F.when(F.col(lines).isNotNull(), F.col(f"`{text}`")), F.col(lines))
    kept = [F.col(f"`{c}`") if c != text else F.coalesce(shorter, F.col(f"`{c}`")).alias(c) for c in names]
    count = [] if removed is None else [F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(removed)]
    return joined.select(*kept, *count)


def oracle(min_words: int) -> str:
    """SQL for doc_id, text, n_deleted over ``documents``, by numbering equal runs; ids must be unique."""
    ahead = ", ".join(
        f"lead(line, {i}) OVER o AS line{i}, lead(words, {i}) OVER o AS words{i}" for i in range(1, min_words)
    )
    listed = []
    for lines in range(1, min_words + 1):
        names = ["line", *(f"line{i}" for i in range(1, lines))]
        words = ["words", *(f"words{i}" for i in range(1, lines))]
        total = " + ".join(words)
        listed.append(
            f"SELECT doc_id, place, {lines} AS lines, {' || chr(10) || '.join(names)} AS run FROM context"
            f" WHERE {names[-1]} IS NOT NULL AND {total} >= {min_words}"
            f" AND ({total} - {words[-1]} < {min_words} OR {total} - words < {min_words})"
        )
    runs = " UNION ALL ".join(listed)
    steps = " UNION ALL ".join(f"SELECT {i} AS step" for i in range(min_words))
    return f"""
    WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
    lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM parts),
    counted AS (SELECT doc_id, place, line, 1 + length(line) - length(replace(line, ' ', '')) AS words FROM lines),
    context AS (SELECT doc_id, place, line, words, {ahead} FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
    runs AS ({runs}),
    copies AS (SELECT doc_id, place, lines FROM (
        SELECT doc_id, place, lines, row_number() OVER (PARTITION BY lines, run ORDER BY doc_id, place) AS nth FROM runs)
        WHERE nth > 1),
    gone AS (SELECT DISTINCT doc_id, place + step AS place FROM copies JOIN ({steps}) AS steps ON step < lines),
    kept AS (SELECT c.doc_id, string_agg(CASE WHEN g.place IS NULL THEN c.line END, chr(10) ORDER BY c.place) AS text,
        count(g.place) AS n_deleted FROM counted c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.place = g.place GROUP BY c.doc_id)
    SELECT d.doc_id, CASE WHEN k.doc_id IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text,
        coalesce(k.n_deleted, 0) AS n_deleted FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id"""
