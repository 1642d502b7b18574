"""Left lookup join of a large frame against a dimension, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.operators.sizing import Sized, fits_broadcast, sized


def _all_equal(pairs: list[tuple[str, str]], null_safe: bool = False) -> Column:
    operator = "<=>" if null_safe else "="
    return F.expr(" AND ".join(f"`{a}` {operator} `{b}`" for a, b in pairs))


# Fact key columns of a join -> hash of a hot key (``key_hash``) -> into how many copies it is split.
Splits = dict[tuple[str, ...], dict[int, int]]

# Key types whose equal values have equal hashes.
_HASHED = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "binary"}


def key_hash(columns: tuple[str, ...] | list[str]) -> str:
    """SQL of the hash by which ``Splits`` name a key."""
    return f"xxhash64({', '.join(f'`{c}`' for c in columns)})"


# Copies of a dimension row in a stream's shuffle join, where hot keys cannot be counted beforehand.
STREAM_COPIES = 16


def left_lookup(
    facts: DataFrame,
    dimension: DataFrame | Sized,
    keys: list[tuple[str, str]],
    limit: int | None = None,
    profile: DataFrame | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """``facts LEFT JOIN dimension`` on ``keys`` (fact column, dimension column).

    The dimension's key columns are dropped from the result; its other columns must not clash
    with fact columns. A dimension within the broadcast bound is broadcast, so the facts are not
    shuffled at all. Beyond it both sides are shuffled and hot fact keys spread over several
    tasks; ``profile`` names a cheaper frame with the same keys to find them on, and ``splits`` says
    which they are without counting. A stream cannot be counted first, so there every key is spread
    over a fixed number of tasks.
    """
    side = sized(dimension)
    joined_keys = [f"__key_{i}" for i in range(len(keys))]
    right = side.frame.withColumnsRenamed({b: k for (_, b), k in zip(keys, joined_keys)})
    pairs = [(a, k) for (a, _), k in zip(keys, joined_keys)]
    if fits_broadcast(side, limit):
        joined = facts.join(F.broadcast(right), _all_equal(pairs), "left")
    elif facts.isStreaming:
        joined = _salted_join(
            facts.withColumn("__copies", F.lit(STREAM_COPIES)), right.withColumn("__copies", F.lit(STREAM_COPIES)), pairs
        )
    elif splits is not None and tuple(a for a, _ in keys) in splits and _same_hashes(facts, right, pairs):
        joined = _split_join(facts, right, pairs, splits[tuple(a for a, _ in keys)])
    else:
        joined = _spread_join(facts, right, pairs, facts if profile is None else profile)
    return joined.drop(*joined_keys)


def hot_keys(facts: DataFrame, columns: list[str], tasks: int) -> DataFrame:
    """Keys holding more than 1/tasks of all rows, with the number of copies each is split into.

    There are fewer than ``tasks`` such keys whatever the data, and their copies add up to less
    than twice ``tasks``, so the result is always small. Counts are combined before the shuffle.
    """
    counts = facts.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    total = facts.agg(F.count(F.lit(1)).alias("__total")).scalar()
    share = F.col("__n").cast("double") * tasks / total
    return counts.withColumn("__share", share).where("__share > 1").selectExpr(
        *[f"`{c}`" for c in columns], "CAST(ceil(__share) AS INT) AS __copies"
    )


def _spread_join(
    facts: DataFrame, dimension: DataFrame, pairs: list[tuple[str, str]], profile: DataFrame
) -> DataFrame:
    """Shuffle join in which every hot key is split into the copies ``hot_keys`` gives it."""
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fact_keys = [a for a, _ in pairs]
    hot_names = {a: f"__hot_{i}" for i, a in enumerate(fact_keys)}
    hot = F.broadcast(hot_keys(profile, fact_keys, tasks).withColumnsRenamed(hot_names))

    left = facts.join(hot, _all_equal([(a, hot_names[a]) for a in fact_keys], null_safe=True), "left")
    right = dimension.join(hot, _all_equal([(b, hot_names[a]) for a, b in pairs]), "left")
    return _salted_join(left.drop(*hot_names.values()), right.drop(*hot_names.values()), pairs)


def _same_hashes(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> bool:
    kinds = [(left.schema[a].dataType.simpleString(), right.schema[b].dataType.simpleString()) for a, b in pairs]
    return all(a == b and a in _HASHED for a, b in kinds)


def _split_join(facts: DataFrame, dimension: DataFrame, pairs: list[tuple[str, str]], copies: dict[int, int]) -> DataFrame:
    """Shuffle join with the given copies by key hash, of which there are fewer than tasks."""
    if not copies:
        return facts.join(dimension, _all_equal(pairs), "left")
    known = facts.sparkSession.createDataFrame(list(copies.items()), "__hash bigint, __copies int")

    def marked(side: DataFrame, columns: list[str]) -> DataFrame:
        return side.join(F.broadcast(known), F.expr(f"{key_hash(columns)} = __hash"), "left").drop("__hash")

    return _salted_join(marked(facts, [a for a, _ in pairs]), marked(dimension, [b for _, b in pairs]), pairs)


def _salted_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Left join of sides that both name in ``__copies`` how often their key is split (NULL: not).

    Rows of one key differ in their other columns or, when they are copies of one another, in the
    input partition they come from; either spreads them, and both repeat on a retry.
    """
    hashable = [f"`{f.name}`" for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = f"pmod(xxhash64(spark_partition_id(), {', '.join(hashable)}), coalesce(__copies, 1))"
    left = left.withColumn("__salt", F.expr(f"CAST({spread} AS INT)")).drop("__copies")
    right = right.withColumn("__copy", F.expr("explode(sequence(0, coalesce(__copies, 1) - 1))")).drop("__copies")
    return left.join(right, _all_equal([*pairs, ("__salt", "__copy")]), "left").drop("__salt", "__copy")
