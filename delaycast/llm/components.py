"""Connected components of a graph given as pairs of numbers, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import settle


def _larger_to_minimum(edges: DataFrame) -> DataFrame:
    """Point every neighbour of u that is larger than u to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.min("v").alias("low")).selectExpr("u", "least(u, low) AS low")
    least = settle(least, "least")
    return both.where("v > u").join(least, "u").selectExpr("v AS u", "low AS v").distinct()


def _smaller_to_minimum(edges: DataFrame) -> DataFrame:
    """Point u and its smaller neighbours to the smallest of them."""
    least = settle(edges.groupBy("u").agg(F.min("v").alias("low")), "least")
    moved = edges.join(least, "u").where("v <> low").selectExpr("v AS u", "low AS v")
    return moved.unionByName(least.selectExpr("u", "low AS v")).distinct()


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): every node that is in a pair of ``a`` and ``b``, with the smallest node it can reach.

    Pairs may repeat and may come in either direction; those with a null or of a node with itself
    count for nothing. The rounds needed grow with the logarithm of the longest path. Each round is
    written to the shared folder, so neither its lineage nor a lost executor costs more than one
    round. Minima are taken before rows meet by key. They are written before they are joined, so
    that each join stands between two exchanges and adaptive execution can split it where a root
    has very many members.
    """
    links = pairs.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    links = settle(links, name)
    mark = None
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return links.selectExpr("u AS node", "v AS root").unionByName(
                links.selectExpr("v AS node", "v AS root").distinct()
            )
        mark = tuple(seen)
        links = settle(_smaller_to_minimum(_larger_to_minimum(links)), name)
