"""Connected components on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import stored


def _mark(edges: DataFrame) -> tuple:
    """Number of distinct edges and the sum of their hashes: whether a round has changed anything, without a shuffle of them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the smallest node that can be reached.

    Rounds of large-star and small-star: every node is tied to the smallest of its neighbours, and that one's larger
    neighbours to it, until nothing changes. A node with many edges is pre-aggregated before each shuffle. Null ends and
    loops are ignored: a node with loops alone isn't returned.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a is not null and b is not null and a <> b").distinct())
    seen = _mark(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u")
        now = stored(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after = _mark(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components didn't settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
