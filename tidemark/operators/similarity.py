"""Similarity joins of token sets by prefix filtering.

Tokens are ordered by rarity, the rarest first. Two sets that are alike enough share a token among the first few of each,
so only these are joined: a token that every row has stands last and is in no prefix but of sets that have nothing
else. Sizes and places bound what two sets can still share, and a pair is made at its first shared token alone, so no
distinct() is needed. The residual likeness is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import jaccard
from tidemark.shared import stored

#: Keeps products of a threshold and a size on the right side of a whole number.
EPSILON = 1e-9


def _ranked(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """rows (id, tokens, …) with the numbers of their tokens, from rare to frequent; sets without a token go."""
    each = rows.select("id", F.explode("tokens").alias("token")).join(counts, "token")
    order = each.groupBy("id").agg(F.transform(F.array_sort(F.collect_set(F.struct("n", "number"))), lambda x: x["number"]).alias("order"))
    return rows.drop("tokens").join(order.hint("merge"), "id")


def candidates(left: DataFrame, right: DataFrame, threshold: float, by: tuple[str, ...] = (), hours: float | None = None, once: bool = False) -> DataFrame:
    """(left, right, left_order, right_order) of pairs that may be at least `threshold` alike; see similar_pairs()."""
    sides = left if once else left.select("tokens").unionByName(right.select("tokens"))
    counts = sides.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    # each row of the join carries its set, which takes less room as numbers than as words
    counts = stored(counts.withColumn("number", F.monotonically_increasing_id()))
    slot = F.floor(F.unix_micros(F.col("at").cast("timestamp")) / (hours * 3_600_000_000)) if hours is not None else F.lit(0)
    near = F.array(*[slot + d for d in (-1, 0, 1)]) if hours is not None else F.array(slot)
    size = F.size("order")
    # a set shares at least this part of its tokens, so one of the first (size - part + 1) is shared
    prefix = F.slice("order", F.lit(1), size - F.ceil(threshold * size - EPSILON).cast("int") + 1)

    def side(rows: DataFrame, x: str, slots: Column) -> DataFrame:
        ranked = _ranked(rows.filter("at is not null") if hours is not None else rows, counts)
        each = ranked.select(*by, F.col("id").alias(x), F.col("order").alias(f"{x}_order"), *([F.col("at").alias(f"{x}_at")] if hours is not None else []), F.explode(slots).alias("slot"), prefix.alias("prefix"))
        return each.select("*", F.posexplode("prefix").alias(f"{x}_place", "token")).drop("prefix")

    # tables that compress well look small enough to broadcast, and aren't
    both = side(left, "left", F.array(slot)).join(side(right, "right", near).hint("merge"), [*by, "slot", "token"])
    if once:
        both = both.filter(F.col("left") < F.col("right"))
    a, b = F.size("left_order"), F.size("right_order")
    least = F.ceil(threshold / (1 + threshold) * (a + b) - EPSILON)
    fits = (b >= threshold * a - EPSILON) & (a >= threshold * b - EPSILON) & (F.least(a - F.col("left_place"), b - F.col("right_place")) >= least)
    earlier = F.arrays_overlap(F.slice("left_order", F.lit(1), F.col("left_place")), F.slice("right_order", F.lit(1), F.col("right_place")))
    if hours is not None:
        fits = fits & (F.abs(F.unix_micros(F.col("left_at").cast("timestamp")) - F.unix_micros(F.col("right_at").cast("timestamp"))) <= int(hours * 3_600_000_000))
    # the first shared token is the first of each side's order up to it, so what stands before shares nothing
    return both.filter(fits & ~earlier).select("left", "right", "left_order", "right_order", *by)


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float, by: tuple[str, ...] = (), hours: float | None = None, once: bool = False) -> DataFrame:
    """(left, right, similarity, by…): pairs whose token sets have at least `threshold` in common of all they have.

    Both sides have id (unique), tokens (array<string>), the columns of `by`, on which pairs must be equal, and, if hours
    are given, at: pairs lie no further apart. once: both sides are the same rows, and each pair is told with the
    smaller id first. Sets without tokens, null ids, null times and null columns of `by` are in no pair.
    """
    if not 0 < threshold <= 1:
        raise ValueError("a threshold of 0 asks for all pairs")
    alike = jaccard(F.col("left_order"), F.col("right_order"))
    pairs = candidates(left, right, threshold, by, hours, once).withColumn("similarity", alike)
    return pairs.filter(F.col("similarity") >= threshold).select("left", "right", "similarity", *by)
