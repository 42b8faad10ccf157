"""Sharding by sampled splitters, on DataFrame functions only.

Keys are drawn with a chance in proportion to their size; quantiles of the draw are the splitters that range-partition
the records, so each range holds about the same bytes; a range that still holds too many is subdivided. Exact sums over
ranges and then within each give every record's place in the whole order, and the place gives the shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import crc32_of, stored

#: Bytes that a record has besides its text.
RECORD_BYTES = 8
#: Keys drawn for each range.
DRAWS = 32
#: Ranges at most; the draw has at most DRAWS times as many keys.
MAX_RANGES = 1024
#: A range with more than so many times its fair share is subdivided.
OVERFULL = 1.5
#: Equal texts stay in one shard if together they have at most this part of a shard.
WHOLE_GROUP = 0.02

LOWEST = -(1 << 63)


def _range_of(key: Column, tie: Column, splitters: list[tuple[int, int]]) -> Column:
    """How many splitters are at or below (key, tie): a balanced tree of comparisons."""

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        k, t = splitters[mid]
        below = (key < k) if t == LOWEST else (key < k) | ((key == k) & (tie < t))
        return F.when(below, pick(low, mid)).otherwise(pick(mid + 1, high))

    return pick(0, len(splitters))


def shard(docs: DataFrame, n_shards: int = 24, n_ranges: int | None = None) -> DataFrame:
    """A shard and a gapless slot for each row of docs (doc_id, text), by the law `bytes`: shard sizes are near equal.

    Records are ordered by a hash of the text, then of the identifier. Equal texts are neighbours: a small group stays
    in one shard, a large one is divided between neighbouring shards. Null text: size 8, the checksum of no bytes; it
    stands with empty texts. A null doc_id is a value like any other; rows that repeat get a slot each. Empty table: no
    rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(text)
    records = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"), crc32_of(F.col("text")).alias("text_crc32"), key.alias("key"),
            F.xxhash64(F.lit("tie"), "doc_id").alias("tie"),
        )
    )
    n_ranges = n_ranges or min(MAX_RANGES, max(2 * n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # the smallest -ln(u) / size are a draw without replacement with chances in proportion to size
    u = (F.pmod(F.xxhash64(F.lit("draw"), "tie", "key"), F.lit(1 << 30)) + 1) / float((1 << 30) + 1)
    drawn = sorted((r.key, r.tie) for r in records.select("key", "tie", (-F.log(u) / F.col("size")).alias("at")).orderBy("at", "key", "tie").limit(DRAWS * n_ranges).collect())
    cuts = [drawn[len(drawn) * n // n_ranges] for n in range(1, n_ranges)] if drawn else []
    # one splitter in a group of equal texts moves to its start; a group with more is cut between its records
    keys = [k for k, _ in cuts]
    splitters = sorted({(k, t if keys.count(k) > 1 else LOWEST) for k, t in cuts})
    ranged = records.withColumn("range", _range_of(F.col("key"), F.col("tie"), splitters))
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()  # a row a range: at most MAX_RANGES
    total = sum(r.bytes for r in sizes)
    fair = total / max(1, len(sizes))
    pieces = {r.range: math.ceil(r.bytes / fair) for r in sizes if r.bytes > OVERFULL * fair and r.n > 1}
    # part by part keeps equal texts together, as long as the text isn't what makes the range overfull
    hot = {k for k in keys if keys.count(k) > 1}
    dealt = F.when(F.col("key").isin(*hot), F.col("tie")).otherwise(F.xxhash64("key")) if hot else F.xxhash64("key")
    part = F.lit(0)
    for r, n in pieces.items():
        part = F.when(F.col("range") == r, F.pmod(dealt, F.lit(n)).cast("int")).otherwise(part)
    ranged = ranged.withColumn("part", part)
    counted = ranged.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect() if pieces else [(r.range, 0, r.bytes, r.n) for r in sizes]
    rows, at_bytes, at_rows = [], 0, 0
    for r, p, size, n in sorted(tuple(x) for x in counted):
        rows.append(F.struct(F.lit(r).alias("range"), F.lit(p).alias("part"), F.lit(at_bytes).cast("long").alias("bytes_before"), F.lit(at_rows).cast("long").alias("rows_before")))
        at_bytes, at_rows = at_bytes + size, at_rows + n
    starts = F.array(*rows) if rows else F.array().cast("array<struct<range:int,part:int,bytes_before:bigint,rows_before:bigint>>")
    offsets = spark.range(0, 1, 1, 1).select(F.inline(starts))
    share = max(1.0, total / n_shards)
    whole = W.partitionBy("range", "part")
    order = whole.orderBy("key", "tie", "doc_id")
    group = W.partitionBy("range", "part", "key")
    placed = (
        ranged.join(F.broadcast(offsets), ["range", "part"])
        .withColumn("end", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("row", F.col("rows_before") + F.row_number().over(order) - 1)
        .withColumn("group_bytes", F.sum("size").over(group))
        .withColumn("group_end", F.max("end").over(group))
    )
    own = F.col("bytes_before") + F.col("end") - F.col("size") / 2
    middle = F.when(F.col("group_bytes") <= WHOLE_GROUP * share, F.col("bytes_before") + F.col("group_end") - F.col("group_bytes") / 2).otherwise(own)
    placed = placed.withColumn("shard", F.least(F.floor(middle / share), F.lit(n_shards - 1)).cast("int"))
    placed = stored(placed.select("doc_id", "size", "text_crc32", "shard", "row"))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # a row a shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
