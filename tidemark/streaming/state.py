"""Structured Streaming forms of the stateful rules. Times are part of the rows; nothing reads a clock."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ledgers


def first_seen(stream: DataFrame, key: list[str], at: str) -> DataFrame:
    """(key…, first_observed_at, observations) of each key so far. Write-once keys never expire, so there is no watermark.

    Write it in update mode: a batch tells the keys that it has touched alone, and latest() puts them together.
    """
    return stream.groupBy(*key).agg(F.min(at).alias("first_observed_at"), F.count("*").alias("observations"))


def recent_only(stream: DataFrame, published: str, seen: str, days: int = 7) -> DataFrame:
    """Late data is archive by the distance of two times in the row, not by how far the stream has come."""
    lead = F.floor((F.unix_micros(F.col(seen).cast("timestamp")) - F.unix_micros(F.col(published).cast("timestamp"))) / 86_400_000_000)
    return stream.filter(F.coalesce(lead <= days, F.lit(True)))


def courses(batch: DataFrame, before: DataFrame | None) -> DataFrame:
    """(source, step) after a batch of runs (source, seq, outcome): what came before, then the batch in its own order.

    A batch is one step a source, the same fold as in batch; a row that comes in a later batch counts after those before
    it. Keep it with merge_into() and read it with ledgers.health_of().
    """
    now = ledgers.course(batch)
    if before is None:
        return now
    both = now.select("source", F.col("step").alias("new")).join(before.select("source", F.col("step").alias("old")), "source", "full")
    step = F.when(F.col("old").isNull(), F.col("new")).when(F.col("new").isNull(), F.col("old")).otherwise(ledgers.then(F.col("old"), F.col("new")))
    return both.select("source", step.alias("step"))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The last committed version of a table that merge_into() keeps, or None before the first one."""
    last = _commits(spark, path)
    last = last and last.agg(F.max_by("folder", "version").alias("folder")).first()
    return spark.read.parquet(f"{path}/{last.folder}") if last and last.folder else None


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMITS).parquet(f"{path}/commits")
    except AnalysisException:
        return None


COMMITS = "version long, folder string, run string, number long"


def merge_into(
    path: str, key: list[str], combine: Callable[[DataFrame, DataFrame | None], DataFrame], run: str = "", before_commit: Callable[[int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that keeps one row a key in a table of versions; one writer at a time.

    A batch writes a version into a folder of its own, then a row of the commit table that names it. Readers see the last
    version that is named, never half of one; a batch that fails before its commit leaves a folder that nothing names. A
    batch of a run that has been committed already is left out, so repeating it changes nothing. The state belongs to the
    path, not to a checkpoint: another run, with another checkpoint, goes on from the last version. before_commit is
    called between the two writes.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, done = batch.sparkSession, _commits(batch.sparkSession, path)
        last = done.agg(F.max("version").alias("version"), F.max_by("folder", "version").alias("folder"), F.count_if((F.col("run") == run) & (F.col("number") == number)).alias("again")).first() if done else None
        if last and last.again:
            return
        folder = f"data/{uuid.uuid4().hex}"
        before = spark.read.parquet(f"{path}/{last.folder}") if last and last.folder else None
        combine(batch, before).dropDuplicates(key).write.parquet(f"{path}/{folder}")
        if before_commit:
            before_commit(number)
        version = (last.version or 0) + 1 if last else 1
        spark.createDataFrame([(version, folder, run, number)], COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")

    return write


def cursors(batch: DataFrame, before: DataFrame | None) -> DataFrame:
    """(source, cursor, failures) after a batch of fetches (source, ts, ok): a failed fetch doesn't move the cursor."""
    seen = batch.groupBy("source").agg(F.max(F.when(F.col("ok"), F.col("ts"))).alias("cursor"), F.count_if(~F.col("ok")).alias("failures"))
    both = seen if before is None else seen.unionByName(before)
    return both.groupBy("source").agg(F.max("cursor").alias("cursor"), F.sum("failures").alias("failures"))


def latest(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of rows that batches have told of keys, the last of each; rows have the batch's number."""
    rest = [c for c in rows.columns if c not in (*key, "batch")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*key, "x.*")
