"""Logs of runs and stored states: one JSON object a line or a file, read with patience for what is broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RUN_SCHEMA = "at string, day string, sources array<struct<id: string, status: string, items: bigint, error: string>>"


def append_run(stats: DataFrame, path: str, at: Column, day: Column) -> None:
    """Append one run of stats (id, status, items, error, and nothing else of them) to the log at path.

    A run is one object, as what is asked of runs later counts by run. A run without sources is written as well.
    """
    one = F.struct("id", F.col("status").cast("string").alias("status"), F.col("items").cast("long").alias("items"), "error")
    stats.agg(F.array_sort(F.collect_list(one)).alias("sources")).select(at.alias("at"), day.alias("day"), "sources").write.mode("append").json(path)


def read_runs(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """Runs of a log in order of time, the last ones only if there is a limit; blank and broken lines are passed over."""
    runs = spark.read.text(path).select(F.from_json("value", RUN_SCHEMA).alias("r")).select("r.*").filter("at is not null")
    if limit:
        # as many rows as the limit reach one task, whatever the log's length
        runs = runs.orderBy(F.desc("at")).limit(limit)
    return runs.withColumn("run", F.row_number().over(W.orderBy("at"))) if limit else runs.orderBy("at")


def read_state(states: DataFrame, value: str = "string") -> DataFrame:
    """(key, value, readable) of states (text), each an object in JSON: a row a key.

    A state that can't be read gives one row that says so, which an empty one doesn't: nothing known isn't nothing there.
    """
    parsed = states.select(F.from_json("text", f"map<string, {value}>").alias("m"))
    known = parsed.filter("m is not null").select(F.explode("m").alias("key", "value")).withColumn("readable", F.lit(True))
    return known.unionByName(parsed.filter("m is null").select(F.lit(None).cast("string").alias("key"), F.lit(None).cast(value).alias("value"), F.lit(False).alias("readable")))
