"""What the corpus operators share: session tuning, stable storage of intermediate tables, text folding."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import importable, shared_dir, stored

__all__ = ["ascii_lower", "crc32_of", "gathered", "release", "stored", "tune", "written"]

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tune(spark: SparkSession, rows: int = 256) -> None:
    """Small Arrow batches: texts differ in length by five orders of magnitude, and a Python worker holds one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    importable(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more; call it after stored()."""
    # the first round drops Python's hold on the JVM's objects, the second finds them free
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, computed once: for many small rows, which take less room so than in a checkpoint.

    The shuffle files of computing it are deleted when it is written, not when the driver's garbage is collected.
    """
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def gathered(batches: Iterator[pa.RecordBatch], at: int, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many bytes in column at: small for Arrow's transfer, large for array code."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.column(at).get_total_buffer_size()
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; null becomes empty. The quick way serves texts that are all ASCII."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, UPPER.lower()))


def crc32_of(col: Column) -> Column:
    """Unsigned CRC-32 of a column's UTF-8 text; null counts as empty."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))
