"""What all machines share: the folder for what a job has to find again when an executor is lost, and this package."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session that names none gets a folder of its own.

    On a cluster without one this raises: an executor's own disk is lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named and not context.getCheckpointDir() and context.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir isn't set: name a folder that all machines share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return named or context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder, with its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def importable(spark: SparkSession) -> None:
    """Workers find this package even if the driver runs from another folder."""
    root, env = str(Path(__file__).parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
