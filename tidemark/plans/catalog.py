"""The catalogue of named queries and of their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import reporting, scoring, streams, watching
from tidemark.plans.base import ORACLES, QUERIES

__all__ = ["queries", "oracle_sql", "reporting", "scoring", "streams", "watching"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
