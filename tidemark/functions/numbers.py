"""Rounding and scales that match half-even arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column) -> Column:
    """Rounded half to even, between 0 and 100; null stays null."""
    whole = F.bround(value).cast("int")
    return F.when(whole < 0, 0).when(whole > 100, 100).otherwise(whole)


def log_scale(value: Column, full: float) -> Column:
    """0 at 0 and below, 1 from full on, logarithmic between."""
    return F.when(value <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.log1p(value.cast("double")) / math.log1p(full)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeated values; 0 if one is empty or null."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), common / (F.size(a) + F.size(b) - common)).otherwise(F.lit(0.0))
