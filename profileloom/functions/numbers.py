"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_close(truth: Column, value: Column, tolerance: float = 0.0) -> Column:
    """Equality, or closeness relative to ``truth``; a null on either side is false."""
    if tolerance > 0:
        relative = F.abs(truth - value) / F.abs(F.nullif(truth, F.lit(0.0)))
        match = F.when(truth == 0, value == 0).otherwise(relative <= tolerance)
    else:
        match = truth == value
    return F.coalesce(match, F.lit(False))


def clamp_unit(value: Column) -> Column:
    """The value limited to [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
