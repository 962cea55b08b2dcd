"""Unrolling computed arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unroll(df: DataFrame, array: Column, name: str, *keep: str | Column) -> DataFrame:
    """``keep`` and one row per element of a computed array.

    For a plain explode Spark infers a filter on the array's size, pushes it to
    the scan and so computes the array twice. The outer form infers nothing;
    rows of empty arrays are dropped afterwards.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def unroll_with_position(
    df: DataFrame, array: Column, position: str, name: str, *keep: str | Column
) -> DataFrame:
    """Like ``unroll``, with the position of each element."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, name))
    return rows.filter(F.col(position).isNotNull())


def computed(df: DataFrame, value: Column, name: str, *keep: str | Column) -> DataFrame:
    """``keep`` and a costly non-null value, evaluated exactly once per row.

    Filters on a projected value are pushed below the projection and so
    evaluate it again; they cannot pass the generator used here. Rows whose
    value is null are dropped.
    """
    return unroll(df, F.array(value), name, *keep)
