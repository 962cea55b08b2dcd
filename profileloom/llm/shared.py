"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.runtime import fresh_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again.

    Cuts lineage: a lost executor later costs a read of finished files, and what
    was drawn from task state (partition numbers, positions) can't change.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: str | Column = "text") -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def small_batches(
    batches: Iterator[pa.RecordBatch], bytes_each: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of about ``bytes_each``, so that Python copies stay small."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * bytes_each / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over small batches."""
    return df.mapInArrow(lambda batches: work(small_batches(batches)), schema)


def sql_type(df: DataFrame, column: str) -> str:
    """The type of a column as DDL text."""
    return df.schema[column].dataType.simpleString()
