"""Versioned tables: every write is a new directory, so a reader never sees half of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the completely written versions below ``root``, ascending.

    A version counts once Spark's commit marker is in place, which the job
    writes last.
    """
    fs, path = _file_system(spark, root)
    if not fs.exists(path):
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "/version=*/_SUCCESS")
    found = fs.globStatus(pattern) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def _version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version:08d}"


def read_latest(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The newest complete version; an empty table when there is none."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_version_path(root, known[-1]))


def write_version(df: DataFrame, root: str, version: int | None = None) -> int:
    """Writes a new version and returns its number.

    The version being read is never overwritten. A given ``version`` that is
    already complete is left alone, which makes a repeated batch harmless; one
    left half-written by a lost run is written anew.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    if version is None:
        version = (known[-1] if known else 0) + 1
    if version not in known:
        df.write.mode("overwrite").parquet(_version_path(root, version))
    return version


def append_version(df: DataFrame, root: str) -> int:
    """Adds a version beside those there are; ``read_all`` reads them together."""
    return write_version(df, root)


def read_version(spark: SparkSession, root: str, version: int, schema: T.StructType | str) -> DataFrame:
    """One version, which must be complete."""
    return spark.read.schema(schema).parquet(_version_path(root, version))


def read_all(
    spark: SparkSession, root: str, schema: T.StructType | str, numbered: bool = False, only: list[int] | None = None
) -> DataFrame:
    """The rows of all complete versions or ``only`` some, with their ``version`` if asked for;
    an empty table when there is none."""
    known = versions(spark, root) if only is None else only
    if not known:
        empty = spark.createDataFrame([], schema)
        return empty.selectExpr("*", "cast(null as bigint) as version") if numbered else empty
    rows = spark.read.schema(schema).parquet(*[_version_path(root, v) for v in known])
    if not numbered:
        return rows
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/[^/]*$", 1).cast("bigint")
    return rows.select("*", number.alias("version"))


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file, if it is there."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Moves a folder to a place where there is none."""
    fs, source = _file_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{path} cannot be moved to {to}")
