"""Record and ground-truth sources, record sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profileloom.fixed_values import CATEGORIES
from profileloom.functions.arrays import computed
from profileloom.operators.incremental import last_per_key
from profileloom.operators.records import flatten_fields
from profileloom.operators.responses import stored_record_sql
from profileloom.schemas import RECORD_TYPE, TRUTH_TYPE
from profileloom.sources.json_arrays import valid_elements

FLAT_COLUMNS = ["university_name", "field_name", "field_json", "confidence", "flags_json"]


def parse_records(lines: DataFrame) -> DataFrame:
    """Well-formed records of ``lines(ord, line)``, one JSON record per line.

    Records that fail the schema are dropped one by one; of several with one
    name the last stays.
    """
    valid = computed(lines, F.expr(stored_record_sql("line")), "record", "ord").select("ord", "record.*")
    return last_per_key(valid, ["university_name"], ["ord"])


def _parse_placed(lines: DataFrame) -> DataFrame:
    """``parse_records`` of ``lines(place, line)``, whose ``ord`` comes from the same reading of a line."""
    read = computed(lines, F.expr(stored_record_sql("line", with_place=True)), "read", "place")
    valid = read.select(F.coalesce("read.ord", "place").alias("ord"), "read.record.*")
    return last_per_key(valid, ["university_name"], ["ord"])


def _path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


_TEXT_FORMATS = ("json", "jsonl")
#: Records per compressed text file, which one task reads.
LINES_PER_FILE = 20_000
#: How text is compressed: to about an eleventh, in half the time of the usual level.
_GZIP = {"compression": "gzip", "zlib.compress.level": "THREE"}


def _known_format(fmt: str, formats: tuple[str, ...]) -> None:
    if fmt not in formats:
        raise ValueError(f"unknown format {fmt!r}; known are {', '.join(formats)}")


def _place(file: Column, within: Column) -> Column:
    """One number for a place within a file: below 2**40, as a file's bytes are."""
    return F.shiftleft(file.cast("bigint"), 40) + within


def record_lines(spark: SparkSession, path: str, fmt: str = "jsonl") -> DataFrame:
    """Raw record texts ``(ord, line)`` of a path; no rows when it is missing.

    ``json`` is one array document (or one object) a file, ``jsonl`` holds one record per line;
    both split over tasks. ``ord`` is what a line carries under that name, else its place: files by
    path, then lines as they stand.
    """
    _known_format(fmt, _TEXT_FORMATS)
    if not _path_exists(spark, path):
        return spark.createDataFrame([], "ord bigint, line string")
    if fmt == "json":
        return valid_elements(spark, path).select(_place(F.col("file"), F.col("pos")).alias("ord"), F.col("text").alias("line"))
    position = F.try_variant_get(F.try_parse_json("line"), "$.ord", "bigint")
    return _placed_lines(spark, path).select(F.coalesce(position, "place").alias("ord"), "line")


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their ``place``."""
    # The scan numbers a task's lines in order and a block lies in one task, so a line's number less
    # its block's first one grows along the block. Only a row per block is shuffled, never a text.
    scanned = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
    )
    blocks = scanned.groupBy("path", "block").agg(F.min("row").alias("first"))
    blocks = blocks.withColumn("file", F.dense_rank().over(Window.orderBy("path")) - 1)
    placed = scanned.join(F.broadcast(blocks), ["path", "block"])
    within = F.col("block") + F.col("row") - F.col("first") + 1
    return placed.select(_place(F.col("file"), within).alias("place"), "line")


def _stored_columns() -> T.StructType:
    return T.StructType([T.StructField("ord", T.LongType()), *RECORD_TYPE.fields])


def _read_columnar(spark: SparkSession, path: str) -> DataFrame:
    """Records as ``write_records`` stores them; only the asked columns and fields are read."""
    if not _path_exists(spark, path):
        return spark.createDataFrame([], _stored_columns())
    return spark.read.schema(_stored_columns()).parquet(path)


#: Up to so many repeated names are broadcast to the readers of stored records.
BROADCAST_NAMES = 2_000_000


def _last_of_names(stored: DataFrame) -> DataFrame:
    """The last row of each name by ``ord``. Names are counted at once, as reading that column
    alone is cheap; then only rows of repeated names are shuffled."""
    repeated = stored.groupBy("university_name").count().filter("count > 1").select("university_name")
    n = repeated.count()
    if n == 0:
        return stored
    if n > BROADCAST_NAMES:
        return last_per_key(stored, ["university_name"], ["ord"])
    few = F.broadcast(repeated)
    last = last_per_key(stored.join(few, "university_name", "left_semi"), ["university_name"], ["ord"])
    return stored.join(few, "university_name", "left_anti").unionByName(last).select(*stored.columns)


def read_records(spark: SparkSession, path: str, fmt: str = "jsonl") -> DataFrame:
    """Stored records that fit the schema, one per name, with their position ``ord``."""
    _known_format(fmt, (*_TEXT_FORMATS, "parquet"))
    if fmt == "parquet":
        return _last_of_names(_read_columnar(spark, path).filter("university_name is not null"))
    if fmt == "jsonl" and _path_exists(spark, path):
        return _parse_placed(_placed_lines(spark, path))
    return parse_records(record_lines(spark, path, fmt))


def read_raw_records(spark: SparkSession, path: str, fmt: str = "jsonl") -> DataFrame:
    """Stored records for lookups: declared types, but nothing is dropped or deduplicated."""
    _known_format(fmt, (*_TEXT_FORMATS, "parquet"))
    if fmt == "parquet":
        return _read_columnar(spark, path)
    parsed = F.from_json("line", RECORD_TYPE, {"mode": "PERMISSIVE"})
    return record_lines(spark, path, fmt).select("ord", parsed.alias("r")).select("ord", "r.*")


def write_records(records: DataFrame, path: str, fmt: str = "jsonl") -> None:
    """One record per line or row, nulls kept, ``ord`` included when present.

    ``parquet`` is the store for large tables: it splits, keeps types and lets a lookup
    read single fields. Text is compressed, in files of ``LINES_PER_FILE`` records at most, as
    such a file doesn't split.
    """
    _known_format(fmt, ("jsonl", "parquet"))
    writer = records.write.mode("errorifexists")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.options(ignoreNullFields="false", maxRecordsPerFile=LINES_PER_FILE, **_GZIP).json(path)


def write_flat(records: DataFrame, path: str) -> None:
    """CSV of one row per (record, category), compressed in files of ``LINES_PER_FILE`` records at most."""
    flat = flatten_fields(records).select(*FLAT_COLUMNS)
    rows = LINES_PER_FILE * len(CATEGORIES)
    flat.write.mode("errorifexists").options(header=True, quote='"', escape='"', maxRecordsPerFile=rows, **_GZIP).csv(path)


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """The CSV written by ``write_flat``."""
    columns = ", ".join(f"{c} {'double' if c == 'confidence' else 'string'}" for c in FLAT_COLUMNS)
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": False}
    return spark.read.schema(columns).options(**options).csv(path)


def read_truth(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Sparse ground truth: ``json`` is an array document (or one object), ``jsonl`` an
    object per line, ``parquet`` a row per object. All objects count, whatever the format."""
    _known_format(fmt, (*_TEXT_FORMATS, "parquet"))
    if fmt != "json":
        reader = spark.read.schema(TRUTH_TYPE)
        return reader.json(path) if fmt == "jsonl" else reader.parquet(path)
    entry = F.from_json("text", TRUTH_TYPE)
    return valid_elements(spark, path).select(entry.alias("t")).select("t.*")
