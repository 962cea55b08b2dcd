"""From raw documents to packed batches: five stages, each stored before the next.

``STAGES`` names them in order; each takes (spark, documents, sf_dir) and returns a
DataFrame. ``run`` applies them to the documents of a directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from profileloom.llm.golomb_dedup import keep_one_of_equal
from profileloom.llm.length_buckets import pack
from profileloom.llm.quality import keep_good
from profileloom.llm.secret_scan import redact
from profileloom.llm.shared import stored
from profileloom.llm.simhash import keep_one_of_near


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts stays."""
    return keep_one_of_equal(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near SimHash fingerprints stays."""
    return keep_one_of_near(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; every document stays."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of the documents gets its place in a padded batch."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("secret scans", secrets),
    ("packing", packing),
]

#: Model fitting, SimHash and dynamic programming have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
