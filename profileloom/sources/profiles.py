"""Profile source: the entities of a run and their seed URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profileloom.functions.urls import base_domain
from profileloom.schemas import PROFILE_TYPE
from profileloom.sources.json_arrays import valid_elements


def read_profiles(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Profiles with their seed map; the schema is declared, never inferred.

    A file of whole-document JSON must hold its profiles in an array under ``universities``;
    ``jsonl`` and ``parquet`` hold one profile per row. All of them split over tasks.
    """
    if fmt == "json":
        entry = F.from_json("text", PROFILE_TYPE)
        return valid_elements(spark, path, key="universities").select(entry.alias("p")).select("p.*")
    if fmt not in ("jsonl", "parquet"):
        raise ValueError(f"unknown format {fmt!r}; known are json, jsonl, parquet")
    reader = spark.read.schema(PROFILE_TYPE)
    return reader.json(path) if fmt == "jsonl" else reader.format(fmt).load(path)


def with_keys(profiles: DataFrame) -> DataFrame:
    """Adds the entity key (the name itself: no two entities can share it) and the base domain.

    Of several profiles with one name a single one counts.
    """
    return profiles.dropDuplicates(["name"]).withColumn("ek", F.col("name")).withColumn(
        "base_domain", base_domain("base_url")
    )


def seed_rows(profiles: DataFrame, key: str = "ek") -> DataFrame:
    """One row per seed URL: key, category, position in its list, URL."""
    lists = profiles.select(key, F.explode("seed_urls").alias("category", "urls"))
    return lists.select(key, "category", F.posexplode("urls").alias("pos", "url"))


def entity_named(profiles: DataFrame, name: str) -> DataFrame:
    """Profiles of one name, ignoring case."""
    return profiles.filter(F.lower("name") == F.lower(F.lit(name)))


def require_entity(profiles: DataFrame, name: str) -> DataFrame:
    """Like ``entity_named``, but an unknown name is an error."""
    found = entity_named(profiles, name)
    if found.isEmpty():
        raise ValueError(f"no profile named {name!r}")
    return found
