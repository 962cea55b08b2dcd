"""Page snapshots and the stored page hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from profileloom.functions.joins import copied_if_few
from profileloom.operators.incremental import last_per_key
from profileloom.schemas import HASH_STATE_TYPE, PAGE_TYPE
from profileloom.sources.storage import read_all, read_version, versions, write_version


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fetched pages: ``url, status_code, html, fetched_at, error``."""
    return spark.read.schema(PAGE_TYPE).format(fmt).load(path)


#: Share of the whole state's rows beyond which changes are merged into it.
MERGE_SHARE = 0.2


def _changes(root: str) -> str:
    return f"{root.rstrip('/')}/changes"


def read_hash_state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Page hashes of the latest run, or of the last one before a version; empty before the first.

    A whole state and the changes since. The newest change of a URL counts; of the whole
    state only the URLs meet the changes, so that it isn't shuffled while they are few.
    """
    names = HASH_STATE_TYPE.fieldNames()
    whole = [v for v in versions(spark, root) if before is None or v < before]
    base = whole[-1] if whole else 0
    later = [v for v in versions(spark, _changes(root)) if v > base and (before is None or v < before)]
    rows = read_version(spark, root, base, HASH_STATE_TYPE) if whole else spark.createDataFrame([], HASH_STATE_TYPE)
    if not later:
        return rows
    changes = read_all(spark, _changes(root), HASH_STATE_TYPE, numbered=True, only=later)
    newest = last_per_key(changes, ["url"], ["version"]).select(*names)
    replaced = copied_if_few(newest.select("url"), changes.count())  # from the files' footers
    return rows.join(replaced, "url", "left_anti").select(*names).unionByName(newest)


def write_hash_state(state: DataFrame, root: str, version: int | None = None) -> int:
    """Stores page hashes as a new version, which replaces all changes up to it."""
    if version is None:
        version = _newest(state.sparkSession, root) + 1
    return write_version(state.select(*HASH_STATE_TYPE.fieldNames()), root, version)


def _newest(spark: SparkSession, root: str) -> int:
    return max([0, *versions(spark, root), *versions(spark, _changes(root))])


def append_hash_changes(changes: DataFrame, root: str, version: int | None = None, merge_share: float = MERGE_SHARE) -> int:
    """Stores the changed hashes of a run (see ``state_changes``) as a new version.

    What is written follows the run, not the state. Where the changes since the last whole
    state exceed ``merge_share`` of its rows, they are merged into a new whole one. A
    ``version`` that is complete already is left alone, so a repeated batch is harmless.
    """
    spark = changes.sparkSession
    if version is None:
        version = _newest(spark, root) + 1
    write_version(changes.select(*HASH_STATE_TYPE.fieldNames()), _changes(root), version)
    whole = versions(spark, root)
    base = whole[-1] if whole else 0
    later = [v for v in versions(spark, _changes(root)) if v > base]
    stored = read_version(spark, root, base, HASH_STATE_TYPE).count() if whole else 0  # from the files' footers
    added = read_all(spark, _changes(root), HASH_STATE_TYPE, only=later).count() if later else 0
    if added > merge_share * stored:
        write_version(read_hash_state(spark, root), root, max(later))
    return version
