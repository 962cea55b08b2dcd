"""Incremental runs driven by arriving page snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from profileloom.operators.incremental import last_per_key, page_changes, state_changes
from profileloom.operators.pages import with_clean_text
from profileloom.schemas import PAGE_TYPE
from profileloom.sources.pages import append_hash_changes, read_hash_state
from profileloom.sources.storage import write_version


def start_change_feed(
    spark: SparkSession, pages_dir: str, state_root: str, changes_root: str, checkpoint: str
) -> StreamingQuery:
    """Compares arriving page files with the stored hashes, batch by batch.

    Each micro-batch appends its changed pages to ``changes_root`` and its new hashes to
    the hash state, whose other rows it neither shuffles nor writes. Versions are numbered
    by batch, so a batch that is repeated after a failure rewrites only what it had not
    completed and reads the state from before it.
    """

    def advance(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        state = read_hash_state(batch.sparkSession, state_root, before=version)
        pages = with_clean_text(last_per_key(batch, ["url"], ["fetched_at"]))
        seen = state.join(batch.select("url"), "url", "left_semi")
        changed = page_changes(pages, seen).filter("has_changed")
        write_version(changed.select("url", "hash", "error", "fetched_at"), changes_root, version)
        append_hash_changes(state_changes(pages, seen, F.current_timestamp()), state_root, version)

    stream = spark.readStream.schema(PAGE_TYPE).parquet(pages_dir)
    return (
        stream.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_state(spark: SparkSession, state_root: str) -> DataFrame:
    """Hash state after the last completed batch."""
    return read_hash_state(spark, state_root)
