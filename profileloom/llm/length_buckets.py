"""Length buckets of least padding, and token-budget batches inside them.

The histogram of piece lengths over the whole corpus has at most ``max_tokens``
entries, so one small table decides the bounds: dynamic programming over the lengths
finds the cut into buckets whose padding is least. Batches hold as many padded rows as
the token budget allows; a row's place in its bucket is a global rank, worked out from
sorted partitions and the partitions' counts, never in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import sql_type, stored

MAX_TOKENS = 2048
BUCKETS = 8
BUDGET = 16_384
# Fixed value: what counts as a token where the input has no lengths of its own.
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]"


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding in all.

    ``lengths`` are distinct and ascending. cost[i] is the least padding of the first
    i lengths; a bucket over lengths j..i-1 pads its rows to the last of them.
    """
    n = len(lengths)
    rows, tokens = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * lengths)]
    cost = np.r_[0.0, np.full(n, np.inf)]
    choices = []
    for _ in range(min(buckets, n)):
        new, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        for i in range(1, n + 1):
            padding = cost[:i] + lengths[i - 1] * (rows[i] - rows[:i]) - (tokens[i] - tokens[:i])
            choice[i] = np.argmin(padding)
            new[i] = padding[choice[i]]
        cost = new
        choices.append(choice)
    bounds, i = [], n
    for choice in reversed(choices):
        if i:
            bounds.append(int(lengths[i - 1]))
            i = choice[i]
    return bounds[::-1]


def _ranked(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``rank``: its row's number within its ``bucket``, from 0, by the other keys.

    Rows are dealt by range, so that a bucket of a third of all rows spreads over many
    partitions; the counts of the partitions before give each one its offset.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            bucket = np.asarray(batch.column("bucket"))
            local = np.zeros(len(bucket), np.int64)
            for b in np.unique(bucket):
                mine = bucket == b
                local[mine] = seen.get(b, 0) + np.arange(mine.sum())
                seen[b] = seen.get(b, 0) + int(mine.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(bucket), part)), pa.array(local)],
                names=[*batch.schema.names, "part", "local"],
            )

    columns = [f"{c} {sql_type(df, c)}" for c in df.columns]
    dealt = df.repartitionByRange(*["bucket", *keys]).sortWithinPartitions(*["bucket", *keys])
    local = stored(dealt.mapInArrow(number, ", ".join([*columns, "part bigint", "local bigint"])), "ranks")
    counts = local.groupBy("bucket", "part").agg(F.count("*").alias("rows")).collect()  # partitions and bounds
    before, offsets = {}, []
    for row in sorted(counts):
        offsets.append((row["bucket"], row["part"], before.get(row["bucket"], 0)))
        before[row["bucket"]] = before.get(row["bucket"], 0) + row["rows"]
    table = df.sparkSession.createDataFrame(offsets, "bucket int, part bigint, offset bigint")
    # A row for each pair of bucket and partition that has rows: bounded by partitions + buckets.
    ranked = local.join(F.broadcast(table), ["bucket", "part"])
    return ranked.withColumn("rank", F.col("local") + F.col("offset")).drop("local", "offset", "part")


def pack(
    documents: DataFrame, tokens: str | Column | None = None, max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS, budget: int = BUDGET,
) -> DataFrame:
    """Places every token of ``documents`` (doc_id, text, ...) in a padded batch.

    A row's length is ``tokens`` (a column or expression), by default its number of
    words and signs. A longer row than ``max_tokens`` is cut into pieces; rows without
    tokens make one piece of length 0, so no document is left out. Returns one row per
    piece: doc_id, piece, start, length, bucket, bound (the padded length), batch
    (numbered within its bucket) and slot. Every batch but a bucket's last holds
    max(1, budget // bound) pieces. Null texts count as empty; null and repeated ids and
    repeated rows are rows like others; other columns are ignored; an empty table gives
    none.
    """
    if tokens is None:
        tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TOKEN))
    length = F.coalesce(F.col(tokens) if isinstance(tokens, str) else tokens, F.lit(0)).cast("bigint")
    sized = documents.select("doc_id", length.alias("n"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(max_tokens).cast("bigint"))
    pieces = stored(
        sized.select("doc_id", "n", F.posexplode(starts).alias("piece", "start")).select(
            "doc_id", "piece", "start", F.least(F.col("n") - F.col("start"), F.lit(max_tokens)).alias("length")
        ),
        "pieces",
    )
    histogram = sorted(pieces.groupBy("length").count().collect())  # max_tokens + 1 rows at most
    if not histogram:
        bounds = [0]
    else:
        lengths, counts = (np.array(x, np.int64) for x in zip(*histogram, strict=True))
        bounds = best_bounds(lengths, counts, buckets)
    bucket = F.lit(0)
    for bound in bounds[:-1]:
        bucket = bucket + (F.col("length") > bound).cast("int")
    bound = F.get(F.array(*map(F.lit, bounds)), F.col("bucket")).cast("bigint")
    mixed = F.xxhash64("doc_id", "piece", "length")
    placed = _ranked(pieces.withColumn("bucket", bucket.cast("int")).withColumn("mixed", mixed), ["mixed", "doc_id", "piece"])
    each = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{int(budget)} div greatest(bound, 1)"))
    return (
        placed.withColumn("bound", bound)
        .withColumn("each", each)
        .select(
            "doc_id", "piece", "start", "length", "bucket", "bound",
            F.expr("rank div each").alias("batch"), F.expr("rank % each").alias("slot"),
        )
    )
