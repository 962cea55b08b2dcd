"""Exact duplicates through an exchange of Golomb-coded fingerprints.

Every task hashes its texts, sorts the distinct hashes of a block of rows and
sends each owner of a hash range its part as gaps in Golomb-Rice code: four to
five bytes a document, whatever the texts' length. The owner decodes its lists,
finds the values that came more than once, and answers each list with a bitmap of
positions. Only rows whose bit is set, or whose hash came twice within a block,
are suspects; only their texts are shuffled, pre-aggregated in the map tasks,
and compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import map_arrow, small_batches, sql_type, stored, text_bytes

#: Rows of one list's block, and hashes an owner is dealt on average: bounds of memory.
BLOCK_ROWS = 250_000
OWNER_HASHES = 1_000_000
#: Bits of a hash that travel. Two different texts of an owner collide with a
#: chance of OWNER_HASHES / 2**VALUE_BITS; such false suspects fail verification.
VALUE_BITS = 36
#: Bits of the suspects' filter: 16 a suspect, 2**27 (16 MB) at most.
FILTER_BITS = 1 << 27


def golomb_encode(values: np.ndarray, universe_bits: int) -> tuple[int, bytes, bytes]:
    """Sorted distinct values as (k, unary quotients, k-bit remainders) of their gaps.

    The two halves of each code word stand in streams of their own, so that
    decoding needs no loop over the values.
    """
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    mean = max((1 << universe_bits) / max(len(values), 1), 1.0)
    k = max(int(np.floor(np.log2(max(0.69 * mean, 1.0)))), 0)
    quotients, rests = gaps >> k, gaps & ((1 << k) - 1)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.ones(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 0
    bits = ((rests[:, None] >> np.arange(k)) & 1).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(bits.ravel()).tobytes()


def golomb_decode(n: int, k: int, unary: bytes, rests: bytes) -> np.ndarray:
    """The values of ``golomb_encode``."""
    if not n:
        return np.empty(0, np.int64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rests, np.uint8), count=n * k).reshape(n, k).astype(np.int64)
    return np.cumsum((quotients << k) + bits @ (1 << np.arange(k, dtype=np.int64)) + 1) - 1


def _digests(texts: pa.Array, lower: bool) -> tuple[list[bytes], list[bytes]]:
    """Normalised texts (A-Z lower-cased: ``bytes.lower`` is ASCII only) and their SHA-256."""
    normal = [t.lower() for t in texts.to_pylist()] if lower else texts.to_pylist()
    return normal, [hashlib.sha256(t).digest() for t in normal]


def _heads(digests: list[bytes]) -> np.ndarray:
    """The first eight bytes of each digest as unsigned numbers."""
    return np.frombuffer(b"".join(digests), ">u8")[::4].astype(np.uint64)


def _owner_and_value(heads: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """The owner of each hash's range (top 24 bits) and the bits that travel."""
    owner = ((heads >> np.uint64(40)) * np.uint64(owners)) >> np.uint64(24)
    return owner.astype(np.int64), (heads & np.uint64((1 << VALUE_BITS) - 1)).astype(np.int64)


def _block_rows(ids: pa.Array, digests: list[bytes], first: int, block: int, owners: int, schema: pa.Schema):
    """One block: a row for each document and a coded list for each owner."""
    owner, value = _owner_and_value(_heads(digests), owners)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]
    distinct = np.flatnonzero(new)
    list_of = np.flatnonzero(np.r_[True, owner[distinct][1:] != owner[distinct][:-1]])
    sizes = np.diff(np.r_[list_of, len(distinct)])
    place = np.arange(len(distinct)) - np.repeat(list_of, sizes)
    which = np.cumsum(new) - 1
    repeated = np.bincount(which)[which] > 1
    n = len(order)
    none = lambda kind: pa.nulls(n, kind)
    yield pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(order)), pa.array([digests[i] for i in order], pa.binary()),
            pa.array(first + order), pa.array(np.full(n, block)), pa.array(owner),
            pa.array(place[which]), pa.array(repeated),
            none(pa.int64()), none(pa.int64()), none(pa.binary()), none(pa.binary()),
        ],
        schema=schema,
    )
    lists = [
        (int(owner[distinct[start]]), size, *golomb_encode(value[distinct[start : start + size]], VALUE_BITS))
        for start, size in zip(list_of, sizes, strict=True)
    ]
    m = len(lists)
    yield pa.RecordBatch.from_arrays(
        [
            pa.nulls(m, ids.type), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()),
            pa.array(np.full(m, block)), pa.array([x[0] for x in lists], pa.int64()),
            pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()),
            pa.array([x[1] for x in lists], pa.int64()), pa.array([x[2] for x in lists], pa.int64()),
            pa.array([x[3] for x in lists], pa.binary()), pa.array([x[4] for x in lists], pa.binary()),
        ],
        schema=schema,
    )


def _send(batches: Iterator[pa.RecordBatch], owners: int, lower: bool) -> Iterator[pa.RecordBatch]:
    """A task's blocks; ``uid`` and ``block`` hold the task's number, and are stored at once."""
    task = TaskContext.get().partitionId()
    ids, digests, seen, blocks, schema = [], [], 0, 0, None

    def flush():
        nonlocal ids, digests, seen, blocks
        block = (task << 24) + blocks
        yield from _block_rows(pa.concat_arrays(ids), digests, (task << 32) + seen, block, owners, schema)
        seen, blocks, ids, digests = seen + len(digests), blocks + 1, [], []

    for batch in batches:
        schema = schema or pa.schema(
            [("doc_id", batch.column(0).type), ("sha", pa.binary()), ("uid", pa.int64()), ("block", pa.int64()),
             ("owner", pa.int64()), ("pos", pa.int64()), ("repeated", pa.bool_()), ("n", pa.int64()),
             ("k", pa.int64()), ("unary", pa.binary()), ("rests", pa.binary())]
        )
        if batch.num_rows:
            ids.append(batch.column(0))
            digests += _digests(batch.column(1), lower)[1]
            if len(digests) >= BLOCK_ROWS:
                yield from flush()
    if digests:
        yield from flush()


def _answer(lists: pa.Table) -> pa.Table:
    """An owner's answer: for each list, a bitmap of the values that other lists hold, too."""
    rows = lists.to_pylist()
    values = [golomb_decode(r["n"], r["k"], r["unary"], r["rests"]) for r in rows]
    every, counts = np.unique(np.concatenate(values), return_counts=True)
    shared = every[counts > 1]
    block, owner, words = [], [], []
    for row, mine in zip(rows, values, strict=True):
        hit = np.isin(mine, shared, assume_unique=True)
        if hit.any():
            bits = np.zeros(-(-len(hit) // 64) * 64, np.uint8)
            bits[: len(hit)] = hit
            block.append(row["block"])
            owner.append(row["owner"])
            words.append(np.packbits(bits, bitorder="little").view(np.int64).tolist())
    return pa.table(
        {"block": pa.array(block, pa.int64()), "owner": pa.array(owner, pa.int64()), "words": pa.array(words, pa.list_(pa.int64()))}
    )


def _filter_bits(heads: DataFrame, bits: int) -> bytes:
    """A bit for each suspect hash, modulo ``bits``: a fixed size that bounds what is collected."""
    spot = F.expr(f"pmod(head, {bits}) + 1")
    parts = (
        heads.groupBy(F.bitmap_bucket_number(spot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bitmap"))
        .collect()
    )
    whole = bytearray(bits // 8)
    for part in parts:
        at = (part["bucket"] - 1) * 4096
        whole[at : at + 4096] = part["bitmap"][: len(whole) - at]
    return bytes(whole)


def _suspect_texts(documents: DataFrame, suspects: DataFrame, lower: bool) -> DataFrame:
    """(sha, text) of the rows whose hash is set in the suspects' filter."""
    bits = 1 << 15
    while bits < 16 * suspects.count() and bits < FILTER_BITS:
        bits *= 2
    heads = suspects.select(F.expr("cast(conv(hex(substring(sha, 2, 7)), 16, 10) as bigint)").alias("head"))
    filled = documents.sparkSession.sparkContext.broadcast(_filter_bits(heads, bits))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(filled.value, np.uint8)
        for batch in small_batches(batches):
            normal, digests = _digests(batch.column(0), lower)
            spot = (_heads(digests) & np.uint64((1 << 56) - 1)) % np.uint64(bits)
            hit = np.flatnonzero((marks[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digests[i] for i in hit], pa.binary()), pa.array([normal[i] for i in hit], pa.binary())],
                names=["sha", "normal"],
            )

    return documents.select(text_bytes()).mapInArrow(pick, "sha binary, normal binary")


def exact_duplicates(documents: DataFrame, lower: bool = True) -> DataFrame:
    """The class of equal texts of every row of ``documents`` (doc_id, text, ...).

    Texts are equal when identical after lower-casing A-Z (or as they are, with
    ``lower=False``); null counts as empty. Returns one row per row: doc_id, keep_id
    (the largest doc_id of the class; null ids come last, and stay null in a class
    without ids), group_size, kept (true for exactly one row of each class, also where
    rows repeat a doc_id), text_sha256. Other columns of the input are ignored. An
    empty table gives an empty result. Should two different texts share a SHA-256,
    verification fails the job: no result is better than a wrong one.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owners = min(max(partitions, -(-documents.count() // OWNER_HASHES)), 1 << 24)
    sent = stored(
        map_arrow(
            documents.select("doc_id", text_bytes().alias("text")),
            lambda batches: _send(batches, owners, lower),
            f"doc_id {sql_type(documents, 'doc_id')}, sha binary, uid bigint, block bigint, owner bigint, pos bigint,"
            " repeated boolean, n bigint, k bigint, unary binary, rests binary",
        ),
        "fingerprints",
    )
    lists = sent.filter("n is not null").select("block", "owner", "n", "k", "unary", "rests")
    answers = lists.groupBy("owner").applyInArrow(_answer, "block bigint, owner bigint, words array<bigint>")
    bit = F.expr("shiftright(element_at(words, cast(pos div 64 as int) + 1), cast(pos % 64 as int)) & 1 = 1")
    rows = stored(
        sent.filter("uid is not null")
        .join(answers, ["block", "owner"], "left")
        .select("doc_id", "uid", "sha", (F.col("repeated") | F.coalesce(bit, F.lit(False))).alias("suspect")),
        "suspects",
    )
    suspects = rows.filter("suspect")
    verified = (
        _suspect_texts(documents, suspects, lower)
        .groupBy("sha", "normal")
        .agg(F.count("*").alias("copies"))
        .groupBy("sha")
        .agg(F.count("*").alias("texts"))
    )
    groups = suspects.groupBy("sha").agg(
        F.max(F.struct("doc_id", "uid")).alias("top"), F.count("*").alias("group_size")
    )
    classes = stored(groups.join(verified, "sha"), "classes")
    same = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.lit("two different texts have one SHA-256")).cast("bigint")
    )
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    grouped = suspects.join(classes, "sha").select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), same.alias("group_size"),
        (F.col("uid") == F.col("top.uid")).alias("kept"), sha,
    )
    single = rows.filter("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), sha,
    )
    return single.unionByName(grouped)


def keep_one_of_equal(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each class of equal texts; all columns stay.

    Rows leave by (doc_id, SHA-256); where rows repeat a doc_id and a text, one of
    them stays.
    """
    decided = stored(exact_duplicates(documents), "exact")
    dropped = decided.filter("not kept").select(
        F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha")
    )
    kept_too = decided.filter("kept").join(
        dropped.distinct(), (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.unhex("text_sha256") == F.col("_sha")), "left_semi"
    )
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), _UPPER, _UPPER.lower()), 256)
    if not kept_too.isEmpty():  # repeated rows: their key can't tell the kept one from the others
        key, number = "_digest", "_number"
        from pyspark.sql import Window

        marked = documents.withColumn(key, digest)
        first = F.row_number().over(Window.partitionBy("doc_id", key).orderBy(F.lit(0)))
        documents = marked.withColumn(number, first).filter(F.col(number) == 1).drop(key, number)
        decided = decided.filter("kept").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha"))
        return documents.join(decided, _matches(documents, digest), "left_semi")
    return documents.join(dropped, _matches(documents, digest), "left_anti")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _matches(documents: DataFrame, digest):
    return documents["doc_id"].eqNullSafe(F.col("_id")) & (F.unhex(digest) == F.col("_sha"))
