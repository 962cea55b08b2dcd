"""The trie of conversations' turns, peeled from its deepest turns upwards.

A conversation becomes a path: for each turn a digest of all turns so far and the code
points of its text. Equal conversations become one row first. Then turns are peeled off
the ends of paths: at each depth the paths that end there meet the nodes that survived
one turn deeper, equal paths become one node with the sums of its subtree, and its last
turn is stripped. Turns that no other conversation shares need no regrouping: they are
peeled within their row, so the number of rounds is the depth down to which different
conversations agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import map_arrow, small_batches, stored

# Conversations of a block of ids share their first one's first turns, 0 to 5 of them.
BLOCK, SHARED_MOST = 100, 6
#: 128 bits of SHA-256 stand for a sequence of turns, 4 bytes for its last text's code points.
_KEY, _TURN = 16, 20
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_BLOCK_BYTES = 1 << 18


def rebuild(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (array of digest, chars) of every rebuilt conversation.

    Of ``conversations`` (conv_id, turn, role, text, ...) every conv_id c gets the first h
    turns of conversation c - c % 100 and its own behind its first h, h = crc32(c) % 6. Turns
    are ordered by ``turn``, null first, those of one number by their digests; repeated
    rows are turns of their own. Null role or text counts as empty. Rows without conv_id
    make one conversation, whose id is written as empty text and whose base is absent.
    Texts leave at once as digests; a row holds the turns of one conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turn = F.struct("turn", F.substring(F.unhex(F.sha2(told, 256)), 1, _KEY).alias("digest"), F.char_length(text).alias("chars"))
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = stored(own.select("conv_id", F.transform("turns", lambda t: t.dropFields("turn")).alias("turns")), "turns")
    first = own.filter(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, SHARED_MOST - 1).alias("_first"))
    h = (F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % SHARED_MOST).cast("int")
    joined = own.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % BLOCK, "_h": h}).join(first, "_base", "left")
    shared = F.slice(F.coalesce("_first", F.array().cast(own.schema["turns"].dataType)), F.lit(1), F.col("_h"))
    return joined.select("conv_id", F.concat(shared, F.slice("turns", F.col("_h") + 1, F.size("turns"))).alias("turns"))


def _paths(rebuilt: DataFrame) -> DataFrame:
    """conv_id and path: ``_TURN`` bytes for each turn."""

    def path(turns: list[dict]) -> bytes:
        key, parts = b"", []
        for turn in turns:
            key = hashlib.sha256(key + turn["digest"]).digest()[:_KEY]
            parts += key, turn["chars"].to_bytes(_TURN - _KEY, "big")
        return b"".join(parts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = pa.array(map(path, batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), paths], names=["conv_id", "path"])

    return map_arrow(rebuilt.select("conv_id", "turns"), work, "conv_id bigint, path binary")


def _last(path: str | Column) -> Column:
    """The last turn of a path, which alone tells paths apart; empty for the root."""
    path = F.col(path) if isinstance(path, str) else path
    return F.substring(path, F.greatest(F.octet_length(path) - _TURN + 1, F.lit(1)), F.lit(_TURN))


def _end_digests(paths: DataFrame) -> DataFrame:
    """_end (last turn) and ends_sha256 of the conversations that end there, without gathering them.

    A digest reads its ids one after another. Ranges of (end, id) are sorted and written
    out as blocks of text by many tasks; then one pass over a node's blocks feeds them to
    its digest, holding one at a time.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, end, ids, held = TaskContext.get().partitionId(), 0, None, [], 0
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ends, numbers, texts = zip(*rows, strict=True)
            rows.clear()
            columns = [pa.array(ends, pa.binary()), pa.array([part] * len(ends)), pa.array(numbers, pa.int64()), pa.array(texts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["end", "part", "number", "ids"])

        for batch in batches:
            for now, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if end is not None and (now != end or held >= _BLOCK_BYTES):
                    rows.append((end, number, b",".join(ids)))
                    number, ids, held = number + 1, [], 0
                    if len(rows) >= 10_000 or len(rows[-1][2]) >= _BLOCK_BYTES:
                        yield flush()
                end = now
                ids.append(b"" if conv_id is None else b"%d" % conv_id)
                held += len(ids[-1]) + 1
        if end is not None:
            rows.append((end, number, b",".join(ids)))
            yield flush()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, digest = None, None
        for batch in batches:
            done = []
            for now, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now == end:
                    digest.update(b",")
                else:
                    if end is not None:
                        done.append((end, digest.hexdigest()))
                    end, digest = now, hashlib.sha256()
                digest.update(ids)
            yield _pairs(done)
        if end is not None:
            yield _pairs([(end, digest.hexdigest())])

    def _pairs(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([e for e, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["end", "ends_sha256"]
        )

    ordered = paths.select(_last("path").alias("end"), "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    written = ordered.mapInArrow(lambda b: blocks(small_batches(b)), "end binary, part bigint, number bigint, ids binary")
    written = stored(written, "ends")  # their numbers come from tasks
    together = written.repartition("end").sortWithinPartitions("end", "part", "number").select("end", "ids")
    return together.mapInArrow(lambda b: digests(small_batches(b)), "end binary, ends_sha256 string")


_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_ROWS = pa.schema([
    ("inner", pa.bool_()), ("depth", pa.int64()), ("path", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()),
    *((name, pa.int64()) for name in _SUMS), ("ends_sha256", pa.string()),
])
_ROWS_SQL = f"inner boolean, depth bigint, path binary, parent binary, conv_id bigint, {', '.join(f'{s} bigint' for s in _SUMS)}, ends_sha256 string"


def _tails(ended: DataFrame) -> DataFrame:
    """The nodes of turns that no other path has, and what is left of each path above them.

    ``ended`` has a row for each distinct path. Rows with ``inner`` false are finished nodes
    and have the path of their parent where it isn't a node of the same tail. Rows with
    ``inner`` true are what a path brings to the node at its ``path``: a surviving child, or
    newly ended conversations.
    """
    depth = (F.octet_length("path") / _TURN).cast("int")
    turn = lambda d: F.substring(F.col("path"), (d - 1) * _TURN + 1, F.lit(_TURN))
    turns = F.transform(F.sequence(F.lit(1), depth), lambda d: F.struct(d.alias("d"), turn(d).alias("key")))
    each = ended.filter(depth > 0).select(_last("path").alias("_end"), F.explode(turns).alias("t")).select("_end", "t.*")
    alone = each.groupBy("key").agg(F.count("*").alias("n"), F.min("_end").alias("_end"), F.min("d").alias("d")).filter("n = 1")
    alone = alone.groupBy("_end").agg(F.min("d").alias("_alone"))

    def peel(path: bytes, conv_id: int | None, n: int, ends: str, alone: int | None) -> Iterator[tuple]:
        turns = len(path) // _TURN
        if alone is None:  # the whole path starts others
            yield True, turns, path, None, conv_id, n, 0, 0, 0, ends
            return
        saved = 0
        for d in range(turns, alone - 1, -1):
            saved += (n - 1) * int.from_bytes(path[_TURN * d - _TURN + _KEY : _TURN * d], "big")
            above = path[: _TURN * (d - 1)] if d == alone else None
            yield False, d, None, above, conv_id, n, int(d < turns), 1, saved, ends if d == turns else _NO_ENDS
        yield True, alone - 1, path[: _TURN * (alone - 1)], None, conv_id, n, 1, 1, saved, None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20):
            rows = [row for each in zip(*(c.to_pylist() for c in batch.columns), strict=True) for row in peel(*each)]
            if rows:
                columns = [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), _ROWS, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ROWS)

    marked = ended.withColumn("_end", _last("path")).join(alone, "_end", "left")
    return marked.select("path", "conv_id", "n", "ends_sha256", "_alone").mapInArrow(work, _ROWS_SQL)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations; see ``rebuild`` for rows and nulls.

    Returns conv_id (the smallest member, null only where no member has an id), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, members
    but one times code points of the node's text) and ends_sha256 (of the ids of the
    members that end there, ascending, joined by commas). The root has depth 0. An empty
    table has no nodes; other columns are ignored.
    """
    spark = conversations.sparkSession
    paths = stored(_paths(rebuild(conversations)), "paths")
    counted = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    ended = counted.withColumn("end", _last("path")).join(_end_digests(paths), "end").drop("end")
    rows = stored(_tails(stored(ended, "ended")), "tails")
    left = rows.filter("inner")
    deepest = left.agg(F.max("depth")).first()[0]
    finished = rows.filter("not inner")
    columns = ["conv_id", "depth", "parent_conv_id", *_SUMS, "ends_sha256"]
    if deepest is None:
        return finished.withColumn("parent_conv_id", F.col("conv_id")).select(*columns)
    levels, deeper = [], None
    for depth in range(deepest, -1, -1):
        here = left.filter(F.col("depth") == depth).select("path", "conv_id", *_SUMS, "ends_sha256")
        if deeper is not None:
            stripped = F.substring(F.col("path"), F.lit(1), F.lit(_TURN * depth))
            here = here.unionByName(deeper.withColumns({"path": stripped, "n_children": F.lit(1).cast("long"), "ends_sha256": F.lit(None).cast("string")}))
        sums = [F.sum(c).alias(c) for c in _SUMS]
        nodes = here.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"))
        chars = F.coalesce(F.conv(F.hex(F.substring(F.col("path"), F.lit(_TURN * depth - (_TURN - _KEY) + 1), F.lit(_TURN - _KEY))), 16, 10).cast("long"), F.lit(0))
        nodes = nodes.withColumns({
            "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * (chars if depth else F.lit(0)),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(_NO_ENDS)),
        })
        deeper = stored(nodes, "level")
        levels.append(deeper.withColumn("depth", F.lit(depth).cast("long")))
    root = levels.pop()
    below = root.first()["conv_id"]  # the root has one row
    shared = spark.createDataFrame([], levels[0].schema) if levels else root.filter("false")
    for level in levels:
        shared = shared.unionByName(level)
    names = shared.select(_last("path").alias("_parent"), F.col("conv_id").alias("_named"))
    topmost = finished.filter("parent is not null").withColumn("_parent", _last("parent")).drop("parent", "path", "inner")
    open_ended = topmost.unionByName(
        shared.withColumn("_parent", _last(F.substring(F.col("path"), F.lit(1), F.octet_length("path") - _TURN))).drop("path")
    )
    of_root = open_ended.filter("octet_length(_parent) = 0").withColumn("parent_conv_id", F.lit(below).cast("long"))
    of_others = open_ended.filter("octet_length(_parent) > 0").join(names, "_parent").withColumnRenamed("_named", "parent_conv_id")
    tails = finished.filter("parent is null").withColumn("parent_conv_id", F.col("conv_id"))
    every = root.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    for part in (of_root, of_others, tails):
        every = every.unionByName(part.select(*columns))
    return every
