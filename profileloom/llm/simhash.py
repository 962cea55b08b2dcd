"""SimHash near duplicates by a byte-position index with count filtering.

Fingerprints that differ in at most three of 64 bits differ in at most three of
eight bytes, so they share at least five positional bytes. The inverted index
posts every distinct fingerprint under sets of positional bytes, chosen so that
any two sharing five bytes meet in some posting list. Within a list the shared
bytes of each pair are tallied, pairs below five are dropped, and the bits of the
rest are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.llm.components import connected
from profileloom.llm.shared import map_arrow, small_batches, sql_type, stored, text_bytes

BYTES = 8
#: Fingerprints of one comparison cell: longer posting lists are dealt to pairs of chunks.
CHUNK = 512
#: Up to so many distinct fingerprints lists under three bytes are short; beyond, five bytes.
THREE_BYTE_LIMIT = 1 << 30
_HASHES_AT_ONCE = 1 << 15


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _HASHES_AT_ONCE):
        part = hashes[start : start + _HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, words_each: int = 3) -> int:
    """The SimHash of a UTF-8 text as a signed 64-bit number; zero without words."""
    words = text.lower().split()  # both know ASCII only: A-Z, and the six white-space bytes
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    count = max(len(words) - words_each + 1, 1)
    if words_each == 3 and len(words) >= 3:
        hashes = [digest(b"%b %b %b" % three, 42) for three in zip(words, words[1:], words[2:], strict=False)]
    else:
        hashes = [digest(b" ".join(words[i : i + words_each]), 42) for i in range(count)]
    return _majority(np.array(hashes, np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch], words_each: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t, words_each) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "print"])


def position_sets(width: int) -> list[tuple[int, ...]]:
    """Sets of ``width`` byte positions, such that any five of the eight contain one of them.

    Of five positions at least three lie in one half: the triples of either half do
    for width 3 (8 sets). Width 5 takes all sets of five (56).
    """
    if width == 3:
        return [s for half in (range(4), range(4, 8)) for s in combinations(half, 3)]
    if width == 5:
        return list(combinations(range(BYTES), 5))
    raise ValueError("width is 3 or 5")


def _index(prints: DataFrame, width: int) -> DataFrame:
    """(key, print): a posting for each set of positional bytes."""
    def key(number: int, places: tuple[int, ...]):
        parts = [F.shiftleft(F.shiftright("print", 8 * p).bitwiseAND(F.lit(255)), 8 * i) for i, p in enumerate(places)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts, F.lit(number << (8 * width)).cast("bigint"))

    keys = F.array(*[key(i, s) for i, s in enumerate(position_sets(width))])
    return prints.select("print", F.explode(keys).alias("key"))


def linked_forest(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that join what pairs of at most ``most`` differing bits join: one fewer than members, per group.

    Each print is compared once with those not yet reached: shared positional bytes
    are tallied, pairs with fewer than the guaranteed number dropped, the rest verified.
    """
    rest, links = prints, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            differing = rest ^ one
            shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)
            near = shared >= BYTES - most
            # Unsigned: of signed numbers the bits of the absolute value would be counted.
            near[near] = np.bitwise_count(differing[near].view(np.uint64)) <= most
            if near.any():
                links += [(int(one), int(x)) for x in rest[near]]
                queue += list(rest[near])
                rest = rest[~near]
    return links


def _cell_links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = []
        for prints in batch.column(0):
            links += linked_forest(np.asarray(prints.values, np.int64), most)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in links], pa.int64()) for i in range(2)], names=["a", "b"]
        )


def _links(prints: DataFrame, most: int, width: int, chunk: int) -> DataFrame:
    """Links between distinct prints, enough to join whatever is near.

    A posting list of over ``chunk`` prints is cut into chunks by a hash, and each
    pair of chunks is a cell of its own: cells are bounded, no pair is left out.
    """
    index = _index(prints, width)
    counted = index.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    lists = stored(counted.select("key", F.ceil(F.col("size") / chunk).cast("int").alias("chunks")), "postings")
    own = F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int")
    cells = (
        index.join(lists, "key")
        .select("key", "print", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.collect_list("print").alias("prints"))
        .filter("size(prints) > 1")
        .select("prints")
    )
    return cells.mapInArrow(lambda batches: _cell_links(small_batches(batches, 1 << 20), most), "a bigint, b bigint")


def near_duplicates(
    documents: DataFrame, words_each: int = 3, most: int = 3, width: int | None = None, chunk: int = CHUNK
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``documents``.

    Words are runs without ASCII white space, A-Z lower-cased; shingles have
    ``words_each`` words, repeats included, and a text with fewer words is one
    shingle. No words (null, empty, blank) gives fingerprint zero, linked like any
    other. ``component_id`` is the least doc_id reachable over links of at most
    ``most`` (3 or fewer) differing bits; rows without doc_id take part, and a
    component of such rows alone has a null id. Repeated rows are rows like others.
    ``width`` sets how many positional bytes a posting key has, ``chunk`` the largest
    cell; the result depends on neither. Other columns are ignored.
    """
    if not 0 <= most <= 3:
        raise ValueError("five shared bytes are guaranteed for 3 bits at most")
    light = stored(
        map_arrow(
            documents.select("doc_id", text_bytes().alias("text")),
            lambda batches: _fingerprints(batches, words_each),
            f"doc_id {sql_type(documents, 'doc_id')}, print bigint",
        ),
        "prints",
    )
    classes = stored(light.groupBy("print").agg(F.min("doc_id").alias("least")), "print-classes")
    width = width or (3 if classes.count() <= THREE_BYTE_LIMIT else 5)
    roots = connected(_links(classes, most, width, chunk))
    member = classes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    member = stored(member, "members")
    least = stored(member.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = stored(member.join(least, "root").select("print", "component_id"), "components")
    return light.join(named, "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_near(documents: DataFrame) -> DataFrame:
    """``documents`` with exactly one row of each component; all columns stay.

    It is the row of the least doc_id, null ids last, and of several such rows that of
    the least SHA-256 of the text. Where ids are distinct, rows leave by doc_id; else
    rows are numbered and stored first, and leave by number.
    """
    if documents.groupBy("doc_id").count().filter("count > 1").isEmpty():
        decided = stored(near_duplicates(documents), "near")
        goes = decided.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id"))
        return documents.join(goes, F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    numbered = stored(documents.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    near = near_duplicates(numbered.select(F.col("_number").alias("doc_id"), "text"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2(text_bytes(), 256), "_number")
    rows = numbered.select("_number", order.alias("order"))
    stays = (
        rows.join(near.select(F.col("doc_id").alias("_number"), "component_id"), "_number")
        .groupBy("component_id")
        .agg(F.min("order").getField("_number").alias("_number"))
    )
    return numbered.join(stored(stays.select("_number"), "stays"), "_number", "left_semi").select(*documents.columns)
