"""Token ids in patched frame-of-reference blocks.

The format, all numbers little-endian. A segment holds the ids of consecutive
documents, each with its end id, in blocks of 128:

    magic "PFR1", u32 blocks, u32 ids, u32 documents
    u32 start of each block, counted from the payload's beginning   (the block index)
    u32 ids of each document
    payload: per block u32 minimum, u8 width, u8 count - 1, u8 exceptions, the ids less
    the minimum packed at ``width`` bits, then per exception u8 position and u32 of the
    bits above the width

The width is a percentile of the widths the block's values need, so that a few large
values don't widen the rest; those keep their upper bits as exceptions. Segments are
the binary column of Parquet files, which Spark commits whole or not at all, finds in
any store and prunes by document range.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profileloom.llm.shared import small_batches
from profileloom.runtime import fresh_path

BLOCK = 128
PERCENTILE = 90
SEGMENT_IDS = 1 << 18
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
# A pre-token of this tokenizer goes on over neither white space behind anything else nor
# punctuation behind a letter, so a text may be cut in front of both. Classes of bytes:
# white space, signs, letters and digits all engines agree on, else 0; nothing is cut
# in front of or behind the latter.
_SPACE, _SIGN, _LETTER, _DIGIT = 1, 2, 3, 4
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[*b"\t\n\v\f\r "]] = _SPACE
_CLASS[[c for c in range(0x21, 0x7F) if chr(c).isalpha()]] = _LETTER
_CLASS[[*b"0123456789"]] = _DIGIT
# By the classes of the byte before (times 8) and here.
_CUT = np.zeros(64, bool)
_CUT[[8 * before + _SPACE for before in (_SIGN, _LETTER, _DIGIT)] + [8 * _LETTER + _SIGN]] = True
_SPACED_WORD = re.compile(r" [!-~À-ÖØ-öø-ÿ]+")
_REMEMBERED, _LONGEST = 600_000, 64
_NOTHING = pa.array([], pa.large_binary())


def encode_segment(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """The bytes of a segment: ids of documents of the given sizes, one after another."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    filled = np.zeros(blocks * BLOCK, np.int64)
    filled[:n] = ids
    if n % BLOCK:
        filled[n:] = ids[-1]
    grid = filled.reshape(blocks, BLOCK)
    least = grid.min(1) if blocks else np.empty(0, np.int64)
    rest = grid - least[:, None]
    needed = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)  # bits of each value
    widths = np.sort(needed, axis=1)[:, (BLOCK * PERCENTILE + 99) // 100 - 1].astype(np.int64) if blocks else least
    counts = np.full(blocks, BLOCK)
    if n % BLOCK:
        counts[-1] = n % BLOCK
    parts, starts, at = [], np.zeros(blocks, np.int64), 0
    packed = {}
    for width in np.unique(widths):  # blocks of a width are packed at once
        mine = np.flatnonzero(widths == width)
        kind = "<u2" if width <= 16 else "<u4"
        low = (rest[mine] & ((1 << int(width)) - 1)).astype(kind).view(np.uint8).reshape(len(mine), BLOCK, -1)
        bits = np.unpackbits(low, axis=2, bitorder="little", count=int(width)).reshape(len(mine), BLOCK * int(width))
        body, long = np.packbits(bits, axis=1, bitorder="little").tobytes(), BLOCK * int(width) // 8
        packed.update((b, body[i * long : (i + 1) * long]) for i, b in enumerate(mine.tolist()))
    heads = np.zeros(blocks, [("least", "<u4"), ("width", "u1"), ("last", "u1"), ("more", "u1")])
    over = (needed > widths[:, None]) & (np.arange(BLOCK) < counts[:, None])
    heads["least"], heads["width"], heads["last"], heads["more"] = least, widths, counts - 1, over.sum(1)
    rows, places = np.nonzero(over)
    extra = np.zeros(len(rows), [("place", "u1"), ("high", "<u4")])
    extra["place"], extra["high"] = places, rest[rows, places] >> widths[rows]
    ends = (np.searchsorted(rows, np.arange(blocks), "right") * extra.itemsize).tolist()
    head, more, size, begin = heads.tobytes(), extra.tobytes(), heads.itemsize, 0
    for b in range(blocks):
        starts[b] = at
        chunk = head[b * size : (b + 1) * size] + packed[b] + more[begin : ends[b]]
        begin = ends[b]
        parts.append(chunk)
        at += len(chunk)
    header = b"PFR1" + np.array([blocks, n, len(sizes)], "<u4").tobytes()
    return header + starts.astype("<u4").tobytes() + np.asarray(sizes, "<u4").tobytes() + b"".join(parts)


def decode_block(segment: bytes, number: int) -> np.ndarray:
    """One block's ids, found by the index of block starts."""
    blocks, _, documents = np.frombuffer(segment, "<u4", 3, 4)
    start = int(np.frombuffer(segment, "<u4", 1, 16 + 4 * number)[0]) + 16 + 4 * int(blocks + documents)
    least = int.from_bytes(segment[start : start + 4], "little")
    width, last, more = segment[start + 4 : start + 7]
    body = start + 7
    size = BLOCK * width // 8
    values = np.zeros(BLOCK, np.int64)
    if width:
        bits = np.unpackbits(np.frombuffer(segment, np.uint8, size, body), bitorder="little").reshape(BLOCK, width)
        values = bits.astype(np.int64) @ (1 << np.arange(width, dtype=np.int64))
    if more:
        extra = np.frombuffer(segment, [("place", "u1"), ("high", "<u4")], more, body + size)
        values[extra["place"]] |= extra["high"].astype(np.int64) << width
    return (values + least)[: last + 1]


def decode_segment(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a segment and its documents' sizes."""
    if segment[:4] != b"PFR1":
        raise ValueError("not a segment of token ids")
    blocks, n, documents = (int(x) for x in np.frombuffer(segment, "<u4", 3, 4))
    sizes = np.frombuffer(segment, "<u4", documents, 16 + 4 * blocks).astype(np.int64)
    base = 16 + 4 * (blocks + documents)
    starts = np.frombuffer(segment, "<u4", blocks, 16).astype(np.int64) + base
    raw = np.frombuffer(segment, np.uint8)
    least = raw[starts[:, None] + np.arange(4)].astype(np.int64) @ (1 << 8 * np.arange(4, dtype=np.int64))
    widths, more = raw[starts + 4].astype(np.int64), raw[starts + 6].astype(np.int64)
    values = np.zeros((blocks, BLOCK), np.int64)
    for width in np.unique(widths):
        if width:
            mine = np.flatnonzero(widths == width)
            packed = raw[(starts[mine] + 7)[:, None] + np.arange(BLOCK * width // 8)]
            bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(mine), BLOCK, width)
            whole = np.zeros((len(mine), BLOCK, 4), np.uint8)
            whole[:, :, : (width + 7) // 8] = np.packbits(bits, axis=2, bitorder="little")
            values[mine] = whole.view("<u4")[:, :, 0]
    rows = np.repeat(np.arange(blocks), more)
    order = np.arange(len(rows)) - np.repeat(np.cumsum(more) - more, more)
    at = (starts + 7 + BLOCK * widths // 8)[rows] + 5 * order
    if len(rows):
        high = raw[at[:, None] + 1 + np.arange(4)].astype(np.int64) @ (1 << 8 * np.arange(4, dtype=np.int64))
        values[rows, raw[at]] |= high << widths[rows]
    return (values + least[:, None]).reshape(-1)[:n], sizes


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces begin of texts that stand one after another, cut at ``bounds`` in UTF-8 bytes."""
    kind = _CLASS[data]
    begins = bounds[:-1][bounds[:-1] < len(data)]
    # The letters from U+00C0 to U+00FF; the two signs among them are left alone.
    latin = (data[:-1] == 0xC3) & (data[1:] >> 6 == 2) & (data[1:] & 0xDF != 0x97)
    latin[begins[begins > 0] - 1] = False
    kind[1:][latin] = _LETTER
    cut = np.empty(len(data), bool)
    cut[1:] = _CUT[kind[:-1] << 3 | kind[1:]]
    cut[begins] = True
    return np.flatnonzero(cut)


class Encoder:
    """The tokenizer's ids of whole texts, with the ids of short pieces remembered."""

    def __init__(self, path: str):
        # Tasks share the cores already: threads of the library would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        #: The added tokens' strings, which the library takes out of a text before all else.
        self._added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        longest_first = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(longest_first)})")
        # Others reach into the text around them or depend on a normaliser: no cutting then.
        self._pieces_do = not any(
            t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", t.content) for t in added.values()
        )
        #: Remembered pieces and their ids.
        self._known = self._ids = _NOTHING
        #: Whether a token starts with a space, as the file's byte characters show it.
        self._spaced = np.zeros(self._tokenizer.get_vocab_size(), bool)
        self._spaced[[i for s, i in self._tokenizer.get_vocab().items() if s.startswith("Ġ")]] = True

    def whole(self, text: str) -> np.ndarray:
        """The library's ids of a text in one go."""
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.int64)

    def _learn(self, new: list[str]) -> pa.Array:
        """The ids of pieces; those of one space and a word are encoded as one text and told apart by their spaces."""
        order = np.array([_SPACED_WORD.fullmatch(p) is not None for p in new], bool)
        chain, alone = np.flatnonzero(order), np.flatnonzero(~order)
        found = _NOTHING
        if len(chain):
            (coded,) = self._tokenizer.encode_batch_fast(["".join([new[i] for i in chain])], add_special_tokens=False)
            ids = np.array(coded.ids, "<u4")
            starts = np.append(np.flatnonzero(self._spaced[ids]), len(ids)) * 4
            if len(starts) == len(chain) + 1:
                found = pa.Array.from_buffers(pa.large_binary(), len(chain), [None, pa.py_buffer(starts), pa.py_buffer(ids)])
            else:
                chain, alone = chain[:0], np.arange(len(new))
        coded = self._tokenizer.encode_batch_fast([new[i] for i in alone], add_special_tokens=False)
        rest = pa.array([struct.pack(f"<{len(c)}I", *c.ids) for c in coded], pa.large_binary())
        return pa.concat_arrays([found, rest]).take(pa.array(np.argsort(np.concatenate([chain, alone]))))

    def _coded(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts without added tokens: equal pieces of a batch are looked up once."""
        texts = texts.cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return [b""] * len(texts)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        starts = piece_starts(data, bounds)
        ends = pa.py_buffer(np.append(starts, len(data)))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, ends, pa.py_buffer(data)])
        # Numbered behind the remembered ones, so that what is new has the last numbers.
        numbered = pa.chunked_array([self._known, pieces]).dictionary_encode().chunks[-1]
        new = numbered.dictionary.slice(len(self._known))
        learnt = self._learn([p.decode("utf-8", "replace") for p in new.to_pylist()])
        ids = pa.concat_arrays([self._ids, learnt])
        if len(ids) > _REMEMBERED:
            self._known, self._ids = _NOTHING, _NOTHING
        else:
            short = pc.less_equal(pc.binary_length(new), _LONGEST)
            self._known = pa.concat_arrays([self._known, new.filter(short)])
            self._ids = pa.concat_arrays([self._ids, learnt.filter(short)])
        joined = ids.take(numbered.indices)
        places = np.frombuffer(joined.buffers()[1], np.int64)[np.searchsorted(starts, bounds)].tolist()
        whole = memoryview(joined.buffers()[2])
        return [bytes(whole[a:b]) for a, b in zip(places, places[1:], strict=False)]

    def raw(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (UTF-8 bytes), 4 bytes each, from the library's ids of the texts' pieces."""
        if not len(texts):
            return []
        if not self._pieces_do:
            return [self.whole(t.decode("utf-8", "replace")).astype("<u4").tobytes() for t in texts.to_pylist()]
        if not any(pc.any(pc.match_substring(texts, token)).as_py() for token in self._added):
            return self._coded(texts)
        # Odd parts are added tokens, the parts between them texts of their own.
        split = [self._cut.split(t.decode("utf-8", "replace")) for t in texts.to_pylist()]
        between = iter(self._coded(pa.array([p.encode() for parts in split for p in parts[::2]], pa.binary())))
        return [b"".join(self._added[p] if i % 2 else next(between) for i, p in enumerate(parts)) for parts in split]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The same ids as numbers."""
        return [np.frombuffer(ids, "<u4").astype(np.int64) for ids in self.raw(pa.array([t.encode() for t in texts], pa.binary()))]


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker, with what it remembers."""
    return Encoder(path)


def _segments(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode, part, number = _encoder(path), TaskContext.get().partitionId(), 0
    ids, docs, held, end = [], [], 0, np.array([END_ID], "<u4").tobytes()

    def flush() -> pa.RecordBatch:
        nonlocal ids, docs, held, number
        every = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        segment = encode_segment(every, np.array([len(x) // 4 for x in ids]))
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([part]), pa.array([number]), pa.array([held]), pa.array([segment], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(docs)),
            ],
            names=["part", "number", "ids", "segment", "doc_ids"],
        )
        number, ids, docs, held = number + 1, [], [], 0
        return batch

    for batch in small_batches(batches, 4 << 20):
        for i, found in enumerate(encode.raw(batch.column(1))):
            ids.append(found + end)
            docs.append(batch.column(0).slice(i, 1))
            held += len(ids[-1]) // 4
            if held >= SEGMENT_IDS:
                yield flush()
    if ids:
        yield flush()


def write_tokens(documents: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Writes the ids of ``documents`` (doc_id, text, ...) in ascending doc_id order.

    Texts are encoded whole, and the strings of the tokenizer's added tokens get those
    tokens' ids, as in the library; null counts as empty and leaves the end id alone. Null ids
    come first; repeated ids and rows are documents like others, in the order of their
    texts' hashes. Files are in the order of (part, number), one row per segment.
    """
    file = tokenizer or public_tokenizers.path(TOKENIZER)
    kind = documents.schema["doc_id"].dataType.simpleString()
    ordered = documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # Ranges of ids and of the texts' hashes, so that a repeated or null id is split.
    key = "doc_id", F.xxhash64("text")
    ordered = ordered.repartitionByRange(*key).sortWithinPartitions(*key, "text")
    ordered.mapInArrow(
        lambda batches: _segments(batches, file),
        f"part bigint, number bigint, ids bigint, segment binary, doc_ids array<{kind}>",
    ).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens (both with end ids) and ids_crc32.

    ``start`` counts the ids of all documents before it: the segments' counts, one row
    for each part of the files, give every part its offset.
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs = batch.column(3).slice(i, 1).flatten()
                ids, sizes = decode_segment(batch.column(2)[i].as_py())
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
                crcs = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for s, e in zip(sizes, ends, strict=True)]
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs, pa.array(np.full(n, batch.column(0)[i].as_py())), pa.array(np.full(n, batch.column(1)[i].as_py())),
                        pa.array(ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "part", "number", "within", "n_tokens", "ids_crc32"],
                )

    parts = sorted(files.groupBy("part").agg(F.sum("ids").alias("ids")).collect())  # a row per written file
    offsets, total = [], 0
    for row in parts:
        offsets.append((row["part"], total))
        total += row["ids"]
    table = F.broadcast(spark.createDataFrame(offsets, "part bigint, part_start bigint"))
    from pyspark.sql import Window

    before = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    segments = files.select("part", "number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("segment_start"))
    rows = files.select("part", "number", "segment", "doc_ids").mapInArrow(
        lambda batches: look(small_batches(batches, 4 << 20)),
        f"doc_id {kind}, part bigint, number bigint, within bigint, n_tokens bigint, ids_crc32 bigint",
    )
    placed = rows.join(segments, ["part", "number"]).join(table, "part")
    start = F.col("part_start") + F.col("segment_start") + F.col("within")
    return placed.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def round_trip(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the documents' ids into a new folder and reads them back."""
    path = fresh_path(documents.sparkSession, "token-files")
    write_tokens(documents, path, tokenizer)
    return read_tokens(documents.sparkSession, path)
