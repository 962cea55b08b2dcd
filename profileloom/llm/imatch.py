"""I-Match fingerprints over randomised lexicon subsets.

Terms whose document frequency lies in a band (their inverse document frequency is
neither low nor high) form the lexicon. A document keeps its distinct lexicon terms in
sorted order; for each of 96 random subsets of the lexicon the terms in it are hashed
to a signature. Subset 0 is the whole lexicon (the classic fingerprint), the next
five drop a tenth of it, the rest are thinner and thinner, so that texts of any
length find subsets of which they hold a few terms. Two texts agree in a subset if its
signature is the same; their likeness is the share of agreeing subsets among those
either has terms of.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import map_arrow, small_batches, sql_type, stored, text_bytes

#: The band: a term is in the lexicon if this share of all documents holds it. A term
#: of a document counts once, so at most (mean distinct terms of a document) / LOW terms
#: qualify, however large the corpus is: the lexicon that is sent to all tasks is bounded.
LOW, HIGH = 0.001, 0.3
SUBSETS = 96
#: Shares of the lexicon in each subset.
SHARES = np.array([1.0] + 5 * [0.9] + [2.0 ** -(2 + i // 9) for i in range(90)])
_TERM = re.compile(r"\w+")
_SALTS = np.array([xxhash.xxh64_intdigest(b"subset", i) for i in range(SUBSETS)], np.uint64)
_FLUSH = 200_000


def terms_of(text: str) -> set[str]:
    """The distinct terms of a text: words in lower case."""
    return set(_TERM.findall(text.lower()))


def _hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))


def _membership(hashes: np.ndarray) -> np.ndarray:
    """For each term's hash and each subset, whether the term is in it."""
    x = hashes[:, None] ^ _SALTS
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < SHARES * 2.0**53


class Lexicon:
    """Terms of the band, in sorted order, with their hashes and subsets."""

    def __init__(self, terms: list[str]):
        self._place = {t: i for i, t in enumerate(terms)}
        self._hashes = np.array([_hash(t) for t in terms], np.uint64)
        self._member = np.packbits(_membership(self._hashes), axis=1)

    def signatures(self, text: str) -> np.ndarray:
        """The signatures; 0 for subsets of which the text has no terms.

        A text with terms, but none of the band, counts with all its terms; a text
        without terms has no signatures.
        """
        terms, place = terms_of(text), self._place
        found = sorted([place[t] for t in terms if t in place])
        if found:
            hashes, member = self._hashes[found], np.unpackbits(self._member[found], axis=1).view(bool)
        elif terms:
            hashes = np.array([_hash(t) for t in sorted(terms)], np.uint64)
            member = _membership(hashes)
        else:
            return np.zeros(SUBSETS, np.uint32)
        out = np.zeros(SUBSETS, np.uint32)
        for subset in np.flatnonzero(member.any(0)):
            out[subset] = xxhash.xxh32_intdigest(hashes[member[:, subset]].tobytes(), int(subset)) or 1
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of agreeing subsets among those either text has terms of; 1 if neither has any."""
    either = (a != 0) | (b != 0)
    return float((a == b)[either].mean()) if either.any() else 1.0


def build_lexicon(documents: DataFrame, low: float = LOW, high: float = HIGH) -> list[str]:
    """The terms of the band over all of ``documents``; counted per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            terms = [t.encode("utf-8", "replace").decode() for t in counts]
            batch = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(terms_of(text.decode("utf-8", "replace")))
            if len(counts) > _FLUSH:
                yield flush()
        yield flush()

    total = documents.count()
    counted = map_arrow(documents.select(text_bytes().alias("text")), count, "term string, n bigint")
    band = counted.groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n").between(low * total, high * total))
    return sorted(row["term"] for row in band.select("term").collect())


_BUILT: dict[str, Lexicon] = {}


def _lexicon(key: str, terms: list[str]) -> Lexicon:
    """One lexicon for all tasks of a worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Lexicon(terms)
    return _BUILT[key]


def _text(value: bytes) -> str:
    return value.decode("utf-8", "replace")


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: a third less to shuffle than by Spark's own codec."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = pa.array([press.compress(t) for t in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["doc_id", "digest", "text"])


def _grown(values: pa.Array) -> Iterator[str]:
    expand = zstandard.ZstdDecompressor()
    return (_text(expand.decompress(v)) for v in values.to_pylist())


_COLUMNS = ("n_chars", "edited_sha256", "signatures", "edited_signatures", "near_edited", "near_next")
_SCHEMA = "n_chars bigint, edited_sha256 string, signatures binary, edited_signatures binary, near_edited double, near_next double"


def _compare(lexicon: Lexicon, text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> tuple:
    """The columns of a document, given its successor."""
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    other = lexicon.signatures(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), digest, own.astype(">u4").tobytes(), other.astype(">u4").tobytes(), likeness(own, other), likeness(own, next_own)


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
    return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]


def fingerprints(documents: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """doc_id, n_chars and the signatures (hex) of every row of ``documents``: the plain operator."""
    terms = documents.sparkSession.sparkContext.broadcast(build_lexicon(documents, low, high))
    key = uuid.uuid4().hex

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(key, terms.value)
        for batch in batches:
            texts = [_text(t) for t in batch.column(1).to_pylist()]
            prints = [lexicon.signatures(t).astype(">u4").tobytes().hex() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    schema = f"doc_id {sql_type(documents, 'doc_id')}, n_chars bigint, fingerprint string"
    return map_arrow(documents.select("doc_id", text_bytes().alias("text")), work, schema)


def compare_with_edits(documents: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every row of ``documents`` (doc_id, text, ...) and of its edited text.

    The edited text has the last half of its code points replaced by the first as many
    (or all) of the next document by descending doc_id; the last one's next is the
    first, a single document's itself. Null ids come last, rows that repeat an id follow
    each other in the order of a hash of their texts. Returns one row per row: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Null texts count as empty; other columns are ignored; an empty table gives none.

    Texts are dealt once, by ranges of doc_id, and walked in order. The last row of each
    range meets the first of the next in a small join of one row per range.
    """
    spark = documents.sparkSession
    terms = spark.sparkContext.broadcast(build_lexicon(documents, low, high))
    key, kind = uuid.uuid4().hex, sql_type(documents, "doc_id")
    names = ["part", "edge", "doc_id", "text", *_COLUMNS]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, part = _lexicon(key, terms.value), TaskContext.get().partitionId()
        last = None

        def edge(name: str, doc_id: pa.Array, text: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([name]), doc_id, pa.array([text.encode("utf-8", "surrogatepass")], pa.binary()), *_columns([(None,) * 6])],
                names=names,
            )

        for batch in small_batches(batches, 2 << 20):
            ids, rows, pending = batch.column(0), [], last
            for i, text in enumerate(_grown(batch.column(1))):
                own = lexicon.signatures(text)
                if pending is None:
                    yield edge("first", ids.slice(i, 1), text)
                else:
                    rows.append(_compare(lexicon, pending[0], pending[1], text, own))
                pending = (text, own)
            if rows:
                done = pa.concat_arrays([last[2], ids.slice(0, len(rows) - 1)]) if last else ids.slice(0, len(rows))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), pa.nulls(n, pa.string()), done, pa.nulls(n, pa.binary()), *_columns(rows)], names=names
                )
            if pending:
                last = (*pending, ids.slice(batch.num_rows - 1, 1))
        if last:
            yield edge("last", last[2], last[0])

    order = [F.col("doc_id").desc_nulls_last(), F.col("digest")]
    keyed = documents.select("doc_id", F.xxhash64(text_bytes()).alias("digest"), text_bytes().alias("text"))
    packed = map_arrow(keyed, _shrink, f"doc_id {kind}, digest bigint, text binary")
    dealt = packed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = stored(dealt.mapInArrow(walk, f"part bigint, edge string, doc_id {kind}, text binary, {_SCHEMA}"), "walked")
    parts = sorted(r["part"] for r in walked.filter("edge = 'first'").select("part").collect())  # one per range
    following = spark.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1], strict=True)) or [(0, 0)], "part bigint, next_part bigint"
    )
    first = walked.filter("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    meet = walked.filter("edge = 'last'").select("part", "doc_id", "text").join(following, "part").join(first, "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(key, terms.value)
        for batch in small_batches(batches, 2 << 20):
            rows = []
            for text, after in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text, after = _text(text), _text(after)
                rows.append(_compare(lexicon, text, lexicon.signatures(text), after, lexicon.signatures(after)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(rows)], names=["doc_id", *_COLUMNS])

    closed = meet.select("doc_id", "text", "following").mapInArrow(close, f"doc_id {kind}, {_SCHEMA}")
    every = walked.filter("edge is null").select("doc_id", *_COLUMNS).unionByName(closed)
    return every.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("signatures")).alias("fingerprint"),
        F.lower(F.hex("edited_signatures")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
