"""SentencePiece encoding and decoding, with a max-plus scan for giant documents.

Documents of ordinary length are encoded by the library. A giant one is cut into
chunks that are worked on independently. What passes from chunk to chunk is the piece
over the boundary: its beginning before it and its end behind it. Of each chunk a
transfer matrix tells, for every incoming and outgoing boundary piece, the best sum of
piece scores in between, minus infinity where there is no way. Matrices combine
associatively in the max-plus semiring; the combination fixes each boundary piece, and
every chunk then traces its own way back.

The vocabulary is a byte-pair one, whose encoding is the one chain of pieces in which
every two neighbours are stable: merging them as a text of their own gives these two
again. That decides which steps have a finite weight, so the best way is the library's
encoding, not an approximation to it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import map_arrow, small_batches, sql_type, stored, text_bytes

MODEL = "piece_bpe_32k.model"
#: Texts of more characters are giant; their chunks have so many characters.
GIANT, CHUNK = 50_000, 10_000
_WORD, _LONGEST_WORD = re.compile("▁+[^▁]*"), 64
State = tuple[int, int]  # beginning and end of a piece; of the start of a text, (-1, 0)
START: State = (-1, 0)


class Vocabulary:
    """The library's processor, and what the scan needs of its vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        p = self.processor
        self._scores, self._ids, self._bytes = {}, {}, {}
        for i in range(p.get_piece_size()):
            if p.is_byte(i):
                self._bytes[int(p.id_to_piece(i)[3:5], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self._scores[p.id_to_piece(i)] = p.get_score(i)
                self._ids[p.id_to_piece(i)] = i
        self.longest = max(map(len, self._scores))
        # If no piece goes on over a space behind something else, words don't touch each other.
        self.separate = not any(re.search("[^▁]▁", piece) for piece in self._scores)
        self.chain = lru_cache(1 << 18)(self._chain)
        self.stable = lru_cache(1 << 20)(self._stable)
        self._whole = lru_cache(1 << 18)(self._is_whole)

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best pair is merged, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stable(self, left: str, right: str) -> bool:
        return self._merged(left + right) == [left, right]

    def _chain(self, word: str) -> list[tuple[int, int, float]]:
        """(end, begin, sum of scores) of the last pieces on the ways from a word's beginning."""
        came, _ = _ways(self, word, START, len(word))
        return [(end, begin, total) for end, (begin, total) in came.items() if end]

    def _is_whole(self, piece: str) -> bool:
        return len(piece) == 1 or (piece in self._scores and self._merged(piece) == [piece])

    def ending(self, text: str, end: int, least: int) -> Iterator[tuple[int, str]]:
        """(begin, piece) of the pieces of a text that end at ``end`` and begin at ``least`` or behind."""
        for begin in range(end - 1, max(least, end - self.longest) - 1, -1):
            piece = text[begin:end]
            if (begin == end - 1 or piece in self._scores) and self._whole(piece):
                yield begin, piece

    def score(self, piece: str) -> float:
        return self._scores.get(piece, -100_000.0)

    def ids(self, piece: str) -> list[int]:
        """The id of a piece; of a character the vocabulary lacks, those of its bytes."""
        found = self._ids.get(piece)
        return [found] if found is not None else [self._bytes[b] for b in piece.encode("utf-8", "replace")]


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _ways(v: Vocabulary, text: str, state: State, stop: int, reference: dict | None = None) -> tuple[dict, int | None]:
    """For each end up to ``stop``, (begin, sum of scores) of the last piece on the way from ``state``.

    From one state there is at most one way to each end. A way that agrees with the
    reference's last pieces over the longest piece's length agrees from there on: the
    place is returned, and the rest left out. Words are walked once and remembered.
    """
    came = {state[1]: (state[0], 0.0)}
    same, end, reached = 0, state[1], state[1]
    while end < stop and end - reached <= v.longest:  # else no piece leads on
        if v.separate and end in came and end and text[end] == "▁" != text[end - 1]:
            if reference is not None and end in reference:
                return came, end
            word = _WORD.match(text, end)
            if word.end() <= stop and word.end() - end <= _LONGEST_WORD:
                total = came[end][1]
                for last, begin, more in v.chain(word[0]):
                    came[end + last] = (end + begin, total + more)
                end = reached = word.end()
                continue
        end += 1
        for begin, piece in v.ending(text, end, state[1]):
            before = came.get(begin)
            if before is not None and (before[0] < 0 or v.stable(text[before[0] : begin], piece)):
                came[end], reached = (begin, before[1] + v.score(piece)), end
                break
        if reference is not None:
            mine, other = came.get(end), reference.get(end)
            same = same + 1 if (mine and mine[0]) == (other and other[0]) else 0
            if same > v.longest and mine:
                return came, end
    return came, None


def boundary_states(v: Vocabulary, text: str, at: int) -> list[State]:
    """The pieces of a text over the character before ``at``."""
    return [
        (begin, end)
        for end in range(at, min(at + v.longest - 1, len(text)) + 1)
        for begin, _ in v.ending(text, end, max(0, end - v.longest))
        if begin < at
    ]


def transfer(v: Vocabulary, text: str, begin: int, end: int) -> dict[tuple[State, State], float]:
    """The chunk's matrix: the best sums from pieces over ``begin`` to pieces over ``end``."""
    stop = min(end + v.longest - 1, len(text))
    out: dict[tuple[State, State], float] = {}
    reference = None
    for state in [START] if begin == 0 else boundary_states(v, text, begin):
        if state[1] >= end:  # one piece over both boundaries
            out[state, state] = 0.0
            continue
        came, joined = _ways(v, text, state, stop, reference)
        if joined is not None:
            gain = came[joined][1] - reference[joined][1]
            came |= {e: (b, total + gain) for e, (b, total) in reference.items() if e > joined}
        elif reference is None:
            reference = came
        for target, total in _over(v, text, came, state, end, stop).items():
            out[state, target] = total
    return out


def _over(v: Vocabulary, text: str, came: dict, state: State, end: int, stop: int) -> dict[State, float]:
    """Sums up to every piece over ``end``; where the text goes on, any of them may be the right one."""
    found = {}
    for place in range(max(end, state[1] + 1), stop + 1):
        for begin, piece in v.ending(text, place, state[1]):
            before = came.get(begin)
            if begin < end and before is not None and (before[0] < 0 or v.stable(text[before[0] : begin], piece)):
                found[begin, place] = before[1] + v.score(piece)
    return found


def compose(a: dict, b: dict) -> dict:
    """The max-plus product of two matrices; associative."""
    rows: dict[State, list] = {}
    for (middle, target), weight in b.items():
        rows.setdefault(middle, []).append((target, weight))
    out: dict = {}
    for (source, middle), weight in a.items():
        for target, more in rows.get(middle, ()):
            if weight + more > out.get((source, target), -np.inf):
                out[source, target] = weight + more
    return out


def boundaries(matrices: list[dict], length: int) -> list[State]:
    """The boundary piece behind each chunk on the best way: prefix products, then one step back each."""
    prefixes = [matrices[0]]
    for matrix in matrices[1:]:
        prefixes.append(compose(prefixes[-1], matrix))
    state = max((t for _, t in prefixes[-1] if t[1] == length), key=lambda t: prefixes[-1][START, t])
    chosen = [state]
    for before, matrix in zip(reversed(prefixes[:-1]), reversed(matrices[1:]), strict=True):
        state = max(
            (m for m, t in matrix if t == state and (START, m) in before),
            key=lambda m, goal=state: before[START, m] + matrix[m, goal],
        )
        chosen.append(state)
    return chosen[::-1]


def trace(v: Vocabulary, text: str, first: State, last: State) -> list[str]:
    """The pieces from behind ``first`` to ``last``, both being pieces over boundaries."""
    if first == last:
        return []
    came, _ = _ways(v, text, first, last[0])
    pieces, end = [text[last[0] : last[1]]], last[0]
    while end > first[1]:
        begin = came[end][0]
        pieces.append(text[begin:end])
        end = begin
    return pieces[::-1]


def _crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def join_crc(left: int, right: int, right_bytes: int) -> int:
    """The crc32 of two strings behind each other, from theirs and the second one's length."""
    zeros = bytes(right_bytes)
    return zlib.crc32(zeros, left) ^ zlib.crc32(zeros) ^ right


def _shift(states: list[State], by: int) -> list[State]:
    return [s if s == START else (s[0] + by, s[1] + by) for s in states]


_SPLIT = (
    "row bigint, chunk int, chunks int, n_chars bigint, n_tokens bigint, crc bigint, exact boolean,"
    " text binary, at bigint, begin bigint, finish bigint, length bigint"
)
_SPLIT_NAMES = [x.split()[0] for x in _SPLIT.split(",")]


def _split(batches: Iterator[pa.RecordBatch], path: str, giant: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """Ordinary documents as finished rows, giant ones as chunks with the text around them."""
    v, task, seen = vocabulary(path), TaskContext.get().partitionId(), 0
    for batch in small_batches(batches, 2 << 20):
        texts = [t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
        short = [t for t in texts if len(t) <= giant]
        coded = v.processor.encode(short, num_threads=1)
        back = iter(zip(coded, v.processor.decode(coded, num_threads=1) if coded else [], strict=True))
        rows, ids = [], []
        for i, text in enumerate(texts):
            row = (task << 32) + seen
            seen += 1
            if len(text) <= giant:
                own, decoded = next(back)
                rows.append((row, 0, 1, len(text), len(own), _crc(own), decoded == text, None, 0, 0, 0, 0))
                ids.append(i)
                continue
            normal = v.processor.normalize(text)
            cuts = range(0, len(normal), chunk)
            for number, begin in enumerate(cuts):
                end, low = min(begin + chunk, len(normal)), max(0, begin - v.longest)
                part = normal[low : end + v.longest]
                plain = part.encode("utf-8", "replace")
                rows.append((row, number, len(cuts), len(text), None, None, None, plain, low, begin, end, len(normal)))
                ids.append(i)
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), *4 * [pa.int64()]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids)), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]],
                names=["doc_id", *_SPLIT_NAMES],
            )


_STATE = "in_begin bigint, in_end bigint, out_begin bigint, out_end bigint"


def _matrices(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path)
    for batch in batches:
        for r in batch.to_pylist():
            text, low = r["text"].decode(), r["at"]
            cut_end = r["finish"] - low if r["finish"] < r["length"] else len(text)
            matrix = transfer(v, text, r["begin"] - low, cut_end)
            entries = [(*_shift([a], low)[0], *_shift([b], low)[0], w) for (a, b), w in matrix.items()]
            n = len(entries)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["row"]] * n, pa.int64()), pa.array([r["chunk"]] * n, pa.int32()), pa.array([r["length"]] * n, pa.int64()),
                    *[pa.array([e[i] for e in entries], pa.int64()) for i in range(4)], pa.array([e[4] for e in entries], pa.float64()),
                ],
                names=["row", "chunk", "length", "in_begin", "in_end", "out_begin", "out_end", "weight"],
            )


def _choose(table: pa.Table) -> pa.Table:
    """One document's boundary pieces; its matrices hold a few entries per chunk."""
    matrices: dict[int, dict] = {}
    for r in table.to_pylist():
        entry = (r["in_begin"], r["in_end"]), (r["out_begin"], r["out_end"])
        matrices.setdefault(r["chunk"], {})[entry] = r["weight"]
    order = sorted(matrices)
    out = boundaries([matrices[c] for c in order], table["length"][0].as_py())
    ins = [START, *out[:-1]]
    return pa.table(
        {
            "row": pa.array([table["row"][0].as_py()] * len(order), pa.int64()), "chunk": pa.array(order, pa.int32()),
            "in_begin": pa.array([s[0] for s in ins], pa.int64()), "in_end": pa.array([s[1] for s in ins], pa.int64()),
            "out_begin": pa.array([s[0] for s in out], pa.int64()), "out_end": pa.array([s[1] for s in out], pa.int64()),
        }
    )


def _decode(v: Vocabulary, ids: list[int], first: bool) -> str:
    """The text of a chunk's ids: the library drops a text's first space, which only the first chunk has."""
    return v.processor.decode(ids if first else [*v.ids("▁"), *ids])


def _traces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path)
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            text, low = r["text"].decode(), r["at"]
            first, last = _shift([(r["in_begin"], r["in_end"]), (r["out_begin"], r["out_end"])], -low)
            pieces = trace(v, text, first, last)
            ids = [i for piece in pieces for i in v.ids(piece)]
            covered = "".join(pieces)
            plain = covered.replace("▁", " ")
            plain = plain[1:] if r["chunk"] == 0 else plain
            rows.append((len(ids), _crc(ids), _decode(v, ids, r["chunk"] == 0) == plain))
        kinds = (pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("doc_id", "row", "chunk", "n_chars")], *[pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)]],
            names=["doc_id", "row", "chunk", "n_chars", "n_tokens", "crc", "exact"],
        )


def _joined(table: pa.Table) -> pa.Table:
    """A giant document's row from its chunks' counts and checksums."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    crc = 0
    for r in rows:
        crc = join_crc(crc, r["crc"], 4 * r["n_tokens"])
    return pa.table(
        {
            "doc_id": table["doc_id"].slice(0, 1), "n_chars": pa.array([rows[0]["n_chars"]], pa.int64()),
            "n_chunks": pa.array([len(rows)], pa.int32()), "n_tokens": pa.array([sum(r["n_tokens"] for r in rows)], pa.int64()),
            "ids_crc32": pa.array([crc], pa.int64()), "round_trip": pa.array([all(r["exact"] for r in rows)]),
        }
    )


def encode_and_decode(documents: DataFrame, model: str | None = None, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """Encodes every whole text of ``documents`` (doc_id, text, ...) and decodes the ids again.

    Returns one row per row: doc_id, n_chars, n_chunks (1 for ordinary texts), n_tokens,
    ids_crc32 (of the ids as little-endian 32-bit numbers) and round_trip (the decoded ids
    give the text). The ids are the library's, whatever ``giant`` and ``chunk`` are. Null
    texts count as empty, which have no ids; null and repeated ids and repeated rows are
    rows like others; other columns are ignored; an empty table gives none.
    """
    path, kind = model or public_tokenizers.path(MODEL), sql_type(documents, "doc_id")
    split = stored(
        map_arrow(
            documents.select("doc_id", text_bytes().alias("text")),
            lambda batches: _split(batches, path, giant, chunk), f"doc_id {kind}, {_SPLIT}",
        ),
        "pieces-split",
    )
    done = split.filter("text is null").select(
        "doc_id", "n_chars", F.col("chunks").alias("n_chunks"), "n_tokens", F.col("crc").alias("ids_crc32"), F.col("exact").alias("round_trip")
    )
    giants = split.filter("text is not null").select("doc_id", "row", "chunk", "n_chars", "text", "at", "begin", "finish", "length")
    spread = giants.repartition("row", "chunk")  # a document's chunks come from one task
    matrices = stored(
        spread.mapInArrow(
            lambda batches: _matrices(small_batches(batches), path), f"row bigint, chunk int, length bigint, {_STATE}, weight double"
        ),
        "pieces-matrices",
    )
    chosen = matrices.groupBy("row").applyInArrow(_choose, f"row bigint, chunk int, {_STATE}")
    traced = giants.join(chosen, ["row", "chunk"]).mapInArrow(
        lambda batches: _traces(small_batches(batches), path),
        f"doc_id {kind}, row bigint, chunk int, n_chars bigint, n_tokens bigint, crc bigint, exact boolean",
    )
    whole = traced.groupBy("row").applyInArrow(
        _joined, f"doc_id {kind}, n_chars bigint, n_chunks int, n_tokens bigint, ids_crc32 bigint, round_trip boolean"
    )
    return done.unionByName(whole)
