"""Elements of whole-document JSON arrays, read by many tasks.

A file is scanned in blocks, cut at commas, so that no task needs a whole document. Where
a block begins, inside or outside a string and how deep, is unknown to its task. Therefore
each block is read as a small automaton first: for both ways it may begin, whether it ends
inside a string, by how much the depth changes, and how many commas stand at which depth.
Put together in the order of blocks, which needs a row a block and no text, these tell
every block's true start. A second scan then cuts the elements; only those that cross the
ends of blocks are put together from their parts.

A comma inside a string or deeper than the array is a cut of the scan, but not of an element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROKEN = "not one JSON document; one record per line is the format jsonl"
_OPEN, _CLOSE, _QUOTE, _COMMA = b"[{", b"]}", ord('"'), ord(",")
_STEP = np.zeros(256, np.int8)
_STEP[list(_OPEN)], _STEP[list(_CLOSE)] = 1, -1
_SPACE = b" \t\r\n"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes, bool]]:
    """((path, block), text, whether it is the block's first) in the order of the scan; each comma
    ends the piece before it, also behind the file's end, where none is."""
    last = None
    for batch in batches:
        texts, paths, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        start, n = 0, len(texts)
        while start < n:
            key, end = (paths[start], blocks[start]), start + 1
            while end < n and (paths[end], blocks[end]) == key:
                end += 1
            yield key, b",".join(texts[start:end]) + b",", key != last
            last, start = key, end


def _marks(text: bytes, in_string: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """The bytes of a text, whether each stands outside strings, and whether it ends in one."""
    raw = np.frombuffer(text.replace(b"\\\\", b"  ").replace(b'\\"', b"  "), np.uint8)
    quotes = raw == _QUOTE
    inside = (np.cumsum(quotes) + in_string) % 2 == 1
    return raw, ~(inside | quotes), bool(inside[-1]) if len(raw) else in_string


class _Way(NamedTuple):
    """What a block does if it begins outside, or inside, a string; depths count from its start."""

    ends_inside: bool
    depth: int  # at its end
    least: int  # anywhere in it
    commas: dict[int, int]  # by depth
    keys: list[tuple[int, int, int]]  # (depth, place of the bracket, least depth behind it) of arrays under the key


def _follow(way: _Way, text: bytes, at: int, key: re.Pattern | None) -> _Way:
    """The way goes on over a text that begins at a place of the block."""
    raw, outside, inside = _marks(text, way.ends_inside)
    depths = _depths(raw, outside) + way.depth
    commas = dict(way.commas)
    for depth, n in zip(*np.unique(depths[outside & (raw == _COMMA)], return_counts=True), strict=True):
        commas[int(depth)] = commas.get(int(depth), 0) + int(n)
    keys = [(depth, place, min(least, int(depths.min()))) for depth, place, least in way.keys]
    for match in key.finditer(text) if key else ():
        bracket = match.end() - 1
        if outside[bracket]:
            keys.append((int(depths[bracket]) - 1, at + bracket, int(depths[bracket:].min())))
    return _Way(inside, int(depths[-1]), min(way.least, int(depths.min())), commas, keys)


def _depths(raw: np.ndarray, outside: np.ndarray) -> np.ndarray:
    return np.cumsum(np.where(outside, _STEP[raw], 0), dtype=np.int64)


class Block(NamedTuple):
    """How a block truly begins."""

    in_string: bool
    depth: int
    element: int  # number of the element it begins in
    cut: int  # depth of the commas between elements
    begin: int | None  # where in it the array begins; None: before it
    first: bool  # of the blocks with elements of its file
    last: bool  # of its file
    file: int  # its place among the files, by path


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between commas as bytes, with their file and block; tasks read blocks in order."""
    rows = spark.read.option("lineSep", ",").text(path)
    return rows.select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )


_WAY = {"inside": "boolean", "depth": "bigint", "least": "bigint", "at": "array<bigint>", "n": "array<bigint>", "keys": "array<array<bigint>>"}


def _summaries(scan: DataFrame, key: str | None) -> list[dict]:
    """One row a block: both ways, the first byte that isn't blank and its place."""
    pattern = key and re.compile(b'"' + re.escape(key.encode()) + b'"[ \\t\\r\\n]*:[ \\t\\r\\n]*\\[')

    def row(path: str, block: int, head: tuple[bytes, int], ways: list[_Way]) -> dict:
        out = {"path": path, "block": block, "head": head[0], "begin": head[1]}
        for i, w in enumerate(ways):
            keys = [list(k) for k in w.keys]
            values = (w.ends_inside, w.depth, w.least, list(w.commas), list(w.commas.values()), keys)
            out |= {f"{name}{i}": value for name, value in zip(_WAY, values, strict=True)}
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, where, head, ways, at = [], None, (b"", 0), [], 0
        for now, text, first in _pieces(batches):
            if first:
                if where:
                    rows.append(row(*where, head, ways))
                where, head, at = now, (b"", 0), 0
                ways = [_Way(inside, 0, 0, {}, []) for inside in (False, True)]
            if not head[0] and (bare := text.lstrip(_SPACE)):
                head = bare[:1], at + len(text) - len(bare)
            ways = [_follow(way, text, at, pattern) for way in ways]
            at += len(text)
        if where:
            rows.append(row(*where, head, ways))
            yield pa.RecordBatch.from_pylist(rows, schema=fields)

    kinds = {"boolean": pa.bool_(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "array<array<bigint>>": pa.list_(pa.list_(pa.int64()))}
    fields = pa.schema(
        [("path", pa.string()), ("block", pa.int64()), ("head", pa.binary()), ("begin", pa.int64())]
        + [(f"{name}{i}", kinds[kind]) for i in (0, 1) for name, kind in _WAY.items()]
    )
    columns = ", ".join(f"{name}{i} {kind}" for i in (0, 1) for name, kind in _WAY.items())
    found = scan.mapInArrow(work, f"path string, block bigint, head binary, begin bigint, {columns}")
    return [r.asDict() for r in found.collect()]  # a row for each block of a file


def _starts(rows: list[dict], key: str | None) -> dict[tuple[str, int], Block]:
    """The true start of every block with elements; a file that can't be one document is an error."""
    out, by_file = {}, {}
    for row in sorted(rows, key=lambda r: (r["path"], r["block"])):
        by_file.setdefault(row["path"], []).append(row)
    for file, (path, blocks) in enumerate(by_file.items()):
        bare = key is None and bytes(blocks[0]["head"]) != b"["
        cut = 2 if key is not None else 0 if bare else 1
        inside, depth, element, between = False, 0, 0, 0
        state = "before"
        for number, row in enumerate(blocks):
            way, last = int(inside), number == len(blocks) - 1
            begin, least = None, depth + row[f"least{way}"]
            if state == "before":
                if key is not None:
                    found = [k for k in row[f"keys{way}"] if depth + k[0] == 1]
                    begin, least = (found[0][1] + 1, depth + found[0][2]) if found else (None, least)
                else:
                    begin = 0 if bare else row["begin"] + 1
                    least = cut  # nothing may follow the array: see below
                state = "before" if begin is None else "in"
            if state == "in":
                out[path, row["block"]] = Block(inside, depth, element, cut, begin, begin is not None, last, file)
                if key is not None and least < cut:
                    state = "behind"
            commas = {depth + at: n for at, n in zip(row[f"at{way}"], row[f"n{way}"], strict=True)}
            if last and not row[f"inside{way}"]:  # the comma behind the file's end
                commas[depth + row[f"depth{way}"]] -= 1
            element += commas.get(cut, 0)
            between += 0 if bare else commas.get(0, 0)
            broken = depth + row[f"least{way}"] < 0
            inside, depth = row[f"inside{way}"], depth + row[f"depth{way}"]
            if broken:
                raise ValueError(f"{path}: {BROKEN}")
        if inside or depth or between:
            raise ValueError(f"{path}: {BROKEN}")
        if key is not None and state == "before":
            raise ValueError(f"{path}: there is no root key {key!r} with an array")
    return out


_PART = pa.schema([("path", pa.string()), ("file", pa.int64()), ("block", pa.int64()), ("pos", pa.int64()), ("text", pa.binary()), ("whole", pa.bool_())])


class _Cutter:
    """Cuts one block's elements; what its ends cut off comes as parts."""

    def __init__(self, where: tuple[str, int], start: Block):
        self._where, self._start = where, start
        self._inside, self._depth, self._element = start.in_string, start.depth, start.element
        self._open, self._closed, self._at = start.begin is None, False, 0
        self._held: list[bytes] = []
        self._whole = self._none_yet = start.first

    def _row(self, whole: bool, last: bytes = b"") -> tuple:
        path, block = self._where
        return path, self._start.file, block, self._element, b"".join([*self._held, last]), whole

    def cut(self, text: bytes) -> list[tuple]:
        """The elements that end in the block's next text."""
        cut, rows = self._start.cut, []
        raw, outside, self._inside = _marks(text, self._inside)
        depths = _depths(raw, outside) + self._depth
        begin = 0
        if not self._open:
            begin = min(self._start.begin - self._at, len(text))
            self._open = self._start.begin < self._at + len(text)
        commas = np.flatnonzero(outside & (raw == _COMMA) & (depths == cut))
        self._element += int((commas < begin).sum())
        rest = text if self._closed else b""
        if self._open and not self._closed:
            below = np.flatnonzero(depths[begin:] < cut)
            close = begin + int(below[0]) if len(below) else len(text)
            for comma in commas[(commas >= begin) & (commas < close)].tolist():
                rows.append(self._row(self._whole, text[begin:comma]))
                self._held, begin, self._whole = [], comma + 1, True
                self._element += 1
            if close < len(text):
                rows.append(self._row(self._whole, text[begin:close]))
                self._held, self._closed, rest = [], True, text[close + 1 :]
            else:
                self._held.append(text[begin:])
        if cut == 1 and rest.strip(_SPACE + b","):
            raise ValueError(f"{self._where[0]}: {BROKEN}")
        self._at, self._depth = self._at + len(text), int(depths[-1])
        if rows and self._none_yet:
            self._none_yet = False
            if len(rows) == 1 and not rows[0][4].strip(_SPACE) and (self._closed or cut == 0):
                return []  # an array of nothing
        return rows

    def end(self) -> list[tuple]:
        """The part of an element that the block's end cuts off."""
        over = self._closed or (self._start.cut == 0 and self._start.last)
        return [] if over or not self._open else [self._row(False)]


def array_elements(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """``(path, file, pos, text)``: the elements of the JSON arrays in the files of a path.

    Without a ``key`` a file holds one array, or values that make one between brackets: a
    single object is an array of it. With one, a file is an object with an array under that
    key. ``file`` numbers files by path, ``pos`` grows along a file, from 0 and without gaps where there is no key. The texts
    aren't parsed: a file whose brackets and quotes don't make one document is an error, and
    the caller finds texts that are no JSON; a comma at a file's end goes unnoticed. Blocks are as
    large as ``spark.sql.files.maxPartitionBytes``; the driver holds a short row for each of
    them, a task the text of one element and of some pieces.
    """
    scan = _scan(spark, path)
    starts = _starts(_summaries(scan, key), key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, rows = None, []
        for where, text, first in _pieces(batches):
            if first:
                rows += cutter.end() if cutter else []
                cutter = _Cutter(where, starts[where]) if where in starts else None
            rows += cutter.cut(text) if cutter else []
            if rows:
                yield _table(rows)
                rows = []
        yield _table(rows + (cutter.end() if cutter else []))

    parts = scan.mapInArrow(work, "path string, file bigint, block bigint, pos bigint, text binary, whole boolean")
    found = parts.filter("whole").select("path", "file", "pos", "text")
    if any(not (s.first and s.last) for s in starts.values()):
        in_order = F.array_sort(F.collect_list(F.struct("block", "text")))
        joined = F.aggregate(in_order, F.lit(b""), lambda text, part: F.concat(text, part["text"]))
        found = found.unionByName(parts.filter("not whole").groupBy("path", "file", "pos").agg(joined.alias("text")))
    return found.select("path", "file", "pos", F.col("text").cast("string").alias("text"))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    values = zip(*rows, strict=True) if rows else ((),) * len(_PART)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _PART, strict=True)], schema=_PART)


def valid_elements(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """``array_elements`` whose texts all are JSON; one that isn't fails the job, even a count."""
    broken = F.raise_error(F.lit(BROKEN)).cast("boolean")
    # In brackets, as the parser doesn't look behind a first value.
    one = (F.trim("text") != "") & F.try_parse_json(F.concat(F.lit("["), F.col("text"), F.lit("]"))).isNotNull()
    return array_elements(spark, path, key).filter(F.when(one, True).otherwise(broken))
