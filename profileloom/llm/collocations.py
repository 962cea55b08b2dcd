"""Collocations from word suffixes, counted in subtrees of a memory budget each.

The suffixes of all pieces of text, cut off after three words, form a tree whose nodes
are the phrases and whose totals are their counts. The tree is never built whole:

1. Words are counted. Read in order, they are packed into groups of prefixes whose
   occurrences fit the budget. A word beyond the budget is extended to prefixes of two
   words, which are packed likewise; one of these beyond it is extended to three, which
   are leaves and may be dealt out freely.
2. A scan sends every suffix to the group of its prefix, equal ones of a task as one.
3. Each group sorts its suffixes, which lays its subtree out, and reads the counts of
   nodes from the totals of the leaves below them. No group needs another.

Words never become numbers of a shared dictionary, so none has to fit anywhere.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profileloom.llm.shared import small_batches, stored, text_bytes

WORDS_MOST, LEAST, COVERED, TOP = 3, 10, 50, 2000
_SHARES = 32
UNKNOWN_LANG = "und"
# The bytes that end a piece, and blanks besides the space.
_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b"\t"
_END = b"."  # stands for all of them, and is no word
_TABLE = bytes(_END[0] if c in _ENDS else 32 if c in _BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Occurrences of suffixes a group may hold, and tokens a task gathers before it sends.
BUDGET, GATHERED = 1 << 21, 1 << 20
_PART, _BITS = GATHERED // 2, 21  # tokens of a long text at a time; bits of the number of a gathered word


class _Numbers(defaultdict):
    """Words numbered in the order they come; 0 ends a piece."""

    def __init__(self):
        super().__init__(None)
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _tokens(text: bytes) -> list[bytes]:
    """The words of a text with an end behind every piece."""
    found = text.translate(_TABLE).replace(_END, b" . ").split()
    found.append(_END)
    return found


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(lang, words by number, numbers of the tokens) of some texts at a time, whole or in parts.

    Parts of a long text overlap by two tokens, which start no suffix in the former.
    """
    held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    total = 0

    def flush() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, (numbers, parts) in held.items():
            yield lang, list(numbers), np.concatenate([*parts, np.zeros(WORDS_MOST - 1, np.int64)])

    for batch in small_batches(batches, 1 << 20):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens = _tokens(text)
            for at in range(0, len(tokens), _PART):
                numbers, parts = held.setdefault(lang, (_Numbers(), []))
                part = tokens[at : at + _PART]
                beyond = tokens[at + _PART : at + _PART + WORDS_MOST - 1]
                found = np.fromiter(map(numbers.__getitem__, part + beyond), np.int64, len(part) + len(beyond))
                if beyond:
                    # The part's last suffixes reach into the next; a negative number starts none here.
                    found[len(part) :] = -found[len(part) :]
                    found = np.append(found, 0)
                parts.append(found)
                total += len(part)
                if total >= GATHERED:
                    yield from flush()
                    held, total = {}, 0
    yield from flush()


def _suffixes(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct suffixes of three words, packed into one number, in order, and their counts; 0 ends one."""
    first, (second, third) = tokens[:-2], (np.abs(tokens[1:-1]), np.abs(tokens[2:]))
    third = np.where(second == 0, 0, third)
    return np.unique((first << 2 * _BITS | second << _BITS | third)[first > 0], return_counts=True)


def _texts(documents: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG))
    return documents.select(lang.alias("lang"), text_bytes().alias("text"))


def count_words(documents: DataFrame) -> DataFrame:
    """lang, word (UTF-8 bytes) and n for every word of ``documents``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, tokens in _gathered(batches):
            counts = np.bincount(tokens[tokens > 0], minlength=len(words))[1:]
            here = np.flatnonzero(counts)
            found = pa.array(words[1:], pa.binary()).take(pa.array(here))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(here), pa.string()), found, pa.array(counts[here], pa.int64())], names=["lang", "word", "n"]
            )

    found = _texts(documents).mapInArrow(work, "lang string, word binary, n bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _count_pairs(documents: DataFrame, of: set[tuple[str, bytes]]) -> DataFrame:
    """lang, word, next (empty: the piece ends) and n for the suffixes that start with the given words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, tokens in _gathered(batches):
            mine = np.array([(lang, w) in of for w in words])
            first, second = tokens[:-1], np.abs(tokens[1:])
            keep = (first > 0) & mine[np.maximum(first, 0)]
            pairs, counts = np.unique(first[keep] << _BITS | second[keep], return_counts=True)
            names = pa.array([b"", *words[1:]], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(pairs), pa.string()), names.take(pa.array(pairs >> _BITS)),
                    names.take(pa.array(pairs & ((1 << _BITS) - 1))), pa.array(counts, pa.int64()),
                ],
                names=["lang", "word", "next", "n"],
            )

    found = _texts(documents).mapInArrow(work, "lang string, word binary, next binary, n bigint")
    return found.groupBy("lang", "word", "next").agg(F.sum("n").alias("n"))


def _packed(prefixes: DataFrame, budget: int) -> tuple[list[tuple], dict[tuple, int]]:
    """The first prefixes of groups that hold at most ``budget`` occurrences each, and the larger prefixes.

    ``prefixes`` has lang, the words and n. Both have at most one entry for each half a
    budget of occurrences and one for each task, whatever the number of prefixes: that
    is what reaches the driver.
    """
    keys = prefixes.columns[:-1]
    kinds = [prefixes.schema[k].dataType.simpleString() for k in keys]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = budget  # so that the first one starts a group
        for batch in batches:
            n = np.asarray(batch.column(len(keys)))
            starts, at = [], 0
            large = np.flatnonzero(n > budget)
            total = np.cumsum(np.where(n > budget, 0, n))
            base = -held
            while True:
                at = int(np.searchsorted(total, budget + base, "right"))
                if at >= len(n):
                    break
                starts.append(at)
                base = int(total[at - 1]) if at else 0
            held = int(total[-1]) - base if len(n) else held
            rows = sorted({*starts, *large.tolist()})
            if rows:
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r in set(starts) for r in rows])], names=[*keys, "n", "starts"])

    schema = ", ".join(f"{k} {t}" for k, t in zip(keys, kinds, strict=True))
    rows = prefixes.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(work, f"{schema}, n bigint, starts boolean").collect()
    plain = lambda row: tuple(bytes(v) if isinstance(v, bytearray) else v for v in row[: len(keys)])
    starts = sorted(plain(r) for r in rows if r["starts"])
    return starts, {plain(r): r["n"] for r in rows if r["n"] > budget}


class _Groups:
    """The group of a prefix: one word, two where that is too large, three where these are."""

    def __init__(self, words: list, large: dict, pairs: list, large_pairs: dict, budget: int):
        self.words, self.large, self.pairs, self.large_pairs = words, large, pairs, large_pairs
        self._split, at = {}, len(words) + len(pairs) + 2
        for pair, n in sorted(large_pairs.items()):
            self._split[pair] = (at, parts := -(-n // budget))
            at += parts

    def of_words(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Of each word; -1: its prefixes have two words."""
        return np.array([-1 if (lang, w) in self.large else bisect_right(self.words, (lang, w)) for w in words], np.int64)

    def of_pair(self, lang: str, first: bytes, second: bytes) -> tuple[int, int]:
        """(group, 1), or the first of some groups and their number."""
        pair = (lang, first, second)
        return self._split.get(pair) or (len(self.words) + 1 + bisect_right(self.pairs, pair), 1)


def _send(documents: DataFrame, groups: _Groups) -> DataFrame:
    """Per group and gathered texts: grp, lang, the words, and the suffixes as numbers of words with counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(1).compress
        for lang, words, tokens in _gathered(batches):
            suffixes, counts = _suffixes(tokens)
            first, pair = suffixes >> 2 * _BITS, suffixes >> _BITS
            third = suffixes & ((1 << _BITS) - 1)
            of = groups.of_words(lang, words)[first]
            apart = np.flatnonzero(of < 0)
            if len(apart):
                some, back = np.unique(pair[apart], return_inverse=True)
                look = [groups.of_pair(lang, words[p >> _BITS], words[p & ((1 << _BITS) - 1)] if p & ((1 << _BITS) - 1) else b"") for p in some.tolist()]
                start, parts = (np.array(x, np.int64)[back] for x in zip(*look, strict=True))
                spread = np.array([zlib.crc32(w) for w in words], np.int64) if (parts > 1).any() else np.zeros(len(words), np.int64)
                of[apart] = start + spread[third[apart]] % parts
            order = np.argsort(of, kind="stable")
            of, columns = of[order], np.stack([first[order], pair[order] & ((1 << _BITS) - 1), third[order]])
            counts = counts[order]
            bounds = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else np.zeros(1, np.int64)
            rows = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                used, numbers = np.unique(columns[:, a:b], return_inverse=True)
                names = b" ".join([words[i] if i else _END for i in used.tolist()])
                body = np.vstack([numbers.reshape(3, -1), counts[a:b]]).astype("<u4")
                rows.append((int(of[a]), lang, pack(names), pack(body.tobytes())))
            if rows:
                grp, langs, names, bodies = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp, pa.int64()), pa.array(langs), pa.array(names, pa.binary()), pa.array(bodies, pa.binary())],
                    names=["grp", "lang", "words", "suffixes"],
                )

    return _texts(documents).mapInArrow(work, "grp bigint, lang string, words binary, suffixes binary")


def subtree(languages: list[str], words: list[list[bytes]], suffixes: list[np.ndarray]) -> dict[str, list]:
    """The nodes of two and three words of one group's subtree, from its suffixes.

    Each suffix array has rows for three numbers of words, of which an end (``.``) and
    all behind it are no words, and for the count. Returns lists: lang, a, b, c (words;
    c may be None), n, and n1 and n2, the totals of the nodes above: of a, and of a and b
    for three words.
    """
    numbers: dict[tuple[str, bytes], int] = {}
    tables = []
    for lang, names, found in zip(languages, words, suffixes, strict=True):
        mine = np.array([numbers.setdefault((lang, w), len(numbers)) for w in names], np.int64)
        end = np.array([w == _END for w in names])
        table = np.vstack([mine[found[:3]], found[3:]])
        table[1:3][end[found[1:3]]] = -1
        tables.append(table)
    names = list(numbers)
    out = {k: [] for k in ("lang", "a", "b", "c", "n", "n1", "n2")}
    if not tables:
        return out
    a, b, c, n = np.concatenate(tables, axis=1)
    order = np.lexsort((c, b, a))  # the subtree, laid out: below a node lies one run
    a, b, c, n = a[order], b[order], c[order], n[order]
    changed_a = np.r_[True, a[1:] != a[:-1]]
    changed_b = changed_a | np.r_[True, b[1:] != b[:-1]]
    changed_c = changed_b | np.r_[True, c[1:] != c[:-1]]
    level = [np.flatnonzero(x) for x in (changed_a, changed_b, changed_c)]
    totals = [np.add.reduceat(n, starts) for starts in level]
    above = [np.cumsum(x) - 1 for x in (changed_a, changed_b)]
    for depth in (1, 2):
        starts, total = level[depth], totals[depth]
        last = (b, c)[depth - 1][starts]
        keep = (total >= LEAST) & (last >= 0)
        starts, total = starts[keep], total[keep]
        out["lang"] += [names[i][0] for i in a[starts].tolist()]
        out["a"] += [names[i][1] for i in a[starts].tolist()]
        out["b"] += [names[i][1] for i in b[starts].tolist()]
        out["c"] += [names[i][1] for i in c[starts].tolist()] if depth == 2 else [None] * len(starts)
        out["n"] += total.tolist()
        out["n1"] += totals[0][above[0][starts]].tolist()
        out["n2"] += totals[1][above[1][starts]].tolist() if depth == 2 else [None] * len(starts)
    return out


_NODES = "lang string, a binary, b binary, c binary, n bigint, n1 bigint, n2 bigint"


def count_phrases(documents: DataFrame, words: DataFrame, budget: int = BUDGET) -> DataFrame:
    """lang, a, b, c (null: two words), n, n1, n2 of every phrase of two or three words that
    occurs ``LEAST`` times or more.

    ``words`` is what ``count_words`` gives, stored. ``n1`` counts the phrase's first word,
    ``n2`` the first two of three. What reaches the driver and goes to every task are the
    groups' first prefixes and the prefixes beyond the budget: one or two for each half
    a budget of occurrences.
    """
    starts, large = _packed(words, budget)
    pair_starts, large_pairs = [], {}
    if large:
        pairs = stored(_count_pairs(documents, set(large)), "pairs")
        pair_starts, large_pairs = _packed(pairs, budget)
        large_pairs = {pair: n for pair, n in large_pairs.items() if pair[2]}  # an end has no suffixes to deal out
    groups = _Groups(starts, large, pair_starts, large_pairs, budget)

    def build(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        names = [unpack(x).split(b" ") for x in table["words"].to_pylist()]
        suffixes = [np.frombuffer(unpack(x), "<u4").reshape(4, -1).astype(np.int64) for x in table["suffixes"].to_pylist()]
        nodes = subtree(table["lang"].to_pylist(), names, suffixes)
        columns = [pa.array(nodes["lang"], pa.string()), *(pa.array(nodes[k], pa.binary()) for k in "abc")]
        columns += [pa.array(nodes[k], pa.int64()) for k in ("n", "n1", "n2")]
        if large:  # totals of what several groups share are known beforehand
            keys = list(zip(nodes["lang"], nodes["a"], nodes["b"], strict=True))
            n1 = [large.get(k[:2], own) for k, own in zip(keys, nodes["n1"], strict=True)]
            n2 = [large_pairs.get(k, own) if c else own for k, c, own in zip(keys, nodes["c"], nodes["n2"], strict=True)]
            columns[5:] = [pa.array(n1, pa.int64()), pa.array(n2, pa.int64())]
            whole = [c is not None or k not in large_pairs for k, c in zip(keys, nodes["c"], strict=True)]
            columns = [x.filter(pa.array(whole, pa.bool_())) for x in columns]
        return pa.table(columns, names=["lang", "a", "b", "c", "n", "n1", "n2"])

    found = _send(documents, groups).groupBy("grp").applyInArrow(build, _NODES)
    if large_pairs:
        known = [(lang, a, b, None, n, large[lang, a], None) for (lang, a, b), n in large_pairs.items()]
        found = found.unionByName(documents.sparkSession.createDataFrame(known, _NODES))
    return found


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, size, a, and l, r and score of the lowest-scoring cut of each phrase."""
    joined = F.concat_ws(" ", *(F.col(c).cast("string") for c in "abc"))
    three = F.col("c").isNotNull()

    def cut(k: int, left, rest) -> F.Column:
        return F.struct(F.lit(k).alias("k"), left.alias("l"), rest.alias("rest"))

    rest_of_three = F.concat_ws(" ", F.col("b").cast("string"), F.col("c").cast("string"))
    cuts = F.when(three, F.array(cut(1, F.col("n1"), rest_of_three), cut(2, F.col("n2"), F.col("c").cast("string")))).otherwise(
        F.array(cut(1, F.col("n1"), F.col("b").cast("string")))
    )
    each = phrases.select("lang", joined.alias("phrase"), F.when(three, 3).otherwise(2).alias("size"), F.col("n").alias("a"), F.explode(cuts).alias("cut"))
    counts = words.filter(F.col("n") >= LEAST).select("lang", F.col("word").cast("string").alias("rest"), F.col("n").alias("r")).unionByName(
        phrases.filter(~three).select("lang", joined.alias("rest"), F.col("n").alias("r"))
    )
    # Products of counts pass 64 bits: decimals of 38 digits hold 10**6 * a * a for a below 10**16.
    exact = lambda c: F.col(c).cast("decimal(18,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    cuts = each.select("lang", "phrase", "size", "a", "cut.*").join(counts, ["lang", "rest"]).withColumns(
        {"_top": (exact("a") * exact("a") * million).cast("decimal(38,0)"), "_by": (exact("l") * exact("r")).cast("decimal(38,0)")}
    )
    lowest = F.min(F.struct(F.expr("_top div _by").alias("score"), "k", "l", "r")).alias("low")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(lowest).select("lang", "phrase", "size", "a", "low.l", "low.r", "low.score")


def collocations(documents: DataFrame, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """The ``top`` collocations of each language of ``documents`` (text, lang, ...).

    Returns lang, rank (from 1), phrase (words joined by a space), a, l, r, n and score as
    in: words are what stands between blanks (space, tab) in pieces between ``.,;:!?`` and
    line ends, ASCII letters lower-cased; a phrase has two or three words of a piece and
    occurs ``LEAST`` times or more; ``a`` counts it, ``l`` and ``r`` the two parts of the cut
    of the lowest score floor(10**6 a a / (l r)), ties to the shortest first part; ``n``
    counts the language's words. A phrase inside a longer one that holds ``COVERED``
    percent of its occurrences is left out. Ties go to the larger ``a``, then the lesser
    phrase in byte order. Null languages count as ``und``, null texts as empty; repeated
    rows and ids count each time; other columns are ignored; an empty table gives none.
    """
    words = stored(count_words(documents), "words")
    phrases = stored(count_phrases(documents, words, budget), "phrases")
    text = lambda *names: F.concat_ws(" ", *(F.col(c).cast("string") for c in names))
    longer = (
        phrases.filter("c is not null")
        .select("lang", F.explode(F.array(text("a", "b"), text("b", "c"))).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("_longer"))
    )
    kept = _scored(phrases, words).join(longer, ["lang", "phrase"], "left")
    # A phrase of three words has no longer one.
    kept = kept.filter((F.col("size") == WORDS_MOST) | F.col("_longer").isNull() | (100 * F.col("_longer") < COVERED * F.col("a")))
    order = F.desc("score"), F.desc("a"), "phrase"
    # The best of each share of a language first, so that no task meets all its phrases.
    share = F.pmod(F.xxhash64("phrase"), F.lit(_SHARES)).alias("_share")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
