"""Byte-pair encoding by a pair occurrence index, and decoding.

All words that a batch of documents brings for the first time are laid out in one
array of symbols. An index maps every pair that has a merge to all its positions; the
active ranks are applied in ascending order, each at all its positions, and every merge
updates the lists of the pairs it makes. The ids of words are remembered for the
worker's life.

Texts of ASCII and the letters of Western Europe are cut into words by one expression;
for others the tokenizer's normaliser and word pattern are applied by its library. The
merges are this module's for all.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from profileloom.llm.shared import map_arrow, sql_type, text_bytes

TOKENIZER = "word_bpe_49k.json"
# Characters that the tokenizer's normaliser only lower-cases, and the words of
# texts of nothing else, as the tokenizer's file gives them for all letters.
_NOT_PLAIN = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]")
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[!-/:-@\[-`{-~]+")
_REMEMBERED, _LONGEST = 600_000, 64


class Merges:
    """``rank`` of a pair packed as left << 32 | right; of each rank the ``pair`` and the symbol ``made``.

    From (left, right, made) in the order of ranks.
    """

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.pair = [a << 32 | b for a, b, _ in merges]
        self.made = [c for *_, c in merges]
        self.rank = {p: r for r, p in enumerate(self.pair)}
        self._ranks = np.argsort(np.array(self.pair, np.int64), kind="stable")
        self._pairs = np.array(self.pair, np.int64)[self._ranks]

    def index(self, symbols: list[int]) -> dict[int, list[int]]:
        """All positions of every pair that has a merge, by rank; negative symbols are in none."""
        row = np.array(symbols, np.int64)
        pairs = np.where((row[:-1] >= 0) & (row[1:] >= 0), row[:-1] << 32 | row[1:], -1)
        near = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
        places = np.flatnonzero(self._pairs[near] == pairs) if len(self._pairs) else near[:0]
        ranks = self._ranks[near[places]]
        order = np.argsort(ranks, kind="stable")
        found, starts = np.unique(ranks[order], return_index=True)
        lists = np.split(places[order], starts[1:])
        return {rank: list_.tolist() for rank, list_ in zip(found.tolist(), lists, strict=False)}


def merge_words(words: list[list[int]], merges: Merges) -> list[list[int]]:
    """The symbols of each word after all merges.

    Within a word the lowest rank goes first and of one rank the leftmost position,
    whatever the order of the merges. Symbols are numbers of 0 or more.
    """
    symbols, starts = [-1], []  # -1 stands between words and pairs with nothing
    for word in words:
        starts.append(len(symbols))
        symbols += word
        symbols.append(-1)
    after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    rank_of, index = merges.rank.get, merges.index(symbols)
    active = list(index)
    heapify(active)
    while active:
        rank = heappop(active)
        places, made, pair = sorted(index.pop(rank)), merges.made[rank], merges.pair[rank]
        left, right, lower = pair >> 32, pair & 0xFFFFFFFF, False
        for k, at in enumerate(places):
            next_at = after[at]
            if symbols[at] != left or symbols[next_at] != right:
                continue  # a merge has taken part of it
            symbols[at], symbols[next_at] = made, -2
            behind, beyond = before[at], after[next_at]
            after[at], before[beyond] = beyond, at
            for pair, place in ((symbols[behind] << 32 | made, behind), (made << 32 | symbols[beyond], at)):
                found = rank_of(pair)  # a pair with -1 has none
                if found is not None:
                    if found in index:
                        index[found].append(place)
                    else:
                        index[found] = [place]
                        heappush(active, found)
                    lower = lower or found < rank
            if lower:  # goes before the rest of this rank
                if rest := places[k + 1 :]:
                    index[rank] = index.get(rank, []) + rest
                    heappush(active, rank)
                break
    return [[s for s in symbols[a : a + len(word)] if s >= 0] for a, word in zip(starts, words, strict=True)]


class Encoder:
    """Ids of whole texts by a byte-level BPE file with word ends, and their decoding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        odd = {k for k in ("dropout", "unk_token", "continuing_subword_prefix") if model[k] is not None}
        if odd or told["decoder"] is not None or told["post_processor"] is not None:
            raise ValueError(f"this encoder reads plain word-end BPE files only, not {sorted(odd)}")
        tokenizer = Tokenizer.from_file(path)
        self._normalise, self._cut_words = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self._show = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._merges = Merges([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs])
        self._inner = {s: i for s, i in vocabulary.items() if len(s) == 1}
        self._last = {s[0]: i for s, i in vocabulary.items() if len(s) == 1 + len(suffix) and s.endswith(suffix)}
        added = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", t.content) for t in added.values()):
            raise ValueError("added tokens that reach into the text around them")
        self._token = {i: s for s, i in vocabulary.items()} | {i: t.content for i, t in added.items()}
        self._added = {t.content: str(i) for i, t in added.items()}
        self._cut = re.compile(f"({'|'.join(sorted(map(re.escape, self._added), key=len, reverse=True))})")
        self._forget()

    def _forget(self) -> None:
        #: Of known words the decimal ids, and the text they decode to, both joined by spaces.
        self._ids, self._decoded = dict(self._added), {content: content for content in self._added}

    def decode(self, ids: list[int]) -> str:
        """The tokens of ids, special ones too, joined by spaces as the library does for this file."""
        return " ".join([self._token[i] for i in ids if i in self._token])

    def _words(self, text: str) -> list[str]:
        """The words of a text; an added token is one of its own, and no other word is like it."""
        if "<" in text and len(parts := self._cut.split(text)) > 1:
            return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._words(part))]
        if not _NOT_PLAIN.search(text):
            return _WORD.findall(text.lower())
        normal = self._normalise(text)
        return [normal[a:b] for _, (a, b) in self._cut_words(normal)]

    def _learn(self, words: list[str]) -> None:
        """Puts words that none has brought before through the merges together."""
        shown = [w if w.isascii() and w.isprintable() else self._show(w)[0][0] for w in words]
        symbols = [[*map(self._inner.__getitem__, s[:-1]), self._last[s[-1]]] for s in shown]
        coded = merge_words(symbols, self._merges)
        self._ids.update(zip(words, [" ".join(map(str, ids)) for ids in coded], strict=True))
        self._decoded.update(zip(words, map(self.decode, coded), strict=True))

    def __call__(self, texts: list[str]) -> list[tuple[str, str]]:
        """Of each text its decimal ids, and the text they decode to."""
        if len(self._ids) > _REMEMBERED:
            self._forget()
        words = list(map(self._words, texts))
        new = sorted(set().union(*words).difference(self._ids))
        self._learn(new)
        ids, decoded = self._ids.__getitem__, self._decoded.__getitem__
        coded = [(" ".join(map(ids, each)), " ".join(map(decoded, each))) for each in words]
        for word in new:
            if len(word) > _LONGEST:
                del self._ids[word], self._decoded[word]
        return coded


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker, with what it remembers."""
    return Encoder(path)


def _path(tokenizer: str | None) -> str:
    return tokenizer or public_tokenizers.path(TOKENIZER)


def _by_texts(documents: DataFrame, columns: dict[str, tuple[str, pa.DataType]], make, tokenizer: str | None) -> DataFrame:
    """doc_id and the columns that ``make`` makes of every text's ids and decoded text."""
    path = _path(tokenizer)
    schema = ", ".join([f"doc_id {sql_type(documents, 'doc_id')}", *(f"{name} {kind}" for name, (kind, _) in columns.items())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            if batch.num_rows:
                texts = [t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
                made = zip(*map(make, encode(texts)), strict=True)
                arrays = [pa.array(values, kind) for values, (_, kind) in zip(made, columns.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *columns])

    return map_arrow(documents.select("doc_id", text_bytes().alias("text")), work, schema)


def encode(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ids (array<long>) of every whole text of ``documents`` (doc_id, text, ...).

    The ids are the library's without special tokens added; added tokens that stand in a
    text get their own. Null counts as empty, and empty texts and texts of white space
    have no ids. Null and repeated doc_ids and repeated rows are rows like others; other
    columns are ignored; an empty table gives none.
    """
    columns = {"ids": ("array<bigint>", pa.list_(pa.int64()))}
    return _by_texts(documents, columns, lambda coded: ([int(i) for i in coded[0].split()],), tokenizer)


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, ids, ...): all tokens, special ones too.

    Null ids count as none and give the empty text; ids outside the vocabulary have no
    token.
    """
    path = _path(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = _encoder(path).decode
        for batch in batches:
            texts = [decoded(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), work, f"doc_id {sql_type(encoded, 'doc_id')}, text string")


def encode_and_decode(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per document doc_id, n_tokens, ids_sha256 and decoded_sha256, in one pass.

    The digests are those of the decimal ids joined by one space, and of the text
    ``decode`` gives for them. Rows are defined as in ``encode``.
    """

    def digests(coded: tuple[str, str]) -> tuple[int, str, str]:
        n = coded[0].count(" ") + 1 if coded[0] else 0
        return n, *(hashlib.sha256(x.encode()).hexdigest() for x in coded)

    columns = {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}
    return _by_texts(documents, columns, digests, tokenizer)
