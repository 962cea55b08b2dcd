"""Pair index BPE, prefix trie and collocations against the library and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from profileloom.llm import collocations, pair_bpe, prefix_trie


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(pair_bpe.TOKENIZER))


@pytest.fixture(scope="module")
def encoder():
    return pair_bpe.Encoder(public_tokenizers.path(pair_bpe.TOKENIZER))


def _same(encoder, library, texts):
    for text, coded in zip(texts, encoder(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert coded == (" ".join(map(str, expected)), library.decode(expected, skip_special_tokens=False)), text


def test_ids_are_the_librarys(encoder, library):
    random.seed(5)
    letters = " \n\t\x0b\x1c\x1f\x85\xa0　ab'sll1.́é<|,²ΣςİßǅﬁÅ漢字᠎​ſK9٣"
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(40))) for _ in range(4000)]
    texts += ["a<|endoftext|>b", "<|ENDOFTEXT|>", " <|startoftext|><|endoftext|> x", "", " \n", "<|end<|endoftext|>oftext|>", "a" * 99]
    _same(encoder, library, texts)


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text_has_the_librarys_ids(encoder, library, texts):
    _same(encoder, library, texts)


def _merge_by_rank(word, table):
    """Textbook BPE: again and again the lowest rank, leftmost."""
    word = list(word)
    while True:
        best = min(((table[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in table), default=None)  # noqa: B905
        if best is None:
            return word
        i = best[1]
        word[i : i + 2] = [table[tuple(word[i : i + 2])][1]]


@pytest.mark.parametrize("seed", range(30))
def test_merges_in_any_order_of_ranks(seed):
    rng = random.Random(seed)
    symbols, merges = 3, []
    for _ in range(12):
        pair = rng.randrange(symbols), rng.randrange(symbols)
        if pair not in [m[:2] for m in merges]:
            merges.append((*pair, symbols))
            symbols += 1
    rng.shuffle(merges)  # a merge may now rank below those that make its parts
    table = {(a, b): (rank, made) for rank, (a, b, made) in enumerate(merges)}
    words = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(40)]
    assert pair_bpe.merge_words(words, pair_bpe.Merges(merges)) == [_merge_by_rank(w, table) for w in words]


def test_very_long_words_and_texts(encoder, library):
    text = "ab" * 100_000 + " " + "word, " * 50_000 + "é" * 50_000
    _same(encoder, library, [text])


def test_memory_of_stretches_may_run_over(monkeypatch, library):
    monkeypatch.setattr(pair_bpe, "_REMEMBERED", 5)
    small = pair_bpe.Encoder(public_tokenizers.path(pair_bpe.TOKENIZER))
    random.seed(6)
    for _ in range(20):
        _same(small, library, [" ".join(random.choice(["one", "two", "x" * 70, "été", "a1,b", "<|endoftext|>"]) for _ in range(9)) for _ in range(4)])


def test_documents_are_encoded_and_decoded(spark, awkward, nothing, library):
    frame = awkward.repartition(4)
    rows = {(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()}
    found = pair_bpe.encode_and_decode(frame).collect()
    expected = []
    for doc_id, text in ((r.doc_id, r.text) for r in frame.collect()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key) and rows
    encoded = pair_bpe.encode(frame)
    again = {r.doc_id: r.text for r in pair_bpe.decode(encoded).collect()}
    assert again[7] == "word</w>" and again[3] == "" and encoded.filter("doc_id = 7").first().ids == library.encode("word").ids
    assert pair_bpe.encode_and_decode(nothing).count() == 0 and pair_bpe.encode(nothing).count() == 0


# -- prefix trie ------------------------------------------------------------------------


def _trie(rows):
    """Brute force: every prefix of every rebuilt conversation, by direct counting."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(("" if c is None else str(c)).encode()) % 6
        base = None if c is None else c - int(np.fmod(c, 100))
        paths[c] = tuple(own.get(base, [])[:h] if base is not None else []) + tuple(own[c][h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    low = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    value = {p: (len(m) - 1) * len(p[-1][1]) if p else 0 for p, m in members.items()}
    out = []
    for p, m in members.items():
        under = [q for q in members if q[: len(p)] == p]
        children = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in under)]
        ends = sorted((c for c in m if paths[c] == p), key=lambda c: (c is not None, c or 0))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((low[p], len(p), low[p[:-1]] if p else None, len(m), len(children), len(leaves), sum(value[q] for q in under), digest))
    return out


_CONVERSATIONS = "conv_id long, turn long, role string, text string"


def _check_trie(spark, rows, extra=()):
    frame = spark.createDataFrame(rows, _CONVERSATIONS).repartition(5).selectExpr("*", *extra)
    key = lambda r: tuple(map(str, r))
    found = [tuple(r) for r in prefix_trie.prefix_trie(frame).collect()]
    assert sorted(found, key=key) == sorted(_trie(rows), key=key)


def test_trie_of_random_conversations(spark):
    rng = random.Random(8)
    ids = [0, 100, 200, -100, 300, *rng.sample(range(-150, 700), 60)]
    rows = [(c, t, rng.choice(["user", "system", None]), rng.choice(["", "a", "bé\U0001f600", None])) for c in set(ids) for t in range(rng.randrange(1, 8))]
    _check_trie(spark, rows, ("'x' as path", "1 as depth", "2 as n_convs", "3L as end"))


def test_trie_of_awkward_conversations(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (5, None, "user", "zero"), (5, 0, "user", "one"), (100, 3, "user", "x")]
    rows += [(c, 0, "user", "hello") for c in range(400, 460)]  # one conversation many times
    rows += [(c, 1, "assistant", "long " * 5000) for c in range(430, 450)]
    rows += [(601, 2, None, ""), (602, 2, "", None), (605, 0, "user", "same"), (606, 0, "user", "same")]
    _check_trie(spark, rows)
    deep = [(1, t, "user", str(t % 3)) for t in range(300)] + [(2, t, "user", "x" if t > 6 else str(t % 3)) for t in range(200)]
    _check_trie(spark, deep)


def test_repeated_rows_are_turns_and_empty_tables_have_no_nodes(spark):
    frame = spark.createDataFrame([(100, 1, "u", "a")] * 3, _CONVERSATIONS)
    assert {r.depth for r in prefix_trie.prefix_trie(frame).collect()} == {0, 1, 2, 3}
    assert prefix_trie.prefix_trie(frame.filter("false")).count() == 0


def test_ends_of_a_hot_node_go_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_BLOCK_BYTES", 64)
    _check_trie(spark, [(c, 0, "user", "hi") for c in range(0, 90_000, 100)])


# -- collocations -----------------------------------------------------------------------


def _collocations(rows, top=2000):
    """Brute force over (lang, text)."""
    counts = defaultdict(Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 10}
        covered = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if q in candidates and 100 * a >= 50 * candidates[q]}
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def _texts(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "city", "é", "\x1c", "x" * 40, "hot", "hot", "hot", "\U0001f600", "~", "a"]
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "?!"]
    text = lambda: "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60)))
    return [(rng.choice(["en", "fr", None]), rng.choice([text(), None, ""]) if i % 9 == 0 else text()) for i in range(n)]


@pytest.mark.parametrize("budget", [50, 700, 1 << 21])
def test_collocations_by_any_budget(spark, budget, monkeypatch):
    monkeypatch.setattr(collocations, "GATHERED", 600)
    monkeypatch.setattr(collocations, "_PART", 300)
    rows = _texts(budget) + [("en", "hot " * 2000), ("de", "der die das " * 30), ("de", None)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(6).selectExpr("*", "1 as a", "'x' as phrase", "2 as n", "3 as grp")
    found = [tuple(r) for r in collocations.collocations(frame, budget=budget).collect()]
    assert sorted(found) == sorted(_collocations(rows))


def test_only_the_best_stay_and_empty_tables_have_none(spark):
    rows = _texts(1)
    frame = spark.createDataFrame(rows, "lang string, text string")
    found = [tuple(r) for r in collocations.collocations(frame, top=5).collect()]
    assert sorted(found) == sorted(_collocations(rows, 5))
    assert collocations.collocations(frame.filter("false")).count() == 0


def test_scores_of_large_counts_are_exact(spark):
    a, left, right = 9_876_543_211, 12_345_678_901_234, 98_765_432_109
    phrases = spark.createDataFrame([("en", b"x", b"y", None, a, left, None)], collocations._NODES)
    words = spark.createDataFrame([("en", b"y", right)], "lang string, word binary, n bigint")
    (row,) = collocations._scored(phrases, words).collect()
    assert row.score == 10**6 * a * a // (left * right) and (row.l, row.r) == (left, right)


def test_groups_hold_their_budget(spark):
    rng = random.Random(2)
    rows = [("en", b"w%04d" % i, rng.choice([1, 3, 20, 200])) for i in range(600)]
    starts, large = collocations._packed(spark.createDataFrame(rows, "lang string, word binary, n bigint").repartition(3), 100)
    assert set(large) == {r[:2] for r in rows if r[2] > 100}
    groups = collocations._Groups(starts, large, [], {}, 100)
    held = Counter()
    for lang, word, n in rows:
        (group,) = groups.of_words(lang, [word])
        assert (group < 0) == (n > 100)
        held[group] += n if group >= 0 else 0
    assert max(held.values()) <= 100 and len(starts) <= 2 * sum(r[2] for r in rows) / 100 + 16
