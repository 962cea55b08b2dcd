"""Packing, token files, pieces, tool calls and the pipeline."""

import json
import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from profileloom.llm import length_buckets, pieces, queries, token_files, tool_chat
from profileloom.runtime import fresh_path


@pytest.mark.parametrize("seed", range(12))
def test_bounds_pad_least(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 9)), int(rng.integers(1, 5))
    lengths, counts = np.sort(rng.choice(40, n, replace=False)), rng.integers(1, 9, n)
    padding = lambda bounds: sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))  # noqa: E731, B905
    best = min(padding([*some, lengths[-1]]) for r in range(min(k, n)) for some in combinations(lengths[:-1], r))
    bounds = length_buckets.best_bounds(lengths, counts, k)
    assert padding(bounds) == best and len(bounds) <= k


def test_packing_places_every_token_once(spark, awkward, nothing):
    frame = awkward.repartition(6)
    placed = length_buckets.pack(frame, max_tokens=50, buckets=3, budget=120).toPandas()
    size = {i: n for i, n in frame.selectExpr("doc_id", f"regexp_count(coalesce(text, ''), r'{length_buckets.TOKEN}') as n").collect() if i}
    for doc_id, n in size.items():
        mine = placed[placed.doc_id == doc_id].drop_duplicates("piece").sort_values("piece")
        assert mine.length.sum() == n and mine.start.tolist() == list(range(0, max(n, 1), 50))
    assert (placed.length <= placed.bound).all() and placed.bucket.nunique() <= 3
    assert not placed.duplicated(["bucket", "batch", "slot"]).any()
    batches = placed.groupby(["bucket", "batch"]).agg(n=("slot", "size"), top=("slot", "max"), bound=("bound", "first"))
    assert (batches.n == batches.top + 1).all()
    full = np.maximum(120 // np.maximum(batches.bound, 1), 1)
    assert (batches.n <= full).all() and (batches.n < full).groupby("bucket").sum().max() <= 1
    assert length_buckets.pack(nothing).count() == 0
    assert length_buckets.pack(frame.selectExpr("doc_id", "n_chars"), tokens="n_chars").count() >= frame.count()


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
@pytest.mark.parametrize("kind", ["zero", "small", "outliers", "wide"])
def test_blocks_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {
        "zero": np.zeros(n, np.int64), "small": rng.integers(7, 300, n), "wide": rng.integers(0, 2**32, n),
        "outliers": np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(0, 300, n)),
    }[kind]
    sizes = np.array([n // 3, n - n // 3])
    segment = token_files.encode_segment(ids, sizes)
    found, found_sizes = token_files.decode_segment(segment)
    assert (found == ids).all() and (found_sizes == sizes).all()
    for number in range(-(-n // token_files.BLOCK)):
        assert (token_files.decode_block(segment, number) == ids[128 * number : 128 * number + 128]).all()
    if kind == "outliers" and n == 3000:
        assert len(segment) < 2.2 * n


def test_pieces_of_a_text_give_its_ids():
    encode = token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER))
    random.seed(3)
    letters = " \n\t\x0b\x1c\x85\xa0　ab'sll1.́é<|,é²"
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(40))) for _ in range(3000)]
    texts += ["It's  the\n\n <|endoftext|>, don't!", "", "x" * 300 + ", " + "y" * 200, " 'll 've"]
    assert all((a == encode.whole(t)).all() for a, t in zip(encode(texts), texts, strict=True))


def test_added_tokens_in_texts_get_the_librarys_ids(spark):
    from tokenizers import AddedToken, Tokenizer

    path = public_tokenizers.path(token_files.TOKENIZER)
    library = Tokenizer.from_file(path)
    ids = lambda t: library.encode(t, add_special_tokens=False).ids
    end = "<|endoftext|>"
    texts = ["a<|endoftext|>b", end, end * 2, f" {end}  {end}\n", f"it{end}'s  <|endoftext| >, don{end}'t!", f"<|end{end}oftext|>"]
    random.seed(4)
    texts += ["".join(random.choice([end, " ", "  ", "\n", "a", "'s", "<|", "|>", "é", "endoftext"]) for _ in range(12)) for _ in range(2000)]
    assert ids("a<|endoftext|>b") == [64, 50256, 65]
    assert all(a.tolist() == ids(t) for a, t in zip(token_files.Encoder(path)(texts), texts, strict=True))
    rows = token_files.round_trip(spark.createDataFrame(list(enumerate(texts[:6])), "doc_id long, text string")).collect()
    expected = [np.array([*ids(t), token_files.END_ID], "<u4") for t in texts[:6]]
    starts = np.cumsum([0, *map(len, expected)]).tolist()
    assert sorted(map(tuple, rows)) == [(i, starts[i], len(e), zlib.crc32(e.tobytes())) for i, e in enumerate(expected)]

    library.add_tokens([AddedToken("zq", lstrip=True)])
    other = fresh_path(spark, "tokenizer").removeprefix("file:")
    library.save(other)
    texts = ["a  zq b", f"zqzq{end} zq", "plain text"]
    assert [a.tolist() for a in token_files.Encoder(other)(texts)] == [ids(t) for t in texts]


def test_token_files_round_trip(spark, awkward, nothing):
    rows = token_files.round_trip(awkward.repartition(5)).toPandas().sort_values("start")
    assert (rows.start.to_numpy() == np.r_[0, np.cumsum(rows.n_tokens)[:-1]]).all()
    ids = rows.doc_id.dropna().tolist()
    assert ids == sorted(ids) and len(rows) == awkward.count()
    encode = token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER))
    crc = lambda t: zlib.crc32(np.r_[encode.whole(t or ""), 0].astype("<u4").tobytes())
    assert sorted(rows.ids_crc32) == sorted(crc(r.text) for r in awkward.collect())
    path = fresh_path(spark, "none")
    token_files.write_tokens(nothing, path)
    assert token_files.read_tokens(spark, path).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(public_tokenizers.path(pieces.MODEL))


def scan(v, text, chunk):
    whole, matrices, parts = v.processor.normalize(text), [], []
    for begin in range(0, len(whole), chunk):
        end, low = min(begin + chunk, len(whole)), max(0, begin - v.longest)
        part = whole[low : end + v.longest]
        matrix = pieces.transfer(v, part, begin - low, end - low if end < len(whole) else len(part))
        shift = lambda s, low=low: pieces._shift([s], low)[0]
        matrices.append({(shift(a), shift(b)): w for (a, b), w in matrix.items()})
        parts.append((part, low))
    outs = pieces.boundaries(matrices, len(whole))
    ids = []
    for (part, low), first, last in zip(parts, [pieces.START, *outs[:-1]], outs, strict=True):
        first, last = pieces._shift([first, last], -low)
        ids += [i for piece in pieces.trace(v, part, first, last) for i in v.ids(piece)]
    return matrices, ids


def test_scan_gives_the_librarys_ids(vocabulary):
    random.seed(5)
    parts = ["the", "  ", " ", "\n", "ing", "é", "漢", "\U0001f600", "aaaa", "    ", "tion", " of", "==", "1", "00", "<s>", "▁", "x"]
    for _ in range(200):
        text = "".join(random.choice(parts) for _ in range(random.randrange(1, 60)))
        assert scan(vocabulary, text, random.choice([3, 9, 25]))[1] == vocabulary.processor.encode(text)


def test_products_are_associative(vocabulary):
    a, b, c = scan(vocabulary, "the nation's  representatives of international organisations", 20)[0][:3]
    one, other = (pieces.compose(pieces.compose(a, b), c), pieces.compose(a, pieces.compose(b, c)))
    assert one.keys() == other.keys() and all(abs(one[k] - other[k]) < 1e-6 for k in one)


@pytest.mark.parametrize(("giant", "chunk"), [(50_000, 10_000), (100, 90)])
def test_encode_and_decode(vocabulary, awkward, nothing, giant, chunk):
    encode = vocabulary.processor.encode
    expected = sorted((str(r.doc_id), len(r.text or ""), pieces._crc(encode(r.text or ""))) for r in awkward.collect())
    found = pieces.encode_and_decode(awkward, giant=giant, chunk=chunk).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.ids_crc32) for r in found) == expected
    assert all(r.round_trip for r in found)
    assert pieces.encode_and_decode(nothing).count() == 0


def calls(*items):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), item, strict=False)) for item in items]})


def answer(name, content):
    return json.dumps({"tool_call_id": name, "content": content})


GOOD = {"text": "x" * 30, "lookup": "a", "z": {"b": 1, "a": [1, 2.5, None]}}
CHAT = [
    (1, 0, "user", 'hi "x"'),
    (1, 1, "assistant", calls(("b", "reply", GOOD, ["a"]), ("a", "lookup", '{"words": [], "length": 3}'))),
    (1, 2, "tool", answer("a", {"q": 1, "b": "é"})), (1, 3, "tool", answer("b", "5")),
    (1, 4, "tool", answer("zz", "5")), (1, 5, "tool", answer("b", "6")),
    (1, 6, "assistant", calls(
        ("c", "lookup", {"words": "no", "length": -1, "extra": 1}), ("d", "reply", GOOD, ["nope"]), ("e", "reply", GOOD, ["f"]),
        ("f", "reply", GOOD, ["e"]), ("b", "reply", GOOD, ["a"]), ("g", "what", "[]"), ("h", "what", {}), ("i", "reply", GOOD, ["b"]))),
    (None, None, None, None), (2, 0, "assistant", "{broken"), (2, 0, "assistant", "{broken"),
]


def test_tool_calls_are_linked_ordered_and_checked(spark):
    frame = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as id", "2 as step")
    rows = tool_chat.link_tools(frame, tool_chat.SCHEMAS).orderBy("conv_id", "turn", "step", "place", "part").collect()
    first = [(r.kind, r.id, r.status) for r in rows if r.conv_id == 1 and r.turn < 6]
    assert first == [
        ("message", None, "ok"), ("call", "a", "ok"), ("result", "a", "ok"), ("call", "b", "ok"), ("result", "b", "ok"),
        ("result", "zz", "orphan"), ("result", "b", "repeated"),
    ]
    status = {r.id: r.status for r in rows if r.turn == 6}
    assert status == {
        "c": "invalid", "d": "bad reference", "e": "cyclic", "f": "cyclic", "b": "repeated", "g": "invalid", "h": "invalid",
        "i": "unanswered",
    }
    for row in rows:
        assert row.json == json.dumps(json.loads(row.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert sum(r.conv_id == 2 for r in rows) == 2 and sum(r.conv_id is None for r in rows) == 1
    faults = json.loads(next(r.json for r in rows if r.id == "c"))["faults"]
    assert faults == ["words: not array", "length: minimum", "unknown arguments"]
    assert tool_chat.link_tools(frame.filter("false"), tool_chat.SCHEMAS).count() == 0


def test_results_before_their_call_are_early(spark):
    call = json.dumps({"tool_calls": [{"id": "a", "name": "reply", "arguments": "{}"}]})
    result = lambda text: json.dumps({"tool_call_id": "a", "content": text})
    chat = [
        (1, 1, "tool", result("x")), (1, 2, "assistant", call),
        (2, None, "tool", result("x")), (2, 1, "tool", result("x")), (2, 1, "tool", result("x")), (2, 2, "assistant", call),
        (2, 3, "tool", result("y")), (2, 3, "tool", result("y")), (2, 4, "tool", result("x")),
        (3, None, "assistant", call), (3, None, "tool", result("x")), (3, 1, "tool", result("w")),
    ]
    frame = spark.createDataFrame(chat, "conv_id long, turn long, role string, text string").repartition(4)
    rows = tool_chat.link_tools(frame, {"reply": {}}).orderBy("conv_id", "turn", "step", "place", "part").collect()
    found = lambda conv: [(r.turn, r.kind, r.status, json.loads(r.json).get("content")) for r in rows if r.conv_id == conv]
    assert found(1) == [(1, "result", "early", "x"), (2, "call", "unanswered", None)]
    early = [(None, "result", "early", "x"), (1, "result", "early", "x"), (1, "result", "early", "x")]
    more = [(3, "result", "repeated", "y"), (4, "result", "repeated", "x")]
    assert found(2) == [*early, (2, "call", "ok", None), (2, "result", "ok", "y"), *more]
    assert found(3) == [(None, "call", "ok", None), (None, "result", "ok", "x"), (1, "result", "repeated", "w")]


def test_steps_of_calls_equal_longest_chains(spark):
    random.seed(6)
    chats, expected = [], {}
    for conv in range(40):
        n = 600 if conv == 0 else random.randrange(1, 9)
        after = [[i - 1] if i else [] for i in range(n)] if conv == 0 else [random.sample(range(n), random.randrange(min(n, 3))) for _ in range(n)]
        calls = [{"id": f"c{i}", "name": "reply", "arguments": "{}", "after": [f"c{j}" for j in after[i]]} for i in range(n)]
        chats.append((conv, 1, "assistant", json.dumps({"tool_calls": calls})))
        levels = [0] * n
        for _ in range(n):
            levels = [max((levels[j] + 1 for j in some), default=0) for some in after]
        expected |= {(conv, f"c{i}"): (step, "cyclic" if step >= n else "unanswered") for i, step in enumerate(levels)}
    frame = spark.createDataFrame(chats, "conv_id long, turn long, role string, text string")
    rows = tool_chat.link_tools(frame, {"reply": {}}).collect()
    assert {(r.conv_id, r.id): (r.step, r.status) for r in rows} == expected


def test_derived_calls_of_the_table(spark):
    chats = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    log = {(r.conv_id, r.turn): r for r in chats.collect()}
    rows = queries.QUERIES["op9_tool_chat"](spark, "/root/testdata/sf0.001").collect()
    results = {(r.conv_id, r.turn): json.loads(r.json)["content"] for r in rows if r.kind == "result"}
    asked = [k for k, r in log.items() if r.role == "user"]
    answered = {(c, t): log[c, t + 1].text for c, t in asked if (c, t + 1) in log and log[c, t + 1].role == "assistant"}
    assert results == answered
    assert sum(r.kind == "call" for r in rows) == 2 * len(asked)


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "t").cache()
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
    placed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in placed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
