"""Whole-document JSON read in blocks of any size."""

import json
import random

import pytest

from profileloom.sources import profiles as profile_source
from profileloom.sources import records as record_io
from profileloom.sources.json_arrays import array_elements

_LETTERS = ["a", "é", '"', "\\", "\\\\", "{", "}", "[", "]", ",", ":", " ", "\n", "漢", "\\\"", "},{"]


@pytest.fixture
def blocks(spark):
    """Sets the size of blocks, and puts it back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")

    yield use
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _value(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    text = lambda: "".join(rng.choice(_LETTERS) for _ in range(rng.randrange(12)))
    if kind < 2:
        return text()
    if kind == 2:
        return rng.choice([None, True, 1.5, -3, "", 10**15])
    if kind == 3:
        return text() * 5
    if kind == 4:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {text(): _value(rng, depth + 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("size", [2, 17, 150, 1 << 20])
def test_elements_don_t_depend_on_blocks(spark, tmp_path, blocks, size):
    blocks(size)
    rng = random.Random(size)
    for indent in (None, 1):
        wanted = {}
        folder = tmp_path / f"in-{indent}"
        folder.mkdir()
        for name in "ab":
            values = [_value(rng) for _ in range(rng.randrange(9))]
            (folder / name).write_text(" \n" * rng.randrange(2) + json.dumps(values, indent=indent, ensure_ascii=False) + "\n" * rng.randrange(2))
            wanted |= {(name, i): v for i, v in enumerate(values)}
        found = array_elements(spark, str(folder)).collect()
        assert {(r.path.rsplit("/", 1)[1], r.pos): json.loads(r.text) for r in found} == wanted and len(found) == len(wanted)


@pytest.mark.parametrize("size", [3, 1 << 20])
def test_single_objects_and_nothing(spark, tmp_path, blocks, size):
    blocks(size)
    one = {"a": [1, {"b": "x,y"}], "c": "}, ]"}
    for name, text, wanted in (("one", json.dumps(one), [one]), ("none", "[ ]", []), ("blank", " \n", []), ("scalar", "5", [5])):
        (tmp_path / name).write_text(text)
        assert [json.loads(r.text) for r in array_elements(spark, str(tmp_path / name)).collect()] == wanted


@pytest.mark.parametrize("size", [2, 1 << 20])
@pytest.mark.parametrize("text", ['[1,2', '["a]', '[{"a":1}]]', '[1],[2]', '[1,2] 3', '{"a":1}{"b":2}', "[1,,2]", "[,]", '{"a":1}\n{"b":2}', "not json"])
def test_broken_documents_are_errors(spark, tmp_path, blocks, size, text):
    blocks(size)
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="jsonl"):
        record_io.record_lines(spark, str(tmp_path / "x.json"), "json").collect()


@pytest.mark.parametrize("size", [29, 1 << 20])
def test_profiles_under_their_key(spark, tmp_path, blocks, size):
    blocks(size)
    entry = lambda i: {"name": f"U{i}", "country": "C", "base_url": "u", "seed_urls": {"about": [f"a{i},{i}", '"universities":[']}}
    document = {
        "version": [1, [2, {"universities": [{"name": "deep"}]}]], "note": 'say "universities": [1, 2',
        "universities": [entry(i) for i in range(9)], "more": [{"name": "no"}, [3]],
    }
    for indent in (None, 2):
        (tmp_path / "p.json").write_text(json.dumps(document, indent=indent))
        read = profile_source.read_profiles(spark, str(tmp_path / "p.json"))
        assert sorted((r.name, r.seed_urls["about"][0]) for r in read.collect()) == [(f"U{i}", f"a{i},{i}") for i in range(9)]
    (tmp_path / "p.json").write_text(json.dumps({"universities": [], "x": [1]}))
    assert profile_source.read_profiles(spark, str(tmp_path / "p.json")).count() == 0


def test_records_of_a_document_are_spread_over_tasks(spark, tmp_path, blocks):
    blocks(4096)
    (tmp_path / "all.json").write_text(json.dumps([{"university_name": f"U{i % 50}", "n": i, "pad": "x, y" * 20} for i in range(1000)]))
    lines = record_io.record_lines(spark, str(tmp_path / "all.json"), "json")
    assert lines.rdd.getNumPartitions() > 8
    found = sorted((r.ord, json.loads(r.line)["n"]) for r in lines.collect())
    assert found == [(i, i) for i in range(1000)]
