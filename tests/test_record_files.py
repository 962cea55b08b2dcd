"""Text files of records at scale: compressed, and read without shuffling a text."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from tests.test_runs import stored

from profileloom.checks.catalogue import QUERIES
from profileloom.fixed_values import CATEGORIES
from profileloom.schemas import RECORD_TYPE
from profileloom.sources import records as record_io


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_text_records_are_compressed_and_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(record_io, "LINES_PER_FILE", 1)
    record_io.write_records(stored(spark).coalesce(1), str(tmp_path / "r"))
    files = sorted((tmp_path / "r").glob("part-*"))
    assert [len(gzip.decompress(f.read_bytes()).splitlines()) for f in files] == [1, 1]
    assert sorted(r.university_name for r in record_io.read_records(spark, str(tmp_path / "r")).collect()) == ["Other U", "Test U"]


@pytest.mark.parametrize("packed", [False, True])
def test_places_follow_files_and_blocks_without_shuffled_texts(spark, tmp_path, packed):
    lines = [json.dumps({"n": n, "pad": "x" * (n % 50)}) for n in range(400)]
    for name, part in (("b", lines[:300]), ("c", lines[300:])):
        text = ("\n".join(part) + "\n").encode()
        (tmp_path / f"{name}.jsonl{'.gz' if packed else ''}").write_bytes(gzip.compress(text) if packed else text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = record_io.record_lines(spark, str(tmp_path))
        assert packed or read.rdd.getNumPartitions() > 5
        plan = executed(read)
        assert [r.line for r in read.orderBy("ord").collect()] == lines
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    shuffled = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "hashpartitioning" in line]
    assert not any("line#" in line or "value#" in line for line in shuffled)
    assert "SortMergeJoin" not in plan and plan.split("== Initial Plan ==")[0].count("Window ") == 1


def test_the_query_writes_little(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("profileloom.checks.record_queries.fresh_path", lambda _, label: str(tmp_path / label))
    assert QUERIES["records_roundtrip"](spark, "/root/testdata/sf0.001").count() == 1500
    packed = list((tmp_path / "records").glob("part-*"))
    assert sum(len(gzip.decompress(f.read_bytes())) for f in packed) > 8 * sum(f.stat().st_size for f in packed)


def test_columnar_records_are_shuffled_only_where_names_repeat(spark, tmp_path):
    def kept(label, rows):
        frame = spark.createDataFrame(rows, "ord bigint, university_name string")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD_TYPE.fields if f.name != "university_name"]
        path = str(tmp_path / label)
        record_io.write_records(frame.select("*", *empty), path, "parquet")
        return record_io.read_records(spark, path, "parquet")

    once = kept("once", [(i, f"U{i}") for i in range(20)] + [(99, None)])
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert sorted(r.ord for r in once.collect()) == list(range(20))
    rows = [(1, "A"), (7, "A"), (3, "B"), (4, "C"), (5, "C"), (9, None)]
    assert sorted((r.ord, r.university_name) for r in kept("twice", rows).collect()) == [(3, "B"), (5, "C"), (7, "A")]


def test_flat_rows_are_compressed_and_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(record_io, "LINES_PER_FILE", 1)
    path = tmp_path / "flat"
    record_io.write_flat(stored(spark).coalesce(1), str(path))
    parts = [gzip.decompress(f.read_bytes()).decode().splitlines() for f in sorted(path.glob("part-*"))]
    assert [len(lines) for lines in parts] == [1 + len(CATEGORIES)] * 2
    assert {lines[0] for lines in parts} == {",".join(record_io.FLAT_COLUMNS)}
    read = record_io.read_flat(spark, str(path)).collect()
    assert sorted({r.university_name for r in read}) == ["Other U", "Test U"] and len(read) == 2 * len(CATEGORIES)
