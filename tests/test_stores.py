"""The record store, lookups in it, and the hash state as changes."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tests.test_runs import profiles, run_ts

from profileloom.operators import incremental, records
from profileloom.schemas import RECORD_TYPE
from profileloom.sources import pages as page_source
from profileloom.sources import profiles as profile_source
from profileloom.sources import record_store, storage


def stubs(spark, names, city="none"):
    some = spark.createDataFrame([(n, "Canada", f"https://{i}.edu", {}) for i, n in enumerate(names)], profiles(spark).schema)
    built = records.stub_records(profile_source.with_keys(some), 2026, run_ts())
    about = F.col("data.about").withField("location", F.struct(F.lit(city).alias("city"), F.lit("Canada").alias("country")))
    return built.withColumn("data", F.col("data").withField("about", about)).select(*RECORD_TYPE.fieldNames())


def found(spark, root):
    return {r.university_name: (r.ord, r.data.about.location.city) for r in record_store.read_store(spark, root).collect()}


def files(root):
    return {
        os.path.join(d, f): os.path.getsize(os.path.join(d, f))
        for d, _, names in os.walk(os.path.join(root, "data")) for f in names if f.endswith(".parquet")
    }


def test_a_batch_replaces_its_buckets_only(spark, tmp_path):
    root = str(tmp_path / "store")
    assert record_store.read_store(spark, root).isEmpty() and record_store.lookup_entity(spark, root, "x").isEmpty()
    names = [f"U{i:03d}" for i in range(200)]
    assert record_store.put_records(stubs(spark, names, "one"), root, buckets=16) == 1
    first = found(spark, root)
    assert sorted(first) == names and [n for n, _ in sorted(first.items(), key=lambda x: x[1][0])] == names
    before = files(root)
    assert record_store.put_records(stubs(spark, ["U007", "Znew", "Anew"], "two"), root) == 2
    second = found(spark, root)
    assert {n for n in second if second[n][1] == "two"} == {"U007", "Znew", "Anew"} and len(second) == 202
    assert second["U007"][0] == first["U007"][0] and max(o for o, _ in first.values()) < second["Anew"][0] < second["Znew"][0]
    assert {n: v for n, v in second.items() if n in first and n != "U007"} == {n: v for n, v in first.items() if n != "U007"}
    written = {f: n for f, n in files(root).items() if f not in before}
    assert len({os.path.dirname(f) for f in written}) <= 3 and sum(written.values()) < 0.4 * sum(before.values())
    assert not list((tmp_path / "store" / "staged").glob("version=*"))


def test_repeated_and_broken_batches_are_harmless(spark, tmp_path):
    root = str(tmp_path / "store")
    record_store.put_records(stubs(spark, ["A", "B"], "one"), root, version=1)
    assert record_store.put_records(stubs(spark, ["A"], "other"), root, version=1) == 1
    assert {c for _, c in found(spark, root).values()} == {"one"}
    # A batch that ends before its manifest leaves files that no reader sees.
    half = stubs(spark, ["C"]).withColumns({"ord": F.lit(9).cast("bigint"), "name_key": F.lower("university_name")})
    half.write.parquet(f"{root}/data/version=00000002/bucket=0")
    assert sorted(found(spark, root)) == ["A", "B"]
    assert record_store.put_records(stubs(spark, ["D"], "two"), root) == 2
    assert sorted(found(spark, root)) == ["A", "B", "D"]
    assert record_store.put_records(stubs(spark, []), root) == 2
    record_store.drop_old_versions(spark, root)
    assert sorted(found(spark, root)) == ["A", "B", "D"] and storage.versions(spark, f"{root}/manifest") == [2]


def test_places_and_repeated_names(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = stubs(spark, ["A"], "old").withColumn("ord", F.lit(3).cast("bigint")).unionByName(stubs(spark, ["A"], "new").withColumn("ord", F.lit(5).cast("bigint")))
    nameless = stubs(spark, ["B"]).withColumns({"university_name": F.lit(None).cast("string"), "ord": F.lit(1).cast("bigint")})
    record_store.put_records(rows.unionByName(nameless), root)
    assert found(spark, root) == {"A": (5, "new")}


def test_lookups_read_one_bucket(spark, tmp_path, capsys):
    root = str(tmp_path / "store")
    record_store.put_records(stubs(spark, [f"U{i}" for i in range(100)] + ["u5"], "x"), root, buckets=8)
    assert [r.university_name for r in record_store.lookup_entity(spark, root, "U77").collect()] == ["U77"]
    assert record_store.lookup_entity(spark, root, "u5").collect()[0].university_name == "U5"  # the first place
    assert record_store.lookup_entity(spark, root, "nobody").isEmpty()
    field = record_store.lookup_field(spark, root, "u77", "about")
    assert field.collect()[0].field == "about" and record_store.lookup_field(spark, root, "u77", "nothing").isEmpty()
    capsys.readouterr()
    field.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(name_key,u77)" in plan.split("PushedFilters")[1] and "living_costs" not in plan.split("ReadSchema")[1]
    read = record_store._bucket_of(spark, root, "u77").inputFiles()
    assert 0 < len(read) <= len(record_store.read_store(spark, root).inputFiles()) / 4


def state_rows(spark, root, **more):
    return {r.url: (r.hash, r.fetched_at.year) for r in page_source.read_hash_state(spark, root, **more).collect()}


def hashes(spark, year, **of):
    rows = [(u, h, None) for u, h in of.items()]
    frame = spark.createDataFrame(rows, "url string, hash string, error string")
    return frame, F.lit(datetime(year, 1, 1))


def test_changes_follow_the_run(spark, tmp_path):
    root = str(tmp_path / "state")
    expected = {}
    many = {f"u{i}": "a" for i in range(50)}
    for year, of in ((2021, many), (2022, {"u1": "b", "u2": "a", "v": "n"}), (2023, {"u1": "a"}), (2024, {"u1": "a"}), (2025, {f"u{i}": "c" for i in range(20)})):
        state = page_source.read_hash_state(spark, root)
        frame, moment = hashes(spark, year, **of)
        assert {tuple(r) for r in incremental.next_state(frame, state, moment).collect()} >= {tuple(r) for r in state.join(frame, "url", "left_anti").collect()}
        changes = incremental.state_changes(frame, state, moment)
        changed = {u: h for u, h in of.items() if expected.get(u, (None,))[0] != h}
        assert {r.url: r.hash for r in changes.collect()} == changed
        expected |= {u: (h, year) for u, h in changed.items()}
        page_source.append_hash_changes(changes, root)
        assert state_rows(spark, root) == expected
    assert storage.versions(spark, root) == [1, 5] and storage.versions(spark, f"{root}/changes") == [1, 2, 3, 4, 5]
    assert state_rows(spark, root, before=3)["u1"] == ("b", 2022) and state_rows(spark, root, before=1) == {}
    failed, moment = hashes(spark, 2026, u1="z")
    assert incremental.state_changes(failed.withColumn("error", F.lit("x")), page_source.read_hash_state(spark, root), moment).isEmpty()


def test_a_repeated_change_is_harmless_and_the_state_is_not_shuffled(spark, tmp_path):
    root = str(tmp_path / "state")
    frame, moment = hashes(spark, 2021, **{f"u{i}": "a" for i in range(200)})
    page_source.write_hash_state(incremental.next_state(frame, page_source.read_hash_state(spark, root), moment), root)
    for word in ("b", "other"):
        frame, moment = hashes(spark, 2022, u3=word)
        page_source.append_hash_changes(incremental.state_changes(frame, page_source.read_hash_state(spark, root), moment), root, version=2)
    assert state_rows(spark, root)["u3"] == ("b", 2022)
    plan = page_source.read_hash_state(spark, root)
    plan.collect()
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
    assert page_source.write_hash_state(plan, root) == 3


@pytest.mark.parametrize("share", [0.0, 10.0])
def test_merging_keeps_the_state(spark, tmp_path, share):
    root = str(tmp_path / "state")
    for year in range(2021, 2025):
        frame, moment = hashes(spark, year, a=str(year), **{str(year): "x"})
        page_source.append_hash_changes(incremental.state_changes(frame, page_source.read_hash_state(spark, root), moment), root, merge_share=share)
    assert state_rows(spark, root) == {"a": ("2024", 2024)} | {str(y): ("x", y) for y in range(2021, 2025)}
    assert len(storage.versions(spark, root)) == (4 if share == 0 else 1)
