"""Whole runs, incremental reuse, storage, lookups and the change feed."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from profileloom.fixed_values import CATEGORIES
from profileloom.operators import incremental, records
from profileloom.plans.pipeline import block_by_robots, run
from profileloom.sources import pages as page_source
from profileloom.sources import profiles as profile_source
from profileloom.sources import records as record_io
from profileloom.sources import storage
from profileloom.streaming.incremental import latest_state, start_change_feed

PROFILE = "name string, country string, base_url string, seed_urls map<string,array<string>>"
PAGES = "url string, status_code int, html string, error string"


def run_ts():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def profiles(spark):
    seeds = {"about": ["https://t.edu/about"], "tuition_fees": ["https://t.edu/fees", "https://t.edu/gone"]}
    other = {"about": ["https://o.edu/about"]}
    return spark.createDataFrame(
        [("Test U", "Canada", "https://t.edu", seeds), ("Other U", "Brazil", "https://o.edu", other)], PROFILE
    )


def snapshot(spark, about="Version one", fees="Fees are 5"):
    rows = [
        ("https://t.edu/about", 200, f"<p>{about}</p>", None),
        ("https://t.edu/fees", 200, f"<p>{fees}</p>", None),
        ("https://t.edu/gone", 404, "<p>no such page</p>", None),
        ("https://o.edu/about", 503, "", "HTTP status error: 503"),
    ]
    return spark.createDataFrame(rows, PAGES)


def extractor(city):
    def answer(batches):
        for batch in batches:
            about = json.dumps({"name": "Test U", "location": {"city": city, "country": "Canada"}, "institution_type": "public"})
            content = batch["category"].map({"about": about, "tuition_fees": "garbage"})
            yield batch[["ek", "category"]].assign(content=content)

    return answer


def by_name(frame):
    return {r.university_name: r for r in frame.collect()}


def test_incremental_runs_reuse_unchanged_categories(spark):
    first = run(profiles(spark), snapshot(spark), extractor("Toronto"), 2026, run_ts())
    one = by_name(first.records)
    assert one["Test U"].data.about.location.city == "Toronto"
    assert one["Test U"].data.tuition_fees == []
    assert one["Other U"].data.about.name == "Other U"
    assert set(one["Test U"].field_confidence) == set(CATEGORIES)
    state = {r.url: r for r in first.state.collect()}
    assert sorted(state) == ["https://t.edu/about", "https://t.edu/fees", "https://t.edu/gone"]

    stored = spark.createDataFrame(first.records.collect(), first.records.schema)
    hashes = spark.createDataFrame(list(state.values()), first.state.schema)
    same = run(profiles(spark), snapshot(spark), extractor("Vancouver"), 2026, run_ts(), hashes, stored)
    assert by_name(same.records)["Test U"].data.about.location.city == "Toronto"

    new_page = run(profiles(spark), snapshot(spark, "Version two"), extractor("Vancouver"), 2026, run_ts(), hashes, stored)
    assert by_name(new_page.records)["Test U"].data.about.location.city == "Vancouver"
    later = {r.url: r.hash for r in new_page.state.collect()}
    assert later["https://t.edu/about"] != state["https://t.edu/about"].hash
    assert later["https://t.edu/fees"] == state["https://t.edu/fees"].hash


def test_store_keeps_other_entities_and_places(spark):
    first = run(profiles(spark), snapshot(spark), extractor("Toronto"), 2026, run_ts())
    store = spark.createDataFrame(first.store.collect(), first.store.schema)
    assert {r.university_name: r.ord for r in store.collect()}.keys() == {"Test U", "Other U"}
    kept = {r.university_name: r.ord for r in store.collect()}
    assert kept["Other U"] < kept["Test U"]
    hashes = spark.createDataFrame(first.state.collect(), first.state.schema)
    batch = profiles(spark).filter("name = 'Test U'").unionByName(
        spark.createDataFrame([("A new U", "Canada", "https://n.edu", {})], PROFILE)
    )
    later = run(batch, snapshot(spark, "Version two"), extractor("Vancouver"), 2026, run_ts(), hashes, store)
    found = by_name(later.store)
    assert sorted(found) == ["A new U", "Other U", "Test U"]
    assert found["Other U"] == by_name(store)["Other U"]
    assert found["Test U"].ord == kept["Test U"] and found["A new U"].ord > max(kept.values())
    assert found["Test U"].data.about.location.city == "Vancouver"


def test_robots_of_the_entitys_site_bind_its_plan(spark):
    seeds = {"about": ["https://t.edu/about"], "tuition_fees": ["https://t.edu/fees"]}
    both = spark.createDataFrame(
        [("Test U", "Canada", "https://t.edu", seeds), ("Guest U", "Canada", "https://g.edu", seeds)], PROFILE
    )
    rules = spark.createDataFrame([("t.edu", "User-agent: *\nDisallow: /about")], "site string, robots_text string")
    seen = run(both, snapshot(spark), extractor("Toronto"), 2026, run_ts(), robots=rules)
    found = by_name(seen.records)
    assert found["Test U"].data.about.location.city != "Toronto"
    assert found["Guest U"].data.about.location.city == "Toronto"


def test_failed_entities_get_the_fallback_and_no_others(spark):
    errors = spark.createDataFrame([("Other U", "boom"), ("Other U", "again")], "university_name string, error string")
    found = by_name(run(profiles(spark), snapshot(spark), extractor("Toronto"), 2026, run_ts(), errors=errors).records)
    assert found["Other U"].validation_flags[0].issue.endswith("boom") and len(found) == 2
    assert set(found["Other U"].field_confidence.values()) == {0.0}
    assert found["Test U"].data.about.location.city == "Toronto"


def test_repeated_answers_do_not_end_a_run(spark):
    once = extractor("Toronto")

    def twice(batches):
        for batch in once(batches):
            yield batch
            yield batch

    found = by_name(run(profiles(spark), snapshot(spark), twice, 2026, run_ts()).records)
    assert found["Test U"].data.about.location.city == "Toronto"


def test_run_without_extractor_gives_defaults(spark):
    found = by_name(run(profiles(spark), snapshot(spark), None, 2026, run_ts()).records)
    stubs = records.stub_records(profile_source.with_keys(profiles(spark)), 2026, run_ts())
    expected = by_name(stubs)
    for name in expected:
        assert found[name].data == expected[name].data
        assert found[name].field_confidence == {c: 0.3 - 0.25 for c in CATEGORIES}


def test_robots_turn_pages_into_failures(spark):
    pages = snapshot(spark).withColumn("site", F.regexp_extract("url", "//([^/]*)", 1))
    robots = spark.createDataFrame([("t.edu", "User-agent: *\nDisallow: /fees\nAllow: /")], "site string, robots_text string")
    found = {r.url: r for r in block_by_robots(pages, robots, "profilebot/1.0").collect()}
    assert found["https://t.edu/fees"].error == "blocked_by_robots"
    assert found["https://t.edu/about"].error is None


def test_hash_state(spark):
    def pages(text):
        return spark.createDataFrame([("u", text, None)], "url string, hash string, error string")

    state = spark.createDataFrame([], "url string, hash string, fetched_at timestamp")
    assert incremental.page_changes(pages("a"), state).collect()[0].has_changed
    state = incremental.next_state(pages("a"), state, run_ts())
    assert not incremental.page_changes(pages("a"), state).collect()[0].has_changed
    assert incremental.page_changes(pages("b"), state).collect()[0].has_changed
    failed = spark.createDataFrame([("u", "a", "x")], "url string, hash string, error string")
    assert incremental.page_changes(failed, state).collect()[0].has_changed
    assert incremental.next_state(failed, state, F.current_timestamp()).collect() == state.collect()


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 0, 1), ("b", 1, 1)], "university_name string, ord int, v int")
    new = spark.createDataFrame([("b", 0, 2), ("c", 1, 2), ("c", 2, 3)], "university_name string, ord int, v int")
    once = incremental.upsert(old, new)
    twice = incremental.upsert(once, new)
    expected = [("a", 1), ("b", 2), ("c", 3)]
    assert sorted((r.university_name, r.v) for r in once.collect()) == expected
    assert sorted((r.university_name, r.v) for r in twice.collect()) == expected


def test_versions_are_never_overwritten(spark, tmp_path):
    root = str(tmp_path / "state")
    assert page_source.read_hash_state(spark, root).isEmpty()
    frame = spark.createDataFrame([("u", "h", None)], "url string, hash string, fetched_at timestamp")
    assert page_source.write_hash_state(frame, root) == 1
    grown = page_source.read_hash_state(spark, root).unionByName(frame.withColumn("url", F.lit("v")))
    assert page_source.write_hash_state(grown, root) == 2
    assert page_source.write_hash_state(frame, root, version=2) == 2
    assert page_source.read_hash_state(spark, root).count() == 2
    assert storage.versions(spark, root) == [1, 2]


def stored(spark):
    built = records.stub_records(profile_source.with_keys(profiles(spark)), 2026, run_ts())
    return built.withColumn("ord", F.when(F.col("university_name") == "Test U", 0).otherwise(1).cast("bigint")).drop("ek")


def test_record_files(spark, tmp_path):
    path = str(tmp_path / "records")
    record_io.write_records(stored(spark), path)
    read = by_name(record_io.read_records(spark, path))
    assert read["Test U"].data == by_name(stored(spark))["Test U"].data
    assert read["Test U"].scraped_at == datetime(2026, 1, 1)
    assert record_io.read_records(spark, str(tmp_path / "none")).isEmpty()
    assert record_io.read_raw_records(spark, path).count() == 2
    flat = str(tmp_path / "flat")
    record_io.write_flat(stored(spark), flat)
    rows = record_io.read_flat(spark, flat).collect()
    assert len(rows) == 2 * len(CATEGORIES)
    assert json.loads(rows[0].flags_json)[0]["severity"] == "medium"


def test_array_document_of_records(spark, tmp_path):
    lines = [json.loads(r[0]) for r in stored(spark).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
    broken = {**lines[0], "data": {**lines[0]["data"], "about": None}, "university_name": "Broken"}
    again = {**lines[0], "field_confidence": {"about": 1}}
    path = tmp_path / "all.json"
    path.write_text(json.dumps([*lines, broken, again], indent=2))
    read = by_name(record_io.read_records(spark, str(path), "json"))
    assert sorted(read) == ["Other U", "Test U"]
    assert read[lines[0]["university_name"]].field_confidence == {"about": 1.0}
    path.write_text("not json")
    with pytest.raises(Exception, match="jsonl"):
        record_io.read_records(spark, str(path), "json").count()


def test_last_line_of_a_name_wins_without_positions(spark, tmp_path):
    line = json.loads(stored(spark).limit(1).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0])
    line.pop("ord")
    for name, years in (("a.jsonl", range(5)), ("b.jsonl", range(5, 9))):
        lines = [{**line, "data": {**line["data"], "about": {**line["data"]["about"], "name": f"v{y}"}}} for y in years]
        (tmp_path / name).write_text("\n".join(map(json.dumps, lines)) + "\n")
    read = record_io.read_records(spark, str(tmp_path)).collect()
    assert [r.data.about.name for r in read] == ["v8"]
    raw = record_io.read_raw_records(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r.data.about.name for r in raw] == [f"v{y}" for y in range(9)]


def test_record_formats(spark, tmp_path):
    path = str(tmp_path / "columnar")
    record_io.write_records(stored(spark), path, "parquet")
    read = by_name(record_io.read_records(spark, path, "parquet"))
    assert read["Test U"].data == by_name(stored(spark))["Test U"].data
    assert record_io.read_raw_records(spark, path, "parquet").count() == 2
    assert record_io.read_records(spark, str(tmp_path / "none"), "parquet").isEmpty()
    for use in (record_io.read_records, record_io.read_raw_records, record_io.read_truth):
        with pytest.raises(ValueError, match="unknown format"):
            use(spark, path, "csv")


def test_truth_formats_keep_every_object(spark, tmp_path):
    truth = [{"university_name": f"U{i}", "data": {"about": {"founding_year": 1900 + i}}} for i in range(3)]
    lines, array = tmp_path / "t.jsonl", tmp_path / "t.json"
    lines.write_text("\n".join(map(json.dumps, truth)))
    array.write_text(json.dumps(truth, indent=1))
    for path, fmt in ((lines, "jsonl"), (array, "json")):
        rows = record_io.read_truth(spark, str(path), fmt).collect()
        assert sorted((r.university_name, r.data.about.founding_year) for r in rows) == [(f"U{i}", 1900 + i) for i in range(3)]
    with pytest.raises(Exception, match="jsonl"):
        record_io.read_truth(spark, str(lines), "json").count()


def test_lookups(spark):
    frame = stored(spark)
    assert [r.university_name for r in records.list_entities(frame).collect()] == ["Test U", "Other U"]
    assert records.find_entity(frame, "test u").collect()[0].university_name == "Test U"
    assert records.find_entity(frame, "nobody").isEmpty()
    field = records.find_field(frame, "TEST U", "about").collect()[0]
    assert json.loads(field.value)["name"] == "Test U"
    assert field.confidence == 0.3 - 0.25 and len(field.validation_flags) == 1
    assert records.find_field(frame, "Test U", "nothing").isEmpty()


def test_failed_entity_gets_the_fallback_record(spark):
    keyed = profile_source.with_keys(profiles(spark))
    built = records.stub_records(keyed, 2026, run_ts())
    errors = keyed.filter("name = 'Other U'").select("ek", F.lit("boom").alias("error"))
    found = by_name(records.isolate_failures(built, keyed, errors))
    assert found["Other U"].field_confidence == {c: 0.0 for c in CATEGORIES}
    assert [(f.field, f.severity) for f in found["Other U"].validation_flags] == [("orchestrator", "high")]
    assert found["Test U"] == by_name(built)["Test U"]


def test_profile_files(spark, tmp_path):
    path = tmp_path / "profiles.json"
    entry = {"name": "U", "country": "C", "base_url": "u.edu", "seed_urls": {"about": ["a", "b"]}}
    path.write_text(json.dumps({"universities": [entry]}))
    read = profile_source.read_profiles(spark, str(path))
    seeds = profile_source.seed_rows(read, "name").collect()
    assert [(r.category, r.pos, r.url) for r in seeds] == [("about", 0, "a"), ("about", 1, "b")]
    assert profile_source.require_entity(read, "u").count() == 1
    with pytest.raises(ValueError):
        profile_source.require_entity(read, "x")
    path.write_text(json.dumps({"other": []}))
    with pytest.raises(Exception, match="root key"):
        profile_source.read_profiles(spark, str(path)).collect()


def test_change_feed(spark, tmp_path):
    source, state, changes, checkpoint = (str(tmp_path / n) for n in ("pages", "state", "changes", "ck"))

    def arrive(text, when):
        rows = [("u", 200, f"<p>{text}</p>", when, None), ("v", 200, "<p>same</p>", when, None)]
        schema = "url string, status_code int, html string, fetched_at timestamp, error string"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        start_change_feed(spark, source, state, changes, checkpoint).awaitTermination()

    arrive("one", datetime(2026, 1, 1))
    arrive("two", datetime(2026, 1, 2))
    assert latest_state(spark, state).count() == 2
    last = spark.read.parquet(f"{changes}/version=00000002").collect()
    assert [r.url for r in last] == ["u"]
