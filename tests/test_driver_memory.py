"""Tables that grow with the input are never copied to the driver, however small their files look."""

import pytest
from tests.test_runs import extractor, profiles, run_ts, snapshot
from tests.test_store_parts import found, stubs

from profileloom.functions import joins
from profileloom.plans.pipeline import run
from profileloom.schemas import HASH_STATE_TYPE
from profileloom.sources import record_store

ROBOTS = [("t.edu", "User-agent: *\nDisallow: /private"), ("o.edu", "")]


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def nothing_is_few(monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(record_store, "BROADCAST_NAMES", 0)


def test_a_run_broadcasts_nothing_that_grows(spark, tmp_path, nothing_is_few):
    def filed(frame, name):  # only of files does Spark know how small they are
        frame.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    robots = filed(spark.createDataFrame(ROBOTS, "site string, robots_text string"), "robots")
    hashes = filed(spark.createDataFrame([("https://t.edu/about", "a", None)], HASH_STATE_TYPE), "hashes")
    stored = filed(stubs(spark, ["Test U", "Other U"], "one"), "stored")
    colleges, shown = filed(profiles(spark), "profiles"), filed(snapshot(spark), "pages")
    again = run(colleges, shown, extractor("Toronto"), 2026, run_ts(), hashes, stored, robots=robots)
    assert "BroadcastExchange" not in physical(again.records)


def test_a_large_batch_and_its_places_are_not_broadcast(spark, tmp_path, nothing_is_few, monkeypatch):
    plans, write = [], record_store._write_parts
    monkeypatch.setattr(record_store, "_write_parts", lambda rows, path: (plans.append(physical(rows)), write(rows, path)))
    root, names = str(tmp_path / "store"), [f"U{i:03d}" for i in range(100)]
    for batch, label in ((names, "one"), (names[::2], "two")):
        record_store.put_records(stubs(spark, batch, label), root, buckets=2)
    assert len(plans) == 2 and not any("BroadcastExchange" in plan for plan in plans)
    assert found(spark, root) == {n: (i, "one" if i % 2 else "two") for i, n in enumerate(names)}


def test_few_planned_pages_leave_the_state_unshuffled(spark, tmp_path):
    few = spark.createDataFrame([("a",)], "url string")
    many = spark.range(10).selectExpr("cast(id as string) as url")
    for rows, kind in ((1, "BroadcastHashJoin"), (joins.BROADCAST_KEYS + 1, "SortMergeJoin"), (None, "SortMergeJoin")):
        assert kind in physical(many.join(joins.copied_if_few(few, rows), "url", "left_semi"))
