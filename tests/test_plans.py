"""Plan shapes: no nested loops, no Python on native paths, skew-safe joins."""

import pytest

from profileloom.checks.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WITH_PYTHON = {"extractor_plugin"}
WRITES = {
    "flat_csv_roundtrip", "records_roundtrip", "records_parquet_roundtrip", "records_last_wins", "records_raw_load",
    "truth_read",
    "hash_state_runs", "run_failures", "run_incremental", "record_store_upsert", "record_store_lookup",
}


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_shape(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    # Seeds of the test inputs cross a two-row constant; nothing else may loop.
    if "BroadcastNestedLoopJoin" in plan:
        assert name.startswith(("frontier", "plan_")) and plan.count("BroadcastNestedLoopJoin") <= 2
    assert (("Python" in plan) or ("InPandas" in plan)) == (name in WITH_PYTHON)


def test_scans_read_only_needed_columns(spark):
    plan = physical(QUERIES["page_scan"](spark, SF_DIR))
    assert "html" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["page_changed", "plan_fetch_join", "plan_any_render", "robots_filter"])
def test_no_copies_of_a_joined_side(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "_salt" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_building_a_query_starts_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"build {name}", name)
    QUERIES[name](spark, SF_DIR)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(i) for i in tracker.getJobIdsForGroup(f"build {name}")]
    stages = [tracker.getStageInfo(i) for job in jobs if job for i in job.stageIds]
    # Reading the footers of a table's files for its schema is all that may run.
    assert all(stage.name.startswith("parquet at") for stage in stages if stage)
