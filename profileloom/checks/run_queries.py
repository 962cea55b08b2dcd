"""Whole runs with robots, failures, reuse and stores, and the stores by themselves."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from profileloom.checks.inputs import dealt, run_sql
from profileloom.checks.record_queries import _FLAT_VIEWS, stored_records
from profileloom.checks.registry import register
from profileloom.plans.pipeline import run
from profileloom.runtime import fresh_path, materialise
from profileloom.schemas import RECORD_TYPE
from profileloom.sources import record_store
from profileloom.sources.pages import append_hash_changes, read_hash_state

# Colleges with a page about them and one of fees: some sites close the first to robots, some
# fail to serve the second, and some first pages change between two snapshots.
_COLLEGE = """
select c_custkey as k, concat('College ', cast(c_custkey as string)) as name, 'Canada' as country,
  concat('https://c', cast(c_custkey as string), '.example.edu') as base_url
from $customer"""


def _profiles(spark, sf_dir):
    seeds = F.create_map(
        F.lit("about"), F.array(F.concat("base_url", F.lit("/about"))), F.lit("tuition_fees"), F.array(F.concat("base_url", F.lit("/fees")))
    )
    return run_sql(spark, sf_dir, _COLLEGE).withColumn("seed_urls", seeds)


def _pages(colleges, version):
    of = F.concat(F.lit(" of "), F.col("k").cast("string"))
    text = F.when(F.col("k") % 3 == 0, F.lit(f" v{version}")).otherwise(F.lit(" v1"))
    about = F.struct(
        F.concat("base_url", F.lit("/about")).alias("url"), F.lit(200).alias("status_code"),
        F.concat(F.lit("<p>About"), of, text, F.lit("</p>")).alias("html"), F.lit(None).cast("string").alias("error"),
    )
    down = F.col("k") % 7 == 0
    fees = F.struct(
        F.concat("base_url", F.lit("/fees")).alias("url"), F.when(down, 503).otherwise(200).alias("status_code"),
        F.when(down, "").otherwise(F.concat(F.lit("<p>Fees"), of, F.lit("</p>"))).alias("html"),
        F.when(down, "HTTP status error: 503").alias("error"),
    )
    return colleges.select(F.explode(F.array(about, fees)).alias("page")).select("page.*")


def _robots(colleges):
    text = F.when(F.col("k") % 5 == 0, "User-agent: *\nDisallow: /about").otherwise("User-agent: *\nDisallow: /private")
    return colleges.select(F.regexp_replace("base_url", "https://", "").alias("site"), text.alias("robots_text"))


def _reader(label):
    """An extractor that raises on batches with the fees of every eleventh college."""

    def answer(batches):
        for batch in batches:
            text = [message.split("\nText:\n", 1)[1].strip() for message in batch["user_message"]]
            if any(t.startswith("Fees") and int(t.rsplit(" ", 1)[1]) % 11 == 0 for t in text):
                raise ValueError("unreadable fees")
            about = [
                json.dumps({"name": f"{t} {label}", "location": {"city": "C", "country": "Canada"}, "institution_type": "public"}) for t in text
            ]
            content = [a if category == "about" else "[]" for a, category in zip(about, batch["category"], strict=True)]
            yield batch[["ek", "category"]].assign(content=content)

    return answer


def _run(spark, colleges, version, label, **more):
    run_ts = F.lit("2026-01-01").cast("timestamp")
    return run(
        colleges.drop("k"), _pages(colleges, version), _reader(label), 2026, run_ts, robots=_robots(colleges), materialise=materialise, **more
    )


_FAILS = "(k % 11 = 0 and k % 7 <> 0)"
_FIRST = f"""
select k, name, case when k % 5 = 0 or {_FAILS} then name else concat('About of ', cast(k as varchar), ' v1 first') end as about_name,
  {_FAILS} as failed from $college"""


@register("select name as university_name, about_name, failed from $first", college=_COLLEGE, first=_FIRST)
def run_failures(spark, sf_dir):
    """One run whose extractor raises on some entities' requests: they get fallback records, no others do."""
    return _summary(_run(spark, dealt(_profiles(spark, sf_dir)), 1, "first").records)


@register(
    """
select name as university_name, failed and k % 2 = 1 as failed,
  case when k % 2 = 1 then about_name when k % 5 = 0 then name
    when k % 3 = 0 then concat('About of ', cast(k as varchar), ' v2 second') else about_name end as about_name
from $first""",
    college=_COLLEGE, first=_FIRST,
)
def run_incremental(spark, sf_dir):
    """Two runs into stores of records and hashes: the second, of every other entity, reuses what did not change."""
    records, state = fresh_path(spark, "records"), fresh_path(spark, "state")
    colleges = dealt(_profiles(spark, sf_dir))
    first = _run(spark, colleges, 1, "first")
    record_store.put_records(first.records, records)
    append_hash_changes(first.changes, state)
    batch = colleges.filter("k % 2 = 0")
    stored = record_store.read_store(spark, records)
    second = _run(spark, batch, 2, "second", state=read_hash_state(spark, state), previous=stored)
    record_store.put_records(second.records, records)
    append_hash_changes(second.changes, state)
    return _summary(record_store.read_store(spark, records))


def _summary(records):
    failed = F.exists("validation_flags", lambda flag: flag["field"] == "orchestrator")
    return records.select("university_name", F.col("data.about.name").alias("about_name"), failed.alias("failed"))


@register(
    """
select ek as ord, name as university_name, n_tuition as n_fees, n_course,
  case when ek % 50 = 0 then 'changed' when ek % 11 = 0 then 'Unknown' when ek % 23 = 0 then '' else name end as about_name
from $rec"""
)
def record_store_upsert(spark, sf_dir):
    """All records are stored, then a batch of changed ones: these are replaced in their places."""
    root = fresh_path(spark, "store")
    everything = stored_records(spark, sf_dir)
    record_store.put_records(everything, root)
    changed = F.col("data").withField("about", F.col("data.about").withField("name", F.lit("changed")))
    batch = record_store.read_store(spark, root).filter("ord % 50 = 0").withColumn("data", changed)
    record_store.put_records(batch.select(*RECORD_TYPE.fieldNames()), root)
    return record_store.read_store(spark, root).select(
        "ord", "university_name", F.size("data.tuition_fees").alias("n_fees"), F.size("data.course_listings").alias("n_course"),
        F.col("data.about.name").alias("about_name"),
    )


@register(
    """
select 'tuition_fees' as field, c.field_json as value, s.confidence, s.n_high + s.n_medium + s.n_low as n_flags
from (select ek from $rec where lower(name) = 'entity 42') f
join $cells c on c.ek = f.ek and c.field_name = 'tuition_fees' join $scores s on s.ek = f.ek and s.field = 'tuition_fees'""",
    **_FLAT_VIEWS,
)
def record_store_lookup(spark, sf_dir):
    """A field of one entity, from one bucket of a store of all records."""
    root = fresh_path(spark, "store")
    record_store.put_records(stored_records(spark, sf_dir), root)
    found = record_store.lookup_field(spark, root, "ENTITY 42", "tuition_fees")
    return found.withColumn("n_flags", F.size("validation_flags").cast("bigint")).drop("validation_flags")
