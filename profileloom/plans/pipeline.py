"""The whole run as one lazy plan: profiles and page snapshot in, records out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.fixed_values import (
    BLOCKED_BY_ROBOTS,
    MAX_CONTEXT_CHARS,
    MAX_PAGES_PER_CATEGORY,
    MAX_URLS_PER_CATEGORY,
)
from profileloom.functions.joins import copied_if_few, shuffled
from profileloom.operators.assembly import (
    assemble_texts,
    extraction_requests,
    sources_or_base,
)
from profileloom.operators.extractor import Extractor, guarded_answers, stored_answers
from profileloom.operators.frontier import build_plan, fetch_plan, plan_with_render
from profileloom.operators.incremental import (
    category_reuse,
    merge_reused,
    next_state,
    page_changes,
    state_changes,
    stored_order,
)
from profileloom.operators.links import extract_links, followable_links
from profileloom.operators.pages import needs_render, plan_usable, with_clean_text
from profileloom.operators.records import FAILED, compile_data, finish_records
from profileloom.operators.robots import apply_robots, parse_rules, url_allowed
from profileloom.sources.profiles import seed_rows, with_keys


class RunResult(NamedTuple):
    """Lazy outputs of a run: ``records`` of this batch, ``store`` with all stored ones;
    ``state`` is the whole next state, ``changes`` what differs from the one before."""

    plan: DataFrame
    records: DataFrame
    state: DataFrame
    store: DataFrame
    changes: DataFrame


def block_by_robots(pages: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """Turns disallowed pages of ``pages(site, ...)`` into failed fetches."""
    judged = apply_robots(pages, robots, agent)
    blocked = ~F.col("allowed")
    return (
        judged.withColumn("error", F.when(blocked, "blocked_by_robots").otherwise(F.col("error")))
        .withColumn("status_code", F.when(blocked, 0).otherwise(F.col("status_code")))
        .withColumn("html", F.when(blocked, "").otherwise(F.col("html")))
        .drop("allowed")
    )


def entity_rules(profiles: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """``(ek, _rules)``: the rules of each entity's own site, which bind all its fetches."""
    sites = robots.select(F.col("site").alias("base_domain"), parse_rules(F.col("robots_text"), agent).alias("_rules"))
    return profiles.select("ek", "base_domain").join(shuffled(sites), "base_domain").select("ek", "_rules")


def _forbid(fetched: DataFrame, rules: DataFrame) -> DataFrame:
    """Planned pages an entity may not read come back as failed fetches."""
    judged = fetched.join(shuffled(rules), "ek", "left").withColumn("_no", ~url_allowed(F.col("_rules"), F.col("url")))
    return (
        judged.withColumn("error", F.when(F.col("_no"), BLOCKED_BY_ROBOTS).otherwise(F.col("error")))
        .withColumn("status_code", F.when(F.col("_no"), 0).otherwise(F.col("status_code")))
        .withColumn("clean_text", F.when(F.col("_no"), "").otherwise(F.col("clean_text")))
        .withColumn("has_changed", F.col("_no") | F.col("has_changed"))
        .drop("_no", "_rules")
    )


def plan_targets(
    profiles: DataFrame,
    pages: DataFrame,
    max_urls: int = MAX_URLS_PER_CATEGORY,
    max_pages: int = MAX_PAGES_PER_CATEGORY,
    materialise=None,
    rules: DataFrame | None = None,
) -> DataFrame:
    """Crawl plan of keyed profiles over a page snapshot.

    Links leave the page scan already judged and resolved; ``html`` is never shuffled.
    """
    usable = pages.filter(plan_usable(F.col("error"), F.col("status_code")))
    links = followable_links(extract_links(usable.select("url", "html")))
    plan = build_plan(seed_rows(profiles), profiles, links, max_urls, max_pages, materialise, rules)
    shell = needs_render(F.col("error"), F.col("status_code"), F.col("html"))
    shown = plan_with_render(plan, pages.select("url", shell.alias("needs_render")))
    if rules is None:
        return shown
    may = url_allowed(F.col("_rules"), F.col("url"))
    return shown.join(shuffled(rules), "ek", "left").withColumn("needs_render", F.col("needs_render") & may).drop("_rules")


def run(
    profiles: DataFrame,
    pages: DataFrame,
    extractor: Extractor | None,
    as_of_year: int,
    run_ts: Column,
    state: DataFrame | None = None,
    previous: DataFrame | None = None,
    max_urls: int = MAX_URLS_PER_CATEGORY,
    max_pages: int = MAX_PAGES_PER_CATEGORY,
    context_chars: int = MAX_CONTEXT_CHARS,
    materialise=None,
    robots: DataFrame | None = None,
    agent: str = "profilebot",
    errors: DataFrame | None = None,
    answer_store: str | None = None,
    extractor_tasks: int | None = None,
) -> RunResult:
    """Plans, reads, reuses, extracts, types, validates and scores every profile.

    ``pages(url, status_code, html, error)`` has one row per URL. With ``state``
    and ``previous`` (stored records) the run is incremental: categories whose
    pages did not change keep their stored value and never reach the extractor.
    ``materialise`` stores the plan and the answers, so that a costly extractor
    runs once however often the outputs are used.

    ``robots(site, robots_text)`` bind ``agent``: the rules of an entity's own site hold
    for every URL it plans, so one page may be open to one entity and closed to another.
    A request the extractor raises on makes its entity's record a fallback, with the error in
    its flag, and touches no other entity. ``errors(university_name, error)`` names entities
    whose work failed elsewhere; they get the fallback record, too. With ``answer_store``, a
    folder, answers are kept there, and no run asks for them again; ``extractor_tasks``
    spreads the extractor's calls, over as many tasks as a shuffle has unless it is given.
    ``store`` is ``previous`` with the
    batch's records put in; a record keeps its place ``ord``, new ones follow by name.
    """
    spark = profiles.sparkSession
    keep = materialise or (lambda df: df)
    keyed = with_keys(profiles)
    rules = None if robots is None else entity_rules(keyed, robots, agent)
    plan = keep(plan_targets(keyed, pages, max_urls, max_pages, materialise, rules))

    # Each planned page is cleaned and hashed once, however many plans name it. An
    # inner join, as a semi join would be pushed below the cleaning and shuffle html.
    planned = plan.select("url").distinct()
    planned = copied_if_few(planned, plan.count() if materialise else None)
    visited = with_clean_text(pages).join(planned, "url")
    # What is read of a page is cut before popular pages are copied to their plans.
    read = F.left("clean_text", F.lit(context_chars + 1)).alias("clean_text")
    known = state if state is not None else spark.createDataFrame([], "url string, hash string, fetched_at timestamp")
    # Of the state only what is planned: it isn't shuffled while the batch is small.
    seen = known.join(planned, "url", "left_semi")
    fetched = fetch_plan(plan, page_changes(visited, seen).select(
        "url", "status_code", "error", read, "has_changed"
    )).withColumn("has_changed", F.coalesce("has_changed", F.lit(True)))

    if rules is not None:
        fetched = _forbid(fetched, rules)
    texts = assemble_texts(fetched, context_chars)
    stored = None
    if previous is not None and state is not None:
        stored = previous.withColumn("ek", F.col("university_name"))
        reuse = category_reuse(fetched, stored).filter("can_reuse").select("ek", "category")
        texts = texts.join(shuffled(reuse), ["ek", "category"], "left_anti")
    based = texts.join(shuffled(keyed.select("ek", "base_url")), "ek", "left").withColumn(
        "source_urls", sources_or_base(F.col("source_urls"), F.col("base_url"))
    )
    requests = extraction_requests(based, context_chars)
    # Requests are short but slow to answer: by their bytes alone few tasks would get them all.
    tasks = extractor_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if answer_store is not None and extractor is not None:
        answers = stored_answers(requests, extractor, answer_store, tasks)
    else:
        answers = keep(guarded_answers(requests, extractor, tasks))

    data = compile_data(keyed.select("ek", "name", "country", "base_url"), answers)
    if errors is not None:
        given = errors.groupBy(F.col("university_name").alias("ek")).agg(F.max("error").alias("_given"))
        data = data.join(shuffled(given), "ek", "left").withColumn(FAILED, F.coalesce("_given", FAILED)).drop("_given")
    if stored is not None:
        reusable = reuse.groupBy("ek").agg(F.collect_set("category").alias("_keep"))
        none = F.array().cast("array<string>")
        data = merge_reused(
            data.join(shuffled(reusable), "ek", "left"), stored, F.coalesce("_keep", none)
        ).drop("_keep")
    records = finish_records(data, as_of_year, run_ts)
    # The batch's records are worked out once for the store: places come from the names.
    kinds = {f.name: f.dataType for f in records.drop("ek").schema}
    before = spark.createDataFrame([], "ord bigint").withColumns({n: F.lit(None).cast(k) for n, k in kinds.items()})
    if previous is not None:
        own = previous.select("university_name").distinct()
        before = previous if "ord" in previous.columns else previous.join(shuffled(stored_order(own, before)), "university_name")
    names = keyed.select(F.col("name").alias("university_name"))
    fresh = records.join(shuffled(stored_order(names, before)), "university_name").select("ord", *kinds)
    store = before.select("ord", *kinds).join(shuffled(names), "university_name", "left_anti").unionByName(fresh)
    return RunResult(plan, records, next_state(visited, known, run_ts), store, state_changes(visited, seen, run_ts))
