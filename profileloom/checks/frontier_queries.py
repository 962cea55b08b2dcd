"""Queries over the crawl plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from profileloom.checks.inputs import dealt, load
from profileloom.checks.page_queries import (
    _RESOLVED,
    _TARGETS,
    DUCK_IS_PAGE,
    DUCK_RELEVANT,
    _link_tokens,
)
from profileloom.checks.registry import register
from profileloom.functions.urls import base_domain, strip_fragment
from profileloom.operators import frontier, links
from profileloom.operators.pages import plan_usable
from profileloom.sources.profiles import entity_named, seed_rows

MAX_URLS, MAX_PAGES = 4, 5

# The oracle walks level by level with plain joins and windows.
_GOOD_LINK = f"""
select t.page_url, t.pos, t.target_url, t.ek, {DUCK_IS_PAGE} as is_page,
  {DUCK_RELEVANT['tuition_fees']} as r_tuition, {DUCK_RELEVANT['course_listings']} as r_course
from $targets t join $linkpage p on p.url = t.page_url and p.status_code < 400
join $entity e on e.ek = t.ek and t.target_domain = replace(e.base_url, 'https://', '')"""
_LEVEL_0 = """
select ek, category, split_part(url, '#', 1) as url, 0 as level, 0 as parent_rank, cast(pos as bigint) as pos,
  1 as rank from $seed"""


def _level(n: int, max_pages: int) -> str:
    return f"""
select * exclude (dup), row_number() over (partition by ek, category order by level, parent_rank, pos, url) as rank from (
  select *, row_number() over (partition by ek, category, url order by level, parent_rank, pos) as dup from (
    select ek, category, url, level, parent_rank, pos from $walk_{n - 1}
    union all
    select k.ek, k.category, l.target_url, {n}, k.rank, l.pos
    from $walk_{n - 1} k join $good_link l on l.page_url = k.url and l.ek = k.ek
    where k.level = {n - 1} and k.rank < {MAX_URLS}
      and case when l.is_page then k.rank < {max_pages}
        when k.category = 'tuition_fees' then l.r_tuition else l.r_course end) a) b
where dup = 1 qualify rank <= {MAX_URLS}"""


def _walk(max_pages: int) -> dict[str, str]:
    views = {"resolved": _RESOLVED, "targets": _TARGETS, "good_link": _GOOD_LINK, "walk_0": _LEVEL_0}
    views.update({f"walk_{n}": _level(n, max_pages) for n in range(1, MAX_URLS)})
    return views


def _inputs(spark, sf_dir):
    entities = load(spark, sf_dir, "entity").select("ek", base_domain("base_url").alias("base_domain"))
    ok_pages = load(spark, sf_dir, "linkpage").filter("status_code < 400").select(F.col("url").alias("page_url"))
    table = links.followable_links(_link_tokens(dealt(load(spark, sf_dir, "link"))))
    return load(spark, sf_dir, "seed"), entities, table.join(ok_pages, "page_url", "left_semi")


def _plan(spark, sf_dir, max_pages=MAX_PAGES):
    return frontier.build_plan(*_inputs(spark, sf_dir), MAX_URLS, max_pages)


def _snapshot(spark, sf_dir):
    """Pages of the link graph as fetch rows."""
    return load(spark, sf_dir, "linkpage").select(
        "url", "status_code", F.lit(None).cast("string").alias("error"),
        (F.length("url") % 2 == 0).alias("shell"),
    )


_PLAN = f"select ek, category, rank, url, level from $walk_{MAX_URLS - 1}"


@register(_PLAN, **_walk(MAX_PAGES))
def frontier_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@register(_PLAN, **_walk(2))
def frontier_page_cap(spark, sf_dir):
    return _plan(spark, sf_dir, max_pages=2)


# The queue a first level would hold, before and after removing repeats.
_QUEUE = """
select k.ek, k.category, l.target_url as url, 1 as level, k.rank as parent_rank, l.pos
from $walk_0 k join $good_link l on l.page_url = k.url and l.ek = k.ek
where case when l.is_page then true when k.category = 'tuition_fees' then l.r_tuition else l.r_course end"""


def _queue(spark, sf_dir):
    seeds, entities, table = _inputs(spark, sf_dir)
    first = seeds.select("ek", "category", strip_fragment("url").alias("page_url"))
    joined = first.join(entities, "ek").join(table, "page_url")
    kind = F.col("kind")
    admitted = frontier.link_admitted(kind == links.PAGINATION, kind == F.col("category"), F.lit(1))
    return joined.filter(admitted & (F.col("target_domain") == F.col("base_domain"))).select(
        "ek", "category", "base_domain", F.col("target_url").alias("url"),
        F.lit(1).alias("level"), F.lit(1).alias("parent_rank"), "pos",
    )


@register(
    "select ek, category, url, level, parent_rank, min(pos) as pos from $queue group by all",
    queue=_QUEUE, **_walk(MAX_PAGES),
)
def frontier_dedup(spark, sf_dir):
    return frontier.earliest_per_url(_queue(spark, sf_dir)).drop("base_domain")


@register(
    """
select ek, category, url, level, parent_rank, pos,
  row_number() over (partition by ek, category order by level, parent_rank, pos, url) as rank
from (select ek, category, url, level, parent_rank, min(pos) as pos from $queue group by all) d
qualify rank <= 4""",
    queue=_QUEUE, **_walk(MAX_PAGES),
)
def frontier_topk(spark, sf_dir):
    distinct = frontier.earliest_per_url(_queue(spark, sf_dir))
    return frontier.first_in_queue(distinct, MAX_URLS).drop("base_domain")


_FETCHED = f"""
select w.ek, w.category, w.rank, w.url, coalesce(p.status_code, 0) as status_code,
  case when p.url is null then 'Transport error: not in snapshot' end as error,
  case when p.status_code < 400 then length(w.url) % 2 = 0 else false end as needs_render
from $walk_{MAX_URLS - 1} w left join $linkpage p on p.url = w.url"""


@register("select ek, category, rank, url, status_code, error from $fetched", fetched=_FETCHED, **_walk(MAX_PAGES))
def plan_fetch_join(spark, sf_dir):
    pages = _snapshot(spark, sf_dir).drop("shell")
    return frontier.fetch_plan(_plan(spark, sf_dir), pages).drop("level")


@register(
    "select ek, bool_or(needs_render) as any_render from $fetched group by ek",
    fetched=_FETCHED, **_walk(MAX_PAGES),
)
def plan_any_render(spark, sf_dir):
    info = _snapshot(spark, sf_dir).select(
        "url", F.when(plan_usable(F.col("error"), F.col("status_code")), F.col("shell")).otherwise(False).alias("needs_render")
    )
    return frontier.any_render(frontier.plan_with_render(_plan(spark, sf_dir), info))


def _profiles(spark, sf_dir):
    """Profiles with a seed map of two categories, one of them with two seeds."""
    base = F.col("base_url")
    seeds = F.create_map(
        F.lit("about"), F.array(base),
        F.lit("tuition_fees"), F.array(F.concat(base, F.lit("/fees")), F.concat(base, F.lit("/costs"))),
    )
    return load(spark, sf_dir, "entity").withColumn("seed_urls", seeds)


@register(
    """
select ek, 'about' as category, 0 as pos, base_url as url from $entity
union all select ek, 'tuition_fees', 0, concat(base_url, '/fees') from $entity
union all select ek, 'tuition_fees', 1, concat(base_url, '/costs') from $entity"""
)
def seed_explode(spark, sf_dir):
    return seed_rows(_profiles(spark, sf_dir))


@register("select ek, name, country, base_url from $entity where lower(name) = 'supplier#000000007'")
def entity_filter(spark, sf_dir):
    return entity_named(load(spark, sf_dir, "entity"), "SUPPLIER#000000007")
