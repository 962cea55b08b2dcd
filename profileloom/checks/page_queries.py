"""Queries over page snapshots and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from profileloom.checks.inputs import dealt, load, run_sql
from profileloom.checks.registry import register
from profileloom.fixed_values import CATEGORIES, CATEGORY_KEYWORDS
from profileloom.functions.arrays import unroll
from profileloom.functions.text import (
    clean_text,
    content_hash,
    normalise_alnum,
    visible_text,
)
from profileloom.functions.urls import base_domain, in_domain, resolve, strip_fragment
from profileloom.operators import incremental, links, pages, robots
from profileloom.runtime import fresh_path
from profileloom.sources.pages import append_hash_changes, read_hash_state

# The oracle's own reading of HTML, one replacement per element kind.
_RAW = ["script", "style", "noscript", "iframe"]


def _duck_strip(html: str, drops: list[str], gap: str) -> str:
    text = f"regexp_replace({html}, '(?s)<!--.*?-->', '{gap}', 'g')"
    for tag in drops:
        text = f"regexp_replace({text}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', '{gap}', 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', '{gap}', 'g')"
    for entity, char in (
        ("&middot;", "chr(183)"), ("&copy;", "chr(169)"), ("&quot;", "chr(34)"), ("&amp;", "'&'"),
    ):
        text = f"replace({text}, '{entity}', {char})"
    return f"trim(regexp_replace(replace({text}, chr(160), ' '), '\\s+', ' ', 'g'))"


DUCK_CLEAN = _duck_strip("html", [*_RAW, "nav", "footer"], " ")
DUCK_VISIBLE = _duck_strip("html", _RAW, "")
_DUCK_PAGE = f"""
select page_id, url, status_code, error,
  case when error is null then {DUCK_CLEAN} else '' end as clean_text,
  case when error is null and status_code < 400 then length({DUCK_VISIBLE}) < 200 else false end as needs_render
from $fetch"""


@register("select page_id, url, status_code, error from $fetch")
def page_scan(spark, sf_dir):
    return load(spark, sf_dir, "fetch").select("page_id", "url", "status_code", "error")


@register(f"select page_id, {DUCK_CLEAN} as clean_text from $pages")
def page_clean_text(spark, sf_dir):
    return dealt(load(spark, sf_dir, "pages")).select("page_id", clean_text(F.col("html")).alias("clean_text"))


@register(f"select page_id, {DUCK_VISIBLE} as visible_text from $pages")
def page_visible_text(spark, sf_dir):
    return dealt(load(spark, sf_dir, "pages")).select("page_id", visible_text(F.col("html")).alias("visible_text"))


@register("select page_id, needs_render from $page", page=_DUCK_PAGE)
def page_needs_render(spark, sf_dir):
    flag = pages.needs_render(F.col("error"), F.col("status_code"), F.col("html"))
    return dealt(load(spark, sf_dir, "fetch")).select("page_id", flag.alias("needs_render"))


@register(
    "select page_id, url, clean_text, needs_render, sha256(clean_text) as hash from $page",
    page=_DUCK_PAGE,
)
def page_profile(spark, sf_dir):
    return pages.page_profile(dealt(load(spark, sf_dir, "fetch"))).select(
        "page_id", "url", "clean_text", "needs_render", "hash"
    )


@register(f"select page_id, sha256({DUCK_CLEAN}) as hash from $pages")
def page_hash(spark, sf_dir):
    return dealt(load(spark, sf_dir, "pages")).select(
        "page_id", content_hash(clean_text(F.col("html"))).alias("hash")
    )


@register(
    """
select page_id, status_code, error,
  case when error = 'blocked_by_robots' then 'robots' when error is not null then 'server_error'
    when status_code >= 400 then 'client_error' else 'ok' end as outcome,
  error is null and status_code < 400 as plan_usable, error is null as extract_usable
from $fetch"""
)
def fetch_outcome(spark, sf_dir):
    scan = load(spark, sf_dir, "fetch").select("page_id", "status_code", "error")
    return pages.fetch_outcomes(scan)


_ANCHORS = """
select page_id, url, i as pos, a[i + 1] as anchor
from (select *, unnest(range(len(a))) as i
      from (select page_id, url, regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>') as a from $pages) x) y"""
_PAGE_LINKS = """
select page_id, url, cast(pos as int) as pos, regexp_extract(anchor, 'href="([^"]*)"', 1) as href,
  replace(regexp_replace(anchor, '<[^>]*>', '', 'g'), '&amp;', '&') as anchor_text
from $anchors"""


@register("select page_id, pos, href, anchor_text from $page_links", anchors=_ANCHORS, page_links=_PAGE_LINKS)
def link_extract(spark, sf_dir):
    found = links.extract_links(dealt(load(spark, sf_dir, "pages")), "page_id")
    return found.select("page_id", "pos", "href", "anchor_text")


# hrefs of the test tables are absolute, rooted or a bare query.
_RESOLVED = """
select *, case when href like 'http%' then href
  when href like '/%' then concat(regexp_extract(page_url, '^[a-z]+://[^/?#]*'), href)
  when href like '?%' then concat(split_part(split_part(page_url, '#', 1), '?', 1), href) end as absolute
from (select ek, page_url, pos, href, anchor_text, rel from $link) x"""


@register(
    """
select ek, page_url, pos, href, absolute from $resolved
union all
select page_id as ek, url as page_url, pos, href,
  concat(regexp_extract(url, '^[a-z]+://[^/?#]*'), href) as absolute from $page_links""",
    resolved=_RESOLVED, anchors=_ANCHORS, page_links=_PAGE_LINKS,
)
def url_resolve(spark, sf_dir):
    table = dealt(load(spark, sf_dir, "link")).select("ek", "page_url", "pos", "href")
    found = links.extract_links(dealt(load(spark, sf_dir, "pages")), "page_id").select(
        F.col("page_id").alias("ek"), "page_url", "pos", "href"
    )
    return table.union(found).withColumn("absolute", resolve("page_url", "href"))


@register("select page_id, split_part(url, '#', 1) as url_normalized from $pages")
def url_normalize(spark, sf_dir):
    return load(spark, sf_dir, "pages").select(
        "page_id", strip_fragment("url").alias("url_normalized")
    )


_TARGETS = """
select *, split_part(absolute, '#', 1) as target_url,
  regexp_extract(absolute, '^[a-z]+://([^/?#]*)', 1) as target_domain from $resolved"""


def _resolved_links(spark, sf_dir):
    return links.resolve_links(dealt(load(spark, sf_dir, "link")))


@register(
    """
select t.ek, pos, target_url, target_domain,
  target_domain = replace(base_url, 'https://', '')
    or ends_with(target_domain, concat('.', replace(base_url, 'https://', ''))) as same_domain
from $targets t join $entity e on t.ek = e.ek""",
    resolved=_RESOLVED, targets=_TARGETS,
)
def link_same_domain(spark, sf_dir):
    bases = load(spark, sf_dir, "entity").select("ek", base_domain("base_url").alias("base"))
    joined = _resolved_links(spark, sf_dir).join(bases, "ek")
    return joined.select(
        "ek", "pos", "target_url", "target_domain",
        in_domain("target_domain", "base").alias("same_domain"),
    )


DUCK_IS_PAGE = (
    "(rel = 'next' or href like '%page=%' or href like '%p=%' or href like '%pg=%' "
    "or lower(anchor_text) like '%next%' or lower(anchor_text) like '%older%' "
    "or anchor_text like '%>%' or anchor_text like '%»%')"
)


def _link_tokens(frame):
    """The table's single rel token as the token arrays that extraction yields."""
    rel = F.filter(F.array("rel"), lambda token: token != "")
    return frame.withColumn("rel", rel).withColumn("classes", F.array().cast("array<string>"))


@register(f"select ek, page_url, pos, href, anchor_text, {DUCK_IS_PAGE} as is_page from $link")
def link_pagination(spark, sf_dir):
    table = _link_tokens(dealt(load(spark, sf_dir, "link")))
    flag = links.is_pagination("anchor_text", "href", "rel", "classes")
    return table.select("ek", "page_url", "pos", "href", "anchor_text", flag.alias("is_page"))


def _duck_relevant(category: str) -> str:
    path = "lower(regexp_replace(regexp_replace(href, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''))"
    tests = [
        f"contains(lower(anchor_text), '{word}') or contains({path}, '{word}')"
        for word in CATEGORY_KEYWORDS[category]
    ]
    return "(" + " or ".join(tests) + ")"


DUCK_RELEVANT = {c: _duck_relevant(c) for c in CATEGORIES}


@register(
    " union all ".join(
        f"select ek, page_url, pos, href, '{c}' as category from $link where {DUCK_RELEVANT[c]}"
        for c in CATEGORIES
    )
)
def link_relevance(spark, sf_dir):
    hits = links.relevant_categories("anchor_text", "href")
    return unroll(dealt(load(spark, sf_dir, "link")), hits, "category", "ek", "page_url", "pos", "href")


@register(
    """
select page_id, url,
  case when variant = 0 then not regexp_matches(url, '^[a-z]+://[^/]*/en/') else true end as allowed
from $pages p join $site_robots r
  on r.site = regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[/?#].*$', '')
  and r.variant = (select min(variant) from $site_robots q where q.site = r.site)"""
)
def robots_filter(spark, sf_dir):
    sites = load(spark, sf_dir, "site_robots")
    files = sites.groupBy("site").agg(F.min_by("robots_text", "variant").alias("robots_text"))
    urls = run_sql(
        spark, sf_dir,
        "select page_id, url, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[/?#].*$', '') as site from $pages",
    )
    return robots.apply_robots(urls, files, "profilebot/1.0").select("page_id", "url", "allowed")


_EARLIER = f"select url, sha256({DUCK_CLEAN}) as hash from $earlier_page"
_NOW = "select page_id, url, error, sha256(clean_text) as hash from $page"
_EARLIER_TIME = "2025-01-01 00:00:00"
_RUN_TIME = "2026-01-01 00:00:00"


def _now_and_earlier(spark, sf_dir):
    now = pages.with_clean_text(dealt(load(spark, sf_dir, "fetch")))
    earlier = dealt(load(spark, sf_dir, "earlier_page")).select(
        "url",
        content_hash(clean_text(F.col("html"))).alias("hash"),
        F.lit(_EARLIER_TIME).cast("timestamp_ntz").alias("fetched_at"),
    )
    return now, earlier


@register(
    """
select n.page_id, n.url, n.error is not null or e.hash is null or n.hash <> e.hash as has_changed
from $now n left join $earlier e on n.url = e.url""",
    page=_DUCK_PAGE, now=_NOW, earlier=_EARLIER,
)
def page_changed(spark, sf_dir):
    now, earlier = _now_and_earlier(spark, sf_dir)
    return incremental.page_changes(now, earlier).select("page_id", "url", "has_changed")


@register(
    f"""
select coalesce(n.url, e.url) as url, coalesce(n.hash, e.hash) as hash,
  case when n.hash is null or n.hash = e.hash then timestamp '{_EARLIER_TIME}' else timestamp '{_RUN_TIME}' end as fetched_at
from (select * from $now where error is null) n full outer join $earlier e on n.url = e.url""",
    page=_DUCK_PAGE, now=_NOW, earlier=_EARLIER,
)
def page_hash_update(spark, sf_dir):
    now, earlier = _now_and_earlier(spark, sf_dir)
    return incremental.next_state(now, earlier, F.lit(_RUN_TIME).cast("timestamp_ntz"))


@register(
    f"""
select coalesce(n.url, e.url) as url, coalesce(n.hash, e.hash) as hash,
  case when n.hash is null or n.hash = e.hash then timestamp '{_EARLIER_TIME}' else timestamp '{_RUN_TIME}' end as fetched_at
from (select * from $now where error is null) n full outer join $earlier e on n.url = e.url""",
    page=_DUCK_PAGE, now=_NOW, earlier=_EARLIER,
)
def hash_state_runs(spark, sf_dir):
    """The stored state after three runs: one that makes it, one that changes pages, one that changes none."""
    root = fresh_path(spark, "state")
    now, earlier = _now_and_earlier(spark, sf_dir)
    first = earlier.select("url", "hash", F.lit(None).cast("string").alias("error"))
    for pages_read, moment in ((first, _EARLIER_TIME), (now, _RUN_TIME), (now, "2027-01-01 00:00:00")):
        state = read_hash_state(spark, root)
        changes = incremental.state_changes(pages_read, state, F.lit(moment).cast("timestamp"))
        append_hash_changes(changes, root)
    return read_hash_state(spark, root).withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


@register("select doc_id, lower(regexp_replace(coalesce(text, ''), '[^\\p{L}\\p{N}]', '', 'g')) as plain from $documents")
def normalize_text(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", normalise_alnum(F.col("text")).alias("plain"))
