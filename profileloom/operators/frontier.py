"""The crawl plan: a bounded breadth-first walk of the link graph as joins.

Queue order equals order by (level, rank of the linking page, link position),
and every new URL taken from the queue becomes a target, so a target's rank is
also the number of pages fetched up to it. At most ``max_urls`` targets per
(entity, category) means at most ``max_urls - 1`` levels, unrolled into one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from profileloom.fixed_values import MAX_PAGES_PER_CATEGORY, MAX_URLS_PER_CATEGORY
from profileloom.functions.arrays import unroll
from profileloom.functions.joins import shuffled
from profileloom.functions.urls import domain_and_parents, strip_fragment
from profileloom.operators.links import PAGINATION
from profileloom.operators.robots import url_allowed

PLACE = ["level", "parent_rank", "pos"]


def earliest_per_url(candidates: DataFrame) -> DataFrame:
    """One row per (ek, category, url): its earliest place in the queue."""
    place = F.struct(*PLACE)
    return (
        candidates.groupBy("ek", "category", "base_domain", "url")
        .agg(F.min(place).alias("place"))
        .select("ek", "category", "base_domain", "url", "place.*")
    )


def first_in_queue(candidates: DataFrame, max_urls: int = MAX_URLS_PER_CATEGORY) -> DataFrame:
    """The first ``max_urls`` URLs of each (ek, category), ranked from 1.

    The rank filter lets Spark keep only ``max_urls`` rows per group in each
    map task, before the shuffle.
    """
    order = Window.partitionBy("ek", "category").orderBy(*PLACE, "url")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= max_urls
    )


def link_admitted(
    is_page: Column, relevant: Column, parent_rank: Column, max_pages: int = MAX_PAGES_PER_CATEGORY
) -> Column:
    """Whether a link enters the queue.

    Pagination is judged first: a pagination link beyond the page limit is
    dropped even if it is relevant.
    """
    return F.when(is_page, parent_rank < max_pages).otherwise(relevant)


def page_outlinks(
    links: DataFrame, domains: DataFrame, max_urls: int = MAX_URLS_PER_CATEGORY
) -> DataFrame:
    """Per (page, base domain) the links a walk could ever take, as one short array.

    ``links`` are followable links of usable pages; ``domains`` holds the base
    domains of the entities. A walk holds at most ``max_urls`` URLs and needs at
    most as many new ones, so of each category's distinct targets on a page only
    the first ``2 * max_urls`` can matter. The array is bounded by that, however
    many links a page has, and repeated links collapse before the shuffle.
    """
    # Repeats collapse first. Both readers of the collapsed links ask for the same columns, hence
    # a bound that every place meets, so that the links are worked out and shuffled once.
    collapsed = links.filter("target_domain is not null").groupBy("page_url", "kind", "target_url", "target_domain")
    distinct = collapsed.agg(F.min(F.col("pos").cast("bigint")).alias("pos")).filter(F.col("pos") >= F.lit(-(2**63)))
    # Domains are matched once each: links meet the few matches of their own domain, never one
    # row per parent domain such as "com".
    targets = distinct.select("target_domain").distinct()
    parents = unroll(targets, domain_and_parents("target_domain"), "base_domain", "target_domain")
    matched = parents.join(shuffled(domains.select("base_domain").distinct()), "base_domain", "left_semi")
    first_seen = distinct.join(shuffled(matched), "target_domain")
    order = Window.partitionBy("page_url", "base_domain", "kind").orderBy("pos", "target_url")
    leading = first_seen.withColumn("_n", F.row_number().over(order)).filter(
        F.col("_n") <= 2 * max_urls
    )
    return leading.groupBy("page_url", "base_domain").agg(
        F.collect_list(F.struct("kind", "pos", "target_url")).alias("outlinks")
    )


def _seed_queue(seeds: DataFrame, entities: DataFrame) -> DataFrame:
    """Level 0 of the queue: seeds in their order, on whatever domain they are."""
    queue = seeds.select(
        "ek",
        "category",
        strip_fragment("url").alias("url"),
        F.lit(0).alias("level"),
        F.lit(0).alias("parent_rank"),
        F.col("pos").cast("bigint").alias("pos"),
    )
    first = queue.groupBy("ek", "category", "url").agg(F.min(F.struct(*PLACE)).alias("place"))
    domains = entities.select("ek", "base_domain")
    return first.select("ek", "category", "url", "place.*").join(shuffled(domains), "ek", "left")


def _next_level(
    kept: DataFrame, outlinks: DataFrame, level: int, max_urls: int, max_pages: int, rules: DataFrame | None
) -> DataFrame:
    """Every kept row together with the candidates its page adds at ``level``."""
    sources = outlinks.withColumnRenamed("page_url", "url")
    joined = kept.join(shuffled(sources), ["url", "base_domain"], "left")
    itself = F.struct("url", *PLACE)
    expands = (F.col("level") == level - 1) & (F.col("rank") < max_urls)
    if rules is not None:
        joined = joined.join(shuffled(rules), "ek", "left")
        expands = expands & url_allowed(F.col("_rules"), F.col("url"))
    may_follow = F.filter(
        "outlinks",
        lambda link: link_admitted(
            link["kind"] == PAGINATION, link["kind"] == F.col("category"), F.col("rank"), max_pages
        ),
    )
    found = F.transform(
        may_follow,
        lambda link: F.struct(
            link["target_url"].alias("url"),
            F.lit(level).alias("level"),
            F.col("rank").alias("parent_rank"),
            link["pos"].alias("pos"),
        ),
    )
    rows = F.when(expands & F.col("outlinks").isNotNull(), F.concat(F.array(itself), found)).otherwise(
        F.array(itself)
    )
    unrolled = unroll(joined, rows, "row", "ek", "category", "base_domain")
    return unrolled.select("ek", "category", "base_domain", "row.*")


def build_plan(
    seeds: DataFrame,
    entities: DataFrame,
    links: DataFrame,
    max_urls: int = MAX_URLS_PER_CATEGORY,
    max_pages: int = MAX_PAGES_PER_CATEGORY,
    materialise=None,
    rules: DataFrame | None = None,
) -> DataFrame:
    """Targets ``(ek, category, rank, url, level)`` in crawl order.

    ``seeds(ek, category, pos, url)``, ``entities(ek, base_domain)``, and
    followable ``links`` of usable pages only. Each level uses the
    previous one exactly once: a kept row and its page's candidates leave the
    join together, so the plan grows linearly and needs no action between
    levels. ``materialise`` (such as ``runtime.materialise``) stores the outlink
    table when the links are costly to derive. ``rules(ek, _rules)``, one row per
    entity, forbid it pages: those stay targets, but nothing is followed from them.
    """
    outlinks = page_outlinks(links, entities, max_urls)
    if materialise is not None:
        outlinks = materialise(outlinks)
    kept = first_in_queue(_seed_queue(seeds, entities), max_urls)
    for level in range(1, max_urls):
        grown = _next_level(kept, outlinks, level, max_urls, max_pages, rules)
        # One shuffle serves both steps: groups are small here by construction.
        grown = grown.repartition("ek", "category")
        kept = first_in_queue(earliest_per_url(grown), max_urls)
    return kept.select("ek", "category", "rank", "url", "level")


def plan_with_render(plan: DataFrame, page_info: DataFrame) -> DataFrame:
    """Adds ``needs_render`` to plan targets; failed and unknown pages never need it.

    ``page_info(url, needs_render)`` holds one row per URL. A popular URL may be
    planned by very many entities; adaptive execution splits such a key.
    """
    flags = page_info.select("url", "needs_render")
    joined = plan.join(shuffled(flags), "url", "left")
    return joined.withColumn("needs_render", F.coalesce("needs_render", F.lit(False)))


def any_render(plan: DataFrame) -> DataFrame:
    """Per entity, whether any target of its plan must be rendered."""
    return plan.groupBy("ek").agg(F.bool_or("needs_render").alias("any_render"))


def fetch_plan(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """Page rows of the planned targets, in plan order per category.

    A target the snapshot lacks comes back as a failed fetch.
    """
    snapshot = pages.withColumn("_known", F.lit(True))
    joined = plan.join(shuffled(snapshot), "url", "left")
    missing = F.col("_known").isNull()
    return (
        joined.withColumn(
            "error", F.when(missing, "Transport error: not in snapshot").otherwise(F.col("error"))
        )
        .withColumn("status_code", F.when(missing, 0).otherwise(F.col("status_code")))
        .drop("_known")
    )
