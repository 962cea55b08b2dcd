"""The plan against a plain first-in-first-out walk."""

import random

import pytest
from pyspark.sql import functions as F

from profileloom.checks.catalogue import QUERIES
from profileloom.operators.frontier import build_plan, page_outlinks
from profileloom.plans.pipeline import plan_targets
from profileloom.sources.profiles import with_keys

LINKS = "page_url string, pos int, kind string, target_url string, target_domain string"


def walk(seeds, graph, category, base, max_urls, max_pages):
    """Queue walk of one (entity, category): graph maps a page to its links or None."""
    queue, visited, targets = list(seeds), set(), []
    while queue and len(targets) < max_urls:
        url = queue.pop(0).split("#")[0]
        if url in visited:
            continue
        visited.add(url)
        targets.append(url)
        for kinds, target, domain in graph.get(url) or []:
            if domain != base and not domain.endswith("." + base):
                continue
            if "*" in kinds:
                if len(targets) < max_pages:
                    queue.append(target)
            elif category in kinds:
                queue.append(target)
    return targets


@pytest.mark.parametrize("max_urls, max_pages", [(4, 5), (4, 2), (3, 1), (1, 5)])
def test_plan_equals_queue_walk_on_random_graphs(spark, max_urls, max_pages):
    rng = random.Random(max_urls * 10 + max_pages)
    seeds, entities, links, expected = [], [], [], {}
    for ek in range(40):
        base = f"u{ek}.edu"
        urls = [f"https://{rng.choice(['', 'www.'])}{base}/p{i}" for i in range(9)]
        graph = {}
        for url in urls:
            if rng.random() < 0.2:
                continue
            # One page in every graph repeats its links many times over.
            size = 300 if url == urls[0] else rng.randrange(6)
            graph[url] = []
            for pos in range(size):
                target = rng.choice(urls)
                domain = rng.choice([base, "www." + base, "other.org"])
                kinds = rng.choice([["*"], ["about"], ["tuition_fees"], ["about", "tuition_fees"]])
                graph[url].append((kinds, target, domain))
                links += [(url, pos, kind, target, domain) for kind in kinds]
        entities.append((ek, base))
        for category in ("about", "tuition_fees"):
            chosen = [rng.choice(urls) + rng.choice(["", "#a"]) for _ in range(rng.randrange(1, 4))]
            seeds += [(ek, category, i, url) for i, url in enumerate(chosen)]
            expected[ek, category] = walk(chosen, graph, category, base, max_urls, max_pages)
    plan = build_plan(
        spark.createDataFrame(seeds, "ek bigint, category string, pos int, url string"),
        spark.createDataFrame(entities, "ek bigint, base_domain string"),
        spark.createDataFrame(links, LINKS), max_urls, max_pages,
    )
    found = {}
    for row in sorted(plan.collect(), key=lambda r: r["rank"]):
        found.setdefault((row.ek, row.category), []).append(row.url)
    assert found == expected


def test_outlinks_of_a_hot_page_stay_bounded(spark):
    links = spark.range(50_000).select(
        F.lit("https://u.edu/").alias("page_url"), F.col("id").alias("pos"), F.lit("about").alias("kind"),
        F.concat(F.lit("https://u.edu/"), F.col("id").cast("string")).alias("target_url"),
        F.lit("u.edu").alias("target_domain"),
    )
    row = page_outlinks(links, spark.createDataFrame([("u.edu",)], "base_domain string"), 4).collect()
    assert len(row) == 1
    assert sorted(link["pos"] for link in row[0].outlinks) == list(range(8))


def profile(seeds):
    return [("U", "Canada", "https://u.edu", seeds)]


PROFILE = "name string, country string, base_url string, seed_urls map<string,array<string>>"
PAGES = "url string, status_code int, html string, error string"


def plan_of(spark, seeds, pages, **limits):
    keyed = with_keys(spark.createDataFrame(profile(seeds), PROFILE))
    rows = [(url, status, html, None) for url, status, html in pages]
    plan = plan_targets(keyed, spark.createDataFrame(rows, PAGES), **limits)
    return [(r.category, r.url, r.needs_render) for r in sorted(plan.collect(), key=lambda r: (r.category, r["rank"]))]


LONG = "<p>" + "word " * 60 + "</p>"


def test_pagination_is_followed(spark):
    found = plan_of(
        spark,
        {"course_listings": ["https://u.edu/courses-home"]},
        [
            ("https://u.edu/courses-home", 200, LONG + '<a href="/courses?page=2">Next page</a><a href="/courses/math-101">Intro</a>'),
            ("https://u.edu/courses?page=2", 200, '<h1>Page 2</h1><a href="/courses/science-200">Advanced</a>'),
        ],
        max_pages=3,
    )
    assert [url for _, url, _ in found] == [
        "https://u.edu/courses-home", "https://u.edu/courses?page=2",
        "https://u.edu/courses/math-101", "https://u.edu/courses/science-200",
    ]
    assert [shell for *_, shell in found] == [False, True, False, False]


def test_relevant_links_join_their_category(spark):
    html = LONG + '<a href="/tuition-calc">Our Tuition</a><a href="/awards">Scholarships</a><a href="https://w.org/fees">Fees</a>'
    seeds = {"tuition_fees": ["https://u.edu/home"], "scholarships": ["https://u.edu/home"]}
    found = plan_of(spark, seeds, [("https://u.edu/home", 200, html)])
    assert [(c, u) for c, u, _ in found] == [
        ("scholarships", "https://u.edu/home"), ("scholarships", "https://u.edu/awards"),
        ("tuition_fees", "https://u.edu/home"), ("tuition_fees", "https://u.edu/tuition-calc"),
    ]


def test_failed_seed_stays_and_shell_is_flagged(spark):
    shell = '<head><script src="b.js"></script></head><body><div id="app"></div></body>'
    seeds = {"about": ["https://u.edu/gone", "https://u.edu/portal"]}
    found = plan_of(spark, seeds, [("https://u.edu/gone", 404, shell), ("https://u.edu/portal", 200, shell)])
    assert found == [("about", "https://u.edu/gone", False), ("about", "https://u.edu/portal", True)]


def test_links_are_worked_out_once(spark):
    plan = QUERIES["frontier_plan"](spark, "/root/testdata/sf0.001")
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    worked_out = [line for line in final.splitlines() if "Generate " in line and "[target_url#" in line]
    assert len(worked_out) == 1
