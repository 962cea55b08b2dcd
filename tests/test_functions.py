import random
from datetime import datetime
from urllib.parse import urljoin, urlparse
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from profileloom.functions import dates, numbers, text, urls
from profileloom.operators import links, robots

BASES = [
    "http://a/b/c/d;p?q", "https://u.edu/list-home", "https://u.edu", "https://u.edu/x/",
    "https://u.edu/x//y/z?k=1",
]
HREFS = [
    "g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "", ".",
    "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.",
    "..g", "./../g", "./g/.", "g/./h", "g/../h", "mailto:x@y", "https://o.org/../x", "a//b",
    "/a//b", "tel:5", "HTTP://x.y/z", "?", "#", "http:g", "/p?x=/../y",
]
DATES = [
    "2025-01-15", "20250115", "2025-1-5", "5/3/2025", "13/03/2025", "03/13/2025", "2025/3/4",
    "March 5, 2025", "5 march 2025", "Mar 5, 2025", "5 Sep 2025", "5 Sept 2025", "2025", "2025-01",
    "2025-02-30", "30/02/2025", "Rolling", "Fall 2025", "2025-01-15T10:00:00Z",
    "2025-01-15T10:00:00+02:30", "2025-01-15 10:00", "2025-01-15T10", "2025-01-15T101112.5-0500",
    "  2025-01-15 ", "March  5,  2025", "March 5,2025", "", "2025-13-01", "1/2/25",
    "2025-01-15T25:00", None, "20251301", "May 31, 2024", "2025-01-15x", "2025-01/15",
]
# The accepted date formats, tried after ISO 8601.
FORMATS = [
    "%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%Y/%m/%d", "%B %d, %Y", "%d %B %Y", "%b %d, %Y", "%d %b %Y",
]


def parsed_by_python(value):
    if not value:
        return None
    try:
        found = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
        return (found - found.utcoffset()).replace(tzinfo=None) if found.tzinfo else found
    except ValueError:
        pass
    for form in FORMATS:
        try:
            return datetime.strptime(value.strip(), form)
        except ValueError:
            continue
    return None


def test_urls_join_like_the_standard_library(spark):
    pairs = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "b string, h string")
    found = pairs.select(
        "b", "h", urls.resolve("b", "h").alias("joined"), urls.path_of("h").alias("path"),
        urls.authority("h").alias("netloc"),
    ).collect()
    assert [(r.b, r.h, r.joined) for r in found] == [(r.b, r.h, urljoin(r.b, r.h)) for r in found]
    assert [(r.path, r.netloc) for r in found] == [
        (urlparse(r.h).path, urlparse(r.h).netloc) for r in found
    ]


def test_domain_and_parents_matches_suffix_rule(spark):
    rows = [(d, b) for d in ("a.b.c", "xb.c", "b.c", "") for b in ("b.c", "a.b.c", "c", "com")]
    found = spark.createDataFrame(rows, "d string, b string").select(
        urls.in_domain("d", "b").alias("rule"),
        F.array_contains(urls.domain_and_parents("d"), F.col("b")).alias("member"),
    ).collect()
    assert all(r.rule == r.member for r in found)


def test_base_domain_falls_back(spark):
    rows = spark.createDataFrame([("https://u.edu:8/x",), ("u.edu",), ("?q",)], "u string")
    assert [r[0] for r in rows.select(urls.base_domain("u")).collect()] == ["u.edu:8", "u.edu", "?q"]


def test_dates_parse_like_python(spark):
    rows = spark.createDataFrame([(d,) for d in DATES], "x string")
    for row in rows.select("x", dates.parse_date("x").alias("d")).collect():
        assert row.d == parsed_by_python(row.x), row.x


@pytest.mark.parametrize(
    "value, expected",
    [
        ("a &amp;lt; b", "a &lt; b"), ("&#8364;&#x20AC;&euro;", "€€€"), ("AT&T &foo; &", "AT&T &foo; &"),
        ("&#38;lt;", "&lt;"), ("&quot;x&quot;", '"x"'), ("plain", "plain"), (None, None),
    ],
)
def test_entities_decode_once(spark, value, expected):
    rows = spark.createDataFrame([(value,)], "x string")
    assert rows.select(text.decode_entities(F.col("x"))).collect()[0][0] == expected


PAGE = (
    "<html><head><title>T</title><style>p{}</style></head><body><p>x<nav>a<nav>b</nav>c</nav>y</p>"
    '<script>if(a<b){"</p>"}</script><!-- <p>no</p> -->z<img alt="a>b">w&nbsp;&amp;lt;'
    "<noscript><iframe src=x></iframe>hidden</noscript><b>bo</b>ld it's"
    '<a class="b  Next" HREF=\'/q?a=1&amp;b=2\' rel="nofollow next">Go <b>on</b></a>'
    '<a name=x>no</a><a href>bare</a><a href=/u>open<a href="/v">two</a><footer>f</footer></body></html>'
)


def test_html_to_text(spark):
    row = spark.createDataFrame([(PAGE,), (None,), ("",)], "html string").select(
        text.clean_text(F.col("html")).alias("clean"), text.visible_text(F.col("html")).alias("seen")
    ).collect()
    assert row[0].clean == "T x y z w &lt; bo ld it's Go on no bare open two"
    assert row[0].seen == "Txabcyzw &lt;bold it'sGo onnobareopentwof"
    assert [r.clean for r in row[1:]] == ["", ""]


def test_long_attributes_do_not_exhaust_the_regex_stack(spark):
    page = '<p data-x="' + "y" * 200_000 + '" ' + "k=v " * 20_000 + ">text</p><script>" + "z<" * 100_000
    rows = spark.createDataFrame([(page,)], "html string")
    assert rows.select(text.clean_text(F.col("html"))).collect()[0][0] == "text"


def test_anchors(spark):
    rows = spark.createDataFrame([(PAGE, "u")], "html string, url string")
    found = [(r.pos, r.href, r.anchor_text, r.rel, r.classes) for r in links.extract_links(rows).collect()]
    assert found == [
        (0, "/q?a=1&b=2", "Go on", ["nofollow", "next"], ["b", "Next"]),
        (1, "", "bare", [], []),
        (2, "/u", "open", [], []),
        (3, "/v", "two", [], []),
    ]


def test_pagination_and_relevance(spark):
    rows = spark.createDataFrame(
        [
            ("Next steps", "/x", [], []), ("x", "/a?page=2", [], []), ("x", "/x", ["next"], []),
            ("x", "/x", ["Next"], []), ("x", "/x", [], ["Pagination"]), ("»", "/x", [], []),
            ("Tuition", "/x", [], []), ("x", "https://fees.edu/HOUSING;fee?visa", [], []),
        ],
        "anchor_text string, href string, rel array<string>, classes array<string>",
    )
    found = rows.select(
        links.is_pagination("anchor_text", "href", "rel", "classes").alias("page"),
        links.relevant_categories("anchor_text", "href").alias("categories"),
    ).collect()
    assert [r.page for r in found] == [True, True, True, False, True, True, False, False]
    assert found[6].categories == ["tuition_fees"]
    assert found[7].categories == ["living_costs"]


ROBOTS = [
    "User-agent: *\nDisallow: /blocked-path\nAllow: /",
    "User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow:",
    "User-agent: bot\nAllow: /x\nDisallow: /\nUser-agent: *\nDisallow: /q",
    "User-agent: a\nUser-agent: PROFILEBOT\nDisallow: /q # why\n\nUser-agent: *\nDisallow: /",
    "", None,
]
URLS = ["https://a.b/blocked-path/x", "https://a.b/x?y", "https://a.b", "https://a.b/q"]


def test_robots_like_the_standard_library(spark):
    rows = spark.createDataFrame([(t, u) for t in ROBOTS for u in URLS], "t string, u string")
    allowed = robots.url_allowed(robots.parse_rules(F.col("t"), "profilebot/1.0"), F.col("u"))
    for row in rows.select("t", "u", allowed.alias("ok")).collect():
        parser = RobotFileParser()
        parser.parse((row.t or "").splitlines())
        assert row.ok == parser.can_fetch("profilebot/1.0", row.u), (row.t, row.u)


def test_numeric_closeness(spark):
    rows = spark.createDataFrame(
        [(100.0, 105.0), (100.0, 105.1), (0.0, 0.0), (0.0, 0.1), (None, 1.0), (-100.0, -96.0)],
        "a double, b double",
    )
    found = rows.select(
        numbers.is_close(F.col("a"), F.col("b"), 0.05).alias("near"),
        numbers.is_close(F.col("a"), F.col("b")).alias("same"),
    ).collect()
    assert [r.near for r in found] == [True, False, True, False, False, True]
    assert [r.same for r in found] == [False, False, True, False, False, False]


def test_robots_over_many_files(spark):
    random.seed(11)
    lines = ["User-agent: *", "User-agent: profilebot", "user-agent: Other", "Disallow: /x", "Allow: /x/y", "Disallow:", "",
             "Disallow: /a%20b", "Disallow: /caf%C3%A9", "Crawl-delay: 3", "# note", "Sitemap: /s", "Disallow: *", "Allow: /a b"]
    files = ["\n".join(random.choice(lines) for _ in range(random.randrange(1, 12))) for _ in range(150)]
    urls = ["https://h/x", "https://h/x/y", "https://h/a b/c", "https://h/a%20b/c", "https://h/caf\u00e9", "https://h", "https://h/q?x=1"]
    frame = spark.createDataFrame([(i, f, u) for i, f in enumerate(files) for u in urls], "i int, t string, u string")
    allowed = robots.url_allowed(robots.parse_rules(F.col("t"), "profilebot/1.0"), F.col("u"))
    for row in frame.select("t", "u", allowed.alias("ok")).collect():
        parser = RobotFileParser()
        parser.parse(row.t.splitlines())
        parser.modified()
        assert row.ok == parser.can_fetch("profilebot/1.0", row.u), (row.t, row.u)


def test_nested_and_unclosed_elements(spark):
    deep = "<nav>a" * 5 + "b" + "</nav>c" * 4 + "</nav>text"
    cases = {
        "<nav>a<nav>b<nav>c</nav>d</nav>e</nav>text": "text", deep: "text",
        "<div><nav>x</div><p>kept</p>": "kept", "one<footer>two": "one", "</nav>stray": "stray",
        "<DIV>a<Nav class='x'>b<br>c<img src='d'></NAV>e</DIV>": "a e", "<navy>stays</navy>": "stays",
        "<nav>x<footer>y</footer>z</nav>w": "w", "<nav>x<footer>y</nav>z": "z",
    }
    rows = spark.createDataFrame(list(cases.items()), "html string, expected string")
    for row in rows.select("*", text.clean_text(F.col("html")).alias("found")).collect():
        assert row.found == row.expected, row.html


def test_html5_references(spark):
    cases = {
        "it&apos;s": "it's", "&#00000065;&#x0000041;": "AA", "&#146;": "\u2019", "&NotEqualTilde;": "\u2242\u0338", "&amp;lt;": "&lt;",
        "&copy 2024": "&copy 2024", "&Afr;": "\U0001d504", "&nosuch; &#1114112; &": "&nosuch; &#1114112; &", "&bsol;&quot;&lt;": '\\"<',
    }
    rows = spark.createDataFrame(list(cases.items()), "t string, expected string")
    for row in rows.select("*", text.decode_entities(F.col("t")).alias("found")).collect():
        assert row.found == row.expected, row.t


def test_walks_of_pages_and_robots_files_grow_with_their_length(spark):
    """Ten times the tags or lines take about ten times as long, never a hundred."""
    from time import perf_counter

    def seconds(value, column):
        frame = spark.createDataFrame([(value,)], "v string")
        best = 1e9
        for _ in range(2):
            start = perf_counter()
            frame.select(column.alias("n")).first()
            best = min(best, perf_counter() - start)
        return best

    rules = F.size(robots.parse_rules(F.col("v"), "bot"))
    cases = [
        (lambda n: "<body><nav><nav>x</nav></nav>" + "<p>t</p>" * (n // 2), F.length(text.clean_text(F.col("v")))),
        (lambda n: "<body><nav><nav>x</nav></nav>" + "<p>t" * n, F.length(text.clean_text(F.col("v")))),
        (lambda n: "User-agent: *\n" + "Disallow: /x\n" * n, rules),
        (lambda n: "User-agent: *\nDisallow: /x\n" * (n // 2), rules),
    ]
    for page, column in cases:
        assert seconds(page(100_000), column) < 20 * max(seconds(page(10_000), column), 0.2)


def test_dropped_elements_by_hand(spark):
    pages = {
        "<nav>a<nav>b</nav>c</nav>d": "d",
        "<div><nav>a</div>b": "b",
        "<p>x<nav>a<p>b</nav>c": "x c",
        "<nav>a<nav>b</nav>c": "",
        "</nav>a<nav>b</p>c</nav>d": "a d",
        "<p>1<p>2<nav>3<nav>4</p>5": "1 2 5",
    }
    frame = spark.createDataFrame([(h,) for h in pages], "h string")
    assert {r.h: r.t for r in frame.select("h", text.clean_text(F.col("h")).alias("t")).collect()} == pages
