"""Link operators: anchors of a page, and the predicates that admit them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.fixed_values import (
    CATEGORY_KEYWORDS,
    PAGINATION_CLASSES,
    PAGINATION_PARAMETERS,
    PAGINATION_WORDS,
)
from profileloom.functions.arrays import computed, unroll, unroll_with_position
from profileloom.functions.dates import bind
from profileloom.functions.text import (
    ANY_TAG,
    COMMENT,
    OPAQUE_ELEMENTS,
    TAG_BODY,
    UNICODE_SPACE,
    _element,
    decode_entities,
)
from profileloom.functions.urls import authority, path_of_sql, resolve_sql

# Kind of a link that any category may follow.
PAGINATION = "*"

_OPENING = rf"(?is)^<a({TAG_BODY})>"
_ANCHOR = rf"(?is)<a(?=[\s/>]){TAG_BODY}>.*?(?=</a[\s>]|<a[\s/>]|\z)"


def _attribute(opening: Column, name: str) -> Column:
    """Decoded value of an attribute; empty when bare, null when absent."""
    pattern = rf"""(?is)[\s"'/]{name}(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>"']|$)"""
    value = F.concat(*[F.regexp_extract(opening, pattern, i) for i in (1, 2, 3)])
    return F.when(opening.rlike(pattern), decode_entities(value))


def _tokens(value: Column) -> Column:
    words = F.filter(F.split(value, UNICODE_SPACE), lambda word: word != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def anchors(html: Column) -> Column:
    """Array of the anchors of a page in document order.

    Each is a struct of ``href``, ``anchor_text``, ``rel`` and ``classes``;
    anchors without ``href`` are left out. Comments and raw-text elements are
    removed first so that markup inside them is not mistaken for links.
    """
    noise = "(?is)" + "|".join([COMMENT, *map(_element, OPAQUE_ELEMENTS)])
    found = F.regexp_extract_all(F.regexp_replace(html, noise, ""), F.lit(_ANCHOR), F.lit(0))

    def read(anchor: Column) -> Column:
        opening = F.regexp_extract(anchor, _OPENING, 1)
        inner = F.regexp_replace(F.regexp_replace(anchor, _OPENING, ""), ANY_TAG, "")
        return F.struct(
            _attribute(opening, "href").alias("href"),
            decode_entities(inner).alias("anchor_text"),
            _tokens(_attribute(opening, "rel")).alias("rel"),
            _tokens(_attribute(opening, "class")).alias("classes"),
        )

    return F.filter(F.transform(found, read), lambda link: link["href"].isNotNull())


def extract_links(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per anchor: the ``keep`` columns, ``page_url``, ``pos`` and the anchor."""
    url = F.col("url").alias("page_url")
    rows = unroll_with_position(pages, anchors(F.col("html")), "pos", "link", *keep, url)
    return rows.select(*keep, "page_url", "pos", "link.*")


def is_pagination(anchor_text: str, href: str, rel: str, classes: str) -> Column:
    """Whether an anchor looks like navigation to a further page of a listing."""
    text, address = f"lower({anchor_text})", f"lower({href})"
    class_text = f"lower(array_join({classes}, ' '))"
    tests = [
        f"array_contains({rel}, 'next')",
        *[f"contains({class_text}, '{word}')" for word in PAGINATION_CLASSES],
        *[f"contains({address}, '{word}')" for word in PAGINATION_PARAMETERS],
        *[f"contains({text}, '{word}')" for word in PAGINATION_WORDS],
    ]
    return F.expr(" or ".join(tests))


def shortest_keywords(keywords: list[str]) -> list[str]:
    """Keywords without those implied by a shorter one (``fees`` holds ``fee``)."""
    return [k for k in keywords if not any(o != k and o in k for o in keywords)]


def _words_sql(anchor_text: str, href: str) -> str:
    """SQL of the text that keywords are looked for in: never null."""
    return f"lower(concat_ws('\\n', {anchor_text}, {path_of_sql(href)}))"


def _hits_sql(words: str) -> str:
    """SQL array of the categories with a keyword in ``words``; no lambda, so that it is compiled."""

    def hit(category: str) -> str:
        tests = " or ".join(f"contains({words}, '{word}')" for word in shortest_keywords(CATEGORY_KEYWORDS[category]))
        return f"if({tests}, '{category}', null)"

    return f"array_except(array({', '.join(map(hit, CATEGORY_KEYWORDS))}), array(cast(null as string)))"


def relevant_categories(anchor_text: str, href: str) -> Column:
    """Array of the categories whose keywords occur in anchor text or raw path.

    Text and path are searched together, prepared once; the newline between
    them cannot be part of a keyword, so no match spans both.
    """
    return F.expr(bind(_words_sql(anchor_text, href), "words", _hits_sql("words")))


def resolve_links(links: DataFrame) -> DataFrame:
    """Adds the absolute target without fragment and its domain to extracted links."""
    absolute = resolve_sql("page_url", "href")
    target = F.expr(f"substring_index({absolute}, '#', 1)")
    return links.withColumn("target_url", target).withColumn(
        "target_domain", authority("target_url")
    )


def followable_links(links: DataFrame) -> DataFrame:
    """Links a walk may follow: ``(page_url, pos, kind, target_url, target_domain)``.

    ``kind`` is ``*`` for pagination, otherwise a category the link is relevant
    to, one row each. Links of no kind are dropped before anything else is
    worked out for them.
    """
    page = is_pagination("anchor_text", "href", "rel", "classes")
    words = F.when(page, F.lit("")).otherwise(F.expr(_words_sql("anchor_text", "href")))
    read = computed(links, F.struct(page.alias("page"), words.alias("words")), "read", "page_url", "pos", "href")
    kinds = F.when(F.col("read.page"), F.array(F.lit(PAGINATION))).otherwise(F.expr(_hits_sql("read.words")))
    kept = unroll(read, kinds, "kind", "page_url", "pos", "href")
    target = F.expr(f"substring_index({resolve_sql('page_url', 'href')}, '#', 1)")
    resolved = computed(kept, target, "target_url", "page_url", "pos", "kind")
    return resolved.withColumn("target_domain", authority("target_url"))
