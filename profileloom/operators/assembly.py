"""From fetched pages to extraction requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.fixed_values import (
    CATEGORIES,
    MAX_CONTEXT_CHARS,
    TEMPERATURE,
    TRUNCATION_MARK,
)
from profileloom.schemas import CATEGORY_TYPES


def assemble_texts(fetched: DataFrame, keep_chars: int | None = None) -> DataFrame:
    """Joined text and source list per (ek, category), in plan order.

    ``fetched(ek, category, rank, url, error, clean_text)`` holds the targets of
    a plan, so a group has at most the plan's few rows. Texts of usable,
    non-blank pages are joined by a blank line; the source list names every
    page. With ``keep_chars`` each page is cut to one character more before it
    is shuffled: enough to give the same truncated text, and to tell that it was
    truncated.
    """
    usable = F.col("error").isNull() & (F.col("clean_text") != "")
    text = F.col("clean_text")
    if keep_chars is not None:
        text = F.substring(text, 1, keep_chars + 1)
    page = F.struct("rank", "url", F.when(usable, text).alias("text"))
    ordered = F.array_sort(F.collect_list(page))
    grouped = fetched.groupBy("ek", "category").agg(
        ordered.alias("pages"), F.count(F.lit(1)).alias("n_pages")
    )
    texts = F.filter(F.transform("pages", lambda p: p["text"]), lambda t: t.isNotNull())
    return grouped.select(
        "ek",
        "category",
        F.array_join(texts, "\n\n").alias("text"),
        F.array_join(F.transform("pages", lambda p: p["url"]), ", ").alias("source_urls"),
        "n_pages",
    )


def sources_or_base(source_urls: Column, base_url: Column) -> Column:
    """Source list, or the entity's base URL when no page was planned."""
    return F.coalesce(F.nullif(source_urls, F.lit("")), base_url)


def truncate_text(text: Column, limit: int = MAX_CONTEXT_CHARS) -> Column:
    """Text within the model's context: longer texts are cut and marked."""
    cut = F.concat(F.substring(text, 1, limit), F.lit(TRUNCATION_MARK))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def schema_text(category: Column) -> Column:
    """JSON description of a category's type."""
    table = F.create_map(
        *[F.lit(part) for name in CATEGORIES for part in (name, CATEGORY_TYPES[name].json())]
    )
    return F.try_element_at(table, category)


def extraction_requests(texts: DataFrame, limit: int = MAX_CONTEXT_CHARS) -> DataFrame:
    """One request per (ek, category) with any text at all.

    ``texts(ek, category, text, source_urls)``; the result holds both messages
    and the sampling settings an extractor needs.
    """
    system = F.concat(
        F.lit(
            "Extract structured facts from the text below. Use only what the text states; "
            "leave out what it does not. Answer with JSON of this type and nothing else:\n"
        ),
        schema_text(F.col("category")),
    )
    user = F.concat(
        F.lit("Category: "), F.col("category"), F.lit("\nSources: "), F.col("source_urls"),
        F.lit("\nText:\n"), truncate_text(F.col("text"), limit),
    )
    return texts.filter(F.trim("text") != "").select(
        "ek",
        "category",
        system.alias("system_message"),
        user.alias("user_message"),
        F.lit(TEMPERATURE).alias("temperature"),
        F.lit("json_object").alias("response_format"),
    )
