"""Page snapshot operators: text, hashing, render need, fetch outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.fixed_values import BLOCKED_BY_ROBOTS, SHELL_TEXT_LENGTH
from profileloom.functions.text import clean_text, content_hash, visible_text


def plan_usable(error: Column, status_code: Column) -> Column:
    """A page the planner may expand: no error and no 4xx/5xx status."""
    return error.isNull() & (status_code < 400)


def extract_usable(error: Column) -> Column:
    """A page extraction may read: no error; a 404 body still counts."""
    return error.isNull()


def needs_render(error: Column, status_code: Column, html: Column) -> Column:
    """Whether a usable page shows so little text that it must be rendered first."""
    shell = F.length(visible_text(html)) < SHELL_TEXT_LENGTH
    return F.when(plan_usable(error, status_code), shell).otherwise(False)


def outcome_class(error: Column, status_code: Column) -> Column:
    """Label of a fetch attempt."""
    return (
        F.when(error == BLOCKED_BY_ROBOTS, "robots")
        .when(error.startswith("HTTP status error"), "server_error")
        .when(error.startswith("Transport error"), "transport_error")
        .when(error.isNotNull(), "unexpected_error")
        .when(status_code >= 400, "client_error")
        .otherwise("ok")
    )


def error_label(status_code: Column, blocked: Column, transport: Column, failure: Column) -> Column:
    """Error text of a fetch attempt; null when a response below 500 came back."""
    return (
        F.when(blocked, BLOCKED_BY_ROBOTS)
        .when(transport.isNotNull(), F.concat(F.lit("Transport error: "), transport))
        .when(failure.isNotNull(), F.concat(F.lit("Unexpected error: "), failure))
        .when(
            status_code >= 500,
            F.concat(F.lit("HTTP status error: "), status_code.cast("string")),
        )
    )


def fetch_outcomes(fetches: DataFrame) -> DataFrame:
    """Adds outcome class and both usability predicates to a fetch log."""
    error, status = F.col("error"), F.col("status_code")
    return fetches.select(
        "*",
        outcome_class(error, status).alias("outcome"),
        plan_usable(error, status).alias("plan_usable"),
        extract_usable(error).alias("extract_usable"),
    )


def with_clean_text(pages: DataFrame) -> DataFrame:
    """Replaces ``html`` by the clean text and its hash; failed pages have empty text.

    Dropping ``html`` here keeps raw markup out of every later shuffle.
    """
    text = F.when(extract_usable(F.col("error")), clean_text(F.col("html"))).otherwise("")
    kept = [name for name in pages.columns if name != "html"]
    return pages.select(*kept, text.alias("clean_text")).withColumn(
        "hash", content_hash(F.col("clean_text"))
    )


def page_profile(pages: DataFrame) -> DataFrame:
    """Clean text, its hash and the render need of every page, in one scan."""
    text = F.when(extract_usable(F.col("error")), clean_text(F.col("html"))).otherwise("")
    kept = [name for name in pages.columns if name != "html"]
    shell = needs_render(F.col("error"), F.col("status_code"), F.col("html"))
    return pages.select(*kept, text.alias("clean_text"), shell.alias("needs_render")).withColumn(
        "hash", content_hash(F.col("clean_text"))
    )
