"""Accuracy against ground truth.

Truth and records meet once, by name. Everything else happens inside that row,
so the items of an entity are never paired up across rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.fixed_values import CATEGORIES, FEE_TOLERANCE, SEVERITIES
from profileloom.functions.arrays import unroll
from profileloom.functions.numbers import is_close
from profileloom.functions.text import normalise_alnum


def join_truth(truth: DataFrame, records: DataFrame) -> DataFrame:
    """Truth rows with the record of the same name; ``record_missing`` when none.

    ``truth(university_name, data)``; ``records`` has unique names.
    """
    found = records.select(
        "university_name",
        F.col("data").alias("found"),
        F.col("validation_flags").alias("flags"),
        F.lit(True).alias("_known"),
    )
    joined = truth.select("university_name", F.col("data").alias("truth")).join(
        found, "university_name", "left"
    )
    return joined.withColumn("record_missing", F.col("_known").isNull()).drop("_known")


def _score(correct: Column, checked: Column) -> Column:
    return F.struct(correct.cast("int").alias("correct"), checked.cast("int").alias("checked"))


def _points(given: Column, match: Column) -> tuple[Column, Column]:
    right = given & F.coalesce(match, F.lit(False))
    return right.cast("int"), given.cast("int")


def about_score(truth: Column, found: Column) -> Column:
    """A point each for founding year and institution type, where truth has them."""
    year_right, year_asked = _points(
        truth["founding_year"].isNotNull(), is_close(truth["founding_year"], found["founding_year"])
    )
    kind = normalise_alnum(truth["institution_type"])
    kind_right, kind_asked = _points(
        truth["institution_type"].isNotNull(),
        (kind != "") & (kind == normalise_alnum(found["institution_type"])),
    )
    return _score(year_right + kind_right, year_asked + kind_asked)


def _matched(truth: Column, found: Column, match: Callable[[Column, Column], Column]) -> Column:
    """Truth items that match some found item; both lists are worked out once, not per pair."""
    some = lambda candidates: F.filter(truth, lambda t: F.exists(candidates, lambda c: match(t, c)))
    return F.get(F.transform(F.array(found), some), 0)


def tuition_score(truth: Column, found: Column) -> Column:
    """A point per truth fee that some found fee matches in currency and amount."""

    def plain(fees: Column) -> Column:
        return F.transform(
            fees,
            lambda f: F.struct(
                normalise_alnum(f["currency"]).alias("currency"), f["international_fee"].alias("fee")
            ),
        )

    def same(t: Column, c: Column) -> Column:
        return (t["currency"] == c["currency"]) & is_close(t["fee"], c["fee"], FEE_TOLERANCE)

    return _score(F.size(_matched(plain(truth), plain(found), same)), F.size(truth))


def acceptance_score(truth: Column, found: Column) -> Column:
    """A point for the exact overall rate, where truth has it."""
    return _score(
        *_points(truth["overall_pct"].isNotNull(), is_close(truth["overall_pct"], found["overall_pct"]))
    )


def course_score(truth: Column, found: Column) -> Column:
    """A point per truth course whose code and title some found course contains or is part of."""

    def plain(courses: Column) -> Column:
        return F.transform(
            courses,
            lambda c: F.struct(
                normalise_alnum(c["code"]).alias("code"), normalise_alnum(c["title"]).alias("title")
            ),
        )

    def overlaps(a: Column, b: Column) -> Column:
        return (a != "") & (b != "") & (b.contains(a) | a.contains(b))

    def same(t: Column, c: Column) -> Column:
        return overlaps(t["code"], c["code"]) & overlaps(t["title"], c["title"])

    return _score(F.size(_matched(plain(truth), plain(found), same)), F.size(truth))


_SCORERS = {
    "about": about_score,
    "tuition_fees": tuition_score,
    "acceptance_rate": acceptance_score,
    "course_listings": course_score,
}


def category_score(category: str, truth: Column, found: Column) -> Column:
    """Struct ``(correct, checked)`` of one category.

    Nothing is checked without truth or for categories that have no comparison;
    a missing value costs one checked point.
    """
    nothing = _score(F.lit(0), F.lit(0))
    if category not in _SCORERS:
        return nothing
    return (
        F.when(truth.isNull(), nothing)
        .when(found.isNull(), _score(F.lit(0), F.lit(1)))
        .otherwise(_SCORERS[category](truth, found))
    )


def score_rows(joined: DataFrame) -> DataFrame:
    """Facts ``(category, university_name, correct, checked)``; missing records have none."""
    truth_fields = set(joined.schema["truth"].dataType.fieldNames())
    entries = [
        F.struct(
            F.lit(c).alias("category"),
            (
                category_score(c, F.col("truth")[c], F.col("found")[c])
                if c in truth_fields
                else _score(F.lit(0), F.lit(0))
            ).alias("score"),
        )
        for c in CATEGORIES
    ]
    known = joined.filter(~F.col("record_missing"))
    rows = unroll(known, F.array(*entries), "row", "university_name")
    return rows.select("row.category", "university_name", "row.score.correct", "row.score.checked")


def _percent(correct: Column, checked: Column) -> Column:
    return F.when(checked > 0, F.round(correct * 100.0 / F.nullif(checked, F.lit(0)), 1))


def accuracy_cube(scores: DataFrame) -> DataFrame:
    """Totals and percentages per cell, category, entity and overall; null percent is N/A."""
    cubed = scores.cube("category", "university_name").agg(
        F.grouping("category").cast("int").alias("all_categories"),
        F.grouping("university_name").cast("int").alias("all_entities"),
        F.sum("correct").alias("correct"),
        F.sum("checked").alias("checked"),
    )
    return cubed.withColumn("percent", _percent(F.col("correct"), F.col("checked")))


def accuracy_matrix(scores: DataFrame, entities: list[str] | None = None) -> DataFrame:
    """Percentages as a matrix.

    By default one row per entity and one column per category, which works for
    any number of entities. With ``entities`` named, one row per category and
    one column per named entity, as a report prints it.
    """
    if entities is None:
        table = scores.groupBy("university_name").pivot("category", CATEGORIES)
        columns = CATEGORIES
    else:
        table = scores.groupBy("category").pivot("university_name", entities)
        columns = entities
    wide = table.agg(F.sum("correct").alias("correct"), F.sum("checked").alias("checked"))
    key = wide.columns[0]
    return wide.select(
        key,
        *[_percent(F.col(f"`{c}_correct`"), F.col(f"`{c}_checked`")).alias(c) for c in columns],
    )


def flag_counts(joined: DataFrame) -> DataFrame:
    """Flags by severity of every truth entity; zeros stay, other severities are ignored."""
    return joined.select(
        "university_name",
        *[
            F.size(
                F.filter(
                    F.coalesce("flags", F.array().cast(joined.schema["flags"].dataType)),
                    lambda flag: F.lower(flag["severity"]) == name,
                )
            )
            .cast("bigint")
            .alias(name)
            for name in SEVERITIES
        ],
    )


def known_gaps(joined: DataFrame) -> DataFrame:
    """(entity, category) pairs without any checked point, missing records included."""
    truth_fields = set(joined.schema["truth"].dataType.fieldNames())

    def gap(category: str) -> Column:
        if category not in _SCORERS or category not in truth_fields:
            return F.lit(True)
        score = category_score(category, F.col("truth")[category], F.col("found")[category])
        return F.col("record_missing") | (score["checked"] == 0)

    cells = F.array_compact(F.array(*[F.when(gap(c), F.lit(c)) for c in CATEGORIES]))
    return unroll(joined, cells, "category", "university_name")
