"""Declared types of profiles, records and their ten categories."""

from __future__ import annotations

from pyspark.sql import types as T

from profileloom.fixed_values import CATEGORIES, INSTITUTION_TYPES

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


class Field:
    """A field of a category: its type, whether it must be given, allowed values."""

    def __init__(self, name, kind, required=False, allowed=None):
        self.name, self.kind, self.required, self.allowed = name, kind, required, allowed


class Shape:
    """An object with declared fields."""

    def __init__(self, *fields: Field):
        self.fields = list(fields)

    def spark_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, spark_type(f.kind)) for f in self.fields])


class ListOf:
    """A list of values of one kind."""

    def __init__(self, kind):
        self.kind = kind


def spark_type(kind) -> T.DataType:
    """Spark type of a declared kind."""
    if isinstance(kind, Shape):
        return kind.spark_type()
    if isinstance(kind, ListOf):
        return T.ArrayType(spark_type(kind.kind))
    return kind


RANKING = Shape(Field("rank", LONG, True), Field("source", STRING, True), Field("year", LONG, True))
LOCATION = Shape(Field("city", STRING, True), Field("country", STRING, True))

CATEGORY_KINDS = {
    "about": Shape(
        Field("name", STRING, True),
        Field("founding_year", LONG),
        Field("overall_ranking", RANKING),
        Field("location", LOCATION, True),
        Field("institution_type", STRING, True, allowed=INSTITUTION_TYPES),
    ),
    "tuition_fees": ListOf(
        Shape(
            Field("programme_level", STRING, True),
            Field("domestic_fee", DOUBLE),
            Field("international_fee", DOUBLE),
            Field("currency", STRING, True),
            Field("academic_year", STRING, True),
            Field("source_url", STRING, True),
        )
    ),
    "living_costs": Shape(
        Field("city", STRING, True),
        Field("monthly_rent", DOUBLE),
        Field("monthly_food", DOUBLE),
        Field("monthly_transport", DOUBLE),
        Field("currency", STRING, True),
        Field("source_url", STRING, True),
        Field("estimate_basis", STRING),
    ),
    "scholarships": ListOf(
        Shape(
            Field("name", STRING, True),
            Field("value", STRING),
            Field("eligibility_criteria", STRING, True),
            Field("application_deadline", STRING),
            Field("source_url", STRING, True),
        )
    ),
    "acceptance_rate": Shape(
        Field("overall_pct", DOUBLE),
        Field("undergraduate_pct", DOUBLE),
        Field("postgraduate_pct", DOUBLE),
        Field("year", LONG),
        Field("source_url", STRING, True),
    ),
    "graduate_employment": Shape(
        Field("employed_within_6_months_pct", DOUBLE),
        Field("data_source", STRING),
        Field("data_year", LONG),
        Field("source_url", STRING, True),
    ),
    "average_salaries": ListOf(
        Shape(
            Field("field_of_study", STRING, True),
            Field("median_salary", DOUBLE, True),
            Field("currency", STRING, True),
            Field("year", LONG),
            Field("source_url", STRING, True),
        )
    ),
    "visa_policies": Shape(
        Field("country", STRING, True),
        Field("visa_type", STRING, True),
        Field("processing_time", STRING),
        Field("key_requirements", ListOf(STRING), True),
        Field("source_url", STRING, True),
    ),
    "intake_deadlines": ListOf(
        Shape(
            Field("intake_name", STRING, True),
            Field("programme_level", STRING),
            Field("application_open_date", STRING),
            Field("application_close_date", STRING),
            Field("source_url", STRING, True),
        )
    ),
    "course_listings": ListOf(
        Shape(
            Field("code", STRING, True),
            Field("title", STRING, True),
            Field("credits", DOUBLE),
            Field("description", STRING),
            Field("prerequisites", ListOf(STRING), True),
            Field("mode", STRING),
            Field("source_url", STRING, True),
        )
    ),
}

CATEGORY_TYPES = {name: spark_type(kind) for name, kind in CATEGORY_KINDS.items()}
DATA_TYPE = T.StructType([T.StructField(name, CATEGORY_TYPES[name]) for name in CATEGORIES])

FLAG_TYPE = T.StructType(
    [
        T.StructField("field", STRING),
        T.StructField("rule_id", STRING),
        T.StructField("idx", LONG),
        T.StructField("issue", STRING),
        T.StructField("severity", STRING),
    ]
)
RECORD_TYPE = T.StructType(
    [
        T.StructField("university_name", STRING),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("data", DATA_TYPE),
        T.StructField("field_confidence", T.MapType(STRING, DOUBLE)),
        T.StructField("validation_flags", T.ArrayType(FLAG_TYPE)),
    ]
)
PROFILE_TYPE = T.StructType(
    [
        T.StructField("name", STRING),
        T.StructField("country", STRING),
        T.StructField("base_url", STRING),
        T.StructField("seed_urls", T.MapType(STRING, T.ArrayType(STRING))),
    ]
)
PAGE_TYPE = T.StructType(
    [
        T.StructField("url", STRING),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("html", STRING),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("error", STRING),
    ]
)
HASH_STATE_TYPE = T.StructType(
    [
        T.StructField("url", STRING),
        T.StructField("hash", STRING),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)
TRUTH_TYPE = T.StructType(
    [
        T.StructField("university_name", STRING),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "about",
                        T.StructType(
                            [
                                T.StructField("founding_year", LONG),
                                T.StructField("institution_type", STRING),
                            ]
                        ),
                    ),
                    T.StructField(
                        "tuition_fees",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("international_fee", DOUBLE),
                                    T.StructField("currency", STRING),
                                ]
                            )
                        ),
                    ),
                    T.StructField(
                        "acceptance_rate", T.StructType([T.StructField("overall_pct", DOUBLE)])
                    ),
                    T.StructField(
                        "course_listings",
                        T.ArrayType(
                            T.StructType(
                                [T.StructField("code", STRING), T.StructField("title", STRING)]
                            )
                        ),
                    ),
                ]
            ),
        ),
    ]
)
