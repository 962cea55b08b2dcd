"""Compiled records: building, isolating failures, reshaping, looking up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.fixed_values import CATEGORIES, FAILURE_FIELD
from profileloom.functions.joins import shuffled
from profileloom.operators.responses import answer_sql, default_data, default_value
from profileloom.operators.rules import validate_records
from profileloom.schemas import FLAG_TYPE

#: Column with the error of a failed entity.
FAILED = "_failed"


def _profile_columns() -> list[Column]:
    return [F.col(name) for name in ("name", "country", "base_url")]


def compile_data(profiles: DataFrame, responses: DataFrame, unwrap: bool = False) -> DataFrame:
    """Adds the nested ``data`` of every profile from its answers.

    ``profiles(ek, name, country, base_url)``; ``responses(ek, category,
    content)``. Missing, empty and rejected answers become the typed default. Of
    repeated answers to one category the greatest text counts, whatever their order.
    Where responses have an ``error``, the greatest one of an entity stays with it, and
    ``finish_records`` makes a fallback record of it.
    """
    failed = [F.max("error").alias(FAILED)] if "error" in responses.columns else []
    answers = responses.groupBy("ek").agg(
        *[F.max(F.when(F.col("category") == c, F.col("content"))).alias(f"_answer_{c}") for c in CATEGORIES],
        *failed,
    )
    joined = profiles.join(shuffled(answers), "ek", "left")
    read = joined.select(
        *profiles.columns,
        *([FAILED] if failed else []),
        *[F.expr(answer_sql(f"_answer_{c}", c, unwrap)).alias(f"_{c}") for c in CATEGORIES],
    )
    data = F.struct(
        *[
            F.coalesce(F.col(f"_{c}.value"), default_value(c, *_profile_columns())).alias(c)
            for c in CATEGORIES
        ]
    )
    return read.select(*profiles.columns, *([FAILED] if failed else []), data.alias("data"))


def _fallback_parts() -> dict[str, Column]:
    """What a failed entity's record holds: defaults, zero confidence and one high flag with its error."""
    flag = F.struct(
        F.lit(FAILURE_FIELD).alias("field"),
        F.lit("T9").alias("rule_id"),
        F.lit(None).cast("bigint").alias("idx"),
        F.concat(F.lit("entity failed: "), F.col(FAILED)).alias("issue"),
        F.lit("high").alias("severity"),
    )
    zero = F.map_from_arrays(F.array(*map(F.lit, CATEGORIES)), F.array_repeat(F.lit(0.0), len(CATEGORIES)))
    flags = F.array(flag).cast(f"array<{FLAG_TYPE.simpleString()}>")
    return {"data": default_data(*_profile_columns()), "field_confidence": zero, "validation_flags": flags}


def finish_records(compiled: DataFrame, as_of_year: int, run_ts: Column) -> DataFrame:
    """Validated, scored records in their stored layout, keys kept.

    Rows with an error in the column ``FAILED``, where there is one, become fallback records
    in place: no join, and no other row changes.
    """
    keys = [name for name in compiled.columns if name not in ("name", "country", "base_url", "data", FAILED)]
    scored = validate_records(compiled, as_of_year)
    parts = {name: F.col(name) for name in ("data", "field_confidence", "validation_flags")}
    if FAILED in compiled.columns:
        instead = _fallback_parts()
        parts = {name: F.when(F.col(FAILED).isNotNull(), instead[name]).otherwise(own) for name, own in parts.items()}
    return scored.select(
        *keys,
        F.col("name").alias("university_name"),
        run_ts.alias("scraped_at"),
        *[part.alias(name) for name, part in parts.items()],
    )


def stub_records(profiles: DataFrame, as_of_year: int, run_ts: Column) -> DataFrame:
    """Records made of defaults only, validated like any other; needs no pages."""
    filled = profiles.withColumn("data", default_data(*_profile_columns()))
    return finish_records(filled.select("ek", "name", "country", "base_url", "data"), as_of_year, run_ts)


def isolate_failures(
    records: DataFrame, profiles: DataFrame, errors: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Replaces the records of failed entities by the fallback record.

    ``errors(ek, error)`` has one row per failed key. A fallback record has
    default data, zero confidence everywhere and one high flag, and does not
    touch other entities: of ``records`` only the keys meet the failed ones, which are
    broadcast while they are few.
    """
    failed = profiles.select("ek", "name", "country", "base_url").join(errors.withColumnRenamed("error", FAILED), "ek")
    made = {name: part.alias(name) for name, part in _fallback_parts().items()}
    made["university_name"] = F.col("name").alias("university_name")
    made["scraped_at"] = (F.current_timestamp() if run_ts is None else run_ts).cast(records.schema["scraped_at"].dataType).alias("scraped_at")
    missing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in records.schema if f.name not in (*made, "ek")}
    fallback = failed.select(*[made.get(c) if c in made else missing.get(c, F.col(c)) for c in records.columns])
    return records.join(errors.select("ek"), "ek", "left_anti").select(*records.columns).unionByName(fallback)


def flatten_fields(records: DataFrame, *keep: str) -> DataFrame:
    """One row per (record, category): value and flags as JSON, and the confidence.

    Nulls stay in the JSON; a missing confidence is 0. Rows are unrolled inside
    each record, so nothing is shuffled.
    """
    options = {"ignoreNullFields": "false"}

    def row(category: str) -> Column:
        own = F.filter("validation_flags", lambda flag: flag["field"] == category)
        shown = F.transform(
            own, lambda flag: F.struct(flag["field"], flag["issue"], flag["severity"])
        )
        return F.struct(
            F.lit(category).alias("field_name"),
            F.to_json(F.col("data")[category], options).alias("field_json"),
            F.coalesce(F.try_element_at("field_confidence", F.lit(category)), F.lit(0.0)).alias(
                "confidence"
            ),
            F.to_json(shown, options).alias("flags_json"),
        )

    rows = F.explode(F.array(*[row(c) for c in CATEGORIES])).alias("row")
    return records.select(*keep, "university_name", rows).select(*keep, "university_name", "row.*")


def list_entities(records: DataFrame) -> DataFrame:
    """Names of the stored records in stored order; nameless rows are skipped."""
    named = records.filter(F.col("university_name").isNotNull())
    return named.select("ord", "university_name").orderBy("ord")


def find_entity(records: DataFrame, name: str) -> DataFrame:
    """The first stored record of a name, ignoring case; no row when unknown."""
    same = F.lower("university_name") == F.lower(F.lit(name))
    return records.filter(same).orderBy("ord").limit(1)


def find_field(records: DataFrame, name: str, field: str) -> DataFrame:
    """Value, confidence and well-formed flags of one field; no row when unknown.

    Only the asked field is read from a columnar store.
    """
    if field not in CATEGORIES:
        return records.limit(0).select(
            F.lit(field).alias("field"),
            F.lit(None).cast("string").alias("value"),
            F.lit(None).cast("double").alias("confidence"),
            F.col("validation_flags"),
        )
    found = find_entity(
        records.select(
            "ord",
            "university_name",
            F.col("data")[field].alias("value"),
            F.col("field_confidence"),
            F.col("validation_flags"),
        ),
        name,
    )
    well_formed = F.filter(
        "validation_flags",
        lambda flag: (flag["field"] == field)
        & flag["issue"].isNotNull()
        & flag["severity"].isin("low", "medium", "high"),
    )
    return found.select(
        F.lit(field).alias("field"),
        F.to_json("value", {"ignoreNullFields": "false"}).alias("value"),
        F.coalesce(F.try_element_at("field_confidence", F.lit(field)), F.lit(0.0)).alias("confidence"),
        well_formed.alias("validation_flags"),
    )
