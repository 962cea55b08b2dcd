"""Queries over nested records: validation, reshape, storage, lookup, reuse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.checks.inputs import (
    dealt,
    duck_data_columns,
    load,
    run_sql,
    spark_data_columns,
)
from profileloom.checks.registry import register
from profileloom.checks.rule_queries import (
    AS_OF_YEAR,
    all_flags_sql,
    confidence_sql,
)
from profileloom.fixed_values import CATEGORIES, LIST_CATEGORIES
from profileloom.functions.arrays import computed, unroll
from profileloom.operators import incremental, records, responses, rules
from profileloom.runtime import fresh_path
from profileloom.schemas import CATEGORY_TYPES, DATA_TYPE
from profileloom.sources import records as record_io

_RUN_TIME = "2026-01-01"


def nested_records(spark, sf_dir):
    """One nested record per order: ``ek, ord, name, country, base_url, data``."""
    columns = spark_data_columns()
    base = dealt(load(spark, sf_dir, "rec"))
    flat = base.selectExpr("ek", "ord", "name", "country", "base_url", *[f"{columns[c]} as {c}" for c in CATEGORIES])
    data = F.struct(*CATEGORIES).cast(DATA_TYPE)
    return flat.select("ek", "ord", "name", "country", "base_url", data.alias("data"))


def stored_records(spark, sf_dir):
    """The nested records, validated and in their stored layout."""
    run_ts = F.lit(_RUN_TIME).cast("timestamp")
    return records.finish_records(nested_records(spark, sf_dir), AS_OF_YEAR, run_ts)


@register(f"select ek, field, rule_id, idx, severity from ({all_flags_sql(nested=True)}) f")
def record_flags(spark, sf_dir):
    validated = rules.validate_records(nested_records(spark, sf_dir), AS_OF_YEAR)
    return unroll(validated, F.col("validation_flags"), "flag", "ek").select(
        "ek", "flag.field", "flag.rule_id", "flag.idx", "flag.severity"
    )


@register(f"select ek, field, confidence from ({confidence_sql(nested=True)}) c")
def record_confidence(spark, sf_dir):
    validated = rules.validate_records(nested_records(spark, sf_dir), AS_OF_YEAR)
    return validated.select("ek", F.explode_outer("field_confidence").alias("field", "confidence"))


_DUCK = duck_data_columns()
_CELLS = " union all ".join(
    f"select ek, name as university_name, '{c}' as field_name, cast(to_json({_DUCK[c]}) as varchar) as field_json from $rec"
    for c in CATEGORIES
)
_FLAT = f"""
select c.ek, c.university_name, c.field_name, c.field_json, s.confidence,
  s.n_high + s.n_medium + s.n_low as n_flags
from $cells c join $scores s on s.ek = c.ek and s.field = c.field_name"""
_FLAT_VIEWS = {"cells": _CELLS, "scores": confidence_sql(nested=True)}


def _count_flags(flat):
    """The flags column as a count, so that issue wording stays out of the comparison."""
    return flat.withColumn("n_flags", F.json_array_length("flags_json").cast("bigint")).drop("flags_json")


@register(f"select university_name, field_name, field_json, confidence, n_flags from ({_FLAT}) f", **_FLAT_VIEWS)
def flatten_fields(spark, sf_dir):
    return _count_flags(records.flatten_fields(stored_records(spark, sf_dir)))


@register(f"select university_name, field_name, field_json, confidence, n_flags from ({_FLAT}) f", **_FLAT_VIEWS)
def flat_csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "flat")
    record_io.write_flat(stored_records(spark, sf_dir), path)
    return _count_flags(record_io.read_flat(spark, path))


_STORE = """
select r.ek as ord, r.name as university_name, timestamp '2026-01-01' as scraped_at,
  case when r.ek % 7 = 0 then null else cast(floor(price / 200) as bigint) end as founding_year,
  n_tuition as n_fees, n_requirement as n_requirements, coalesce(n, 0) as n_flags
from $rec r left join (select ek, count(*) as n from $flags group by ek) f on f.ek = r.ek"""


@register(_STORE, flags=all_flags_sql(nested=True))
def records_parquet_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "records")
    record_io.write_records(stored_records(spark, sf_dir), path, "parquet")
    return _store_summary(record_io.read_records(spark, path, "parquet"))


@register(_STORE, flags=all_flags_sql(nested=True))
def records_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "records")
    record_io.write_records(stored_records(spark, sf_dir), path)
    return _store_summary(record_io.read_records(spark, path))


def _store_summary(read):
    return read.select(
        "ord", "university_name", F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"),
        F.col("data.about.founding_year").alias("founding_year"),
        F.size("data.tuition_fees").alias("n_fees"),
        F.size("data.visa_policies.key_requirements").alias("n_requirements"),
        F.size("validation_flags").cast("bigint").alias("n_flags"),
    )


# Answers of every category made of the record values: cut short, in another JSON kind,
# fenced, between white space, or as they stand.
_ANSWERED = " union all ".join(
    f"""select ek, '{c}' as category, case when ek % 7 = 6 then 'empty' when ek % 5 = 3 then 'rejected'
      when field_json = '[]' then 'empty' else 'loaded' end as status, field_json from $cells where field_name = '{c}'"""
    for c in CATEGORIES
)


@register(
    "select ek, category, status, case when status = 'loaded' then field_json end as value_json from $answered",
    cells=_CELLS, answered=_ANSWERED,
)
def response_typed_all(spark, sf_dir):
    base, columns = dealt(load(spark, sf_dir, "rec")), spark_data_columns()
    options = {"ignoreNullFields": "false"}

    def loaded(category):
        value = F.expr(columns[category]).cast(CATEGORY_TYPES[category])
        texts, text = computed(base, F.to_json(value, options), "text", "ek"), F.col("text")
        other = F.concat(F.lit('{"items":'), text, F.lit("}")) if category in LIST_CATEGORIES else F.concat(F.lit("["), text, F.lit("]"))
        content = (
            F.when(F.col("ek") % 7 == 6, F.substring(text, F.lit(1), F.length(text) - 1))
            .when(F.col("ek") % 5 == 3, other)
            .when(F.col("ek") % 5 == 1, F.concat(F.lit("```json\n"), text, F.lit("\n```")))
            .when(F.col("ek") % 5 == 2, F.concat(F.lit(" \n"), text, F.lit("\n")))
            .otherwise(text)
        )
        read = responses.load_responses(computed(texts, content, "content", "ek"), category)
        return read.select("ek", F.lit(category).alias("category"), "status", F.to_json("value", options).alias("value_json"))

    return reduce(DataFrame.unionByName, map(loaded, CATEGORIES))


# Stored record lines, some of them damaged; about ten lines share each name,
# and a third of all lines share one.
_LINE_NAME = "case when o_orderkey % 3 = 0 then 'Popular' else concat('Entity ', cast(o_custkey as string)) end"
_LINES = """
select o_orderkey as ord, @name as name, cast(o_orderkey % 8 as int) as variant,
  case o_orderkey % 8 when 7 then concat('not json ', o_orderpriority) else concat(
    '{"university_name":', case o_orderkey % 8 when 6 then 'null' else concat('"', @name, '"') end,
    ',"scraped_at":"2026-01-01T00:00:00Z","data":{"about":{"name":"', cast(o_orderkey as string),
    '","location":{"city":"C","country":"Canada"},"institution_type":"', case o_orderkey % 8 when 5 then 'Secret' else 'public' end,
    '"},"living_costs":{"city":"C","monthly_rent":', cast(o_custkey as string), ',"currency":"CAD","source_url":"u"},',
    '"acceptance_rate":{"source_url":"u"},"graduate_employment":{"source_url":"u"},',
    '"visa_policies":{"country":"Canada","visa_type":"S","key_requirements":', case o_orderkey % 8 when 4 then '"x"' else '["x"]' end,
    ',"source_url":"u"}},"field_confidence":{"about":', case o_orderkey % 8 when 3 then '"high"' else '0.5' end, '}',
    case o_orderkey % 8 when 2 then '' else ',"validation_flags":[{"field":"about","issue":"i","severity":"low"}]' end, '}') end as line
from $orders""".replace("@name", _LINE_NAME)


@register(
    """
select ord, university_name, about_name, monthly_rent, n_flags from (
  select ord, name as university_name, cast(ord as varchar) as about_name, cast(o_custkey as double) as monthly_rent,
    case when variant = 2 then 0 else 1 end as n_flags, row_number() over (partition by name order by ord desc) as n
  from $lines join $orders on o_orderkey = ord where variant < 3) x where n = 1""",
    lines=_LINES,
)
def records_tolerant_load(spark, sf_dir):
    lines = dealt(run_sql(spark, sf_dir, _LINES).select("ord", "line"))
    return record_io.parse_records(lines).select(
        "ord", "university_name", F.col("data.about.name").alias("about_name"),
        "data.living_costs.monthly_rent", F.size("validation_flags").alias("n_flags"),
    )


@register(
    """
select university_name, about_name, monthly_rent from (
  select name as university_name, cast(ord as varchar) as about_name, cast(o_custkey as double) as monthly_rent,
    row_number() over (partition by name order by ord desc) as n
  from $lines join $orders on o_orderkey = ord where variant < 3) x where n = 1""",
    lines=_LINES,
)
def records_last_wins(spark, sf_dir):
    """Lines that carry no position: the last of a name in file order stays."""
    path = fresh_path(spark, "lines")
    run_sql(spark, sf_dir, _LINES).orderBy("ord").select("line").write.text(path)
    read = record_io.read_records(spark, path)
    return read.select("university_name", F.col("data.about.name").alias("about_name"), "data.living_costs.monthly_rent")


@register(
    """
select case when variant < 6 then name end as university_name,
  case when variant < 7 then cast(ord as varchar) end as about_name, variant = 7 as broken
from $lines""",
    lines=_LINES,
)
def records_raw_load(spark, sf_dir):
    """Every stored line in declared types, damaged ones included."""
    path = fresh_path(spark, "lines")
    run_sql(spark, sf_dir, _LINES).select("line").write.text(path)
    read = record_io.read_raw_records(spark, path)
    about = F.col("data.about.name")
    return read.select("university_name", about.alias("about_name"), about.isNull().alias("broken"))


@register("select ord, name as university_name from $rec where ek % 10 <> 0")
def entity_list(spark, sf_dir):
    nameless = F.when(F.col("ek") % 10 != 0, F.col("name"))
    stored = load(spark, sf_dir, "rec").select("ek", "ord", nameless.alias("university_name"))
    return records.list_entities(stored)


# Names shared by several records, so that the first one matters.
_SHARED = "concat('Entity ', cast(ek % 100 as varchar))"


def _shared_names(spark, sf_dir):
    stored = stored_records(spark, sf_dir)
    shared = F.concat(F.lit("Entity "), (F.col("ek") % 100).cast("string"))
    return stored.withColumn("university_name", shared)


@register(f"select ord, {_SHARED} as university_name, n_tuition as n_fees from $rec where lower({_SHARED}) = 'entity 42' order by ord limit 1")
def entity_lookup(spark, sf_dir):
    found = records.find_entity(_shared_names(spark, sf_dir), "ENTITY 42")
    return found.select("ord", "university_name", F.size("data.tuition_fees").alias("n_fees"))


@register(
    f"""
select 'tuition_fees' as field, c.field_json as value, s.confidence, s.n_high + s.n_medium + s.n_low as n_flags
from (select min(ek) as ek from $rec where lower({_SHARED}) = 'entity 42') f
join $cells c on c.ek = f.ek and c.field_name = 'tuition_fees' join $scores s on s.ek = f.ek and s.field = 'tuition_fees'""",
    **_FLAT_VIEWS,
)
def field_lookup(spark, sf_dir):
    found = records.find_field(_shared_names(spark, sf_dir), "entity 42", "tuition_fees")
    return found.withColumn("n_flags", F.size("validation_flags").cast("bigint")).drop("validation_flags")


# ------------------------------------------------------- reuse and replacement
_REUSE = """
select ek, category, count(*) as n_pages, count(*) filter (changed) as n_changed,
  ek % 10 <> 3 and count(*) filter (changed) = 0 as can_reuse
from (select l_suppkey as ek, case l_returnflag when 'A' then 'about' when 'N' then 'tuition_fees' else 'visa_policies' end as category,
        l_suppkey % 4 = 0 and l_orderkey % 50 = 0 as changed from $lineitem) x
group by ek, category"""


@register(_REUSE)
def category_reuse(spark, sf_dir):
    fetched = run_sql(
        spark, sf_dir,
        """select l_suppkey as ek, case l_returnflag when 'A' then 'about' when 'N' then 'tuition_fees'
           else 'visa_policies' end as category, l_suppkey % 4 = 0 and l_orderkey % 50 = 0 as has_changed from $lineitem""",
    )
    previous = load(spark, sf_dir, "entity").filter("ek % 10 <> 3").select("ek")
    return incremental.category_reuse(fetched, previous)


@register(
    """
select ek, case when ek % 4 <> 3 and ek % 3 = 0 then 'stored' else name_now end as about_name,
  case when ek % 4 <> 3 and ek % 2 = 0 then 0 else n_tuition end as n_fees, n_course
from (select *, case when ek % 11 = 0 then 'Unknown' when ek % 23 = 0 then '' else name end as name_now from $rec) r"""
)
def reuse_merge(spark, sf_dir):
    now = nested_records(spark, sf_dir)
    about = F.col("data.about").withField("name", F.lit("stored"))
    none = F.array().cast(DATA_TYPE["tuition_fees"].dataType)
    previous = now.filter("ek % 4 <> 3").select(
        "ek", F.col("data").withField("about", about).withField("tuition_fees", none).alias("data")
    )
    reusable = F.array_compact(
        F.array(
            F.when(F.col("ek") % 3 == 0, F.lit("about")),
            F.when(F.col("ek") % 2 == 0, F.lit("tuition_fees")),
        )
    )
    merged = incremental.merge_reused(now, previous, reusable)
    return merged.select(
        "ek", F.col("data.about.name").alias("about_name"), F.size("data.tuition_fees").alias("n_fees"),
        F.size("data.course_listings").alias("n_course"),
    )


_UPSERT = """
select university_name, ord, source from (
  select *, row_number() over (partition by university_name order by case source when 'new' then 1 else 0 end desc, ord desc) as n from (
    select concat('Customer ', cast(c_custkey as varchar)) as university_name, c_custkey as ord, 'old' as source from $customer
    union all
    select concat('Customer ', cast(o_custkey as varchar)), o_orderkey, 'new' from $orders where {batch}) u) x
where n = 1"""


def _upserted(spark, sf_dir, batch):
    named = lambda key: F.concat(F.lit("Customer "), F.col(key).cast("string")).alias("university_name")
    stored = load(spark, sf_dir, "customer").select(
        named("c_custkey"), F.col("c_custkey").alias("ord"), F.lit("old").alias("source")
    )
    fresh = load(spark, sf_dir, "orders").filter(batch).select(
        named("o_custkey"), F.col("o_orderkey").alias("ord"), F.lit("new").alias("source")
    )
    return incremental.upsert(stored, fresh)


@register(_UPSERT.format(batch="o_orderstatus = 'P'"))
def record_upsert(spark, sf_dir):
    """A small batch: most stored records stay."""
    return _upserted(spark, sf_dir, "o_orderstatus = 'P'")


@register(_UPSERT.format(batch="true"))
def record_upsert_all(spark, sf_dir):
    """A batch that repeats most keys."""
    return _upserted(spark, sf_dir, "true")
