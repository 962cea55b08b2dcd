"""Queries over text assembly, requests, answers and defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from profileloom.checks.inputs import dealt, load
from profileloom.checks.registry import register
from profileloom.fixed_values import LIST_CATEGORIES, MAX_CONTEXT_CHARS
from profileloom.operators import assembly, records, responses
from profileloom.operators.extractor import apply_extractor

_TEXTS = """
select ek, category,
  coalesce(string_agg(clean_text, concat(chr(10), chr(10)) order by rank) filter (where error is null and clean_text <> ''), '') as text,
  string_agg(url, ', ' order by rank) as source_urls, count(*) as n_pages
from $planned_text group by ek, category"""
_CUT = f"case when length(text) > {MAX_CONTEXT_CHARS} then concat(substr(text, 1, {MAX_CONTEXT_CHARS}), chr(10), '...[TRUNCATED]...') else text end"


def _assembled(spark, sf_dir, keep_chars=None):
    return assembly.assemble_texts(load(spark, sf_dir, "planned_text"), keep_chars)


@register("select ek, category, text, n_pages from $texts", texts=_TEXTS)
def text_assemble(spark, sf_dir):
    return _assembled(spark, sf_dir).select("ek", "category", "text", "n_pages")


@register(
    """
select t.ek, t.category, t.source_urls from $texts t
union all
select s_suppkey as ek, 'visa_policies' as category, concat('https://u', cast(s_suppkey as varchar), '.example.edu') as source_urls
from $supplier""",
    texts=_TEXTS,
)
def source_urls(spark, sf_dir):
    planned = _assembled(spark, sf_dir).select("ek", "category", "source_urls", F.lit("").alias("base_url"))
    unplanned = load(spark, sf_dir, "entity").select(
        "ek", F.lit("visa_policies").alias("category"), F.lit("").alias("source_urls"), "base_url"
    )
    merged = assembly.sources_or_base(F.col("source_urls"), F.col("base_url"))
    return planned.unionByName(unplanned).select("ek", "category", merged.alias("source_urls"))


@register(
    f"""
select 'page' as kind, doc_id as ek, {_CUT} as text from $documents
union all select 'plan' as kind, ek, {_CUT} as text from $texts""",
    texts=_TEXTS,
)
def text_truncate(spark, sf_dir):
    whole = load(spark, sf_dir, "documents").select(
        F.lit("page").alias("kind"), F.col("doc_id").alias("ek"),
        assembly.truncate_text(F.col("text")).alias("text"),
    )
    joined = _assembled(spark, sf_dir, MAX_CONTEXT_CHARS).select(
        F.lit("plan").alias("kind"), "ek", assembly.truncate_text(F.col("text")).alias("text")
    )
    return whole.unionByName(joined)


@register(
    f"""
select ek, category, concat('Category: ', category, chr(10), 'Sources: ', source_urls, chr(10), 'Text:', chr(10), {_CUT}) as user_message,
  0.1e0 as temperature, 'json_object' as response_format from $texts where trim(text) <> ''""",
    texts=_TEXTS,
)
def extract_requests(spark, sf_dir):
    return assembly.extraction_requests(_assembled(spark, sf_dir, MAX_CONTEXT_CHARS)).drop("system_message")


@register("select ek, category, concat('{\"chars\":', cast(length(text) as varchar), '}') as content from $cut where trim(text) <> ''",
          cut=f"select ek, category, source_urls, {_CUT} as text from $texts", texts=_TEXTS)
def extractor_plugin(spark, sf_dir):
    def measure(batches):
        for batch in batches:
            sizes = batch["user_message"].str.split("\nText:\n", n=1).str[1].str.len()
            content = '{"chars":' + sizes.astype(str) + "}"
            yield batch[["ek", "category"]].assign(content=content)

    requests = assembly.extraction_requests(_assembled(spark, sf_dir, MAX_CONTEXT_CHARS))
    return apply_extractor(requests, measure)


@register("select ek, category, '{}' as content from $texts where trim(text) <> ''", texts=_TEXTS)
def extractor_null(spark, sf_dir):
    requests = assembly.extraction_requests(_assembled(spark, sf_dir, MAX_CONTEXT_CHARS))
    return apply_extractor(requests, None)


@register(
    """
select ek, variant <> 4 as parsed,
  case variant when 4 then null when 7 then null when 8 then '5' when 2 then 'U' when 6 then 'U'
    else concat('U', cast(ek as varchar)) end as name,
  variant in (4, 7) as blank
from $answer"""
)
def response_parse(spark, sf_dir):
    parsed = responses.parse_response("about_content")
    return dealt(load(spark, sf_dir, "answer")).select("ek", parsed.alias("v")).select(
        "ek",
        F.col("v").isNotNull().alias("parsed"),
        F.try_variant_get("v", "$.name", "string").alias("name"),
        responses.is_blank_response("v").alias("blank"),
    )


# The outcome of each kind of answer, restated by kind.
_TYPED = """
select ek, 'about' as category,
  case when variant in (0, 1, 5) then 'loaded' when variant in (4, 7) then 'empty' else 'rejected' end as status,
  case when variant in (0, 1, 5) then concat('U', cast(ek as varchar)) end as name,
  case variant when 0 then cast(1000 + ek % 1000 as double) when 5 then 1900e0 end as amount,
  case variant when 0 then 'public' when 1 then 'private' when 5 then 'unknown' end as label
from $answer
union all
select ek, 'tuition_fees' as category,
  case when variant in (0, 4, 8) then 'loaded' when variant = 2 then 'empty' else 'rejected' end as status,
  case when variant in (0, 4, 8) then 'phd' end as name,
  case variant when 0 then cast(ek as double) + 12.5e0 when 4 then 1e0 when 8 then 0e0 end as amount,
  case variant when 0 then 'CAD,USD' when 4 then 'CAD' when 8 then 'CAD' end as label
from $answer"""


@register(_TYPED)
def response_typed(spark, sf_dir):
    answers = dealt(load(spark, sf_dir, "answer"))
    about = responses.load_responses(answers.select("ek", F.col("about_content").alias("content")), "about")
    tuition = responses.load_responses(
        answers.select("ek", F.col("tuition_content").alias("content")), "tuition_fees"
    )
    fee = F.aggregate(
        "value",
        F.lit(0.0),
        lambda total, x: total
        + F.coalesce(x["domestic_fee"], F.lit(0.0))
        + F.coalesce(x["international_fee"], F.lit(0.0)),
    )
    return about.select(
        "ek", F.lit("about").alias("category"), "status", "value.name",
        F.col("value.founding_year").cast("double").alias("amount"),
        F.col("value.institution_type").alias("label"),
    ).unionByName(
        tuition.select(
            "ek", F.lit("tuition_fees").alias("category"), "status",
            F.col("value")[0]["programme_level"].alias("name"),
            fee.alias("amount"),
            F.array_join(F.transform("value", lambda x: x["currency"]), ",").alias("label"),
        )
    )


_DEFAULTS = """
select ek, name as about_name, 'Unknown' as city, country, 'unknown' as institution_type, 'Unknown' as living_city,
  'USD' as currency, base_url as living_source, base_url as acceptance_source, base_url as employment_source,
  country as visa_country, 'Unknown' as visa_type, base_url as visa_source, 0 as n_requirements, 0 as n_items
from $entity"""


def _default_columns(data):
    items = F.lit(0)
    for name in LIST_CATEGORIES:
        items = items + F.size(data[name])
    about, living, visa = data["about"], data["living_costs"], data["visa_policies"]
    return [
        about["name"].alias("about_name"),
        about["location"]["city"].alias("city"),
        about["location"]["country"].alias("country"),
        about["institution_type"].alias("institution_type"),
        living["city"].alias("living_city"),
        living["currency"].alias("currency"),
        living["source_url"].alias("living_source"),
        data["acceptance_rate"]["source_url"].alias("acceptance_source"),
        data["graduate_employment"]["source_url"].alias("employment_source"),
        visa["country"].alias("visa_country"),
        visa["visa_type"].alias("visa_type"),
        visa["source_url"].alias("visa_source"),
        F.size(visa["key_requirements"]).alias("n_requirements"),
        items.alias("n_items"),
    ]


@register(_DEFAULTS)
def typed_default(spark, sf_dir):
    data = responses.default_data(F.col("name"), F.col("country"), F.col("base_url"))
    filled = load(spark, sf_dir, "entity").select("ek", data.alias("data"))
    return filled.select("ek", *_default_columns(F.col("data")))


_STUBS = "select ek, name as university_name, base_url, timestamp '2026-01-01' as scraped_at from $entity"


@register(
    """
select s.ek, s.university_name, s.scraped_at, f.field, 0.3e0 - 0.25e0 as confidence, 1 as n_flags
from $stubs s cross join (select unnest(['about', 'tuition_fees', 'living_costs', 'scholarships', 'acceptance_rate',
  'graduate_employment', 'average_salaries', 'visa_policies', 'intake_deadlines', 'course_listings']) as field) f""",
    stubs=_STUBS,
)
def stub_records(spark, sf_dir):
    built = records.stub_records(
        load(spark, sf_dir, "entity"), 2026, F.lit("2026-01-01").cast("timestamp_ntz")
    )
    cells = built.select("ek", "university_name", "scraped_at", "validation_flags", F.explode("field_confidence").alias("field", "confidence"))
    own = F.size(F.filter("validation_flags", lambda flag: flag["field"] == F.col("field")))
    return cells.select("ek", "university_name", "scraped_at", "field", "confidence", own.alias("n_flags"))


def _profiles_and_answers(spark, sf_dir):
    """One profile per order with the answers for two of its categories."""
    base = dealt(load(spark, sf_dir, "rec")).select("ek", "name", "country", "base_url")
    answers = dealt(load(spark, sf_dir, "answer"))
    long = answers.select("ek", F.lit("about").alias("category"), F.col("about_content").alias("content")).unionByName(
        answers.select("ek", F.lit("tuition_fees").alias("category"), F.col("tuition_content").alias("content"))
    )
    return base, long


_COMPILED = """
select r.ek, r.name as university_name, timestamp '2026-01-01' as scraped_at,
  case when t.variant in (0, 1, 5) then concat('U', cast(r.ek as varchar)) else r.name end as about_name,
  case t.variant when 0 then 'public' when 1 then 'private' else 'unknown' end as institution_type,
  case t.variant when 0 then 2 when 4 then 1 when 8 then 1 else 0 end as n_fees,
  r.base_url as living_source, 10 as n_scores
from $rec r join $answer t on t.ek = r.ek"""


@register(_COMPILED)
def record_compile(spark, sf_dir):
    base, answers = _profiles_and_answers(spark, sf_dir)
    built = records.finish_records(
        records.compile_data(base, answers), 2026, F.lit("2026-01-01").cast("timestamp_ntz")
    )
    return built.select(
        "ek", "university_name", "scraped_at",
        F.col("data.about.name").alias("about_name"),
        "data.about.institution_type",
        F.size("data.tuition_fees").alias("n_fees"),
        F.col("data.living_costs.source_url").alias("living_source"),
        F.size("field_confidence").alias("n_scores"),
    )


@register(
    """
select r.ek, r.name as university_name, r.ek % 7 = 0 as failed,
  case when r.ek % 7 <> 0 and t.variant in (0, 1, 5) then concat('U', cast(r.ek as varchar)) else r.name end as about_name,
  case when r.ek % 7 = 0 then 0 end as failed_confidence,
  case when r.ek % 7 = 0 then 'orchestrator/high' end as failed_flag
from $rec r join $answer t on t.ek = r.ek"""
)
def failed_entity_fallback(spark, sf_dir):
    base, answers = _profiles_and_answers(spark, sf_dir)
    built = records.finish_records(
        records.compile_data(base, answers), 2026, F.lit("2026-01-01").cast("timestamp")
    )
    errors = base.filter("ek % 7 = 0").select("ek", F.lit("boom").alias("error"))
    whole = records.isolate_failures(built, base, errors)
    failed = F.exists("validation_flags", lambda flag: flag["field"] == "orchestrator")
    total = F.aggregate(F.map_values("field_confidence"), F.lit(0.0), lambda a, x: a + x)
    first = F.col("validation_flags")[0]
    return whole.select(
        "ek", "university_name", failed.alias("failed"), F.col("data.about.name").alias("about_name"),
        F.when(failed, total).cast("int").alias("failed_confidence"),
        F.when(failed, F.concat(first["field"], F.lit("/"), first["severity"])).alias("failed_flag"),
    )
