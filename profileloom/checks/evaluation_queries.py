"""Queries over accuracy evaluation.

Truth is derived from the orders: most records match it in part, some records
are missing, some truths are sparse.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from profileloom.checks.inputs import run_sql
from profileloom.checks.record_queries import stored_records
from profileloom.checks.registry import register
from profileloom.checks.rule_queries import all_flags_sql
from profileloom.fixed_values import CATEGORIES
from profileloom.operators import evaluation
from profileloom.runtime import fresh_path
from profileloom.sources import records as record_io

# Fields of a truth row over the columns of "rec".
_YEAR = "case when ek % 5 = 0 then null when ek % 5 = 1 then cast(floor(price / 200) as bigint) else cast(1900 as bigint) end"
_TYPE = "case when ek % 4 = 0 then null when ek % 4 = 1 then 'Public' else 'private!' end"
_FEE = "price * 1.25e0 - 60000e0 + 1000e0 * j"
_FEE_CURRENCY = "case when ek % 2 = 0 then 'CAD' else 'usd' end"
_RATE = "case when ek % 3 = 0 then null else cast(cust % 120 as double) end"
_CODE = "case when ek % 6 = 0 then '' else concat('c', cast(ek + j as string)) end"
_TITLE = "concat('COURSE ', cast(j as string), case when ek % 2 = 0 then '' else ' extended' end)"
_HAS_RECORD = "ek % 9 <> 0"


def truth_rows(spark, sf_dir):
    """``university_name, data`` with a struct per compared category; null where truth is silent."""
    return run_sql(
        spark, sf_dir,
        f"""
select name as university_name, named_struct(
  'about', case when ek % 10 = 0 then null else named_struct('founding_year', {_YEAR}, 'institution_type', {_TYPE}) end,
  'tuition_fees', case when ek % 7 = 0 then null else
    transform(sequence(0, 1), j -> named_struct('international_fee', {_FEE}, 'currency', {_FEE_CURRENCY})) end,
  'acceptance_rate', case when ek % 8 = 0 then null else named_struct('overall_pct', {_RATE}) end,
  'course_listings', case when ek % 11 = 0 then null else
    transform(sequence(0, 1), j -> named_struct('code', {_CODE}, 'title', {_TITLE})) end) as data
from $rec""",
    )


def joined(spark, sf_dir):
    found = stored_records(spark, sf_dir).filter(_HAS_RECORD)
    return evaluation.join_truth(truth_rows(spark, sf_dir), found)


@register(
    f"""
select name as university_name, case when ek % 10 = 0 then null else {_YEAR} end as founding_year,
  case when ek % 10 = 0 then null else {_TYPE} end as institution_type,
  case when ek % 7 = 0 then null else cast(2 as int) end as n_fees,
  case when ek % 8 = 0 then null else {_RATE} end as overall_pct,
  case when ek % 11 = 0 then null else cast(2 as int) end as n_courses
from $rec"""
)
def truth_read(spark, sf_dir):
    """Ground truth stored as one object per line, all of it read again."""
    path = fresh_path(spark, "truth")
    truth_rows(spark, sf_dir).write.json(path)
    items = lambda name: F.when(F.col(f"data.{name}").isNotNull(), F.size(f"data.{name}"))
    return record_io.read_truth(spark, path, "jsonl").select(
        "university_name", "data.about.founding_year", "data.about.institution_type",
        items("tuition_fees").alias("n_fees"), "data.acceptance_rate.overall_pct", items("course_listings").alias("n_courses"),
    )


# ------------------------------------------------- the oracle, in long form
def _plain(text: str) -> str:
    return f"lower(regexp_replace(coalesce({text}, ''), '[^a-zA-Z0-9]', '', 'g'))"


def _inside(a: str, b: str) -> str:
    return f"({a} <> '' and {b} <> '' and (contains({a}, {b}) or contains({b}, {a})))"


_ABOUT = f"""
select r.ek, r.name as university_name,
  cast(coalesce(case when r.ek % 10 = 0 then false else ({_YEAR.replace('ek', 'r.ek').replace('price', 'r.price')}) = a.founding_year end, false) as int)
  + cast(coalesce(case when r.ek % 10 = 0 then false else {_plain(_TYPE.replace('ek', 'r.ek'))} <> ''
      and {_plain(_TYPE.replace('ek', 'r.ek'))} = a.institution_type end, false) as int) as correct,
  case when r.ek % 10 = 0 then 0 else cast(r.ek % 5 <> 0 as int) + cast(r.ek % 4 <> 0 as int) end as checked
from $rec r join $rec_about a on a.ek = r.ek"""
_TUITION = f"""
select t.ek, any_value(t.name) as university_name, cast(count(*) filter (hit) as int) as correct, cast(count(*) as int) as checked from (
  select x.ek, x.name, x.j, exists (select 1 from $rec_tuition_fees f where f.ek = x.ek
    and {_plain('f.currency')} = {_plain('x.cur')}
    and case when x.fee = 0 then f.international_fee = 0 else abs(x.fee - f.international_fee) / abs(x.fee) <= 0.05e0 end) as hit
  from (select ek, name, j, {_FEE} as fee, {_FEE_CURRENCY} as cur from (select *, unnest([0, 1]) as j from $rec) q where ek % 7 <> 0) x) t
group by t.ek"""
_ACCEPTANCE = f"""
select r.ek, r.name as university_name,
  cast(coalesce(r.ek % 8 <> 0 and ({_RATE.replace('ek', 'r.ek').replace('cust', 'r.cust')}) = a.overall_pct, false) as int) as correct,
  case when r.ek % 8 = 0 or r.ek % 3 = 0 then 0 else 1 end as checked
from $rec r join $rec_acceptance_rate a on a.ek = r.ek"""
_COURSES = f"""
select t.ek, any_value(t.name) as university_name, cast(count(*) filter (hit) as int) as correct, cast(count(*) as int) as checked from (
  select x.ek, x.name, x.j, exists (select 1 from $rec_course_listings f where f.ek = x.ek
    and {_inside(_plain('f.code'), _plain('x.code'))} and {_inside(_plain('f.title'), _plain('x.title'))}) as hit
  from (select ek, name, j, {_CODE} as code, {_TITLE} as title from (select *, unnest([0, 1]) as j from $rec) q where ek % 11 <> 0) x) t
group by t.ek"""
_VIEWS = {"s_about": _ABOUT, "s_tuition": _TUITION, "s_acceptance": _ACCEPTANCE, "s_courses": _COURSES}
_SCORED = {
    "about": "s_about", "tuition_fees": "s_tuition",
    "acceptance_rate": "s_acceptance", "course_listings": "s_courses",
}
_SCORES = " union all ".join(
    f"select '{c}' as category, r.name as university_name, coalesce(s.correct, 0) as correct, coalesce(s.checked, 0) as checked "
    f"from $rec r left join ${_SCORED[c]} s on s.ek = r.ek where r.ek % 9 <> 0"
    if c in _SCORED
    else f"select '{c}' as category, r.name as university_name, 0 as correct, 0 as checked from $rec r where r.ek % 9 <> 0"
    for c in CATEGORIES
)
_VIEWS["scores"] = _SCORES


@register(
    f"""
select name as university_name, not ({_HAS_RECORD}) as record_missing,
  case when {_HAS_RECORD} then n_tuition end as n_found from $rec"""
)
def eval_join(spark, sf_dir):
    return joined(spark, sf_dir).select(
        "university_name", "record_missing", F.when(~F.col("record_missing"), F.size("found.tuition_fees")).alias("n_found")
    )


def _register_score(name: str, category: str) -> None:
    def query(spark, sf_dir):
        pairs = joined(spark, sf_dir).filter("not record_missing")
        score = evaluation.category_score(category, F.col("truth")[category], F.col("found")[category])
        return pairs.select("university_name", score.alias("s")).select("university_name", "s.correct", "s.checked")

    sql = f"select university_name, correct, checked from $scores where category = '{category}'"
    register(sql, name=name, **_VIEWS)(query)


for _name, _category in [
    ("eval_about", "about"),
    ("eval_tuition", "tuition_fees"),
    ("eval_acceptance", "acceptance_rate"),
    ("eval_courses", "course_listings"),
]:
    _register_score(_name, _category)

_PERCENT = "case when sum(checked) > 0 then round(sum(correct) * 100e0 / sum(checked), 1) end"


@register(
    f"""
select category, university_name, cast(grouping(category) as int) as all_categories,
  cast(grouping(university_name) as int) as all_entities, cast(sum(correct) as bigint) as correct,
  cast(sum(checked) as bigint) as checked, {_PERCENT} as percent
from $scores group by cube (category, university_name)""",
    **_VIEWS,
)
def eval_accuracy_cube(spark, sf_dir):
    return evaluation.accuracy_cube(evaluation.score_rows(joined(spark, sf_dir)))


@register(
    "select university_name, "
    + ", ".join(
        f"max(case when category = '{c}' and checked > 0 then round(correct * 100e0 / checked, 1) end) as {c}"
        for c in CATEGORIES
    )
    + " from $scores group by university_name",
    **_VIEWS,
)
def eval_accuracy_pivot(spark, sf_dir):
    return evaluation.accuracy_matrix(evaluation.score_rows(joined(spark, sf_dir)))


# The report's layout: a row for each category, a column for each entity it names.
_REPORTED = [f"Entity {k}" for k in (1, 2, 3, 5, 8)]


@register(
    "select category, "
    + ", ".join(
        f"max(case when university_name = '{n}' and checked > 0 then round(correct * 100e0 / checked, 1) end) as \"{n}\"" for n in _REPORTED
    )
    + " from $scores group by category",
    **_VIEWS,
)
def eval_accuracy_report(spark, sf_dir):
    return evaluation.accuracy_matrix(evaluation.score_rows(joined(spark, sf_dir)), _REPORTED)


@register(
    f"""
select r.name as university_name, count(*) filter (f.severity = 'high') as high,
  count(*) filter (f.severity = 'medium') as medium, count(*) filter (f.severity = 'low') as low
from $rec r left join $flags f on f.ek = r.ek and r.{_HAS_RECORD} group by r.name""",
    flags=all_flags_sql(nested=True),
)
def eval_flag_counts(spark, sf_dir):
    return evaluation.flag_counts(joined(spark, sf_dir))


@register(
    """
select r.name as university_name, c.category from $rec r
cross join (select distinct category from $scores) c
where not exists (select 1 from $scores s where s.university_name = r.name and s.category = c.category and s.checked > 0)""",
    **_VIEWS,
)
def eval_known_gaps(spark, sf_dir):
    return evaluation.known_gaps(joined(spark, sf_dir))
