"""Queries over validation rules, emptiness and confidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from profileloom.checks.inputs import dealt, load
from profileloom.checks.registry import register
from profileloom.fixed_values import CATEGORIES, LIST_CATEGORIES
from profileloom.functions.dates import parse_date
from profileloom.functions.numbers import is_close
from profileloom.operators import rules

AS_OF_YEAR = 2026
VIEW_OF = {
    "about": "about",
    "tuition_fees": "tuition",
    "living_costs": "living",
    "scholarships": "scholarship",
    "acceptance_rate": "acceptance",
    "graduate_employment": "employment",
    "average_salaries": "salary",
    "visa_policies": "visa",
    "intake_deadlines": "deadline",
    "course_listings": "course",
}

# ----------------------------------------------------- the oracle's own rules
_FORMATS = (
    "['%Y-%m-%d', '%Y%m%d', '%d/%m/%Y', '%m/%d/%Y', '%Y/%m/%d', "
    "'%B %d, %Y', '%d %B %Y', '%b %d, %Y', '%d %b %Y']"
)


def duck_date(text: str) -> str:
    return f"try_strptime(trim({text}), {_FORMATS})"


def _bad_date(name: str) -> str:
    return f"regexp_matches({name}, '[0-9]') and {duck_date(name)} is null"


_CURRENCY = "expected is not null and currency <> '' and upper(trim(currency)) <> expected"
# (rule, part, severity, condition) of every category.
DUCK_RULES = {
    "about": [
        ("R1", None, "medium", f"founding_year < 1000 or founding_year > {AS_OF_YEAR}"),
        ("R2", None, "low", "institution_type = 'unknown'"),
    ],
    "tuition_fees": [
        ("R3", None, "high", _CURRENCY),
        ("R4", None, "high", "domestic_fee < 0"),
        ("R5", None, "medium", "domestic_fee > 500000"),
        ("R6", None, "high", "international_fee < 0"),
        ("R7", None, "medium", "international_fee > 500000"),
        ("R8", None, "medium", "international_fee < domestic_fee"),
    ],
    "living_costs": [
        ("R9", None, "high", _CURRENCY),
        ("R10", "rent", "high", "monthly_rent < 0"),
        ("R10", "food", "high", "monthly_food < 0"),
        ("R10", "transport", "high", "monthly_transport < 0"),
        ("R11", None, "medium", "monthly_rent > 10000"),
    ],
    "scholarships": [("R12", None, "medium", _bad_date("application_deadline"))],
    "acceptance_rate": [
        (rule, pct, severity, test.replace("x", pct))
        for pct in ("overall_pct", "undergraduate_pct", "postgraduate_pct")
        for rule, severity, test in (("R13", "high", "x < 0 or x > 100"), ("R14", "low", "x in (0, 100)"))
    ],
    "graduate_employment": [
        ("R15", None, "high", "employed_within_6_months_pct < 0 or employed_within_6_months_pct > 100"),
        ("R16", None, "low", "employed_within_6_months_pct in (0, 100)"),
    ],
    "average_salaries": [
        ("R17", None, "high", _CURRENCY),
        ("R18", None, "high", "median_salary < 0"),
        ("R19", None, "medium", "median_salary > 500000"),
    ],
    "visa_policies": [
        ("R20", None, "medium", "visa_type in ('', 'Unknown')"),
        ("R21", None, "low", "n_requirements = 0"),
    ],
    "intake_deadlines": [
        ("R22", None, "medium", _bad_date("application_open_date")),
        ("R23", None, "medium", _bad_date("application_close_date")),
        ("R24", None, "medium", f"{duck_date('application_close_date')} < {duck_date('application_open_date')}"),
    ],
    "course_listings": [("R25", None, "low", "code = '' or title = ''")],
}
DUCK_EMPTY = {
    "about": "name in ('', 'Unknown') or (founding_year is null and institution_type = 'unknown' {ranking})",
    "living_costs": "coalesce(monthly_rent, monthly_food, monthly_transport) is null",
    "acceptance_rate": "coalesce(overall_pct, undergraduate_pct, postgraduate_pct) is null",
    "graduate_employment": "employed_within_6_months_pct is null",
    "visa_policies": "visa_type in ('', 'Unknown') and n_requirements = 0",
}


def duck_empty(field: str, nested: bool) -> str:
    ranking = "and overall_ranking is null" if nested else ""
    return DUCK_EMPTY[field].replace("{ranking}", ranking)


def duck_flags(field: str, view: str, nested: bool, only: set[str] | None = None) -> str:
    """SQL of the flags of a category from a view with ``ek, idx?, entity_country?``."""
    listed = field in LIST_CATEGORIES
    guard = "true" if listed else f"not coalesce({duck_empty(field, nested)}, false)"
    idx = "cast(t.idx as bigint)" if listed else "cast(null as bigint)"
    if nested:
        source = f"${view} t left join $country_currency c on c.country = t.entity_country"
    else:
        source = f"${view} t left join $entity e on e.ek = t.ek left join $country_currency c on c.country = e.country"
    parts = []
    for rule, part, severity, test in DUCK_RULES[field]:
        if only and rule not in only:
            continue
        label = f"'{part}'" if part else "cast(null as varchar)"
        test = test.replace("currency", "t.currency") if "expected" in test else test
        test = test.replace("name", "t.name") if field == "about" else test
        filter_ = guard.replace("name in", "t.name in")
        parts.append(
            f"select t.ek as ek, '{field}' as field, '{rule}' as rule_id, {label} as part, {idx} as idx, "
            f"'{severity}' as severity from {source} where ({filter_}) and ({test})"
        )
    return " union all ".join(parts)


def _missing(field: str, nested: bool) -> str:
    view = f"rec_{field}" if nested else VIEW_OF[field]
    owners = "$rec" if nested else "$entity"
    filled = f"select ek from ${view}"
    if field not in LIST_CATEGORIES:
        filled += f" where not coalesce({duck_empty(field, nested)}, false)"
    return f"select ek, '{field}' as field from {owners} where ek not in ({filled})"


def missing_sql(nested: bool = False) -> str:
    return " union all ".join(_missing(f, nested) for f in CATEGORIES)


def all_flags_sql(nested: bool = False) -> str:
    missing = (
        "select ek, field, 'N11' as rule_id, cast(null as varchar) as part, cast(null as bigint) as idx, "
        f"'medium' as severity from ({missing_sql(nested)}) m"
    )
    views = {f: f"rec_{f}" if nested else VIEW_OF[f] for f in CATEGORIES}
    return " union all ".join([missing, *[duck_flags(f, views[f], nested) for f in CATEGORIES]])


def confidence_sql(nested: bool = False) -> str:
    owners = "$rec" if nested else "$entity"
    cells = " union all ".join(f"select ek, '{f}' as field from {owners}" for f in CATEGORIES)
    lows = "coalesce(list_reduce(list_transform(range(n_low), lambda q: 0.1e0), lambda a, b: a + b, 0e0), 0e0)"
    return f"""
select ek, field, greatest(0e0, least(1e0,
    case when n_missing > 0 then 0.3e0 else 1e0 end - (0.5e0 * n_high + 0.25e0 * n_medium + {lows}))) as confidence,
  n_high, n_medium, n_low
from (
  select c.ek, c.field, count(*) filter (f.rule_id = 'N11') as n_missing,
    count(*) filter (f.severity = 'high') as n_high, count(*) filter (f.severity = 'medium') as n_medium,
    count(*) filter (f.severity = 'low') as n_low
  from ({cells}) c left join (
    select f.* from ({all_flags_sql(nested)}) f where f.ek in (select ek from {owners})) f
    on f.ek = c.ek and f.field = c.field group by c.ek, c.field) n"""


# ------------------------------------------------------------------ queries
_COLUMNS = ["ek", "field", "rule_id", "part", "idx", "severity"]


def _table(spark, sf_dir, field):
    return load(spark, sf_dir, VIEW_OF[field])


def _register_rule(name: str, field: str, ids: set[str]) -> None:
    def query(spark, sf_dir):
        rows = rules.flag_rows(
            field, _table(spark, sf_dir, field), AS_OF_YEAR, load(spark, sf_dir, "entity"), ids
        )
        return rows.select(*_COLUMNS)

    register(duck_flags(field, VIEW_OF[field], False, ids), name=name)(query)


for _name, _field, _ids in [
    ("rule_founding_year", "about", {"R1"}),
    ("rule_institution_type", "about", {"R2"}),
    ("rule_tuition_currency", "tuition_fees", {"R3"}),
    ("rule_domestic_fee", "tuition_fees", {"R4", "R5"}),
    ("rule_international_fee", "tuition_fees", {"R6", "R7"}),
    ("rule_fee_order", "tuition_fees", {"R8"}),
    ("rule_living_currency", "living_costs", {"R9"}),
    ("rule_living_negative", "living_costs", {"R10"}),
    ("rule_rent_ceiling", "living_costs", {"R11"}),
    ("rule_scholarship_deadline", "scholarships", {"R12"}),
    ("rule_acceptance_range", "acceptance_rate", {"R13"}),
    ("rule_acceptance_exact", "acceptance_rate", {"R14"}),
    ("rule_employment_range", "graduate_employment", {"R15", "R16"}),
    ("rule_salary_currency", "average_salaries", {"R17"}),
    ("rule_salary_range", "average_salaries", {"R18", "R19"}),
    ("rule_visa", "visa_policies", {"R20", "R21"}),
    ("rule_open_date", "intake_deadlines", {"R22"}),
    ("rule_close_date", "intake_deadlines", {"R23"}),
    ("rule_date_order", "intake_deadlines", {"R24"}),
    ("rule_course_identity", "course_listings", {"R25"}),
]:
    _register_rule(_name, _field, _ids)


def _register_empty(name: str, fields: list[str]) -> None:
    def query(spark, sf_dir):
        entities = load(spark, sf_dir, "entity")
        found = [
            rules.empty_entities(f, entities, _table(spark, sf_dir, f)).withColumn("field", F.lit(f))
            for f in fields
        ]
        result = found[0]
        for other in found[1:]:
            result = result.unionByName(other)
        return result

    register(" union all ".join(_missing(f, False) for f in fields), name=name)(query)


for _name, _fields in [
    ("empty_about", ["about"]),
    ("empty_lists", LIST_CATEGORIES),
    ("empty_living_costs", ["living_costs"]),
    ("empty_acceptance_rate", ["acceptance_rate"]),
    ("empty_graduate_employment", ["graduate_employment"]),
    ("empty_visa", ["visa_policies"]),
]:
    _register_empty(_name, _fields)


def _tables(spark, sf_dir):
    return {f: _table(spark, sf_dir, f) for f in CATEGORIES}


@register(missing_sql())
def missing_flags(spark, sf_dir):
    rows = rules.missing_flag_rows(load(spark, sf_dir, "entity"), _tables(spark, sf_dir))
    return rows.select("ek", "field")


@register("select e.ek, e.country, c.expected as currency from $entity e left join $country_currency c on c.country = e.country")
def expected_currency(spark, sf_dir):
    return load(spark, sf_dir, "entity").select(
        "ek", "country", rules.expected_currency(F.col("country")).alias("currency")
    )


@register(all_flags_sql())
def validation_flags(spark, sf_dir):
    rows = rules.all_flag_rows(load(spark, sf_dir, "entity"), _tables(spark, sf_dir), AS_OF_YEAR)
    return rows.select(*_COLUMNS)


@register(confidence_sql())
def field_confidence(spark, sf_dir):
    return rules.confidence_rows(load(spark, sf_dir, "entity"), _tables(spark, sf_dir), AS_OF_YEAR)


# What each form of "date_text" means, worked out from the date it was made of.
@register(
    """
select ek, date_text, d is not null as is_date, d as parsed from (
  select ek, date_text, case ek % 12
    when 7 then null when 8 then null when 9 then null when 11 then null
    when 10 then date_trunc('day', o_orderdate) + interval '10 hours 30 minutes'
    when 4 then make_timestamp(year(o_orderdate), 3, day(o_orderdate), 0, 0, 0)
    when 5 then case when day(o_orderdate) <= 30 then make_timestamp(year(o_orderdate), 9, day(o_orderdate), 0, 0, 0) end
    when 6 then case when day(o_orderdate) <= 12 then make_timestamp(year(o_orderdate), day(o_orderdate), 13, 0, 0, 0) end
    else date_trunc('day', o_orderdate) end as d
  from $date_text where ek % 12 <> 11
  union all
  select ek, date_text, case when day(o_orderdate) <= 12
    then make_timestamp(year(o_orderdate), day(o_orderdate), 13, 0, 0, 0) end as d
  from $date_text where ek % 12 = 11) x"""
)
def date_parse(spark, sf_dir):
    parsed = parse_date("date_text")
    return dealt(load(spark, sf_dir, "date_text")).select(
        "ek", "date_text", parsed.isNotNull().alias("is_date"), parsed.alias("parsed")
    )


@register(
    """
select o_orderkey as ek, coalesce(
    case when truth = 0 then value = 0 else abs(truth - value) <= 0.05e0 * abs(truth) end, false) as near,
  coalesce(truth = value, false) as equal
from (select o_orderkey,
    case when o_orderkey % 10 = 0 then 0e0 when o_orderkey % 11 = 0 then null else o_totalprice end as truth,
    case when o_orderkey % 20 = 0 then 0e0 when o_orderkey % 13 = 0 then null when o_orderkey % 3 = 0 then o_totalprice
      else o_totalprice * (1e0 + (o_orderkey % 20) / 150e0) end as value
  from $orders) x"""
)
def numeric_close(spark, sf_dir):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    truth = F.when(key % 10 == 0, 0.0).when(key % 11 == 0, None).otherwise(price)
    value = (
        F.when(key % 20 == 0, 0.0).when(key % 13 == 0, None).when(key % 3 == 0, price)
        .otherwise(price * (1.0 + (key % 20) / 150.0))
    )
    return load(spark, sf_dir, "orders").select(
        key.alias("ek"), is_close(truth, value, 0.05).alias("near"), is_close(truth, value).alias("equal")
    )
