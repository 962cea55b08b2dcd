"""Validation rules and confidence, declared once and run in two layouts.

*Nested*: a record row holds its ten categories; flags and scores come from
higher-order functions inside the row, with no shuffle at all.

*Long*: each category is a table of its own keyed by ``ek``; flags are a narrow
projection of each table, and scores come from counts that are aggregated on
the map side first, so one entity may own any share of the items.

Rules are SQL conditions in which ``{name}`` is a field of the category or of
the item, ``{expected}`` the expected currency and ``{year}`` the current year.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.fixed_values import (
    AMOUNT_CEILING,
    BASE_CONFIDENCE,
    CATEGORIES,
    COUNTRY_CURRENCIES,
    EARLIEST_FOUNDING_YEAR,
    EMPTY_CONFIDENCE,
    LIST_CATEGORIES,
    MISSING_ISSUE,
    RENT_CEILING,
    SEVERITIES,
    SEVERITY_PENALTY,
    UNKNOWN_NAME,
    UNKNOWN_TYPE,
)
from profileloom.functions.arrays import unroll
from profileloom.functions.dates import parse_date_sql
from profileloom.functions.numbers import clamp_unit
from profileloom.schemas import FLAG_TYPE

MISSING_RULE = "N11"
#: Items of a list, and flags of a category, that compiled code looks at; a lambda has the others.
UNROLLED = 4
_NO_FLAGS = f"cast(array() as array<{FLAG_TYPE.simpleString()}>)"
Names = Callable[[str], str]


class Rule(NamedTuple):
    """One declared check of a category value or list item."""

    rule_id: str
    field: str
    severity: str
    test: str
    issue: str
    part: str | None = None


def expected_currency(country: Column) -> Column:
    """Currency expected in a country; null for countries without one."""
    pairs = ", ".join(f"'{name}', '{code}'" for name, code in COUNTRY_CURRENCIES.items())
    return F.try_element_at(F.expr(f"map({pairs})"), country)


_WRONG_CURRENCY = "{expected} is not null and {currency} <> '' and upper(trim({currency})) <> {expected}"


def _currency_rule(rule_id: str, field: str) -> Rule:
    issue = "concat('currency ', {currency}, ' differs from ', {expected})"
    return Rule(rule_id, field, "high", _WRONG_CURRENCY, issue)


def _value_rule(rule_id, field, severity, name, test, words, part=None) -> Rule:
    issue = f"concat('{name} {words}: ', cast({{{name}}} as string))"
    return Rule(rule_id, field, severity, test.replace("x", f"{{{name}}}"), issue, part)


def _negative(rule_id: str, field: str, name: str, part: str | None = None) -> Rule:
    return _value_rule(rule_id, field, "high", name, "x < 0", "is negative", part)


def _above(rule_id: str, field: str, name: str, ceiling: int) -> Rule:
    return _value_rule(rule_id, field, "medium", name, f"x > {ceiling}", f"is above {ceiling}")


def _no_percent(rule_id: str, field: str, name: str, part: str | None = None) -> Rule:
    return _value_rule(rule_id, field, "high", name, "x < 0 or x > 100", "is not a percentage", part)


def _round_percent(rule_id: str, field: str, name: str, part: str | None = None) -> Rule:
    return _value_rule(rule_id, field, "low", name, "x in (0, 100)", "is suspiciously round", part)


def _bad_date(rule_id: str, field: str, name: str, parsed: str) -> Rule:
    test = f"{{{name}}} rlike r'\\p{{{{Nd}}}}' and {{{parsed}}} is null"
    return Rule(rule_id, field, "medium", test, f"concat('{name} is not a date: ', {{{name}}})")


_PERCENTS = ["overall_pct", "undergraduate_pct", "postgraduate_pct"]
_COSTS = ["rent", "food", "transport"]
_BLANK_VISA = f"coalesce({{visa_type}}, '') in ('', '{UNKNOWN_NAME}')"
_NO_REQUIREMENTS = "coalesce({n_requirements}, 0) <= 0"

# Values that rules use more than once, worked out once per item.
DERIVED = {
    "scholarships": {"deadline_at": "application_deadline"},
    "intake_deadlines": {"open_at": "application_open_date", "close_at": "application_close_date"},
}

RULES: list[Rule] = [
    Rule(
        "R1", "about", "medium",
        f"not ({{founding_year}} between {EARLIEST_FOUNDING_YEAR} and {{year}})",
        "concat('implausible founding year: ', cast({founding_year} as string))",
    ),
    Rule("R2", "about", "low", f"{{institution_type}} = '{UNKNOWN_TYPE}'", "'institution type is unknown'"),
    _currency_rule("R3", "tuition_fees"),
    _negative("R4", "tuition_fees", "domestic_fee"),
    _above("R5", "tuition_fees", "domestic_fee", AMOUNT_CEILING),
    _negative("R6", "tuition_fees", "international_fee"),
    _above("R7", "tuition_fees", "international_fee", AMOUNT_CEILING),
    Rule(
        "R8", "tuition_fees", "medium", "{international_fee} < {domestic_fee}",
        "concat('international fee ', cast({international_fee} as string), "
        "' is below domestic fee ', cast({domestic_fee} as string))",
    ),
    _currency_rule("R9", "living_costs"),
    *[_negative("R10", "living_costs", f"monthly_{cost}", cost) for cost in _COSTS],
    _above("R11", "living_costs", "monthly_rent", RENT_CEILING),
    _bad_date("R12", "scholarships", "application_deadline", "deadline_at"),
    *[
        rule
        for name in _PERCENTS
        for rule in (
            _no_percent("R13", "acceptance_rate", name, name),
            _round_percent("R14", "acceptance_rate", name, name),
        )
    ],
    _no_percent("R15", "graduate_employment", "employed_within_6_months_pct"),
    _round_percent("R16", "graduate_employment", "employed_within_6_months_pct"),
    _currency_rule("R17", "average_salaries"),
    _negative("R18", "average_salaries", "median_salary"),
    _above("R19", "average_salaries", "median_salary", AMOUNT_CEILING),
    Rule("R20", "visa_policies", "medium", _BLANK_VISA, "'visa type is missing'"),
    Rule("R21", "visa_policies", "low", _NO_REQUIREMENTS, "'no key requirements'"),
    _bad_date("R22", "intake_deadlines", "application_open_date", "open_at"),
    _bad_date("R23", "intake_deadlines", "application_close_date", "close_at"),
    Rule(
        "R24", "intake_deadlines", "medium", "{close_at} < {open_at}",
        "concat('closes ', {application_close_date}, ' before it opens ', {application_open_date})",
    ),
    Rule(
        "R25", "course_listings", "low", "coalesce({code}, '') = '' or coalesce({title}, '') = ''",
        "concat('code or title is missing: ', coalesce({code}, ''), ' / ', coalesce({title}, ''))",
    ),
]
CURRENCY_RULES = {"R3", "R9", "R17"}

# When a single-valued category holds nothing worth keeping. Lists are empty
# when they have no items.
EMPTY_TESTS = {
    "about": (
        f"coalesce({{name}}, '') in ('', '{UNKNOWN_NAME}') or ({{founding_year}} is null "
        f"and {{overall_ranking}} is null and coalesce({{institution_type}} = '{UNKNOWN_TYPE}', true))"
    ),
    "living_costs": "coalesce({monthly_rent}, {monthly_food}, {monthly_transport}) is null",
    "acceptance_rate": "coalesce({overall_pct}, {undergraduate_pct}, {postgraduate_pct}) is null",
    "graduate_employment": "{employed_within_6_months_pct} is null",
    "visa_policies": f"{_BLANK_VISA} and {_NO_REQUIREMENTS}",
}


class _Filled(dict):
    def __init__(self, names: Names):
        super().__init__()
        self._names = names

    def __missing__(self, key: str) -> str:
        return self._names(key)


def _fill(template: str, names: Names, expected: str = "null", year: int = 0) -> str:
    values = _Filled(names)
    values.update(expected=expected, year=year)
    return template.format_map(values)


def rules_of(field: str, rule_ids: Iterable[str] | None = None) -> list[Rule]:
    """Declared rules of a category, in order, optionally only some ids."""
    return [r for r in RULES if r.field == field and (rule_ids is None or r.rule_id in rule_ids)]


# ---------------------------------------------------------------- nested layout


def _nested_names(item: str, derived: dict[str, str]) -> Names:
    """Fields of ``item``, and the SQL of its derived values."""

    def path(name: str) -> str:
        if name == "n_requirements":
            return f"size({item}.key_requirements)"
        return derived.get(name) or f"{item}.{name}"

    return path


def _empty_sql(field: str, value: str) -> str:
    if field in LIST_CATEGORIES:
        return f"coalesce(size({value}), 0) <= 0"
    test = _fill(EMPTY_TESTS[field], lambda name: (
        f"size({value}.key_requirements)" if name == "n_requirements" else f"{value}.{name}"
    ))
    return f"({value} is null or {test})"


def _flag_sql(field: str, rule_id: str, idx: str, issue: str, severity: str) -> str:
    return (
        f"named_struct('field', '{field}', 'rule_id', '{rule_id}', 'idx', cast({idx} as bigint), "
        f"'issue', {issue}, 'severity', '{severity}')"
    )


def _derived_sql(field: str, value: str) -> dict[str, str]:
    """SQL of arrays with the derived values of a category's items, by column name."""
    return {
        f"_{field}_{name}": f"transform({value}, x -> {parse_date_sql(f'x.{source}')})"
        for name, source in DERIVED.get(field, {}).items()
    }


def category_flags_sql(field: str, value: str, expected: str, year: int) -> str:
    """SQL of the flags of one non-empty nested category, in item then rule order.

    Spark compiles what stands outside lambdas only, so the rules are spelled out for a value and
    for the first ``UNROLLED`` items of a list; a lambda looks at the others. Columns named as by
    ``_derived_sql`` hold the derived values.
    """

    def check(item: str, at: str, idx: str) -> str:
        names = _nested_names(item, {k: f"get(_{field}_{k}, {at})" for k in DERIVED.get(field, {})})
        found = ", ".join(
            f"if({_fill(r.test, names, expected, year)}, "
            f"array({_flag_sql(field, r.rule_id, idx, _fill(r.issue, names, expected, year), r.severity)}), {_NO_FLAGS})"
            for r in rules_of(field)
        )
        return f"concat({found})"

    if field not in LIST_CATEGORIES:
        return check(value, "null", "null")
    first = [f"if(size({value}) > {n}, {check(f'get({value}, {n})', str(n), str(n))}, {_NO_FLAGS})" for n in range(UNROLLED)]
    at = f"(i + {UNROLLED})"
    others = f"flatten(transform(slice({value}, {UNROLLED + 1}, size({value})), (x, i) -> {check('x', at, at)}))"
    return f"concat({', '.join(first)}, if(size({value}) > {UNROLLED}, {others}, {_NO_FLAGS}))"


def _score_sql(flags: str, empty: str) -> str:
    """SQL of a confidence: base minus penalties taken in flag order, within [0, 1]."""
    weights = " ".join(f"when '{s}' then {SEVERITY_PENALTY[s]!r}D" for s in SEVERITIES)
    first = " + ".join(f"case get({flags}, {n}).severity {weights} else 0D end" for n in range(UNROLLED))
    others = f"slice({flags}, {UNROLLED + 1}, size({flags}))"
    longer = f"aggregate({others}, {first}, (total, flag) -> total + case flag.severity {weights} else 0D end)"
    penalty = f"case when size({flags}) = 0 then 0D when size({flags}) <= {UNROLLED} then {first} else {longer} end"
    missing = f"greatest(0D, least(1D, {EMPTY_CONFIDENCE!r}D - {SEVERITY_PENALTY['medium']!r}D))"
    return f"if({empty}, {missing}, greatest(0D, least(1D, {BASE_CONFIDENCE!r}D - {penalty})))"


def validate_records(
    records: DataFrame, as_of_year: int, country: str = "country", data: str = "data"
) -> DataFrame:
    """Adds ``validation_flags`` and ``field_confidence`` to nested records.

    Missing flags come first, in category order, then each category's own.
    A narrow projection: nothing is shuffled, and each category's flags are
    computed once and used for both outputs.
    """
    missing = {
        f: _flag_sql(f, MISSING_RULE, "null", f"'{MISSING_ISSUE}'", "medium") for f in CATEGORIES
    }
    derived = [f"{v} as {k}" for f in CATEGORIES for k, v in _derived_sql(f, f"{data}.{f}").items()]
    known = records.withColumn("_currency", expected_currency(F.col(country))).selectExpr("*", *derived)
    checked = known.selectExpr(
        *[f"`{name}`" for name in records.columns],
        *[
            f"""if({_empty_sql(f, f'{data}.{f}')}, named_struct('empty', true, 'flags', {_NO_FLAGS}),
                named_struct('empty', false, 'flags',
                    {category_flags_sql(f, f'{data}.{f}', '_currency', as_of_year)})) as _{f}"""
            for f in CATEGORIES
        ],
    )
    absent = ", ".join(f"if(_{f}.empty, array({missing[f]}), {_NO_FLAGS})" for f in CATEGORIES)
    own = ", ".join(f"_{f}.flags" for f in CATEGORIES)
    scores = ", ".join(f"'{f}', {_score_sql(f'_{f}.flags', f'_{f}.empty')}" for f in CATEGORIES)
    return checked.selectExpr(
        *records.columns,
        f"concat({absent}, {own}) as validation_flags",
        f"map({scores}) as field_confidence",
    )


# ------------------------------------------------------------------ long layout


def _column_names(items: DataFrame) -> Names:
    present = set(items.columns)
    return lambda name: f"`{name}`" if name in present else "null"


def attach_currency(items: DataFrame, entities: DataFrame) -> DataFrame:
    """Adds the expected currency of each item's entity (``entities(ek, country)``)."""
    known = entities.select("ek", expected_currency(F.col("country")).alias("expected_currency"))
    return items.join(known, "ek", "left")


def non_empty(field: str, items: DataFrame) -> DataFrame:
    """Rows of a category table that rules apply to; items of lists always do."""
    if field in LIST_CATEGORIES:
        return items
    return items.filter(f"not ({_fill(EMPTY_TESTS[field], _column_names(items))})")


def with_derived(field: str, items: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds the derived values that the given rules read."""
    used = " ".join(r.test for r in rules)
    wanted = {k: v for k, v in DERIVED.get(field, {}).items() if f"{{{k}}}" in used}
    return items.selectExpr("*", *[f"{parse_date_sql(v)} as {k}" for k, v in wanted.items()])


def flag_rows(
    field: str,
    items: DataFrame,
    as_of_year: int,
    entities: DataFrame | None = None,
    rule_ids: Iterable[str] | None = None,
) -> DataFrame:
    """Flags ``(ek, field, rule_id, part, idx, severity, issue)`` of a category table.

    ``items(ek, idx?, ...)``; ``entities`` is needed only for currency rules.
    """
    rules = rules_of(field, rule_ids)
    rows = non_empty(field, items)
    expected = "null"
    if CURRENCY_RULES & {r.rule_id for r in rules}:
        rows = attach_currency(rows, entities)
        expected = "expected_currency"
    rows = with_derived(field, rows, rules)
    names = _column_names(rows)
    flags = ", ".join(
        f"case when {_fill(r.test, names, expected, as_of_year)} then named_struct("
        f"'rule_id', '{r.rule_id}', 'part', {_part_sql(r.part)}, 'severity', '{r.severity}', "
        f"'issue', {_fill(r.issue, names, expected, as_of_year)}) end"
        for r in rules
    )
    found = F.expr(f"array_compact(array({flags}))")
    idx = F.expr(f"cast({names('idx')} as bigint)").alias("idx")
    return unroll(rows, found, "flag", "ek", F.lit(field).alias("field"), idx).select(
        "ek", "field", "flag.rule_id", "flag.part", "idx", "flag.severity", "flag.issue"
    )


def _part_sql(part: str | None) -> str:
    """SQL of the part of a category a rule looks at."""
    return f"'{part}'" if part else "cast(null as string)"


def empty_entities(field: str, entities: DataFrame, table: DataFrame) -> DataFrame:
    """Keys of the entities whose category is empty.

    For lists only the distinct keys of the items travel, reduced on the map
    side, so an entity with very many items costs one row per task.
    """
    filled = non_empty(field, table).select("ek").distinct()
    return entities.select("ek").join(filled, "ek", "left_anti")


def missing_flag_rows(entities: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One medium flag per (entity, empty category)."""
    filled = reduce(
        DataFrame.unionByName,
        [non_empty(f, t).select("ek", F.lit(f).alias("field")) for f, t in tables.items()],
    ).distinct()
    cells = entities.select("ek", F.explode(F.array(*map(F.lit, tables))).alias("field"))
    return cells.join(filled, ["ek", "field"], "left_anti").selectExpr(
        "ek",
        "field",
        f"'{MISSING_RULE}' as rule_id",
        "cast(null as string) as part",
        "cast(null as bigint) as idx",
        "'medium' as severity",
        f"'{MISSING_ISSUE}' as issue",
    )


def all_flag_rows(entities: DataFrame, tables: dict[str, DataFrame], as_of_year: int) -> DataFrame:
    """Every flag of every entity: missing categories and all rules."""
    parts = [missing_flag_rows(entities, tables)]
    parts += [flag_rows(f, t, as_of_year, entities) for f, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _severity_counts(field: str, items: DataFrame, as_of_year: int) -> DataFrame:
    """Per (ek, currency) counts of items and of non-currency flags by severity.

    Currency rules need the entity's country. Counting items per currency first
    moves that join behind the aggregation, so item rows are never joined.
    """
    rules = [r for r in rules_of(field) if r.rule_id not in CURRENCY_RULES]
    priced = len(rules) < len(rules_of(field))
    rows = with_derived(field, non_empty(field, items), rules)
    names = _column_names(rows)

    def hits(severity: str) -> str:
        tests = [_fill(r.test, names, year=as_of_year) for r in rules if r.severity == severity]
        return " + ".join(f"cast(coalesce({t}, false) as bigint)" for t in tests) or "0L"

    currency = f"upper(trim(nullif({names('currency')}, '')))" if priced else "null"
    return (
        rows.selectExpr(
            "ek",
            f"'{field}' as field",
            f"cast({currency} as string) as currency",
            *[f"{hits(s)} as {s}" for s in SEVERITIES],
        )
        .groupBy("ek", "field", "currency")
        .agg(F.count(F.lit(1)).alias("n_items"), *[F.sum(s).alias(s) for s in SEVERITIES])
    )


def score_from_counts(high: Column, medium: Column, low: Column, empty: Column) -> Column:
    """Confidence from flag counts.

    Penalties of a half and a quarter add up exactly in any order. Low ones are
    added one at a time, as a scan over flags would; more than eleven cannot
    change the clamped result.
    """
    lows = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.least(low, F.lit(11)), F.lit(1)).cast("int")),
        F.lit(0.0),
        lambda total, _: total + SEVERITY_PENALTY["low"],
    )
    penalty = (
        high * F.lit(SEVERITY_PENALTY["high"])
        + medium * F.lit(SEVERITY_PENALTY["medium"])
        + F.when(low > 0, lows).otherwise(0.0)
    )
    missing = F.lit(EMPTY_CONFIDENCE - SEVERITY_PENALTY["medium"])
    return F.when(empty, missing).otherwise(clamp_unit(F.lit(BASE_CONFIDENCE) - penalty))


def confidence_rows(entities: DataFrame, tables: dict[str, DataFrame], as_of_year: int) -> DataFrame:
    """Confidence and flag counts of every (entity, category).

    Each table is reduced to counts on the map side before anything is
    shuffled; the reduced counts of all ten then meet the entities in one join.
    """
    counts = reduce(
        DataFrame.unionByName, [_severity_counts(f, t, as_of_year) for f, t in tables.items()]
    )
    known = entities.select("ek", expected_currency(F.col("country")).alias("expected_currency"))
    wrong = F.expr("coalesce(currency <> expected_currency, false)")
    per_field = (
        counts.join(known, "ek", "left")
        .withColumn("high", F.col("high") + F.when(wrong, F.col("n_items")).otherwise(0))
        .groupBy("ek", "field")
        .agg(*[F.sum(s).alias(s) for s in SEVERITIES], F.sum("n_items").alias("n_items"))
    )
    cells = entities.select("ek", F.explode(F.array(*map(F.lit, tables))).alias("field"))
    joined = cells.join(per_field, ["ek", "field"], "left")
    empty = F.col("n_items").isNull()
    n = {s: F.coalesce(F.col(s), F.lit(0)) for s in SEVERITIES}
    return joined.select(
        "ek",
        "field",
        score_from_counts(n["high"], n["medium"], n["low"], empty).alias("confidence"),
        n["high"].alias("n_high"),
        F.when(empty, 1).otherwise(n["medium"]).cast("bigint").alias("n_medium"),
        n["low"].alias("n_low"),
    )
