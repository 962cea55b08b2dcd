"""Dates written in many ways, parsed without exceptions in the hot path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from profileloom.functions.text import UNICODE_SPACE

# Groups: year, month and day (dashed or plain), hour, minute, second, fraction,
# offset sign, offset hour, minute and second.
_ISO = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
    r"(?:([+-])(\d{2}):?(\d{2})?(?::?(\d{2}))?)?)?$"
)
_MONTH = (
    "(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|"
    "sep(tember)?|oct(ober)?|nov(ember)?|dec(ember)?)"
)
_MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"
_SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def bind(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for a value that is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _iso() -> str:
    clock = [f"if(m[{i}] = '', '00', m[{i}])" for i in (1, 2, 3)]
    local = (
        f"try_cast(concat(m[0], 'T', {clock[0]}, ':', {clock[1]}, ':', {clock[2]}, "
        "if(m[4] = '', '', concat('.', m[4]))) as timestamp_ntz)"
    )
    offset = [f"cast(concat('0', m[{i}]) as int)" for i in (6, 7, 8)]
    seconds = f"(({offset[0]} * 60 + {offset[1]}) * 60 + {offset[2]})"
    shifted = f"{local} - make_dt_interval(0, 0, 0, if(m[5] = '-', -{seconds}, {seconds}))"
    parts = (
        f"split(regexp_replace(replace(t, 'Z', '+00:00'), r'{_ISO}', "
        "'$1-$2$4-$3$5;$6;$7;$8;$9;$10;$11;$12;$13'), ';')"
    )
    return bind(parts, "m", f"if(m[5] = '', {local}, {shifted})")


def _named(month: int, day: int) -> str:
    number = f"(instr('{_MONTH_STARTS}', lower(left(w[{month}], 3))) + 2) div 3"
    date = f"try_cast(concat(w[2], '-', {number}, '-', w[{day}]) as date)"
    return bind("split(replace(t, ',', ''), ' ')", "w", f"cast({date} as timestamp_ntz)")


def parse_date_sql(text: str) -> str:
    """SQL of the first successful reading of a date text as ``timestamp_ntz`` (UTC).

    Tried in order: ISO 8601 calendar dates with optional time and offset;
    year-month-day; day/month/year; month/day/year; year/month/day; and the
    English month-name forms ``March 5, 2025`` and ``5 March 2025``, names full
    or abbreviated. Each form is guarded by its shape and then cast, so a text
    that is no date costs regex tests rather than a thrown exception.
    """

    def slashed(order: str) -> str:
        return f"try_cast(regexp_replace(t, r'{_SLASHED}', '{order}') as date)"

    forms = f"""case
        when replace(t, 'Z', '+00:00') rlike r'{_ISO}' then {_iso()}
        when t rlike r'^\\d{{4}}([-/])\\d{{1,2}}\\1\\d{{1,2}}$'
            then cast(try_cast(replace(t, '/', '-') as date) as timestamp_ntz)
        when t rlike r'{_SLASHED}'
            then cast(coalesce({slashed('$3-$2-$1')}, {slashed('$3-$1-$2')}) as timestamp_ntz)
        when t rlike r'(?i)^{_MONTH} \\d{{1,2}}, \\d{{4}}$' then {_named(0, 1)}
        when t rlike r'(?i)^\\d{{1,2}} {_MONTH} \\d{{4}}$' then {_named(1, 0)} end"""
    return bind(f"trim(regexp_replace({text}, r'{UNICODE_SPACE}', ' '))", "t", forms)


def parse_date(text: str) -> Column:
    """``parse_date_sql`` of a column or SQL expression."""
    return F.expr(parse_date_sql(text))
