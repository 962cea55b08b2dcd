"""Extraction answers: parsing, typed loading, typed defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profileloom.fixed_values import (
    CATEGORIES,
    DEFAULT_CURRENCY,
    SEVERITIES,
    UNKNOWN_NAME,
    UNKNOWN_TYPE,
)
from profileloom.functions.arrays import computed
from profileloom.functions.dates import bind, parse_date_sql
from profileloom.functions.text import UNICODE_SPACE
from profileloom.schemas import (
    CATEGORY_KINDS,
    CATEGORY_TYPES,
    DOUBLE,
    FLAG_TYPE,
    STRING,
    Field,
    ListOf,
    Shape,
    spark_type,
)

_NUMBER_TEXT = r"(?i)^[+-]?((\d+(_\d+)*\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"
_INTEGER_TEXT = r"^[+-]?\d+(_\d+)*(\.0*)?$"
_NUMBER_KINDS = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
_JSON_START = r'^[-0-9\[{"tfn]'


def _strip(text: str) -> str:
    return f"regexp_replace({text}, r'^{UNICODE_SPACE}|{UNICODE_SPACE}$', '')"


def parse_response_sql(content: str) -> str:
    """SQL of an answer text as a VARIANT; null when it is not JSON.

    Tried as it stands, then without the first and last line of a code fence.
    """
    opened = r"regexp_replace(t, r'^```[^\r\n]*(\r\n|\r|\n|$)', '')"
    inner = rf"regexp_replace({opened}, r'(^|\r\n|\r|\n)```[^\r\n]*$', '')"
    # Only what may begin a JSON text is parsed: a refusal costs an exception.
    plain = rf"if(t rlike r'{_JSON_START}', try_parse_json(t), null)"
    return bind(_strip(content), "t", f"if(startswith(t, '```'), try_parse_json({_strip(inner)}), {plain})")


def parse_response(content: str) -> Column:
    """``parse_response_sql`` of a column or SQL expression."""
    return F.expr(parse_response_sql(content))


def _result(ok: str, value: str) -> str:
    return f"named_struct('ok', coalesce({ok}, false), 'value', {value})"


_TEXT_OF_VARIANT = "try_variant_get(b.v, '$', 'string')"
# How a bound VARIANT ``b.v`` of kind ``b.kind`` reads as a scalar.
_SCALAR_SQL = {
    "string": f"if(b.kind = 'STRING', {_TEXT_OF_VARIANT}, null)",
    "double": f"""case
        when b.kind rlike '{_NUMBER_KINDS}' then try_variant_get(b.v, '$', 'double')
        when b.kind = 'BOOLEAN' then cast(try_variant_get(b.v, '$', 'boolean') as double)
        when b.kind = 'STRING' then {bind(_strip(_TEXT_OF_VARIANT), "t",
            f"if(t rlike r'{_NUMBER_TEXT}', try_cast(replace(t, '_', '') as double), null)")}
        end""",
    "bigint": f"""case
        when b.kind = 'BIGINT' then try_variant_get(b.v, '$', 'bigint')
        when b.kind rlike '{_NUMBER_KINDS}' then {bind("try_variant_get(b.v, '$', 'double')", "n",
            "if(n = floor(n), try_cast(n as bigint), null)")}
        when b.kind = 'BOOLEAN' then cast(try_variant_get(b.v, '$', 'boolean') as bigint)
        when b.kind = 'STRING' then {bind(_strip(_TEXT_OF_VARIANT), "t",
            f"if(t rlike r'{_INTEGER_TEXT}', try_cast(replace(substring_index(t, '.', 1), '_', '') as bigint), null)")}
        end""",
    # The reading is in UTC, whatever the session's time zone.
    "timestamp": (
        f"if(b.kind = 'STRING', try_cast(concat(cast({parse_date_sql(_TEXT_OF_VARIANT)} as string), 'Z') "
        "as timestamp), null)"
    ),
}


def read_sql(value: str, field: Field, depth: int = 0) -> str:
    """SQL of the struct ``(ok, value)`` of a VARIANT read as a declared field.

    Each level binds what it looks at to a name, so nothing is evaluated twice.
    A value that is no list yields no items, and one that is no object yields no
    fields and so lacks a required one; neither needs a look at its kind.
    """
    declared, name = field.kind, f"p{depth}"
    if isinstance(declared, ListOf):
        item = read_sql(f"x{depth}", Field("item", declared.kind, True), depth + 1)
        parts = f"transform(try_variant_get({value}, '$', 'array<variant>'), x{depth} -> {item})"
        ok = f"{name} is not null and forall({name}, y -> y.ok)"
        return _unless_absent(value, field, bind(parts, name, _result(ok, f"transform({name}, y -> y.value)")))
    if isinstance(declared, Shape):
        parts = ", ".join(f"'{f.name}', {_inner_sql(value, f, depth + 1)}" for f in declared.fields)
        ok = " and ".join(f"{name}.{f.name}.ok" for f in declared.fields)
        values = ", ".join(f"'{f.name}', {name}.{f.name}.value" for f in declared.fields)
        read = bind(f"named_struct({parts})", name, _result(ok, f"named_struct({values})"))
        return _unless_absent(value, field, read)
    source = f"named_struct('v', {value}, 'kind', schema_of_variant({value}))"
    listed = ", ".join(f"'{choice}'" for choice in field.allowed or [])
    ok = f"r in ({listed})" if field.allowed else "r is not null"
    if declared == STRING and not field.allowed:
        read = _result("b.kind = 'STRING'", _SCALAR_SQL["string"])
    else:
        read = bind(_SCALAR_SQL[declared.simpleString()], "r", _result(ok, "r"))
    if not field.required:
        read = f"if(b.kind is null or b.kind = 'VOID', {_nothing(field)}, {read})"
    return bind(source, "b", read)


def _nothing(field: Field) -> str:
    return _result("true", f"cast(null as {spark_type(field.kind).simpleString()})")


def _unless_absent(value: str, field: Field, read: str) -> str:
    if field.required:
        return read
    return f"if({value} is null or is_variant_null({value}), {_nothing(field)}, {read})"


def _inner_sql(owner: str, field: Field, depth: int) -> str:
    value = f"f{depth}"
    return bind(f"try_variant_get({owner}, '$.{field.name}', 'variant')", value, read_sql(value, field, depth))


def is_blank_sql(parsed: str) -> str:
    """SQL of whether an answer says nothing: no JSON, or an empty or zero value."""
    tests = f"""case
        when kind is null or kind in ('OBJECT<>', 'VOID') then true
        when startswith(kind, 'ARRAY') then size(try_variant_get({parsed}, '$', 'array<variant>')) = 0
        when kind = 'STRING' then try_variant_get({parsed}, '$', 'string') = ''
        when kind = 'BOOLEAN' then not try_variant_get({parsed}, '$', 'boolean')
        when kind rlike '{_NUMBER_KINDS}' then try_variant_get({parsed}, '$', 'double') = 0
        else false end"""
    return bind(f"schema_of_variant({parsed})", "kind", tests)


def is_blank_response(parsed: str) -> Column:
    """``is_blank_sql`` of a column or SQL expression."""
    return F.expr(is_blank_sql(parsed))


def unwrap_single_list_sql(parsed: str) -> str:
    """SQL of the list inside an object whose only field is a list; else the value itself."""
    only = "if(size(m) = 1, try_element_at(map_values(m), 1), null)"
    inside = bind(f"try_variant_get({parsed}, '$', 'map<string,variant>')", "m", only)
    return bind(inside, "u", f"if(startswith(schema_of_variant(u), 'ARRAY'), u, {parsed})")


def typed_value_sql(parsed: str, category: str, unwrap: bool = False) -> str:
    """SQL of the struct ``(ok, value)``: a parsed answer loaded as a category's type.

    Unknown keys are ignored. A missing required field, a value of a wrong kind
    or an unlisted choice rejects the whole answer. Numbers may come as numeric
    text or booleans; integers as whole decimals; text only as text.
    """
    field = Field(category, CATEGORY_KINDS[category], True)
    if unwrap and isinstance(field.kind, ListOf):
        return bind(unwrap_single_list_sql(parsed), "answer", read_sql("answer", field))
    return read_sql(parsed, field)


def answer_sql(content: str, category: str, unwrap: bool = False) -> str:
    """SQL of the struct ``(status, value)`` of an answer text.

    ``status`` is loaded, rejected or empty; ``value`` is null unless loaded.
    Answers that say nothing, absent ones included, are not read any further.
    """
    kind = spark_type(CATEGORY_KINDS[category]).simpleString()

    def outcome(status: str, value: str) -> str:
        return f"named_struct('status', {status}, 'value', {value})"

    nothing = f"cast(null as {kind})"
    read = bind(
        typed_value_sql("doc", category, unwrap),
        "r",
        outcome("if(r.ok, 'loaded', 'rejected')", f"if(r.ok, r.value, {nothing})"),
    )
    loaded = bind(
        parse_response_sql(content),
        "doc",
        f"if({is_blank_sql('doc')}, {outcome(repr('empty'), nothing)}, {read})",
    )
    return f"if({content} is null, {outcome(repr('empty'), nothing)}, {loaded})"


def load_responses(responses: DataFrame, category: str, unwrap: bool = False) -> DataFrame:
    """Adds ``status`` (loaded, rejected or empty) and the typed ``value`` of one category."""
    read = F.expr(answer_sql("content", category, unwrap))
    return computed(responses, read, "_answer", *responses.columns).select(
        *responses.columns, "_answer.status", "_answer.value"
    )


def default_value(category: str, name: Column, country: Column, base_url: Column) -> Column:
    """Typed placeholder of a category for which nothing was extracted."""
    if isinstance(CATEGORY_KINDS[category], ListOf):
        filled = F.array()
    else:
        given = {
            "about": {
                "name": name,
                "location": F.struct(F.lit(UNKNOWN_NAME).alias("city"), country.alias("country")),
                "institution_type": F.lit(UNKNOWN_TYPE),
            },
            "living_costs": {
                "city": F.lit(UNKNOWN_NAME),
                "currency": F.lit(DEFAULT_CURRENCY),
                "source_url": base_url,
            },
            "acceptance_rate": {"source_url": base_url},
            "graduate_employment": {"source_url": base_url},
            "visa_policies": {
                "country": country,
                "visa_type": F.lit(UNKNOWN_NAME),
                "key_requirements": F.array(),
                "source_url": base_url,
            },
        }[category]
        filled = F.struct(
            *[
                given.get(f.name, F.lit(None)).cast(spark_type(f.kind)).alias(f.name)
                for f in CATEGORY_KINDS[category].fields
            ]
        )
    return filled.cast(CATEGORY_TYPES[category])


def default_data(name: Column, country: Column, base_url: Column) -> Column:
    """All ten placeholders as one record value."""
    return F.struct(
        *[default_value(c, name, country, base_url).alias(c) for c in CATEGORIES]
    )


FLAG_KIND = ListOf(
    Shape(
        Field("field", STRING, True),
        Field("issue", STRING, True),
        Field("severity", STRING, True, allowed=SEVERITIES),
    )
)


_NUMBER_NAMES = r"(?:BIGINT|DECIMAL[(][0-9,]++[)]|DOUBLE|FLOAT)"
_EXACT_NAMES = {"string": "STRING", "bigint": "BIGINT", "double": _NUMBER_NAMES}
#: What a stored flag holds beyond what is read of it.
_FLAG_EXTRAS = {"rule_id": "(?:STRING|VOID)", "idx": "(?:BIGINT|VOID)"}


def _object_kind(fields: dict[str, str], more: bool = False) -> str:
    """Regex of ``schema_of_variant`` for objects of some of the fields, which it sorts, and with
    ``more`` of scalars of other names."""
    other = f"(?:(?!(?:{'|'.join(fields)}): )[A-Za-z0-9_]++: (?:{_NUMBER_NAMES}|STRING|BOOLEAN|VOID)(?:, )?+)*+" if more else ""
    return "OBJECT<" + "".join(f"{other}(?:{name}: {kind}(?:, )?+)?+" for name, kind in sorted(fields.items())) + f"{other}>"


def _exact_kind(kind, extras: dict[str, str] | None = None) -> str:
    """Regex of ``schema_of_variant`` for values that ``from_json`` reads as ``read_sql`` does."""
    if isinstance(kind, ListOf):
        return f"ARRAY<(?:{_exact_kind(kind.kind, extras)}|VOID)>"
    if isinstance(kind, Shape):
        return _object_kind({f.name: f"(?:{_exact_kind(f.kind)}|VOID)" for f in kind.fields} | (extras or {}))
    return _EXACT_NAMES[kind.simpleString()]


def _sound_sql(value: str, field: Field, depth: int = 0) -> str:
    """SQL of whether a typed value has all that its declaration requires."""
    declared = field.kind
    if isinstance(declared, ListOf):
        inner = f"forall({value}, s{depth} -> {_sound_sql(f's{depth}', Field('item', declared.kind, True), depth + 1)})"
    elif isinstance(declared, Shape):
        tests = [_sound_sql(f"{value}.{f.name}", f, depth) for f in declared.fields if f.required or f.allowed or not isinstance(f.kind, T.DataType)]
        inner = " and ".join(["true", *tests])
    else:
        inner = f"{value} in ({', '.join(map(repr, field.allowed))})" if field.allowed else "true"
    return f"({value} is not null and {inner})" if field.required else f"({value} is null or {inner})"


#: Begins a line of a written record: the place, behind one other column at most.
_HEAD = (
    r'^[{](?:"(?!(?:ord|university_name|scraped_at|data|field_confidence|validation_flags)")[A-Za-z0-9_]++":'
    r'(?:-?(?:0|[1-9][0-9]{0,17})|"[^"\\\\\x00-\x1f]*+"),)?+(?:"ord":-?(?:0|[1-9][0-9]{0,17}),)?+$'
)


def _as_written_sql(line: str, read: str) -> str:
    """SQL of whether a line is just what the record ``read`` of it is written as, so that every
    value has its declared kind and no key is there twice; all that may be missing is there."""
    lists = [f"{read}.data.{c} is not null" for c in CATEGORIES]
    scores = f"map_values({read}.field_confidence)"
    parts = ", ".join(f"'{f}', {read}.{f}" for f in ("university_name", "scraped_at", "data", "field_confidence", "validation_flags"))
    text = f"to_json(named_struct({parts}), map('ignoreNullFields', 'false'))"
    head = f"""substring_index({line}, '"university_name":', 1)"""
    # The text's own brace goes; no length is asked for, which would count a line's characters.
    whole = bind(head, "h", f"h rlike r'{_HEAD}' and {line} = concat(h, trim(leading '{{' from {text}))")
    tests = [
        f"{read}.validation_flags is not null", *lists, f"size(array_compact({scores})) = size({scores})",
        f"size(array_distinct(map_keys({read}.field_confidence))) = size({scores})",
        whole,
    ]
    return f"coalesce({' and '.join(tests)}, false)"


def stored_record_sql(line: str, with_place: bool = False) -> str:
    """SQL of one stored record in declared types, null where the line isn't one; with its
    place, the struct ``(ord, record)``, whose ``ord`` is null where the line has none.

    ``typed_record_sql``, behind shortcuts: a line that is just as its record is written is read
    by ``from_json`` alone. So is a record whose every value has just the declared
    JSON kind, as the kinds of the whole document tell. It is none if it then lacks something
    required. What is no JSON or has a name that is no text
    isn't read any further. All others are read value by value.
    """
    lists = [c for c in CATEGORIES if isinstance(CATEGORY_KINDS[c], ListOf)]
    types = {c: spark_type(CATEGORY_KINDS[c]).simpleString() for c in CATEGORIES}
    flags = spark_type(FLAG_KIND).simpleString()
    # The date text is read like any other; all the rest has its type at once.
    schema = (
        f"ord bigint, university_name string, scraped_at string, data struct<{','.join(f'{c}:{t}' for c, t in types.items())}>, "
        f"field_confidence map<string,double>, validation_flags array<{FLAG_TYPE.simpleString()}>"
    )
    kinds = _object_kind({
        "university_name": "STRING", "scraped_at": "STRING",
        "data": _object_kind({c: _exact_kind(CATEGORY_KINDS[c]) for c in CATEGORIES}),
        "field_confidence": f"OBJECT<(?:[a-z_]++: {_NUMBER_NAMES}(?:, )?+)*+>",
        "validation_flags": _exact_kind(FLAG_KIND, _FLAG_EXTRAS),
    }, more=True)
    tests = [
        "e.t.university_name is not null", "e.at is not null", "e.t.field_confidence is not null",
        *[_sound_sql(f"e.t.data.{c}", Field(c, CATEGORY_KINDS[c], c not in lists)) for c in CATEGORIES],
        _sound_sql("e.t.validation_flags", Field("flags", FLAG_KIND, False)),
    ]
    some = lambda value, kind: f"coalesce({value}, cast(array() as {kind}))"
    data = ", ".join(f"'{c}', " + (some(f"e.t.data.{c}", types[c]) if c in lists else f"e.t.data.{c}") for c in CATEGORIES)
    fields = ", ".join(f"'{f.name}', flag.{f.name}" for f in FLAG_KIND.kind.fields)
    own_flags = f"transform(e.t.validation_flags, flag -> if(flag is null, null, named_struct({fields})))"
    typed = (
        "named_struct('university_name', e.t.university_name, 'scraped_at', e.at, "
        f"'data', named_struct({data}), 'field_confidence', e.t.field_confidence, "
        f"'validation_flags', {some(own_flags, flags)})"
    )
    place = "if(e.doc is null, e.t.ord, try_variant_get(e.doc, '$.ord', 'bigint'))"
    own = (lambda record: f"named_struct('ord', {place}, 'record', {record})") if with_place else str
    slow = bind(typed_record_sql("e.doc"), "r", f"if(r.ok, {own('r.value')}, null)")
    misnamed = "coalesce(schema_of_variant(try_variant_get(e.doc, '$.university_name', 'variant')) <> 'STRING', false)"
    read = f"if(e.t is not null, if({' and '.join(tests)}, {own(typed)}, null), if(e.doc is null or {misnamed}, null, {slow}))"

    # What is bound is handed on; each result that leaves a ``bind`` is copied, so these are few.
    def told(doc: str, record: str) -> str:
        at = f"try_cast(concat(cast({parse_date_sql(record + '.scraped_at')} as string), 'Z') as timestamp)"
        return f"named_struct('doc', {doc}, 't', {record}, 'at', {at})"

    # Only a line with a field that others may lack can be as it is written.
    optional = next(f.name for f in CATEGORY_KINDS["about"].fields if not f.required)
    tried = f"""if(contains({line}, '"{optional}":'), from_json({line}, '{schema}'), null)"""
    exact = f"if(schema_of_variant(doc) rlike r'^{kinds}$', from_json({line}, '{schema}'), null)"
    parsed = bind(f"try_parse_json({line})", "doc", bind(exact, "x", told("doc", "x")))
    looked = f"if({_as_written_sql(line, 'k')}, {told('cast(null as variant)', 'k')}, {parsed})"
    return bind(tried, "k", bind(looked, "e", read))


def typed_record_sql(parsed: str) -> str:
    """SQL of the struct ``(ok, value)`` of one stored record given as a VARIANT.

    List categories and flags may be missing, which reads as no items;
    confidences must be an object of numbers.
    """

    def or_no_items(value: str, declared: ListOf) -> str:
        none = f"cast(array() as {spark_type(declared).simpleString()})"
        return bind(value, "f0", f"if(f0 is null, {_result('true', none)}, {read_sql('f0', Field('list', declared, True))})")

    def category(name: str) -> str:
        value = f"try_variant_get({parsed}, '$.data.{name}', 'variant')"
        declared = CATEGORY_KINDS[name]
        if isinstance(declared, ListOf):
            return or_no_items(value, declared)
        return bind(value, "f0", read_sql("f0", Field(name, declared, True)))

    def required(name: str, kind) -> str:
        return bind(f"try_variant_get({parsed}, '$.{name}', 'variant')", "f0", read_sql("f0", Field(name, kind, True)))

    scores = bind(
        f"transform_values(try_variant_get({parsed}, '$.field_confidence', 'map<string,variant>'), "
        f"(k, x) -> {read_sql('x', Field('score', DOUBLE, True))})",
        "m",
        _result(
            "m is not null and forall(map_values(m), y -> y.ok)",
            "transform_values(m, (k, y) -> y.value)",
        ),
    )
    parts = {
        "university_name": required("university_name", STRING),
        "scraped_at": required("scraped_at", T.TimestampType()),
        **{c: category(c) for c in CATEGORIES},
        "field_confidence": scores,
        "validation_flags": or_no_items(
            f"try_variant_get({parsed}, '$.validation_flags', 'variant')", FLAG_KIND
        ),
    }
    data = "named_struct(" + ", ".join(f"'{c}', q.{c}.value" for c in CATEGORIES) + ")"
    value = (
        f"named_struct('university_name', q.university_name.value, 'scraped_at', q.scraped_at.value, "
        f"'data', {data}, 'field_confidence', q.field_confidence.value, "
        "'validation_flags', q.validation_flags.value)"
    )
    whole = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")"
    return bind(whole, "q", _result(" and ".join(f"q.{k}.ok" for k in parts), value))
