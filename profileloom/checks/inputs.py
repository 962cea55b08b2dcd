"""Inputs of the registered queries, derived from the given tables.

Each view is one SQL text that Spark and DuckDB read alike, so a query and its
oracle start from the same rows. ``$name`` stands for a table or another view.
All of them are row-wise or plain joins and grow with the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_COUNTRY = """case {key} % 10 when 0 then 'United States' when 1 then 'United Kingdom'
    when 2 then 'Canada' when 3 then 'Australia' when 4 then 'Germany' when 5 then 'France'
    when 6 then 'Japan' when 7 then 'New Zealand' when 8 then 'Singapore' else 'Brazil' end"""
_YEAR = "cast(extract(year from {0}) as string)"
_MONTH = "cast(extract(month from {0}) as string)"
_DAY = "cast(extract(day from {0}) as string)"


def _ymd(column: str, separator: str) -> str:
    parts = [p.format(column) for p in (_YEAR, _MONTH, _DAY)]
    return f"concat({parts[0]}, '{separator}', {parts[1]}, '{separator}', {parts[2]})"


def _dmy(column: str) -> str:
    parts = [p.format(column) for p in (_DAY, _MONTH, _YEAR)]
    return f"concat({parts[0]}, '/', {parts[1]}, '/', {parts[2]})"


def _iso(column: str, separator: str = "-") -> str:
    year, month, day = (p.format(column) for p in (_YEAR, _MONTH, _DAY))
    return (
        f"concat({year}, '{separator}', lpad({month}, 2, '0'), '{separator}', lpad({day}, 2, '0'))"
    )


_TAG_WORDS = """case l_linenumber when 1 then 'Tuition Fees' when 2 then 'Course list'
    when 3 then 'Next' when 4 then 'News' else 'More' end"""

VIEWS = {
    # Entities and one table per category, keyed by ek.
    "entity": f"""
select s_suppkey as ek, s_name as name, {_COUNTRY.format(key="s_nationkey")} as country,
  concat('https://u', cast(s_suppkey as string), '.example.edu') as base_url
from $supplier""",
    "about": """
select s_suppkey as ek,
  case when s_suppkey % 11 = 0 then 'Unknown' else s_name end as name,
  case when s_suppkey % 7 = 0 then null else cast(floor(s_acctbal) as int) + 900 end as founding_year,
  case s_suppkey % 3 when 0 then 'unknown' when 1 then 'public' else 'private' end as institution_type
from $supplier""",
    "tuition": """
select l_suppkey as ek, l_orderkey * 8 + l_linenumber as idx,
  case when l_linenumber = 3 then null else l_extendedprice * 8 - 20000 end as domestic_fee,
  case when l_linenumber = 4 then null else l_extendedprice * l_quantity / 8 - 3000 end as international_fee,
  case when l_linestatus = 'O' then ' cad ' when l_returnflag = 'A' then '' else 'USD' end as currency
from $lineitem""",
    "living": """
select s_suppkey as ek,
  case when s_suppkey % 5 = 0 then null else s_acctbal * 1.5e0 end as monthly_rent,
  case when s_suppkey % 5 = 0 then null else s_acctbal / 10 end as monthly_food,
  case when s_suppkey % 5 = 0 then null else 150.0e0 end as monthly_transport,
  case s_suppkey % 4 when 0 then '' when 1 then 'usd' else 'EUR' end as currency
from $supplier""",
    "scholarship": f"""
select o_custkey % 10 as ek, o_orderkey as idx,
  concat('Award ', cast(o_orderkey as string)) as name,
  case o_orderkey % 6 when 0 then null when 1 then 'Rolling' when 2 then 'Fall 2025'
    when 3 then {_dmy("o_orderdate")} when 4 then concat('31/', {_MONTH.format("o_orderdate")}, '/2024')
    else '20250115' end as application_deadline
from $orders""",
    "acceptance": """
select s_suppkey as ek,
  case when s_suppkey % 6 = 0 then null else cast(floor(s_acctbal / 80) as double) end as overall_pct,
  case s_suppkey % 6 when 0 then null when 1 then 0.0e0 when 2 then 100.0e0 else 45.5e0 end as undergraduate_pct,
  case when s_suppkey % 6 = 0 then null else cast(s_suppkey % 7 as double) - 1.0e0 end as postgraduate_pct
from $supplier""",
    "employment": """
select s_suppkey as ek,
  case s_suppkey % 5 when 0 then null when 1 then 100.0e0 when 2 then 101.0e0 else 84.0e0 end
    as employed_within_6_months_pct
from $supplier""",
    "salary": """
select c_custkey % 10 as ek, c_custkey as idx, c_mktsegment as field_of_study,
  c_acctbal * 60 as median_salary,
  case when c_custkey % 2 = 0 then 'USD' else 'CAD' end as currency
from $customer""",
    "visa": """
select s_suppkey as ek,
  case s_suppkey % 3 when 0 then 'Unknown' when 1 then '' else 'Study Permit' end as visa_type,
  cast(s_suppkey % 4 as int) as n_requirements
from $supplier""",
    "deadline": f"""
select l_suppkey as ek, l_orderkey * 8 + l_linenumber as idx,
  case l_linenumber when 1 then {_iso("o_orderdate")} when 2 then {_dmy("o_orderdate")}
    when 3 then 'Rolling' when 4 then 'Fall 2025' when 5 then null
    else concat('March ', {_DAY.format("o_orderdate")}, ', ', {_YEAR.format("o_orderdate")}) end as application_open_date,
  case when l_linenumber = 7 then concat('2024/02/', {_DAY.format("l_shipdate")})
    else {_ymd("l_shipdate", "/")} end as application_close_date
from $lineitem join $orders on l_orderkey = o_orderkey""",
    "course": """
select p_partkey % 10 as ek, p_partkey as idx,
  case when p_size % 10 = 0 then '' else concat(p_brand, '-', cast(p_partkey as string)) end as code,
  case when p_size % 13 = 0 then '' else p_name end as title
from $part""",
    # Page snapshot with fetch outcomes, and the snapshot of an earlier run.
    "fetch": """
select page_id, url, html,
  case when page_id % 17 = 0 then 503 when page_id % 13 = 0 then 404 when page_id % 19 = 0 then 0 else 200 end as status_code,
  case when page_id % 17 = 0 then 'HTTP status error: 503' when page_id % 13 = 0 then null
       when page_id % 19 = 0 then 'blocked_by_robots' else null end as error
from $pages""",
    "earlier_page": """
select page_id, url,
  case when page_id % 3 = 0 then concat(html, '<p>old</p>') else html end as html
from $pages where page_id % 5 <> 0""",
    "site_robots": """
select distinct regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[/?#].*$', '') as site,
  case when length(url) % 3 = 0
      then concat('User-agent: *', chr(10), 'Disallow: /en/', chr(10), 'Allow: /')
    when length(url) % 3 = 1
      then concat('User-agent: *', chr(10), 'Allow: /', chr(10), 'Disallow: /en/')
    else concat('User-agent: somebot', chr(10), 'Disallow: /', chr(10), chr(10), 'User-agent: *', chr(10), 'Disallow:') end as robots_text,
  length(url) % 3 as variant
from $pages""",
    # Link graph.
    "seed": """
select s_suppkey as ek, c.category, 0 as pos,
  concat('https://u', cast(s_suppkey as string), '.example.edu/p', cast(s_suppkey % 5 as string), '#top') as url
from $supplier cross join (select * from (values ('tuition_fees'), ('course_listings')) as v(category)) c""",
    "linkpage": """
select distinct concat('https://u', cast(l_suppkey as string), '.example.edu/p', cast(l_partkey % 40 as string)) as url,
  case when (l_partkey % 40) % 7 = 0 then 404 else 200 end as status_code
from $lineitem""",
    "link": f"""
select l_suppkey as ek,
  concat('https://u', cast(l_suppkey as string), '.example.edu/p', cast(l_partkey % 40 as string)) as page_url,
  l_orderkey * 8 + l_linenumber as pos,
  case when l_linenumber = 7 then 'https://other.example.org/fees'
       when l_linenumber = 6 then concat('/p', cast(l_orderkey % 40 as string), '#s')
       when l_linenumber = 5 then concat('?page=', cast(l_orderkey % 9 as string))
       else concat('/p', cast(l_orderkey % 40 as string)) end as href,
  {_TAG_WORDS} as anchor_text,
  case when l_linenumber = 4 and l_returnflag = 'A' then 'next' else '' end as rel
from $lineitem""",
    # Groups of at most four documents, as a crawl plan would order them.
    "planned_text": """
select cast(floor(doc_id / 4) as bigint) as ek,
  case when doc_id % 8 < 4 then 'about' else 'scholarships' end as category,
  cast(doc_id % 4 as int) + 1 as rank,
  concat('https://d', cast(doc_id as string), '.example.edu/', lang) as url,
  case when doc_id % 9 = 0 then 'Transport error: reset' else null end as error,
  case when doc_id % 9 = 0 or doc_id % 13 = 0 then '' else text end as clean_text
from $documents""",
    # Answers to extraction requests, sound and broken ones.
    "answer": """
select o_orderkey as ek, cast(o_orderkey % 9 as int) as variant, o_totalprice,
  case o_orderkey % 9
    when 0 then concat('{"name":"U', cast(o_orderkey as string), '","location":{"city":"C","country":"Canada"},"institution_type":"public","founding_year":"', cast(1000 + o_orderkey % 1000 as string), '"}')
    when 1 then concat('```json', chr(10), '{"name":"U', cast(o_orderkey as string), '","location":{"city":"C","country":"Canada"},"institution_type":"private","extra":[1,2]}', chr(10), '```')
    when 2 then '{"name":"U","location":{"city":"C","country":"Canada"},"institution_type":"Public"}'
    when 3 then concat('{"name":"U', cast(o_orderkey as string), '"}')
    when 4 then concat('no json here ', o_orderpriority)
    when 5 then concat(' {"name":"U', cast(o_orderkey as string), '","location":{"city":"C","country":"Canada"},"institution_type":"unknown","founding_year":1900.0,"overall_ranking":{"rank":', cast(o_custkey as string), ',"source":"S","year":2024}} ')
    when 6 then '{"name":"U","location":{"city":"C","country":"Canada"},"institution_type":"public","founding_year":1900.5}'
    when 7 then '{}'
    else '{"name":5,"location":{"city":"C","country":"Canada"},"institution_type":"public"}' end as about_content,
  case o_orderkey % 9
    when 0 then concat('[{"programme_level":"phd","domestic_fee":', cast(o_orderkey as string), ',"currency":"CAD","academic_year":"2025","source_url":"u"},{"programme_level":"ug","international_fee":"12.5","currency":"USD","academic_year":"2025","source_url":"u"}]')
    when 1 then '{"tuition_fees":[]}'
    when 2 then '[]'
    when 3 then '[{"programme_level":"phd","currency":"CAD","academic_year":"2025"}]'
    when 4 then concat('```', chr(10), '[{"programme_level":"phd","domestic_fee":true,"currency":"CAD","academic_year":"2025","source_url":"u"}]', chr(10), '```')
    when 5 then '[null]'
    when 6 then '[{"programme_level":"phd","domestic_fee":"many","currency":"CAD","academic_year":"2025","source_url":"u"}]'
    when 7 then '"text"'
    else '[{"programme_level":"phd","domestic_fee":null,"currency":"CAD","academic_year":"2025","source_url":"u"}]' end as tuition_content
from $orders""",
    # Texts of dates.
    "date_text": f"""
select o_orderkey as ek, o_orderdate,
  case o_orderkey % 12 when 0 then {_iso("o_orderdate")} when 1 then {_dmy("o_orderdate")}
    when 2 then {_ymd("o_orderdate", "/")} when 3 then {_iso("o_orderdate", "")}
    when 4 then concat(' March ', {_DAY.format("o_orderdate")}, ',  ', {_YEAR.format("o_orderdate")})
    when 5 then concat({_DAY.format("o_orderdate")}, ' sep ', {_YEAR.format("o_orderdate")})
    when 6 then concat('13/', {_DAY.format("o_orderdate")}, '/', {_YEAR.format("o_orderdate")})
    when 7 then 'Rolling' when 8 then concat('Fall ', {_YEAR.format("o_orderdate")})
    when 9 then {_YEAR.format("o_orderdate")} when 10 then concat({_iso("o_orderdate")}, 'T10:30:00Z')
    else concat({_DAY.format("o_orderdate")}, '/13/', {_YEAR.format("o_orderdate")}) end as date_text
from $orders""",
    # Flat base of nested records: one per order.
    "rec": f"""
select o_orderkey as ek, o_orderkey as ord, concat('Entity ', cast(o_orderkey as string)) as name,
  {_COUNTRY.format(key="o_custkey")} as country,
  concat('https://e', cast(o_orderkey as string), '.example.edu') as base_url,
  o_totalprice as price, o_custkey as cust, o_orderdate as odate,
  cast(o_orderkey % 4 as int) as n_tuition, cast(o_orderkey % 3 as int) as n_scholarship,
  cast(o_orderkey % 5 as int) as n_salary, cast(o_custkey % 3 as int) as n_deadline,
  cast(o_custkey % 4 as int) as n_course, cast(o_orderkey % 3 as int) as n_requirement
from $orders""",
}

# Fields of the single-valued categories of a record over the columns of "rec".
RECORD_STRUCTS = {
    "about": {
        "name": "case when ek % 11 = 0 then 'Unknown' when ek % 23 = 0 then '' else name end",
        "founding_year": "case when ek % 7 = 0 then null else cast(floor(price / 200) as bigint) end",
        "overall_ranking": "case when ek % 8 = 0 then {ranking} else null end",
        "location": "{location}",
        "institution_type": "case ek % 3 when 0 then 'unknown' when 1 then 'public' else 'private' end",
    },
    "living_costs": {
        "city": "'Town'",
        "monthly_rent": "case when ek % 5 = 0 then null else price / 40e0 - 300e0 end",
        "monthly_food": "case when ek % 5 = 0 then null else price / 1000e0 - 20e0 end",
        "monthly_transport": "case when ek % 5 = 0 or ek % 3 = 0 then null else 150.5e0 end",
        "currency": "case ek % 4 when 0 then '' when 1 then ' usd' else 'EUR' end",
        "source_url": "base_url",
        "estimate_basis": "cast(null as string)",
    },
    "acceptance_rate": {
        "overall_pct": "case when ek % 6 = 0 then null else cast(cust % 120 as double) end",
        "undergraduate_pct": "case ek % 6 when 0 then null when 1 then 0.0e0 when 2 then 100.0e0 else 45.5e0 end",
        "postgraduate_pct": "case when ek % 6 = 0 then null else cast(cust % 9 as double) - 1e0 end",
        "year": "cast(2024 as bigint)",
        "source_url": "base_url",
    },
    "graduate_employment": {
        "employed_within_6_months_pct": "case ek % 5 when 0 then null when 1 then 100.0e0 when 2 then 101.0e0 else 84.5e0 end",
        "data_source": "cast(null as string)",
        "data_year": "cast(2023 as bigint)",
        "source_url": "base_url",
    },
    "visa_policies": {
        "country": "country",
        "visa_type": "case cust % 3 when 0 then 'Unknown' when 1 then '' else 'Study Permit' end",
        "processing_time": "cast(null as string)",
        "key_requirements": "{requirements}",
        "source_url": "base_url",
    },
}

# Fields of the items of the list categories; ``i`` is the position in the list.
RECORD_ITEMS = {
    "tuition_fees": (
        "n_tuition",
        {
            "programme_level": "case when i = 0 then 'undergraduate' else 'phd' end",
            "domestic_fee": "case when (ek + i) % 6 = 0 then null else price - 30000e0 + 25000e0 * i end",
            "international_fee": "case when (ek + i) % 7 = 0 then null else price * 1.25e0 - 60000e0 end",
            "currency": "case (ek + i) % 4 when 0 then ' cad ' when 1 then 'USD' when 2 then '' else 'GBP' end",
            "academic_year": "'2025/2026'",
            "source_url": "base_url",
        },
    ),
    "scholarships": (
        "n_scholarship",
        {
            "name": "concat('Award ', cast(ek + i as string))",
            "value": "cast(null as string)",
            "eligibility_criteria": "'any'",
            "application_deadline": f"case (ek + i) % 5 when 0 then null when 1 then 'Rolling' when 2 then 'Fall 2025' when 3 then {_dmy('odate')} else '20250115' end",
            "source_url": "base_url",
        },
    ),
    "average_salaries": (
        "n_salary",
        {
            "field_of_study": "case when i = 0 then 'Law' else 'Art' end",
            "median_salary": "price * 1.5e0 - 20000e0 * i",
            "currency": "case when (cust + i) % 2 = 0 then 'USD' else 'CAD' end",
            "year": "cast(2024 as bigint)",
            "source_url": "base_url",
        },
    ),
    "intake_deadlines": (
        "n_deadline",
        {
            "intake_name": "'Fall'",
            "programme_level": "cast(null as string)",
            "application_open_date": f"case (ek + i) % 4 when 0 then {_iso('odate')} when 1 then {_dmy('odate')} when 2 then 'Spring 2025' else concat('March ', {_DAY.format('odate')}, ', ', {_YEAR.format('odate')}) end",
            "application_close_date": f"case (ek + i) % 3 when 0 then {_ymd('odate', '/')} when 1 then '2/3/1996' else null end",
            "source_url": "base_url",
        },
    ),
    "course_listings": (
        "n_course",
        {
            "code": "case when (ek + i) % 10 = 0 then '' else concat('C-', cast(ek + i as string)) end",
            "title": "case when (ek + i) % 13 = 0 then '' else concat('Course ', cast(i as string)) end",
            "credits": "0.5e0 * i",
            "description": "cast(null as string)",
            "prerequisites": "{no_texts}",
            "mode": "'online'",
            "source_url": "base_url",
        },
    ),
}

#: Items a list of a nested record has at most: counts are remainders of five or less.
_MOST_ITEMS = 4

_SPARK_PARTS = {
    "ranking": "named_struct('rank', cust, 'source', 'S', 'year', cast(2024 as bigint))",
    "location": "named_struct('city', 'Town', 'country', country)",
    # A lambda keeps Spark from fusing the projection into one method, too large for the JIT to compile.
    "requirements": "transform(array_repeat(0, n_requirement), x -> 'proof')",
    "no_texts": "cast(array() as array<string>)",
}
_DUCK_PARTS = {
    "ranking": "{'rank': cust, 'source': 'S', 'year': cast(2024 as bigint)}",
    "location": "{'city': 'Town', 'country': country}",
    "requirements": "list_transform(range(n_requirement), lambda x: 'proof')",
    "no_texts": "cast([] as varchar[])",
}


def _fill(expression: str, parts: dict[str, str]) -> str:
    return re.sub(r"\{(\w+)\}", lambda m: parts[m.group(1)], expression)


def spark_data_columns() -> dict[str, str]:
    """SQL of every category of a nested record, for Spark, over ``rec``."""
    columns = {}
    for name, fields in RECORD_STRUCTS.items():
        pairs = ", ".join(f"'{f}', {_fill(e, _SPARK_PARTS)}" for f, e in fields.items())
        columns[name] = f"named_struct({pairs})"
    for name, (count, fields) in RECORD_ITEMS.items():
        # Spelled out, as Spark interprets lambdas.
        pairs = ", ".join(f"'{f}', {_fill(e, _SPARK_PARTS)}" for f, e in fields.items())
        items = [f"if({n} < {count}, named_struct({re.sub(r'\bi\b', str(n), pairs)}), null)" for n in range(_MOST_ITEMS)]
        columns[name] = f"slice(array({', '.join(items)}), 1, greatest({count}, 0))"
    return columns


def duck_data_columns() -> dict[str, str]:
    """SQL of every category of a nested record, for DuckDB, over ``rec``."""
    columns = {}
    for name, fields in RECORD_STRUCTS.items():
        pairs = ", ".join(f"'{f}': {_fill(e, _DUCK_PARTS)}" for f, e in fields.items())
        columns[name] = "{" + pairs + "}"
    for name, (count, fields) in RECORD_ITEMS.items():
        pairs = ", ".join(f"'{f}': {_fill(e, _DUCK_PARTS)}" for f, e in fields.items())
        columns[name] = f"list_transform(range({count}), lambda i: {{{pairs}}})"
    return columns


def duck_items(name: str) -> str:
    """Long DuckDB view of a record category: ``ek, idx, fields...``."""
    if name in RECORD_STRUCTS:
        fields = ", ".join(f"{_fill(e, _DUCK_PARTS)} as {f}" for f, e in RECORD_STRUCTS[name].items())
        extra = ", n_requirement as n_requirements" if name == "visa_policies" else ""
        return f"select ek, country as entity_country, {fields}{extra} from $rec"
    count, fields = RECORD_ITEMS[name]
    listed = ", ".join(f"{_fill(e, _DUCK_PARTS)} as {f}" for f, e in fields.items())
    return (
        f"select ek, country as entity_country, i as idx, {listed} "
        f"from (select r.*, unnest(range({count})) as i from $rec r) x"
    )


_NAME = re.compile(r"\$(\w+)")



def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a Spark DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return run_sql(spark, sf_dir, VIEWS[name])


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Runs SQL whose ``$name`` references are tables or views."""
    for name in sorted(set(_NAME.findall(text))):
        load(spark, sf_dir, name).createOrReplaceTempView(f"loom_{name}")
    return spark.sql(_NAME.sub(lambda m: f"loom_{m.group(1)}", text))


def oracle(text: str, **extra: str) -> str:
    """The DuckDB form of SQL with ``$name`` references: views become CTEs.

    ``extra`` views exist for this text only. ``$country_currency`` and the
    record category views are always known.
    """
    known = {**VIEWS, **ORACLE_VIEWS, **extra}
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in known and name not in order:
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(text)
    plain = lambda sql: _NAME.sub(lambda m: m.group(1) if m.group(1) not in known else f"v_{m.group(1)}", sql)
    ctes = ", ".join(f"v_{name} as ({plain(known[name])})" for name in order)
    return (f"with {ctes} " if ctes else "") + plain(text)


ORACLE_VIEWS = {
    # Expected currencies, restated for the oracle.
    "country_currency": """
select * from (values ('United States', 'USD'), ('United Kingdom', 'GBP'), ('Canada', 'CAD'),
  ('Australia', 'AUD'), ('Germany', 'EUR'), ('France', 'EUR'), ('Japan', 'JPY'),
  ('New Zealand', 'NZD'), ('Singapore', 'SGD')) as t(country, expected)""",
    **{f"rec_{name}": duck_items(name) for name in [*RECORD_STRUCTS, *RECORD_ITEMS]},
}


#: Bytes of stored input a task gets at most when rows are dealt.
_DEALT_BYTES = 4 << 20


def dealt(df):
    """The rows of a one-file table dealt over the cluster, for checks of costly expressions.

    The given tables have one split each. Operators never deal their input: a large
    table has splits enough. Tasks become more as the files grow, not larger.
    """
    spark = df.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in df.inputFiles()]
    size = sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // _DEALT_BYTES))
