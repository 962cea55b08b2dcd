"""The shortcut for stored records reads what the reading value by value does."""

import json

import pytest
from pyspark.sql import functions as F
from tests.test_runs import stored

from profileloom.functions.dates import bind
from profileloom.operators import responses

OPTIONS = {"ignoreNullFields": "false"}
REPLACED = [
    ("data.about.name", [5, None, "5", "é\\", "NaN", {}, [], True]),
    ("data.about.founding_year", [1900, 1900.0, 1900.5, "1900", None, True, 10**18, 10**20, 1e3]),
    ("data.about.institution_type", ["public", "Public", None, 1]),
    ("data.about.location", [None, {}, {"city": "C", "country": "D", "more": 1}, {"city": "C"}]),
    ("data.about.overall_ranking", [{"rank": 1, "source": "S", "year": 2024}, {"rank": "1"}, {}, []]),
    ("data.living_costs.monthly_rent", [1, 1.5, "1.5", "NaN", "x", -1e300, 10**30, 0.1, None, False]),
    ("data.visa_policies.key_requirements", [["x"], ["x", None], [1], "x", None, [], {}]),
    ("data.tuition_fees", [[], None, {}, [None], [{}], [{"programme_level": "p", "currency": "C", "academic_year": "2025", "source_url": "u", "domestic_fee": 1}],
        [{"programme_level": "p", "currency": "C", "academic_year": "2025", "source_url": "u", "domestic_fee": 1.25}, {"programme_level": None}]]),
    ("data.course_listings", [[{"code": "c", "title": "t", "credits": 1, "prerequisites": ["a"], "source_url": "u"}], [{"prerequisites": None}], 1]),
    ("scraped_at", ["2026-01-01T10:30:00+02:00", "March 5, 2025", "soon", 5, None, " 2026-01-01 "]),
    ("field_confidence", [{}, {"about": None}, {"about": "0.5"}, {"about": 1, "x y": 2}, None, [], {"about": 0.25}]),
    ("validation_flags", [[], None, [{"field": "about", "issue": "i", "severity": "low"}], [{"field": "about", "issue": "i", "severity": "none"}], [None],
        [{"field": "a", "issue": "i", "severity": "high", "rule_id": 5}], [{"field": "a", "issue": "i", "severity": "high", "rule_id": "R1", "idx": 3}]]),
    ("university_name", [None, 1, "", "x"]), ("ord", [1, "1", None]), ("data", [None, [], {}]), ("ek", [5, "k", [1], {}, None]),
]


def lines(spark):
    whole = json.loads(stored(spark).limit(1).select(F.to_json(F.struct("*"), OPTIONS)).first()[0])
    made = [json.dumps(whole)]
    for path, values in REPLACED:
        *outer, last = path.split(".")
        for value in [*values, "absent"]:
            one = json.loads(json.dumps(whole))
            at = one
            for name in outer:
                at = at[name]
            at[last] = value
            if value == "absent":
                del at[last]
            made.append(json.dumps(one))
    twice = made[0].replace('"about":', '"about": 1, "about":', 1)
    return [*made, made[0] + " x", made[0][:-1], twice, "[]", "", "1"]


def test_shortcut_and_plain_reading_agree(spark):
    table = spark.createDataFrame([(line,) for line in lines(spark)], "line string")
    plain = bind(bind("try_parse_json(line)", "doc", responses.typed_record_sql("doc")), "r", "if(r.ok, r.value, null)")
    text = lambda sql: F.to_json(F.struct(F.expr(sql).alias("v")), OPTIONS)
    rows = table.select("line", text(plain).alias("plain"), text(responses.stored_record_sql("line")).alias("short")).collect()
    read = lambda shown: json.loads(shown)
    assert [r.line for r in rows if read(r.plain) != read(r.short)] == []
    assert 30 < sum(read(r.plain)["v"] is not None for r in rows) < len(rows) - 30


def test_whole_records_take_the_shortcut(spark, monkeypatch):
    monkeypatch.setattr(responses, "typed_record_sql", lambda doc: "named_struct('ok', true, 'value', raise_error('plain reading'))")
    table = stored(spark).withColumn("ek", F.lit(7)).select(F.to_json(F.struct("*"), OPTIONS).alias("line"))
    with pytest.raises(Exception, match="plain reading"):
        table.limit(1).selectExpr("concat('[', line, ']') as line").select(F.expr(responses.stored_record_sql("line"))).collect()
    assert all(r[0] is not None for r in table.select(F.expr(responses.stored_record_sql("line"))).collect())


def test_broken_records_are_not_read_value_by_value(spark, monkeypatch):
    monkeypatch.setattr(responses, "typed_record_sql", lambda doc: "named_struct('ok', true, 'value', raise_error('plain reading'))")
    whole = json.loads(stored(spark).limit(1).select(F.to_json(F.struct("*"), OPTIONS)).first()[0])
    odd_type = json.loads(json.dumps(whole))
    odd_type["data"]["about"]["institution_type"] = "Secret"
    broken = ["not json", json.dumps(odd_type), json.dumps(whole | {"university_name": None}), json.dumps(whole | {"university_name": 5})]
    rows = spark.createDataFrame([(line,) for line in broken], "line string").select(F.expr(responses.stored_record_sql("line")).alias("r")).collect()
    assert [r.r for r in rows] == [None] * 4


def test_only_texts_that_may_be_json_are_parsed(spark, monkeypatch):
    texts = ['"x"', "-1", "0.5", "true", "null", "false", "nan", "NaN", "+1", ".5", "﻿{}", "'x'", "no", "Infinity", "/*c*/1", "[", "[1]", '{"a":1}']
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    show = lambda sql: F.expr(f"cast({sql} as string)")
    rows = table.select("t", show(responses.parse_response_sql("t")).alias("guarded"), show("try_parse_json(t)").alias("plain")).collect()
    assert [r.t for r in rows if r.guarded != r.plain] == []
    monkeypatch.setattr(responses, "_JSON_START", "^x")
    assert table.select(show(responses.parse_response_sql("t")).alias("v")).filter("v is not null").count() == 0
