import json

import pytest
from pyspark.sql import functions as F

from profileloom.operators import assembly, responses
from profileloom.operators.extractor import apply_extractor
from profileloom.schemas import DOUBLE, LONG, Field

PLACE = '"location":{"city":"C","country":"Canada"}'
CASES = [
    ("about", '{"name":"U",%s,"institution_type":"public","founding_year":"1827"}' % PLACE, "loaded"),
    ("about", '```json\n{"name":"U",%s,"institution_type":"public"}\n```' % PLACE, "loaded"),
    ("about", '\n```\r\n{"name":"U",%s,"institution_type":"public"}\r\n```  \n' % PLACE, "loaded"),
    ("about", '{"name":"U",%s,"institution_type":"Public"}' % PLACE, "rejected"),
    ("about", '{"name":"U"}', "rejected"),
    ("about", "no json here", "empty"),
    ("about", "```", "empty"),
    ("about", "```{}```", "empty"),
    ("about", None, "empty"),
    ("about", '{"name":"U","location":null,"institution_type":"public"}', "rejected"),
    ("about", '{"name":"U",%s,"institution_type":"public","overall_ranking":{"rank":1}}' % PLACE, "rejected"),
    ("about", '[{"name":"U"}]', "rejected"),
    ("about", "5", "rejected"),
    ("about", "0", "empty"),
    ("about", "false", "empty"),
    ("about", '""', "empty"),
    ("about", "[]", "empty"),
    ("about", "null", "empty"),
    ("tuition_fees", '{"tuition_fees":[]}', "rejected"),
    ("graduate_employment", '{"employed_within_6_months_pct":84,"data_year":2023.5,"source_url":"u"}', "rejected"),
    ("graduate_employment", '{"employed_within_6_months_pct":84,"data_year":2023.0,"source_url":"u"}', "loaded"),
    ("graduate_employment", "{}", "empty"),
    ("visa_policies", '{"country":"C","visa_type":"V","key_requirements":["a",1],"source_url":"u"}', "rejected"),
    ("visa_policies", '{"country":"C","visa_type":"V","key_requirements":[],"source_url":"u"}', "loaded"),
]


@pytest.mark.parametrize("category", sorted({c for c, *_ in CASES}))
def test_status_of_answers(spark, category):
    rows = [(i, content) for i, (c, content, _) in enumerate(CASES) if c == category]
    frame = spark.createDataFrame(rows, "i int, content string")
    found = {r.i: r.status for r in responses.load_responses(frame, category).collect()}
    assert found == {i: CASES[i][2] for i, _ in rows}


NUMBERS = [
    ("7", 7, 7.0), ('"7"', 7, 7.0), ("7.0", 7, 7.0), ('" 7.00 "', 7, 7.0), ('"1_000"', 1000, 1000.0),
    ("true", 1, 1.0), ("7.5", None, 7.5), ('"7.5"', None, 7.5), ('"1e3"', None, 1000.0), ("1e3", 1000, 1000.0),
    ('"x"', None, None), ("[7]", None, None), ('"1d"', None, None), ("-3", -3, -3.0), ('"+4"', 4, 4.0),
    ("9007199254740993", 9007199254740993, 9007199254740992.0),
]


def test_numbers_are_read_leniently(spark):
    frame = spark.createDataFrame([(i, n) for i, (n, *_) in enumerate(NUMBERS)], "i int, n string")
    read = frame.withColumn("v", F.try_parse_json("n")).select(
        "i",
        F.expr(responses.read_sql("v", Field("n", LONG, True))).alias("whole"),
        F.expr(responses.read_sql("v", Field("n", DOUBLE, True))).alias("real"),
    )
    for row in read.collect():
        assert (row.whole.value, row.real.value) == NUMBERS[row.i][1:], NUMBERS[row.i]
        assert row.whole.ok == (NUMBERS[row.i][1] is not None)


def test_single_list_can_be_unwrapped(spark):
    fee = '{"programme_level":"phd","currency":"CAD","academic_year":"2025","source_url":"u"}'
    frame = spark.createDataFrame([('{"fees":[%s]}' % fee,), ("[%s]" % fee,), ('{"a":[],"b":[]}',)], "content string")
    found = responses.load_responses(frame, "tuition_fees", unwrap=True).collect()
    assert [r.status for r in found] == ["loaded", "loaded", "rejected"]
    assert found[0].value[0].currency == "CAD" and found[0].value[0].domestic_fee is None


FETCHED = "ek bigint, category string, rank int, url string, error string, clean_text string"


def test_texts_keep_plan_order_and_truncate_exactly(spark):
    rows = [
        (1, "about", 2, "u2", None, "bb"), (1, "about", 1, "u1", None, "aaa"), (1, "about", 3, "u3", "x", ""),
        (1, "about", 4, "u4", None, ""), (2, "about", 1, "u5", "x", ""),
        (3, "about", 1, "u6", None, "c" * 30), (3, "about", 2, "u7", None, "d" * 30),
    ]
    frame = spark.createDataFrame(rows, FETCHED)
    whole = {r.ek: r for r in assembly.assemble_texts(frame).collect()}
    assert whole[1].text == "aaa\n\nbb" and whole[1].source_urls == "u1, u2, u3, u4"
    assert whole[2].text == ""
    for limit in (5, 7, 29, 30, 31, 33, 61, 62, 63):
        cut = {r.ek: r.text for r in assembly.assemble_texts(frame, limit).withColumn(
            "text", assembly.truncate_text(F.col("text"), limit)).collect()}
        for ek, row in whole.items():
            expected = row.text if len(row.text) <= limit else row.text[:limit] + "\n...[TRUNCATED]..."
            assert cut[ek] == expected


def test_requests_skip_blank_texts_and_reach_the_extractor(spark):
    rows = [(1, "about", "some text", "u1"), (2, "about", " ", "u2")]
    texts = spark.createDataFrame(rows, "ek bigint, category string, text string, source_urls string")
    requests = assembly.extraction_requests(texts)
    request = requests.collect()
    assert [r.ek for r in request] == [1]
    assert json.loads(request[0].system_message.split("\n", 1)[1])["type"] == "struct"

    def echo(batches):
        for batch in batches:
            yield batch[["ek", "category"]].assign(content=batch["user_message"].str.upper())

    answer = apply_extractor(requests, echo).collect()[0]
    assert answer.content.endswith("SOME TEXT")
    assert apply_extractor(requests, None).collect()[0].content == "{}"
