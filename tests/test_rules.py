import json
from itertools import product

import pytest
from pyspark.sql import functions as F

from profileloom.fixed_values import CATEGORIES
from profileloom.operators import rules
from profileloom.schemas import DATA_TYPE

CLEAN = {
    "about": {
        "name": "U", "founding_year": 1827, "overall_ranking": {"rank": 1, "source": "S", "year": 2024},
        "location": {"city": "C", "country": "Canada"}, "institution_type": "public",
    },
    "tuition_fees": [{"programme_level": "ug", "domestic_fee": 6000.0, "international_fee": 45000.0, "currency": "CAD", "academic_year": "2025", "source_url": "u"}],
    "living_costs": {"city": "C", "monthly_rent": 1200.0, "monthly_food": 400.0, "monthly_transport": 150.0, "currency": "CAD", "source_url": "u"},
    "scholarships": [{"name": "A", "eligibility_criteria": "x", "application_deadline": "2025-01-15", "source_url": "u"}],
    "acceptance_rate": {"overall_pct": 43.0, "source_url": "u"},
    "graduate_employment": {"employed_within_6_months_pct": 84.0, "source_url": "u"},
    "average_salaries": [{"field_of_study": "CS", "median_salary": 85000.0, "currency": "CAD", "source_url": "u"}],
    "visa_policies": {"country": "Canada", "visa_type": "Study Permit", "key_requirements": ["x"], "source_url": "u"},
    "intake_deadlines": [{"intake_name": "Fall", "application_open_date": "2024-10-01", "application_close_date": "2025-01-15", "source_url": "u"}],
    "course_listings": [{"code": "C1", "title": "T", "credits": 0.5, "prerequisites": [], "source_url": "u"}],
}


def changed(**fields):
    data = json.loads(json.dumps(CLEAN))
    for path, value in fields.items():
        category, name = path.split("__")
        target = data[category][0] if isinstance(data[category], list) else data[category]
        target[name] = value
    return data


def validate(spark, data, country="Canada"):
    rows = spark.createDataFrame([(json.dumps(data), country)], "text string, country string")
    records = rows.select("country", F.from_json("text", DATA_TYPE).alias("data"))
    row = rules.validate_records(records, 2026).collect()[0]
    return [(f.field, f.rule_id, f.severity) for f in row.validation_flags], row.field_confidence


def test_clean_record(spark):
    flags, confidence = validate(spark, CLEAN)
    assert flags == []
    assert confidence == {c: 1.0 for c in CATEGORIES}


def test_currency_mismatch(spark):
    data = changed(tuition_fees__currency="USD", living_costs__currency="usd ", average_salaries__currency="USD")
    flags, confidence = validate(spark, data)
    assert [f[2] for f in flags] == ["high"] * 3
    assert [confidence[c] for c in ("tuition_fees", "living_costs", "average_salaries")] == [0.5] * 3
    assert validate(spark, data, "Brazil")[0] == []


def test_percentage_out_of_range(spark):
    flags, confidence = validate(spark, changed(acceptance_rate__overall_pct=150.0))
    assert flags == [("acceptance_rate", "R13", "high")]
    assert confidence["acceptance_rate"] == 0.5


def test_empty_list(spark):
    flags, confidence = validate(spark, {**CLEAN, "course_listings": []})
    assert flags == [("course_listings", "N11", "medium")]
    assert confidence["course_listings"] == 0.3 - 0.25


def test_fee_order(spark):
    flags, confidence = validate(spark, changed(tuition_fees__domestic_fee=6000.0, tuition_fees__international_fee=5000.0))
    assert flags == [("tuition_fees", "R8", "medium")]
    assert confidence["tuition_fees"] == 0.75


def test_clamp(spark):
    data = changed(tuition_fees__currency="USD", tuition_fees__domestic_fee=-1000.0, tuition_fees__international_fee=-2000.0)
    flags, confidence = validate(spark, data)
    assert [f[1] for f in flags] == ["R3", "R4", "R6", "R8"]
    assert confidence["tuition_fees"] == 0.0


def test_dates(spark):
    data = changed(
        scholarships__application_deadline="31/02/2025", intake_deadlines__application_open_date="2025-03-01",
        intake_deadlines__application_close_date="1/2/2025",
    )
    assert [f[1] for f in validate(spark, data)[0]] == ["R12", "R24"]
    described = changed(scholarships__application_deadline="Rolling", intake_deadlines__application_open_date="Fall 2025")
    assert [f[1] for f in validate(spark, described)[0]] == ["R22"]


def test_missing_flags_come_first_in_category_order(spark):
    data = {**changed(graduate_employment__employed_within_6_months_pct=100.0), "course_listings": [], "tuition_fees": []}
    assert [f[:2] for f in validate(spark, data)[0]] == [
        ("tuition_fees", "N11"), ("course_listings", "N11"), ("graduate_employment", "R16"),
    ]


def test_scores_from_counts_equal_a_scan_in_any_order(spark):
    weight = {"high": 0.5, "medium": 0.25, "low": 0.1}
    cases = [c for n in range(1, 4) for c in product(["high", "medium", "low"], repeat=n)]
    cases += [("low",) * n for n in range(4, 30)]
    rows = [(i, c.count("high"), c.count("medium"), c.count("low")) for i, c in enumerate(cases)]
    frame = spark.createDataFrame(rows, "i int, h bigint, m bigint, l bigint")
    scored = rules.score_from_counts(F.col("h"), F.col("m"), F.col("l"), F.lit(False))
    found = {r[0]: r[1] for r in frame.select("i", scored).collect()}
    for i, case in enumerate(cases):
        total = 0.0
        for severity in case:
            total += weight[severity]
        assert found[i] == max(0.0, min(1.0, 1.0 - total)), case


def test_long_layout_agrees_with_nested(spark):
    texts = [
        json.dumps(changed(tuition_fees__domestic_fee=fee, tuition_fees__currency=code))
        for fee, code in product([-1.0, 600000.0, None, 50000.0], ["CAD", "USD", "", " cad"])
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "ek bigint, text string").withColumn("country", F.lit("Canada"))
    records = rows.select("ek", "country", F.from_json("text", DATA_TYPE).alias("data"))
    nested = rules.validate_records(records, 2026).select(
        "ek", F.col("field_confidence")["tuition_fees"].alias("confidence"), F.explode("validation_flags").alias("f")
    )
    items = records.select("ek", F.posexplode("data.tuition_fees").alias("idx", "item")).select("ek", "idx", "item.*")
    long = rules.flag_rows("tuition_fees", items, 2026, records)
    expected = {(r.ek, r.f.rule_id, r.f.idx) for r in nested.collect()}
    assert {(r.ek, r.rule_id, r.idx) for r in long.collect()} == expected
    scores = rules.confidence_rows(records, {"tuition_fees": items}, 2026)
    found = {r.ek: r.confidence for r in scores.collect()}
    assert found == {r.ek: r.confidence for r in rules.validate_records(records, 2026).select(
        "ek", F.col("field_confidence")["tuition_fees"].alias("confidence")).collect()}


@pytest.mark.parametrize(
    "about, empty",
    [
        ({"name": "Unknown"}, True), ({"name": ""}, True),
        ({"founding_year": None, "overall_ranking": None, "institution_type": "unknown"}, True),
        ({"founding_year": None, "institution_type": "unknown"}, False),
    ],
)
def test_empty_about(spark, about, empty):
    flags, _ = validate(spark, {**CLEAN, "about": {**CLEAN["about"], **about}})
    assert (("about", "N11", "medium") in flags) == empty


@pytest.mark.parametrize("unrolled", [1, 4, 9])
def test_items_and_flags_behind_the_compiled_ones_count_alike(spark, monkeypatch, unrolled):
    monkeypatch.setattr(rules, "UNROLLED", unrolled)
    data = changed()
    fee, deadline = data["tuition_fees"][0], data["intake_deadlines"][0]
    data["tuition_fees"] = [{**fee, "domestic_fee": -1.0} if i % 2 else fee for i in range(7)]
    data["intake_deadlines"] = [{**deadline, "application_close_date": f"{i + 8}/13/20245"} for i in range(3)] + [deadline] * 3 + [
        {**deadline, "application_close_date": "1 May 2020"}
    ]
    data["course_listings"] = [{**data["course_listings"][0], "code": ""}] * 6
    rows = spark.createDataFrame([(json.dumps(data), "Canada")], "text string, country string")
    row = rules.validate_records(rows.select("country", F.from_json("text", DATA_TYPE).alias("data")), 2026).collect()[0]
    assert [(f.rule_id, f.idx) for f in row.validation_flags] == (
        [("R4", 1), ("R4", 3), ("R4", 5), ("R23", 0), ("R23", 1), ("R23", 2), ("R24", 6)] + [("R25", i) for i in range(6)]
    )
    low = 0.0
    for _ in range(6):
        low += 0.1
    assert row.field_confidence["course_listings"] == 1.0 - low
    assert (row.field_confidence["tuition_fees"], row.field_confidence["intake_deadlines"]) == (0.0, 0.0)
