from pyspark.sql import functions as F

from profileloom.operators import evaluation
from profileloom.schemas import DATA_TYPE, FLAG_TYPE, TRUTH_TYPE

RECORDS = f"university_name string, data string, flags string"


def joined(spark):
    truth = spark.createDataFrame(
        [
            ("T", '{"about":{"founding_year":1827,"institution_type":"Public"},"tuition_fees":[{"international_fee":45000.0,"currency":"CAD"},{"international_fee":0.0,"currency":"USD"}],"acceptance_rate":{"overall_pct":43.0},"course_listings":[{"code":"CSC 108","title":"Intro"},{"code":"","title":"x"}]}'),
            ("M", '{"about":{"founding_year":1853}}'),
            ("Gone", '{"about":{"founding_year":1900}}'),
        ],
        "university_name string, data string",
    ).withColumn("data", F.from_json("data", TRUTH_TYPE["data"].dataType))
    found = spark.createDataFrame(
        [
            ("T", '{"about":{"founding_year":1827,"institution_type":"public"},"tuition_fees":[{"international_fee":47250.0,"currency":"cad"}],"acceptance_rate":{"overall_pct":43.1},"course_listings":[{"code":"CSC108H1","title":"Intro to X"}]}', '[{"field":"about","severity":"HIGH"},{"field":"about","severity":"odd"}]'),
            ("M", '{"about":null}', "[]"),
        ],
        RECORDS,
    ).select(
        "university_name", F.from_json("data", DATA_TYPE).alias("data"),
        F.from_json("flags", f"array<{FLAG_TYPE.simpleString()}>").alias("validation_flags"),
    )
    return evaluation.join_truth(truth, found)


def test_scores(spark):
    found = {(r.category, r.university_name): (r.correct, r.checked) for r in evaluation.score_rows(joined(spark)).collect()}
    assert found["about", "T"] == (2, 2)
    assert found["tuition_fees", "T"] == (1, 2)
    assert found["acceptance_rate", "T"] == (0, 1)
    assert found["course_listings", "T"] == (1, 2)
    assert found["about", "M"] == (0, 1)
    assert found["living_costs", "T"] == (0, 0)
    assert not any(name == "Gone" for _, name in found)


def test_totals_and_matrix(spark):
    scores = evaluation.score_rows(joined(spark))
    cube = {(r.category, r.university_name): r for r in evaluation.accuracy_cube(scores).collect()}
    assert (cube[None, None].correct, cube[None, None].checked, cube[None, None].percent) == (4, 8, 50.0)
    assert cube["about", None].percent == 66.7
    assert cube["living_costs", None].percent is None
    wide = {r.university_name: r for r in evaluation.accuracy_matrix(scores).collect()}
    assert wide["T"].about == 100.0 and wide["M"].tuition_fees is None
    report = {r.category: r for r in evaluation.accuracy_matrix(scores, ["T", "M"]).collect()}
    assert report["about"].M == 0.0 and report["tuition_fees"].T == 50.0


def test_flags_and_gaps(spark):
    pairs = joined(spark)
    counts = {r.university_name: (r.high, r.medium, r.low) for r in evaluation.flag_counts(pairs).collect()}
    assert counts == {"T": (1, 0, 0), "M": (0, 0, 0), "Gone": (0, 0, 0)}
    gaps = {(r.university_name, r.category) for r in evaluation.known_gaps(pairs).collect()}
    assert ("Gone", "about") in gaps and ("M", "about") not in gaps and ("T", "visa_policies") in gaps
