"""Extractors that fail, and answers kept across runs."""

import json

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F
from tests.test_runs import by_name, profiles, run_ts, snapshot

from profileloom.fixed_values import CATEGORIES
from profileloom.operators.extractor import BATCH_ROWS, guarded_answers, stored_answers
from profileloom.plans.pipeline import run
from profileloom.runtime import materialise

REQUEST = "ek string, category string, system_message string, user_message string, temperature double, response_format string"


def requests(spark, n, parts=3):
    rows = [(f"e{i}", "about", "s", f"message {i}", 0.0, "json_object") for i in range(n)]
    return spark.createDataFrame(rows, REQUEST).repartition(parts)


def raising(bad, log=None, whole=True):
    def answer(batches):
        for batch in batches:
            if log:
                with open(log, "a") as file:
                    file.writelines(f"{m}\n" for m in batch["user_message"])
            if whole and batch["user_message"].isin(bad).any():
                raise ValueError("no answer to " + ", ".join(m for m in batch["user_message"] if m in bad))
            for i in range(len(batch)):
                row = batch.iloc[i : i + 1]
                if row["user_message"].iloc[0] in bad:
                    raise KeyError("row")
                yield row[["ek", "category"]].assign(content=row["user_message"])

    return answer


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("n", [1, 2, 700])
def test_only_the_failing_requests_fail(spark, n, whole):
    bad = [f"message {i}" for i in (0, 1, 5, 333, 334, 699) if i < n]
    found = guarded_answers(requests(spark, n), raising(bad, whole=whole), tasks=4).collect()
    assert len(found) == n > 0 and BATCH_ROWS < 700
    for row in found:
        message = "message " + row.ek[1:]
        assert (row.content is None, row.error is not None) == ((True, True) if message in bad else (False, False))
        assert row.content in (None, message)


def test_answers_of_the_wrong_form_are_failures(spark):
    def odd(batches):
        for batch in batches:
            yield batch[["ek"]]

    def nothing(batches):
        return iter(())

    assert all("KeyError" in r.error for r in guarded_answers(requests(spark, 5), odd).collect())
    assert guarded_answers(requests(spark, 5), nothing).count() == 0
    assert guarded_answers(requests(spark, 3), None).filter("error is null and content = '{}'").count() == 3
    assert guarded_answers(requests(spark, 0), odd).count() == 0


def test_a_stored_answer_is_never_asked_for_again(spark, tmp_path):
    log, store = tmp_path / "asked", str(tmp_path / "answers")
    twins = requests(spark, 20).unionByName(requests(spark, 20).withColumn("ek", F.concat("ek", F.lit("-twin"))))
    first = stored_answers(twins, raising(["message 3"], str(log), whole=False), store, tasks=2, rounds=3, batch_rows=1)
    assert first.count() == 40 and {r.ek for r in first.filter("error is not null").collect()} == {"e3", "e3-twin"}
    assert sorted(log.read_text().split("\n")[:-1]) == sorted(f"message {i}" for i in range(20))
    log.write_text("")
    second = stored_answers(requests(spark, 25), raising([], str(log)), store)
    assert second.filter("error is null").count() == 25
    asked = sorted(set(log.read_text().split("\n")[:-1]))
    assert asked == sorted(["message 3", *(f"message {i}" for i in range(20, 25))])
    assert {(r.ek, r.content) for r in second.collect()} == {(f"e{i}", f"message {i}") for i in range(25)}


def test_a_run_ended_half_way_keeps_what_it_had(spark, tmp_path):
    log, store = tmp_path / "asked", str(tmp_path / "answers")

    def dies(batches):
        for batch in batches:
            if batch["user_message"].isin(["message 7"]).any():
                raise SystemExit(3)  # not an error of a request: the task is lost
            yield from raising([], str(log))(iter([batch]))

    with pytest.raises(Exception):
        stored_answers(requests(spark, 12), dies, store, rounds=4, batch_rows=1)
    kept = spark.read.parquet(f"{store}/version=*") if (tmp_path / "answers").exists() and list((tmp_path / "answers").glob("version=*/_SUCCESS")) else None
    before = set() if kept is None else {r.content for r in kept.collect()}
    log.write_text("")
    assert stored_answers(requests(spark, 12), raising([], str(log)), store).count() == 12
    assert before.isdisjoint(log.read_text().split("\n")[:-1])


def test_a_failing_extractor_costs_its_entity_alone(spark, tmp_path):
    def answer(batches):
        for batch in batches:
            if (batch["ek"] == "Test U").any() and (batch["category"] == "tuition_fees").any():
                raise RuntimeError("model is away")
            about = json.dumps({"name": "N", "location": {"city": "Toronto", "country": "Canada"}, "institution_type": "public"})
            yield batch[["ek", "category"]].assign(content=about)

    pages = snapshot(spark).withColumn("status_code", F.lit(200)).withColumn("error", F.lit(None).cast("string")).withColumn("html", F.concat("html", F.lit("<p>x</p>")))
    for store in (None, str(tmp_path / "answers")):
        found = by_name(run(profiles(spark), pages, answer, 2026, run_ts(), answer_store=store).records)
        assert set(found) == {"Test U", "Other U"}
        assert found["Test U"].validation_flags[0].issue == "entity failed: RuntimeError: model is away"
        assert found["Test U"].field_confidence == {c: 0.0 for c in CATEGORIES} and len(found["Test U"].validation_flags) == 1
        assert found["Other U"].data.about.location.city == "Toronto"


def test_a_runs_requests_are_spread_over_tasks(spark):
    def answer(batches):
        for batch in batches:
            about = {"name": f"task {TaskContext.get().partitionId()}", "location": {"city": "C", "country": "Canada"}, "institution_type": "public"}
            yield batch[["ek", "category"]].assign(content=json.dumps(about))

    many = spark.range(64).selectExpr("cast(id as string) as name", "'Canada' as country", "concat('https://u', id, '.edu') as base_url")
    seeds = many.withColumn("seed_urls", F.create_map(F.lit("about"), F.array(F.concat("base_url", F.lit("/a")))))
    pages = many.select(F.concat("base_url", F.lit("/a")).alias("url"), F.lit(200).alias("status_code"), F.lit("<p>Text</p>").alias("html"), F.lit(None).cast("string").alias("error"))
    names = lambda **more: {r.data.about.name for r in run(seeds, pages, answer, 2026, run_ts(), materialise=materialise, **more).records.collect()}
    assert len(names()) > 4 and len(names(extractor_tasks=1)) == 1


def test_halved_batches_leave_one_frame(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(type(requests(spark, 1)), "mapInPandas", lambda frame, work, schema: seen.append(work) or frame)
    guarded_answers(requests(spark, 1), raising([f"message {i}" for i in range(0, 60, 7)]))
    frame = pd.DataFrame([(f"e{i}", "about", "s", f"message {i}", 0.0, "j") for i in range(60)], columns=[part.split()[0] for part in REQUEST.split(", ")])
    (found,) = seen[0](iter([frame]))
    assert len(found) == 60 and found["error"].notna().sum() == 9 and found["content"].isna().sum() == 9
