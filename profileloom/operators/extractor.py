"""The pluggable extraction step, guarded against requests it fails on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.sources.storage import append_version, read_all

Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

#: Requests an extractor is given at a time; a failure asks again for at most so many.
BATCH_ROWS = 256

ANSWER_SCHEMA = "request string, content string, error string"


def apply_extractor(requests: DataFrame, extractor: Extractor | None) -> DataFrame:
    """Answers ``(ek, category, content)`` to extraction requests; a failure ends the job.

    ``extractor`` maps batches of requests to batches of answers inside the
    tasks. It may be costly, so reusable categories must be filtered out of
    ``requests`` beforehand. Without one every answer is empty.
    """
    if extractor is None:
        return requests.select("ek", "category", F.lit("{}").alias("content"))
    key = requests.schema["ek"].dataType.simpleString()
    return requests.mapInPandas(extractor, f"ek {key}, category string, content string")


def _ask(extractor: Extractor, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Answers to a batch with an ``error`` for each request the extractor fails on.

    What was answered before a failure counts. Of the rest, halves are asked again until
    a single request fails alone.
    """
    got, failure = [], None
    try:
        for answers in extractor(iter([batch])):
            got.append(answers[["ek", "category", "content"]].assign(error=None))
    except Exception as problem:  # noqa: BLE001  whatever the user's function raises
        failure = problem
    yield from got
    if failure is None:
        return
    done = {pair for answers in got for pair in zip(answers["ek"], answers["category"], strict=True)}
    left = batch[[pair not in done for pair in zip(batch["ek"], batch["category"], strict=True)]]
    if len(left) == 1:
        said = f"{type(failure).__name__}: {failure}"
        yield left[["ek", "category"]].assign(content=None, error=said)
    elif len(left) < len(batch):
        yield from _ask(extractor, left) if len(left) else ()
    else:
        half = len(left) // 2
        yield from _ask(extractor, left.iloc[:half])
        yield from _ask(extractor, left.iloc[half:])


def guarded_answers(
    requests: DataFrame,
    extractor: Extractor | None,
    tasks: int | None = None,
    batch_rows: int = BATCH_ROWS,
    carry: str | None = None,
) -> DataFrame:
    """``(ek, category, content, error)``: like ``apply_extractor``, but a request the
    extractor raises on, or answers with anything but the declared columns, comes back
    with an error and no content, and harms no other request.

    The extractor is called once for each ``batch_rows`` requests, so set-up that should
    happen once in a worker belongs outside of it. ``tasks`` spreads the calls over that
    many tasks, however few the requests' partitions are. ``carry`` names a column that
    goes from a request to its answers unseen by the extractor.
    """
    if extractor is None:
        return apply_extractor(requests, None).withColumn("error", F.lit(None).cast("string"))
    key = requests.schema["ek"].dataType.simpleString()
    columns = ["ek", "category", "content", "error"]
    schema = f"ek {key}, category string, content string, error string"
    if carry:
        columns, schema = [*columns, carry], f"{schema}, {carry} {requests.schema[carry].dataType.simpleString()}"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shown = batch.drop(columns=[carry]) if carry else batch
            of = dict(zip(zip(batch["ek"], batch["category"], strict=True), batch[carry], strict=True)) if carry else {}
            for start in range(0, len(batch), batch_rows):
                # One frame a batch: halving leaves many short ones.
                parts = list(_ask(extractor, shown.iloc[start : start + batch_rows].reset_index(drop=True)))
                if not parts:
                    continue
                answers = pd.concat(parts, ignore_index=True)
                if carry:
                    pairs = zip(answers["ek"], answers["category"], strict=True)
                    answers = answers.assign(**{carry: [of.get(pair) for pair in pairs]})
                yield answers[columns]

    dealt = requests.repartition(tasks) if tasks else requests
    return dealt.mapInPandas(work, schema)


def request_key() -> F.Column:
    """What an answer depends on, hashed: all that the extractor is told but the entity's key."""
    told = F.to_json(F.struct("category", "system_message", "user_message", "temperature", "response_format"))
    return F.sha2(told, 256)


def stored_answers(
    requests: DataFrame,
    extractor: Extractor,
    store: str,
    tasks: int | None = None,
    rounds: int = 1,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Like ``guarded_answers``, with answers kept in the folder ``store`` across runs.

    Requests whose answers are stored aren't asked again, and equal requests of several
    entities are asked once. Answers are appended in ``rounds`` complete versions, so a run
    that ends half-way costs at most the answers of one round. Errors count for this
    run only: the next one asks again.
    """
    spark = requests.sparkSession
    asked = requests.withColumn("request", request_key())
    known = read_all(spark, store, ANSWER_SCHEMA).filter("error is null").select("request").distinct()
    todo = asked.join(known, "request", "left_anti").dropDuplicates(["request"])
    before = None
    for turn in range(rounds):
        part = todo if rounds == 1 else todo.filter(F.pmod(F.xxhash64("request"), F.lit(rounds)) == turn)
        answers = guarded_answers(part, extractor, tasks, batch_rows, carry="request")
        version = append_version(answers.filter("request is not null").select("request", "content", "error"), store)
        before = version if before is None else before
    every = read_all(spark, store, ANSWER_SCHEMA, numbered=True)
    counts = every.filter(F.col("error").isNull() | (F.col("version") >= before)).drop("version")
    return asked.select("ek", "category", "request").join(counts, "request").select("ek", "category", "content", "error")
