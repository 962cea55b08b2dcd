"""Lines that are just as a record is written are read in one go, any others as before."""

import json

from pyspark.sql import functions as F
from tests.test_record_reading import OPTIONS, lines
from tests.test_runs import stored

from profileloom.functions.dates import bind
from profileloom.operators import responses
from profileloom.sources import records as record_io

HEADS = ["", '"ord":7,', '"ek":7,', '"ek":"é ß","ord":-7,', '"ek":1,"ek":2,', '"ord":07,', '"ord":"7",', '"data":1,', '"ek":"a\\"b",', '"a":1,"b":2,', " ", '"ek":-,']


def tight(line):
    """The line without white space between its tokens, if it is JSON."""
    try:
        return json.dumps(json.loads(line), separators=(",", ":"), ensure_ascii=False)
    except ValueError:
        return line


def test_written_lines_and_plain_reading_agree(spark):
    whole = stored(spark).select(*record_io.RECORD_TYPE.fieldNames()).limit(1).select(F.to_json(F.struct("*"), OPTIONS)).first()[0]
    name = '"university_name":"'
    made = [tight(line) for line in lines(spark)]
    made += ["{" + head + whole[1:] for head in HEADS] + [whole + " ", whole[:-1], whole[1:], f"{whole}{whole}", whole.replace(name, name + "é\\t")]
    made += [whole.replace(name, name + other) for other in ("\\u00e9", "é", "\\/", "\t", "\\")]
    made += [whole.replace('"field_confidence":{', '"field_confidence":{' + more) for more in ('"about":0.5,', '"a":null,', '"z":0.5,', '"y":5,')]
    frame = spark.createDataFrame(list(enumerate(made)), "n int, line string").repartition(4).cache()
    plain = bind("try_parse_json(line)", "doc", bind(responses.typed_record_sql("doc"), "r", "if(r.ok, r.value, null)"))
    place = F.expr("try_variant_get(try_parse_json(line), '$.ord', 'bigint')")
    read = F.expr(responses.stored_record_sql("line", with_place=True))
    known = lambda text: None if text is None else json.loads(text)  # the order of a map's keys is no part of it
    got = {r.n: (known(r.t), r.place) for r in frame.select("n", read.alias("r")).select("n", F.to_json("r.record", OPTIONS).alias("t"), F.col("r.ord").alias("place")).collect()}
    expected = {r.n: (known(r.t), r.place if r.t else None) for r in frame.select("n", F.to_json(F.expr(plain), OPTIONS).alias("t"), place.alias("place")).collect()}
    frame.unpersist()
    assert [(made[n], got[n], expected[n]) for n in got if got[n] != expected[n]] == []
    assert 20 < sum(t is not None for t, _ in got.values()) < len(made)


def test_written_records_are_parsed_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    record_io.write_records(stored(spark).select(F.lit(7).alias("ek"), F.lit(5).alias("ord"), *record_io.RECORD_TYPE.fieldNames()), path)
    monkeypatch.setattr(responses, "typed_record_sql", lambda _: "named_struct('ok', raise_error('read twice') is null, 'value', null)")
    read = record_io.read_records(spark, path)
    assert read._jdf.queryExecution().analyzed().toString().count("try_parse_json(") == 1
    written = spark.read.text(path).withColumnRenamed("value", "line")
    kept = responses.FLAG_TYPE.simpleString()
    schema = f"university_name string, scraped_at string, data {record_io.RECORD_TYPE['data'].dataType.simpleString()}, field_confidence map<string,double>, validation_flags array<{kept}>"
    same = bind(f"from_json(line, '{schema}')", "k", responses._as_written_sql("line", "k"))
    assert [r.same for r in written.select(F.expr(same).alias("same")).collect()] == [True, True]
