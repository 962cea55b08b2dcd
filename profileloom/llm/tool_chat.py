"""Tool calls and results linked, ordered, validated and written as canonical JSON.

Calls stand in assistant messages whose text is JSON with ``tool_calls`` (id, name,
arguments, and optionally ``after``: ids of calls it builds on); results are messages
of role ``tool`` with ``tool_call_id`` and ``content``. Everything is Spark expressions
and joins on (conversation, identifier), so a conversation may be of any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CALLS = "tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>"
_RESULT = "tool_call_id string, content string"
# How types of JSON Schema begin among the types of parsed values.
_TYPES = {
    "string": ("STRING",), "integer": ("BIGINT",), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "null": ("VOID",),
}


def canonical(json: Column) -> Column:
    """JSON with sorted keys and no white space; null if it isn't JSON (repeated keys aren't)."""
    return F.to_json(F.try_parse_json(json))


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _object(**fields: Column) -> Column:
    """A JSON object of JSON values, keys sorted; null fields are left out."""
    pairs = [F.concat(F.lit(f'"{k}":'), fields[k]) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _levels(calls: Column) -> Column:
    """For each call of a message, the longest chain of calls of the message it builds on.

    Calls are found by their places once; then each round looks one call further, until
    nothing changes, or for as many rounds as there are calls: what is on a circle, or
    behind one, ends at or above that number.
    """
    ids = F.transform(calls, lambda c: c["id"])
    none = F.array().cast("array<string>")
    places = F.transform(
        calls,
        lambda c: F.transform(
            F.array_intersect(F.coalesce(c["after"], none), ids), lambda a: F.array_position(ids, a).cast("int") - 1
        ),
    )

    def chained(inner: Column) -> Column:
        def further(levels: Column) -> Column:
            return F.transform(
                inner, lambda after: F.coalesce(F.array_max(F.transform(after, lambda a: F.get(levels, a))) + 1, F.lit(0))
            )

        def round_(state: Column, _: Column) -> Column:
            both = lambda levels: F.struct(levels.alias("levels"), (levels == state["levels"]).alias("settled"))
            return F.when(state["settled"], state).otherwise(F.get(F.transform(F.array(further(state["levels"])), both), 0))

        start = F.struct(
            F.transform(inner, lambda _: F.lit(0)).alias("levels"),
            (~F.exists(inner, lambda after: F.size(after) > 0)).alias("settled"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(inner)), start, round_)["levels"]

    return F.get(F.transform(F.array(places), chained), 0)


def _faults(name: str, schema: dict) -> Column:
    """array of faults of ``args`` (parsed, canonical text in ``arguments``) against one schema."""
    faults = []
    for key in schema.get("required", []):
        faults.append(F.when(~F.array_contains(F.json_object_keys("arguments"), key), F.lit(f"{key}: missing")))
    for key, rule in schema.get("properties", {}).items():
        value = F.try_variant_get("args", f"$['{key}']", "variant")
        kind = F.schema_of_variant(value)
        here = F.array_contains(F.json_object_keys("arguments"), key)
        if "type" in rule:
            fits = reduce(lambda a, b: a | b, [kind.startswith(t) for t in _TYPES[rule["type"]]])
            faults.append(F.when(here & ~F.coalesce(fits, F.lit(False)), F.lit(f"{key}: not {rule['type']}")))
        for word, wrong in (("minimum", lambda x, y: x < y), ("maximum", lambda x, y: x > y)):
            if word in rule:
                number = F.try_variant_get("args", f"$['{key}']", "double")
                faults.append(F.when(here & wrong(number, F.lit(float(rule[word]))), F.lit(f"{key}: {word}")))
        if "minLength" in rule:
            text = F.try_variant_get("args", f"$['{key}']", "string")
            faults.append(F.when(here & (F.length(text) < rule["minLength"]), F.lit(f"{key}: minLength")))
        if "enum" in rule:
            text = F.try_variant_get("args", f"$['{key}']", "string")
            faults.append(F.when(here & ~F.coalesce(text.isin(rule["enum"]), F.lit(False)), F.lit(f"{key}: enum")))
    if schema.get("additionalProperties") is False:
        known = F.array(*map(F.lit, schema.get("properties", {}))).cast("array<string>")
        more = F.array_except(F.json_object_keys("arguments"), known)
        faults.append(F.when(F.size(more) > 0, F.lit("unknown arguments")))
    return F.filter(F.array(*faults, F.lit(None).cast("string")), lambda f: f.isNotNull())


def _checked(calls: DataFrame, schemas: dict[str, dict]) -> Column:
    """array of faults of a call's arguments; a tool without a schema is a fault."""
    found = F.array(F.lit("unknown tool"))
    for name, schema in schemas.items():
        found = F.when(F.col("name") == name, _faults(name, schema)).otherwise(found)
    broken = ~F.coalesce(F.schema_of_variant("args").startswith("OBJECT"), F.lit(False))
    return F.when(broken, F.array(F.lit("arguments: not an object"))).otherwise(found)


def link_tools(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message, call and result of ``messages`` (conv_id, turn, role, text, ...).

    Returns conv_id, turn, step, place, part, kind, id, status and json. Sorted by
    (conv_id, turn, step, place, part) a conversation is in topological order: messages by
    turn; the calls of a message by the longest chain of calls they build on (``step``),
    then as given; each result right behind its call. ``status`` of a call: ``ok``;
    ``invalid`` (arguments against the schema of its tool); ``repeated`` (an earlier
    call of the conversation has the id); ``bad reference`` (``after`` names no call of
    the message or of an earlier turn); ``cyclic``; ``unanswered``; the first that holds
    of invalid, repeated, bad reference, cyclic, unanswered. Of a result: ``ok``, or
    ``orphan`` (no such call), ``early`` (at a turn before its call, which it doesn't
    answer) and ``repeated``; those three stay at their own turn. A call
    without an id has the empty id. A text that isn't such JSON is a message, null is
    empty; null conv_ids make one conversation, null turns come first. Repeated rows
    repeat messages, and their calls and results count as repeated. Other columns are
    ignored; an empty table gives none.
    """
    rows = messages.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    might = F.col("text").rlike(r"^\s*\{")
    parsed = rows.select(
        "conv", "conv_id", "turn", "role", "text",
        F.when((F.col("role") == "assistant") & might, F.from_json("text", _CALLS)["tool_calls"]).alias("calls"),
        F.when((F.col("role") == "tool") & might, F.from_json("text", _RESULT)).alias("result"),
    )
    is_call = F.coalesce(F.size("calls"), F.lit(0)) > 0
    is_result = F.coalesce(F.col("result.tool_call_id").isNotNull(), F.lit(False))
    plain = parsed.filter(~is_call & ~is_result).select(
        "conv_id", "turn", F.lit(0).alias("step"), F.lit(0).alias("place"), F.lit(0).alias("part"),
        F.lit("message").alias("kind"), F.lit(None).cast("string").alias("id"), F.lit("ok").alias("status"),
        _object(role=_quoted(F.col("role")), content=_quoted(F.col("text"))).alias("json"),
    )

    each = parsed.filter(is_call).select(
        "conv", "conv_id", "turn", F.size("calls").alias("size"), "calls", _levels(F.col("calls")).alias("levels")
    ).select("conv", "conv_id", "turn", "size", F.expr("transform(calls, c -> c.id)").alias("ids"),
             F.posexplode(F.arrays_zip("calls", "levels")).alias("place", "x"))
    calls = each.select(
        "conv", "conv_id", "turn", "place", F.col("x.levels").alias("step"), F.coalesce("x.calls.id", F.lit("")).alias("id"),
        F.coalesce("x.calls.name", F.lit("")).alias("name"), (F.col("x.levels") >= F.col("size")).alias("cyclic"),
        F.array_except(F.coalesce("x.calls.after", F.array().cast("array<string>")), "ids").alias("outer"),
        F.try_parse_json("x.calls.arguments").alias("args"), F.coalesce("x.calls.arguments", F.lit("")).alias("raw"),
    ).withColumn("arguments", F.to_json("args"))
    calls = calls.select("*", _checked(calls, schemas).alias("faults")).drop("args")

    # Keyed by conversation and id: counted in the map tasks, joined by hash.
    first = calls.groupBy("conv", "id").agg(
        F.min(F.struct("turn", "place")).alias("first"), F.count_if(F.lit(True)).alias("copies")
    )
    referred = (
        calls.select("conv", "id", "turn", "place", F.explode("outer").alias("ref"))
        .join(first.select("conv", F.col("id").alias("ref"), F.col("first.turn").alias("ref_turn")), ["conv", "ref"], "left")
        .groupBy("conv", "id", "turn", "place")
        .agg(F.max((~F.coalesce(F.col("ref_turn") < F.col("turn"), F.lit(False))).cast("int")).alias("bad"))
    )
    answers = parsed.filter(is_result).select(
        "conv", "conv_id", "turn", F.col("result.tool_call_id").alias("id"), F.coalesce("result.content", F.lit("")).alias("content")
    )
    value = canonical(F.col("content"))
    nested = F.coalesce(value.rlike(r"^[\[{]"), F.lit(False))
    content = F.when(nested, value).otherwise(_quoted(F.col("content")))
    answers = answers.withColumn("content", content)
    call_turn = first.select("conv", "id", F.lit(True).alias("called"), F.col("first.turn").alias("call_turn"))
    is_early = F.coalesce(F.col("turn") < F.col("call_turn"), F.col("turn").isNull() & F.col("call_turn").isNotNull())
    # One row a turn before the calls are met, then the first that isn't early.
    answered = (
        answers.groupBy("conv", "id", "turn").agg(F.min("content").alias("content"))
        .join(call_turn, ["conv", "id"]).filter(~is_early)
        .groupBy("conv", "id").agg(F.min(F.struct("turn", "content")).alias("answer"))
    )

    linked = (
        calls.join(first, ["conv", "id"])
        .join(referred.select(*[F.col(k).alias(f"r_{k}") for k in ("conv", "id", "turn", "place")], "bad"),
              reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in ("conv", "id", "turn", "place")]), "left")
        .join(answered, ["conv", "id"], "left")
    )
    is_first = F.struct("turn", "place").eqNullSafe(F.col("first"))
    status = (
        F.when(F.size("faults") > 0, "invalid").when(~is_first, "repeated").when(F.col("bad") == 1, "bad reference")
        .when(F.col("cyclic"), "cyclic").when(F.col("answer").isNull(), "unanswered").otherwise("ok")
    )
    call_json = _object(
        type=F.lit('"call"'), id=_quoted(F.col("id")), name=_quoted(F.col("name")),
        arguments=F.coalesce("arguments", _quoted(F.col("raw"))),
        faults=F.when(F.size("faults") > 0, F.to_json("faults")),
    )
    result_json = lambda content: _object(type=F.lit('"result"'), id=_quoted(F.col("id")), content=content)
    both = F.array(
        F.struct(F.lit(0).alias("part"), F.lit("call").alias("kind"), status.alias("status"), call_json.alias("json")),
        F.struct(F.lit(1).alias("part"), F.lit("result").alias("kind"), F.lit("ok").alias("status"), result_json(F.col("answer.content")).alias("json")),
    )
    shown = F.when(is_first & F.col("answer").isNotNull(), both).otherwise(F.slice(both, 1, 1))
    out = linked.select("conv_id", "turn", "step", "place", "id", F.explode(shown).alias("x")).select(
        "conv_id", "turn", "step", "place", "x.part", "x.kind", "id", "x.status", "x.json"
    )

    # Results that stand behind no call: orphans, early ones, and all but one of the others.
    again = (
        answers.groupBy("conv", "conv_id", "id", "turn", "content").agg(F.count("*").alias("n"))
        .join(call_turn, ["conv", "id"], "left").join(answered, ["conv", "id"], "left")
        .withColumn("early", F.col("called").isNotNull() & is_early)
        .withColumn("n", F.col("n") - F.struct("turn", "content").eqNullSafe(F.col("answer")).cast("int"))
        .filter("n > 0")
    )
    left = again.select(
        "conv_id", "turn", F.lit(0).alias("step"), F.lit(0).alias("place"),
        F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("part"), F.lit("result").alias("kind"), "id",
        F.when(F.col("called").isNull(), "orphan").when(F.col("early"), "early").otherwise("repeated").alias("status"), result_json(F.col("content")).alias("json"),
    )
    return plain.unionByName(out).unionByName(left)


#: The tools of ``derived_calls``.
SCHEMAS = {
    "lookup": {
        "properties": {"words": {"type": "array"}, "length": {"type": "integer", "minimum": 1, "maximum": 2000}},
        "required": ["words", "length"], "additionalProperties": False,
    },
    "reply": {
        "properties": {"text": {"type": "string", "minLength": 20}, "lookup": {"type": "string"}},
        "required": ["text", "lookup"],
    },
}


def derived_calls(conversations: DataFrame) -> DataFrame:
    """Tool traffic made of every message of a plain chat log, for logs without any.

    A user's message becomes itself and two calls given in reverse order (``reply``
    builds on ``lookup``, and both on no other message); the assistant's next one answers
    the ``reply`` by its identifier.
    """
    text = F.coalesce("text", F.lit(""))
    name = lambda turn, which: F.concat_ws("", F.lit("c"), turn.cast("string"), F.lit(which))
    lookup = F.to_json(F.struct(F.slice(F.split(text, r"\s+"), 1, 3).alias("words"), F.length(text).alias("length")))
    reply = F.to_json(F.struct(text.alias("text"), name(F.col("turn"), "l").alias("lookup")))
    kind = "struct<id:string,name:string,arguments:string,after:array<string>>"
    none = F.array().cast("array<string>")
    called = F.to_json(F.struct(F.array(
        F.struct(name(F.col("turn"), "r"), F.lit("reply"), reply, F.array(name(F.col("turn"), "l"))).cast(kind),
        F.struct(name(F.col("turn"), "l"), F.lit("lookup"), lookup, none).cast(kind),
    ).alias("tool_calls")))
    answered = F.to_json(F.struct(name(F.col("turn") - 1, "r").alias("tool_call_id"), text.alias("content")))
    row = lambda role, value: F.struct(role.alias("role"), value.alias("text"))
    rows = (
        F.when(F.col("role") == "user", F.array(row(F.col("role"), text), row(F.lit("assistant"), called)))
        .when(F.col("role") == "assistant", F.array(row(F.lit("tool"), answered)))
        .otherwise(F.array(row(F.col("role"), text)))
    )
    return conversations.select("conv_id", "turn", F.explode(rows).alias("m")).select("conv_id", "turn", "m.role", "m.text")
