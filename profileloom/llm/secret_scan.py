"""Secrets in texts: known shapes, and windows of high entropy in candidate strings.

Everything is Spark expressions. Positions come from splitting a text at a pattern:
the lengths of the pieces and matches, summed up, are the matches' code points. A
candidate's entropy is followed by a window that slides one character at a time: one
count goes up, one goes down, and the sum of n*log2(n) over the counts changes by
those two terms only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The shapes of secrets, in the order in which their kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
ASSIGN_LEAST = 6
# Candidates of the entropy scan, and their character classes as
# (name, what the whole candidate looks like, alphabet, least entropy in bits).
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}+"
CLASSES = (
    ("entropy_hex", r"^[0-9]*[a-fA-F][0-9a-fA-F]*$", "0123456789abcdef", 3.0),
    (
        "entropy_base64",
        r"^(?=.*[0-9])(?=.*[A-Za-z])",
        "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-",
        3.7,
    ),
)
# What is known to be harmless. Of a candidate that holds a word, the windows
# that share a character with it are left alone; one that looks like another is as a whole.
WORDS = r"(?i)example|placeholder|changeme|x{4,}|0123456789|abcdefgh|12345678"
ALLOWED = (
    r"^[A-Za-z_/-]+$",
    r"^[0-9+/_-]+$",
    WORDS,
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?:[a-z]++[-_/])++[a-z0-9]{1,8}$",  # possessive: a plain repeated group recurses in Java
    r"^(.{1,4})\1++$",
)
KINDS = ("assign", "access", "hex", *(name for name, *_ in CLASSES))
REDACTED = "[SECRET]"
_BLANK = " "  # stands in no candidate
_OF_WORD = 100  # more than any alphabet has


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _n_log_n(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def _replaced(text: Column, pattern: str, value) -> Column:
    """The text with each match of the pattern put through ``value``; other texts are untouched."""
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")
    )
    pieces = F.transform(pairs, lambda x: F.concat(x["p"], F.coalesce(value(x["m"]), F.lit(""))))
    return F.when(text.rlike(pattern), F.array_join(pieces, "")).otherwise(text)


def _blank(match: Column) -> Column:
    return F.repeat(F.lit(_BLANK), F.length(match))


def _hot_windows(value: Column, alphabet: str, least: float) -> Column:
    """struct(first, last): from the first to the last window of ``WINDOW`` characters
    with ``least`` bits of entropy and no part of a harmless word, as offsets in the
    value; null without any.

    Events are +i for a character that enters and -i for one that leaves; one of a word
    enters as i + _OF_WORD.
    """
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(alphabet), c))
    leaving = F.concat(F.array_repeat(F.lit(0), WINDOW), codes)
    words = F.split(_replaced(value, WORDS, _blank), "")
    entering = F.when(
        value.rlike(WORDS), F.zip_with(codes, words, lambda i, c: F.when(c == _BLANK, i + _OF_WORD).otherwise(i))
    ).otherwise(codes)
    events = F.flatten(
        F.transform(F.arrays_zip(entering.alias("i"), leaving.alias("o")), lambda x: F.array(-x["o"], x["i"]))
    )
    most = WINDOW * (math.log2(WINDOW) - least) + 1e-9
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("seen"), F.lit(0).alias("clean"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )

    def slide(state: Column, event: Column) -> Column:
        step = F.signum(event).cast("int")
        code = F.abs(event) % _OF_WORD
        count = F.element_at(state["counts"], code)
        total = state["sum"] + _n_log_n(count + step) - _n_log_n(count)
        seen = state["seen"] + F.greatest(step, F.lit(0))
        clean = F.when(event > _OF_WORD, 0).otherwise(state["clean"] + F.greatest(step, F.lit(0)))
        hot = (step > 0) & (clean >= WINDOW) & (total <= most)
        return F.struct(
            F.transform(state["counts"], lambda n, i: F.when(i + 1 == code, n + step).otherwise(n)).alias("counts"),
            total.alias("sum"), seen.alias("seen"), clean.alias("clean"),
            F.when(hot, F.coalesce(state["first"], seen - WINDOW)).otherwise(state["first"]).alias("first"),
            F.when(hot, seen).otherwise(state["last"]).alias("last"),
        )

    def moved(state: Column, event: Column) -> Column:
        # An event of 0 or a gap at the end stands for nothing that enters or leaves.
        return F.when(F.coalesce(event, F.lit(0)) == 0, state).otherwise(slide(state, event))

    return F.aggregate(
        events, start, moved, lambda s: F.when(s["first"].isNotNull(), F.struct(s["first"], s["last"]))
    )


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with_kind(kind: int):
    return lambda h: F.struct(F.lit(kind).alias("kind"), h["first"].alias("first"), h["last"].alias("last"))


def _entropy(value: Column) -> Column:
    """struct(kind, first, last) of a candidate; null if it is allowed or plain."""
    found = F.lit(None)
    for name, looks, alphabet, least in reversed(CLASSES):
        own = F.lower(value) if alphabet == CLASSES[0][2] else value
        hot = _hot_windows(own, alphabet, least)
        found = F.when(value.rlike(looks), _bound(hot, _with_kind(KINDS.index(name)))).otherwise(found)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        if pattern == WORDS:
            continue  # decides window by window
        allowed = allowed | value.rlike(pattern)
    return F.when(~allowed, found)


def _matches(kind: int, pattern: str) -> Column:
    """array of (kind, match, gap): each match and the length of the piece before it.

    The rest behind the last match stands in an entry without match.
    """
    found = F.regexp_extract_all(_text(), F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(_text(), pattern, -1), F.length)
    rows = F.transform(
        F.arrays_zip(found.alias("m"), gaps.alias("g")),
        lambda x: F.struct(F.lit(kind).alias("kind"), x["m"].alias("match"), x["g"].alias("gap")),
    )
    return F.when(_text().rlike(pattern), rows)


def secret_spans(documents: DataFrame) -> DataFrame:
    """The secrets of every row of ``documents`` (doc_id, text, ...), one row each.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256 (of the spans of these three
    kinds as kind:start:end, by start, then kind) and spans (all spans, likewise, with
    the kinds of the entropy scan). Positions are code points, the end is exclusive.
    A span may lie in another. Null and empty texts have no spans and the hash of the
    empty text; null and repeated doc_ids and repeated rows are rows like others; other
    columns are ignored; an empty table gives none.
    """
    empty = "array<struct<kind:int,match:string,gap:int>>"
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    every = [F.coalesce(_matches(i, p), F.array().cast(empty)) for i, p in enumerate(patterns)]
    numbered = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = numbered.select("row", "doc_id", F.posexplode_outer(F.concat(*every)).alias("at", "f")).select(
        "row", "doc_id", "at", "f.kind", "f.match", "f.gap"
    )
    order = Window.partitionBy("row", "kind").orderBy("at")
    placed = found.repartition("row").select(
        "row", "doc_id", "kind", "match", (F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(order)
        - F.length("match")).alias("start"),
    )
    candidate = _entropy(F.col("match"))
    length = F.length("match")
    span = (
        F.when(F.col("match").isNull(), F.lit(None))
        .when((F.col("kind") == 0) & (F.length(F.regexp_extract("match", ASSIGN, 2)) < ASSIGN_LEAST), F.lit(None))
        .when(F.col("kind") < 3, F.struct(F.col("start"), F.col("kind"), (F.col("start") + length).alias("end")))
        .when(
            F.col("kind") == 3,
            _bound(candidate, lambda e: F.when(e["first"].isNotNull(), F.struct(
                (F.col("start") + e["first"]).alias("start"), e["kind"].alias("kind"), (F.col("start") + e["last"]).alias("end")))),
        )
    )
    spans = placed.select("row", "doc_id", span.alias("span"))
    names = F.array(*map(F.lit, KINDS))

    def joined(value: Column) -> Column:
        words = F.transform(value, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.array_join(words, ",")

    each = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list("span")).alias("spans"),
        *[F.count_if(F.col("span.kind") == i).alias(f"n_{KINDS[i]}") for i in range(3)],
    )
    return each.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with every secret in ``text`` replaced; all columns stay, no row leaves.

    Of an assignment only the value is replaced, of a candidate its hot windows. No
    candidate crosses the ends of a value, and every other secret lies in one candidate;
    so values go first, and within a candidate all secrets are found before any is
    replaced. Those that overlap or touch become one. Null texts stay null; ``n_chars``,
    where there is one, counts again for changed texts.
    """
    def assigned(match: Column) -> Column:
        value = F.length(F.regexp_extract(match, ASSIGN, 2))
        return F.when(value >= ASSIGN_LEAST, F.concat(F.left(match, F.length(match) - value), F.lit(REDACTED))).otherwise(match)

    def either(one: Column, other: Column) -> Column:
        """What is blank in either of two texts of one length."""
        pairs = F.arrays_zip(F.split(one, "").alias("a"), F.split(other, "").alias("b"))
        return F.array_join(F.transform(pairs, lambda x: F.when(x["a"] == _BLANK, x["a"]).otherwise(x["b"])), "")

    def candidate(match: Column) -> Column:
        access, hexes = (_replaced(match, pattern, _blank) for pattern in (ACCESS, HEX))
        shapes = F.when(match.rlike(ACCESS) & match.rlike(HEX), either(access, hexes)).when(match.rlike(HEX), hexes).otherwise(access)
        hot = lambda e: F.when(
            e["first"].isNotNull(),
            F.concat(
                F.left(shapes, e["first"]), F.repeat(F.lit(_BLANK), e["last"] - e["first"]),
                F.substring(shapes, e["last"] + 1, F.length(match)),
            ),
        ).otherwise(shapes)
        return F.regexp_replace(_bound(_entropy(match), hot), f"{_BLANK}+", REDACTED)

    text = F.col("text")
    clean = documents
    for pattern, value in ((ASSIGN, assigned), (CANDIDATE, candidate)):
        clean = clean.withColumn("text", _replaced(text, pattern, value))
    if "n_chars" in documents.columns:
        clean = clean.withColumn("n_chars", F.when(text.isNotNull(), F.length(text)).otherwise(F.col("n_chars")).cast(documents.schema["n_chars"].dataType))
    return clean
