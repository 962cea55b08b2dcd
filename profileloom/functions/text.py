"""Text expressions: HTML to text, whitespace, normalisation, hashing."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from profileloom.fixed_values import CLEAN_TEXT_DROPS, VISIBLE_TEXT_DROPS

# One tag: a quoted value counts only after "=", so a stray apostrophe cannot
# swallow text. Possessive, hence linear and without regex-engine recursion.
TAG_BODY = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""
ANY_TAG = rf"<[a-zA-Z/!?]{TAG_BODY}>"
COMMENT = r"<!--.*?(?:-->|\z)"
UNICODE_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
# Element names whose content the tokenizer never reads as markup.
OPAQUE_ELEMENTS = ["script", "style"]
# Elements that have no end tag.
VOID_ELEMENTS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
]


def _element(name: str) -> str:
    return rf"<{name}(?=[\s/>]){TAG_BODY}>.*?(?:</{name}\s*+>|\z)"


def _tag(names: list[str], closing: str = "") -> str:
    return rf"<{closing}(?:{'|'.join(names)})(?=[\s/>]){TAG_BODY}>"


def _closed(names: list[str]) -> str:
    """A dropped element that is closed and holds no dropped one's tags."""
    tags = "|".join(names)
    return (
        rf"<({tags})(?=[\s/>]){TAG_BODY}>"
        rf"(?:[^<]++|<(?!/?(?:{tags})[\s/>]))*+</\1\s*+>"
    )


def _without(text: Column, drops: list[str], gap: str) -> Column:
    """Text pieces of a page outside the dropped elements, by walking its tags with a stack.

    A closing tag closes its element and whatever is open inside it; one that closes
    nothing is ignored. The walk carries the open elements, those of one name in a row as
    one entry, and a range of pieces for each dropped element, so its cost grows with the
    number of tags, not with its square.
    """
    tags = F.regexp_extract_all(text, F.lit(ANY_TAG), F.lit(0))
    named = F.transform(
        tags,
        lambda tag: F.struct(
            F.lower(F.regexp_extract(tag, r"^</?([a-zA-Z][^\s/>]*)", 1)).alias("name"), tag.startswith("</").alias("ends")
        ),
    )
    entry, ranges = "array<struct<name:string,n:int>>", "array<struct<start:int,size:int>>"
    start = F.struct(
        F.array().cast(entry).alias("open"), F.lit(0).alias("from"), F.lit(0).alias("at"), F.lit(0).alias("since"),
        F.array().cast(ranges).alias("shown"),
    )

    def range_to(state: Column, at: Column) -> Column:
        own = F.struct(state["since"].alias("start"), (at - state["since"] + 1).alias("size"))
        return F.concat(state["shown"], F.array(own))

    def step(state: Column, tag: Column) -> Column:
        stack, size, name = state["open"], F.size(state["open"]), tag["name"]
        opens = ~tag["ends"] & (name != "") & ~name.isin(VOID_ELEMENTS)
        top = F.try_element_at(stack, F.lit(-1))
        place = size + 1 - F.array_position(F.reverse(F.transform(stack, lambda e: e["name"])), name).cast("int")
        closes = tag["ends"] & (place <= size)
        drop = opens & (state["from"] == 0) & name.isin(drops)
        again = opens & ~drop & (size != state["from"]) & top["name"].eqNullSafe(name)
        one = lambda n: F.array(F.struct(name.alias("name"), n.cast("int").alias("n")))
        left = F.try_element_at(stack, F.greatest(place, F.lit(1)))["n"] - 1
        below = F.slice(stack, F.lit(1), F.greatest(place - 1, F.lit(0)))
        opened = (
            F.when(again, F.concat(F.slice(stack, F.lit(1), F.greatest(size - 1, F.lit(0))), one(top["n"] + 1)))
            .when(opens, F.concat(stack, one(F.lit(1))))
            .when(closes & (left > 0), F.concat(below, one(left)))
            .when(closes, below)
            .otherwise(stack)
        )
        shows = closes & (state["from"] > 0) & (place <= state["from"])
        return F.struct(
            opened.alias("open"),
            F.when(drop, size + 1).when(shows, 0).otherwise(state["from"]).alias("from"),
            (state["at"] + 1).alias("at"),
            F.when(shows, state["at"] + 1).otherwise(state["since"]).alias("since"),
            F.when(drop, range_to(state, state["at"])).otherwise(state["shown"]).alias("shown"),
        )

    end = lambda s: F.when(s["from"] == 0, range_to(s, s["at"])).otherwise(s["shown"])
    parts = F.struct(F.split(text, ANY_TAG, -1).alias("pieces"), F.aggregate(named, start, step, end).alias("shown"))
    # Bound once: a lambda would split the text again for every range.
    kept = F.transform(
        F.array(parts),
        lambda p: F.flatten(F.transform(p["shown"], lambda r: F.slice(p["pieces"], r["start"] + 1, r["size"]))),
    )
    return F.array_join(F.flatten(kept), gap)


def collapse_space(text: Column) -> Column:
    """Runs of Unicode whitespace become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, UNICODE_SPACE, " "))


def _windows_1252() -> dict[int, int]:
    """What HTML reads numeric references to the C1 range as: the bytes of Windows-1252."""
    decoded = {code: bytes([code]).decode("cp1252", "ignore") for code in range(0x80, 0xA0)}
    return {code: ord(char) for code, char in decoded.items() if char}


def decode_entities(text: Column) -> Column:
    """Named and numeric character references, decoded once, left to right.

    All HTML5 names count, always with their semicolon; so do numbers with any leading
    zeros, and numbers of the C1 range as Windows-1252.
    """
    known = {name[:-1]: value for name, value in html5.items() if name.endswith(";") and name != "amp;"}
    # One literal, which is folded to a map: thousands of nodes would slow every plan down.
    packed = "\x02".join(f"{name}\x01{value}" for name, value in known.items())
    names = F.str_to_map(F.lit(packed), F.lit("\x02"), F.lit("\x01"))
    moved = F.expr("map(" + ", ".join(f"{a}L, {b}L" for a, b in _windows_1252().items()) + ")")

    def from_code(code: Column) -> Column:
        code = F.coalesce(F.try_element_at(moved, code), code)
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        encoded = F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0"))
        return F.decode(encoded, "UTF-32")

    def decode_piece(piece: Column, position: Column) -> Column:
        name = F.regexp_extract(piece, r"^(#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        decimal = F.regexp_extract(name, r"^#0*([0-9]{1,7})$", 1)
        hexadecimal = F.regexp_extract(name, r"^#[xX]0*([0-9a-fA-F]{1,6})$", 1)
        char = (
            F.when(name == "", None)
            .when(name == "amp", "&")
            .when(name.rlike("^#[xX]"), from_code(F.conv(hexadecimal, 16, 10).cast("bigint")))
            .when(name.startswith("#"), from_code(decimal.try_cast("bigint")))
            .otherwise(F.try_element_at(names, name))
        )
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        decoded = F.concat(char, rest)
        return F.when(position == 0, piece).otherwise(
            F.coalesce(decoded, F.concat(F.lit("&"), piece))
        )

    pieces = F.transform(F.split(text, "&"), decode_piece)
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def strip_markup(html: Column, drop: list[str], gap: str) -> Column:
    """Text of an HTML page without the ``drop`` elements; tags become ``gap``.

    Comments and raw-text elements go first in one left-to-right pass, since
    their content may look like markup. Dropped elements that are closed and hold no
    others go with one more expression; only a page that has tags of dropped elements
    left, being nested or never closed, is walked tag by tag. At last go all other tags.
    """
    opaque = [name for name in drop if name in OPAQUE_ELEMENTS]
    nested = [name for name in drop if name not in OPAQUE_ELEMENTS]
    first = "(?is)" + "|".join([COMMENT, *map(_element, opaque)])
    text = F.regexp_replace(html, first, gap)
    if nested:
        simple = F.regexp_replace(text, "(?is)" + _closed(nested), gap)
        left = simple.rlike("(?is)" + _tag(nested))
        return decode_entities(
            F.when(left, _without(text, nested, gap)).otherwise(F.regexp_replace(simple, ANY_TAG, gap))
        )
    return decode_entities(F.regexp_replace(text, ANY_TAG, gap))


def clean_text(html: Column) -> Column:
    """Readable text of a page: noise elements dropped, text nodes spaced; never null."""
    text = collapse_space(strip_markup(html, CLEAN_TEXT_DROPS, " "))
    return F.coalesce(text, F.lit(""))


def visible_text(html: Column) -> Column:
    """Text a visitor could see, navigation included, text nodes joined without a gap."""
    text = collapse_space(strip_markup(html, VISIBLE_TEXT_DROPS, ""))
    return F.coalesce(text, F.lit(""))


def normalise_alnum(text: Column) -> Column:
    """Letters and digits only, lower case; null becomes the empty string."""
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]", "")
    return F.lower(kept)


def normalise_currency(code: Column) -> Column:
    """Trimmed, upper-case currency code."""
    return F.upper(F.trim(code))


def has_digit(text: Column) -> Column:
    """Whether any decimal digit occurs."""
    return text.rlike(r"\p{Nd}")


def content_hash(text: Column) -> Column:
    """SHA-256 of the UTF-8 text, in hex."""
    return F.sha2(text, 256)
