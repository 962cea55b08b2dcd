"""Format-preserving pseudonyms of personal numbers and dates.

A value that passes its kind's validation is permuted within the kind's format by a
keyed Feistel network: a card number becomes another with a right check digit, a date
another date in the same notation. The permutation depends on the key and the kind
alone, so equal values stay equal across documents and nothing has to be looked up,
shuffled or stored; who holds the key can go back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import map_arrow, small_batches, sql_type, text_bytes

ROUNDS = 10
# The formats. Order decides where two kinds could begin at one place.
_FIRST_DAY, _DAYS = date(1900, 1, 1), 73_049  # up to 2099-12-31
_OTHERS = (
    r"(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}(?P<m1>[-/.])\d{1,2}(?P=m1)\d{1,2}|\d{1,2}(?P<m2>[-/.])\d{1,2}(?P=m2)\d{4})(?!\d|[./-]\d))"
    r"|(?P<phone>(?<![\d+])(?:\+1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d+])\+1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d+.-])[2-9]\d{2}(?P<m3>[.-])\d{3}(?P=m3)\d{4}(?![\d]|[.-]\d)"
    r"|(?<![\d+])\+(?!1[ .-])[1-9]\d{0,2}[ .-](?:\(?\d{1,5}\)?[ .-]?){1,4}(?<=\d)(?!\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
)
_NUMBERS = re.compile(_OTHERS + r"|(?P<card>(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]))", re.ASCII)
_OTHERS = re.compile(_OTHERS, re.ASCII)
_DIGITS = re.compile(r"\d+", re.ASCII)
_FAR = 64  # characters: more than any number has, with what stands around it
# The digit groups card numbers are usually written in.
_CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
#: Runs that hold whatever ``_NUMBERS`` can match: found fast, looked at closely.
_RUN = re.compile(r"[\d(+][\d()+ ./-]*\d", re.ASCII)
_NAME_END = re.compile(r"[A-Za-z0-9._+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
KINDS = ("email", "ip", "date", "phone", "ssn", "card")


def feistel(value: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """A keyed permutation of 0..size-1.

    Halves of a number below a*b >= size take turns in being shifted by a keyed hash of
    the other; what falls outside the range goes through again.
    """
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def mix(turn: int, half: int, modulus: int) -> int:
        data = f"{tweak}|{size}|{turn}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=16).digest(), "big") % modulus

    def once(x: int) -> int:
        left, right = divmod(x, b)
        for turn in range(ROUNDS):
            if turn % 2:
                right = (right + mix(turn, left, b)) % b
            else:
                left = (left + mix(turn, right, a)) % a
        return left * b + right

    def back(x: int) -> int:
        left, right = divmod(x, b)
        for turn in reversed(range(ROUNDS)):
            if turn % 2:
                right = (right - mix(turn, left, b)) % b
            else:
                left = (left - mix(turn, right, a)) % a
        return left * b + right

    step = back if inverse else once
    value = step(value)
    while value >= size:
        value = step(value)
    return value


def _luhn(digits: str) -> int:
    """The check digit of a number without it."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 - i % 2)
        total += n - 9 * (n > 9)
    return -total % 10


def _refill(shape: str, digits: str) -> str:
    """The shape with its digits replaced one by one."""
    left = iter(digits)
    return re.sub(r"\d", lambda _: next(left), shape)


Permute = Callable[[int, int, str], int]


def _is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and _luhn(digits[:-1]) == int(digits[-1]) and bool(digits.strip("0"))


def _card(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not _is_card(digits):
        return None
    body = f"{permute(int(digits[:-1]), 10 ** (len(digits) - 1), f'card{len(digits)}'):0{len(digits) - 1}d}"
    return _refill(text, body + str(_luhn(body)))


def _phone(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    abroad = re.match(r"\+(?!1[ .-]?[\d(])(\d+)", text)
    if abroad:  # the country's code stays
        code, rest = abroad[1], digits[len(abroad[1]) :]
        if not 6 <= len(rest) <= 15 - len(code):
            return None
        return _refill(text, code + f"{permute(int(rest), 10 ** len(rest), f'phone{code}|{len(rest)}'):0{len(rest)}d}")
    # Area codes begin with 2 to 9: numbers that have one get one.
    least, size = (2 * 10**9, 8 * 10**9) if digits[-10] > "1" else (0, 2 * 10**9)
    return _refill(text, digits[:-10] + f"{least + permute(int(digits[-10:]) - least, size, 'phone'):010d}")


def _ssn(text: str, permute: Permute) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    valid = lambda a, g, s: a not in (0, 666) and a < 900 and g and s
    if not valid(area, group, serial):
        return None
    # Numbers of valid areas, groups and serials, without gaps.
    place = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    place = permute(place, 898 * 99 * 9999, "ssn")
    rest, serial = divmod(place, 9999)
    area, group = divmod(rest, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ip(text: str, permute: Permute) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    number = permute(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, "ip")
    return ".".join(map(str, number.to_bytes(4, "big")))


def _date(text: str, permute: Permute) -> str | None:
    mark = re.search(r"[-/.]", text)[0]
    parts = text.split(mark)
    year_first = len(parts[0]) == 4
    year, second, third = (int(x) for x in (parts if year_first else parts[::-1]))
    month, day, american = second, third, False
    if not year_first and month > 12 >= day:  # month before day
        month, day, american = day, month, True
    try:
        place = (date(year, month, day) - _FIRST_DAY).days
    except ValueError:
        return None
    if not 0 <= place < _DAYS:
        return None
    while True:  # days above 12 stay so in any notation: then the order of day and month stays as plain as it was
        place = permute(place, _DAYS, "date")
        new = _FIRST_DAY + timedelta(place)
        if (new.day > 12) == (day > 12):
            break
    first, last = (new.day, new.month) if american else (new.month, new.day)
    pad = 2 if any(len(p) == 2 and p[0] == "0" for p in parts) or all(len(p) >= 2 for p in parts) else 1
    fields = [f"{new.year:04d}", f"{first:0{pad}d}", f"{last:0{pad}d}"]
    return mark.join(fields if year_first else fields[::-1])


def _email(text: str, permute: Permute) -> str | None:
    """Letters and digits of the name are permuted among letters and digits; the domain stays."""
    name, domain = text.rsplit("@", 1)
    value, size = 0, 1
    for c in name.lower():
        base = 26 if c.isalpha() else 10 if c.isdigit() else 1
        value, size = value * base + (ord(c) - ord("a") if base == 26 else int(c) if base == 10 else 0), size * base
    shape = re.sub(r"\d", "9", re.sub(r"[a-z]", "a", name.lower()))
    value, out = permute(value, size, f"email|{shape}|{domain.lower()}"), []
    for c in reversed(name):
        base = 26 if c.isalpha() else 10 if c.isdigit() else 1
        value, digit = divmod(value, base)
        letter = chr(digit + ord("a")) if base == 26 else str(digit) if base == 10 else c
        out.append(letter.upper() if c.isupper() else letter)
    return "".join(reversed(out)) + "@" + domain


_MAKERS = {"email": _email, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}


def _maker(key: bytes, inverse: bool):
    @lru_cache(maxsize=100_000)
    def make(kind: str, text: str) -> str | None:
        return _MAKERS[kind](text, lambda value, size, tweak: feistel(value, size, key, tweak, inverse))

    return make


Span = tuple[int, int, str]  # start, end, kind


def _mails(text: str) -> list[Span]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _NAME_END.match(text[start - 1]):
            start -= 1
        while start < at and not text[start].isalnum():
            start += 1
        domain = _DOMAIN.match(text, at)
        if domain and start < at:
            found.append((start, domain.end(), "email"))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return found


def _valid_part(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The card number of a stretch of digit groups: a valid one in usual groups, or else in one
    group, or else the longest; the first of equals.

    A number by its usual groups is found with or without other numbers beside it.
    """
    groups = [m.span() for m in _DIGITS.finditer(text, start, end)]
    best, rank = None, None
    for i, (a, _) in enumerate(groups):
        for j in range(i, len(groups)):
            sizes = tuple(y - x for x, y in groups[i : j + 1])
            if sum(sizes) > 19:
                break
            if _is_card("".join(text[x:y] for x, y in groups[i : j + 1])):
                now = (sizes in _CARD_GROUPS, len(sizes) == 1, sum(sizes))
                if rank is None or now > rank:
                    best, rank = (a, groups[j][1]), now
    return best


def _in_run(text: str, at: int, end: int, limit: int) -> list[Span]:
    """What looks like numbers of a run, up to ``limit``.

    A card number may stand next to other numbers: the parts of a run of digits are
    tried, up to where a number of another kind begins; if none is valid, the search
    goes on behind the run's first group.
    """
    found = []
    while match := _NUMBERS.search(text, at, end):
        start, at = match.span()
        kind = next(k for k in KINDS[1:] if match[k] is not None)
        if kind == "card":
            first = _DIGITS.match(text, start).end()
            other = _OTHERS.search(text, first, min(end, at + _FAR))
            part = _valid_part(text, start, min(at, limit, other.start() if other else at))
            if part is None:
                at = first
                continue
            start, at = part
        if at <= limit:
            found.append((start, at, kind))
    return found


def _found(text: str) -> list[Span]:
    """What looks like personal data; addresses first, none overlapping."""
    mails = _mails(text)
    out = list(mails)
    rest = iter([*mails, (len(text), len(text), "")])
    mail = next(rest)
    for run in _RUN.finditer(text):
        at = run.start()
        while at < run.end():
            while mail[2] and mail[1] <= at:
                mail = next(rest)
            if at < mail[0]:
                out += _in_run(text, at, min(run.end(), mail[0] + 1), min(run.end(), mail[0]))
            at = max(mail[1], at + 1) if mail[2] else run.end()
    return sorted(out)


def pseudonymise(text: str, make, found: list[Span] | None = None) -> tuple[str, list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what was replaced in the old and in the new text.

    A pseudonym depends on the key, the kind and the value alone, whatever stands beside
    it. Beside other numbers a new value may look like part of another; the spans of the
    new text, given as ``found`` on the way back, tell them apart.
    """
    parts, old, new, at, length = [], [], [], 0, 0
    for start, end, kind in _found(text) if found is None else found:
        value = make(kind, text[start:end])
        if value is not None:
            parts += [text[at:start], value]
            length += start - at
            old.append((kind, start, end))
            new.append((kind, length, length + len(value)))
            length, at = length + len(value), end
    return "".join([*parts, text[at:]]), old, new


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _read(spans: str) -> list[Span]:
    return [(int(a), int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(",") if s)]


def hide_personal_data(documents: DataFrame, key: bytes, inverse: bool = False) -> DataFrame:
    """Every row of ``documents`` (doc_id, text, ...) with pseudonyms for personal data.

    Returns doc_id, text, n_email, n_ip, n_date, n_phone, n_ssn, n_card, spans
    (kind:start:end in the old text, by start, comma-joined) and hidden_spans (likewise
    in the new text). Card numbers must have a right check digit; where other numbers
    stand next to one, usual groups of digits go before one group, that before the longest
    run of groups that has. Dates must exist between 1900 and 2099, addresses and numbers must
    keep their ranges; others stay as they are. Dates that could be read both ways count as
    day before month. Replaced values keep their length, but for addresses and dates written
    without leading zeros. Equal values of a kind have equal pseudonyms in every place.

    With ``inverse`` the pseudonyms go back to the values: those at ``hidden_spans`` where
    ``documents`` has that column, and all that is found where it has none or null, which may
    miss numbers that stand next to others. Null texts count as empty; null and repeated ids
    and repeated rows are rows like others; other columns are ignored; an empty table gives none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _maker(key, inverse)
        for batch in small_batches(batches, 2 << 20):
            rows = []
            for value, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows.append(pseudonymise(value.decode("utf-8", "replace"), make, None if known is None else _read(known)))
            counts = [pa.array([sum(s[0] == kind for s in old) for _, old, _ in rows], pa.int64()) for kind in KINDS]
            spans, hidden = (pa.array([_written(row[i]) for row in rows], pa.string()) for i in (1, 2))
            texts = pa.array([text.encode("utf-8", "surrogatepass").decode("utf-8", "replace") for text, *_ in rows], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), texts, *counts, spans, hidden], names=["doc_id", "text", *[f"n_{k}" for k in KINDS], "spans", "hidden_spans"]
            )

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    schema = f"doc_id {sql_type(documents, 'doc_id')}, text string, {counts}, spans string, hidden_spans string"
    known = F.col("hidden_spans").cast("string") if inverse and "hidden_spans" in documents.columns else F.lit(None).cast("string")
    return map_arrow(documents.select("doc_id", text_bytes().alias("text"), known.alias("known")), work, schema)
