"""Format-preserving pseudonyms of validated personal numbers, dates and addresses, by a keyed Feistel permutation.

A value is found by its form and checked (Luhn, IBAN modulus, calendar, octets, reserved numbers); its digits are permuted
within all values of the form, so the pseudonym is a valid value of the same form, separators stay, and equal values get
equal pseudonyms in every document, whatever their separators. The permutation is a bijection (it can be undone with the key)."""

from __future__ import annotations

import datetime
import hashlib
import re
import warnings
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free_name, give_back

#: The session setting that holds the key of the query and the pipeline, and the key of tests and trials, which hides nothing.
KEY_SETTING = "spark.cloakframe.pii.key"
TRIAL_KEY = b"cloakframe-test-key"
ROUNDS = 10


def session_key(spark: SparkSession) -> bytes:
    """The key in the session's settings; without one the published trial key, and a warning that it hides nothing."""
    found = spark.conf.get(KEY_SETTING, None)
    if not found:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms under the published trial key can be undone by anyone", stacklevel=2)
    return found.encode() if found else TRIAL_KEY


def feistel(value: int, low: int, high: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of the numbers 0 .. low * high - 1, seen as pairs (below low, below high)."""
    a, b = value % low, value // low
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        sign = -1 if back else 1
        if i % 2 == 0:
            a = (a + sign * _round(key, tweak, i, b)) % low
        else:
            b = (b + sign * _round(key, tweak, i, a)) % high
    return b * low + a


def _round(key: bytes, tweak: bytes, i: int, half: int) -> int:
    text = tweak + bytes([i]) + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
    return int.from_bytes(hashlib.blake2b(text, key=key[:64], digest_size=32).digest(), "big")


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False, valid: Callable[[int], bool] | None = None) -> int:
    """A keyed permutation of 0 .. size - 1, or of those of them that are valid, by walking a cycle of a larger one."""
    low = 1
    while low * low < size:
        low *= 10 if size > 100 else 2
    high = -(-size // low)
    while True:
        value = feistel(value, low, high, key, tweak, back)
        if value < size and (valid is None or valid(value)):
            return value


def _digits(text: str, key: bytes, tweak: bytes, back: bool, base: str = "0123456789") -> str:
    """The characters of text, all out of base, permuted among all strings of that length."""
    if not text:
        return text
    n = 0
    for c in text:
        n = n * len(base) + base.index(c)
    n, out = permute(n, len(base) ** len(text), key, tweak + bytes([len(text) % 256]), back), []
    for _ in text:
        n, r = divmod(n, len(base))
        out.append(base[r])
    return "".join(reversed(out))


def _put(text: str, digits: str, among: str = "0123456789") -> str:
    """text with its characters out of `among` replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in among else c for c in text)


def _only(text: str, among: str = "0123456789") -> str:
    return "".join(c for c in text if c in among)


def luhn(digits: str) -> int:
    """The check digit after these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _is_card(d: str) -> bool:
    return len(set(d)) > 1 and luhn(d[:-1]) == int(d[-1])


#: Lengths of the groups that card numbers are mostly written in.
_GROUPS = re.compile(r"1[3-9]|4 4 4 [1-7]|4 6 [45]|4 4 4 4 [1-3]|8 8")


@lru_cache(10_000)
def _cards(run: str, key: bytes, back: bool) -> list[tuple[int, int, str]]:
    """(start, end, pseudonym) of the card numbers in a run of digits over single separators.

    Every sequence of whole groups with 13 to 19 digits that passes Luhn's check may be one, if only its last group has fewer
    than three digits (dates, other numbers and tables have shorter ones, and one in ten passes by chance): the whole run comes first, then
    those in _GROUPS, then the earliest, then the longest. A pseudonym by which another sequence would come before is walked over (only possible
    beside further digits), so the same places are found in the new text and it can be undone."""
    spans = [m.span() for m in re.finditer(r"\d+", run)]
    flat, edges = _only(run), [0]
    for a, b in spans:
        edges.append(edges[-1] + b - a)
    shapes = []
    for i in range(len(spans)):
        for j in range(i + 1, len(edges)):
            n = edges[j] - edges[i]
            if n > 19:
                break
            if n >= 13 and all(b - a > 2 for a, b in spans[i : j - 1]):
                grouped = _GROUPS.fullmatch(" ".join(str(b - a) for a, b in spans[i:j]))
                shapes.append((0 if n == len(flat) else 1 if grouped else 2, edges[i], -n, i, j))
    shapes.sort()
    at: dict[int, list[int]] = {}
    for k, shape in enumerate(shapes):
        at.setdefault(shape[1], []).append(k)
    owner = [len(shapes)] * len(flat)  # of each digit the shape that has it
    chosen = []
    for k, (_, a, n, _, _) in enumerate(shapes):
        if min(owner[a : a - n]) == len(shapes) and _is_card(flat[a : a - n]):
            owner[a : a - n] = [k] * -n
            chosen.append(k)
    out = []
    for k in reversed(chosen) if back else chosen:
        _, a, n, i, j = shapes[k]
        rivals = [shapes[c] for x in range(a - 18, a - n) for c in at.get(x, ()) if c < k and x - shapes[c][2] > a and min(owner[x : x - shapes[c][2]]) >= c]
        body = flat[a : a - n - 1]
        while True:
            body = _digits(body, key, b"card", back)
            new = flat[:a] + body + str(luhn(body)) + flat[a - n :]
            if _is_card(new[a : a - n]) and not any(_is_card(new[x : x - m]) for _, x, m, _, _ in rivals):
                break
        flat = new
        start, end = spans[i][0], spans[j - 1][1]
        out.append((start, end, _put(run[start:end], flat[a : a - n])))
    return out


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _mod97(country: str, check: str, rest: str) -> int:
    return int("".join(str(int(c, 36)) for c in rest + country + check)) % 97


#: The lengths of IBANs by country.
_IBAN_LENGTHS = {
    c: int(n)
    for n, countries in (x.split(":") for x in (
        "15:NO;16:BE;18:DK FI FK FO GL NL SD;19:MK SI;20:AT BA EE KZ LT LU MN XK;21:CH HR LI LV;22:BG BH CR DE GB GE IE ME RS VA;23:AE GI IL IQ OM SO TL;24:AD CZ DZ ES MD PK RO SA SE SK TN VG;"
        "25:LY PT ST;26:IS TR;27:BF BI BJ CF CG CI CM CV DJ FR GA GQ GR IT KM MC MG ML MR MZ NE SM SN TD TG YE;28:AL AO AZ BY CY DO GT HN HU LB NI PL SV;29:BR EG PS QA UA;30:JO KW MU;31:MT SC;32:LC;33:RU"
    ).split(";"))
    for c in countries.split()
}


def _iban_end(text: str) -> int | None:
    """The end of the part of text that has its country's length, if it ends with a word there."""
    left = _IBAN_LENGTHS.get(text[:2], 0)
    for k, c in enumerate(text):
        left -= c != " "
        if left == 0:
            return k + 1 if text[k + 1 : k + 2] in ("", " ") else None
    return None


def _iban_value(text: str, m: re.Match) -> str:
    """What of a match to take: the part of its country's length if that is valid; else all, unless such a one starts in it."""
    start: re.Match | None = m
    while start and start.start() < m.end():
        end = _iban_end(start.group())
        if end and _iban(start.group()[:end], b"", False):
            return start.group()[:end] if start is m else ""
        start = _FOUND["iban"].search(text, start.start() + 1)
    return m.group()


def _iban(text: str, key: bytes, back: bool) -> str | None:
    flat = text.replace(" ", "")
    country, check, rest = flat[:2], flat[2:4], flat[4:]
    if not 15 <= len(flat) <= 34 or _mod97(country, check, rest) != 1:
        return None
    rest = _put(rest, _digits(_only(rest), key, b"iban" + country.encode(), back))
    rest = _put(rest, _digits(_only(rest, _LETTERS), key, b"ibanletters" + country.encode(), back, _LETTERS), _LETTERS)
    out = iter(f"{country}{98 - _mod97(country, '00', rest):02d}{rest}")
    return "".join(c if c == " " else next(out) for c in text)


def _phone(text: str, key: bytes, back: bool) -> str | None:
    """Digits after the country code."""
    m = re.match(r"(\+\d{1,3}[ .-]?)?", text)
    head, rest = text[: m.end()], text[m.end() :]
    d = _only(rest)
    if not 7 <= len(d) <= 12:
        return None
    return head + _put(rest, _digits(d, key, b"phone", back))


def _ssn_ok(n: int) -> bool:
    area, group, serial = n // 10**6, n // 10**4 % 100, n % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    n = int(_only(text))
    if not _ssn_ok(n):
        return None
    return _put(text, f"{permute(n, 10**9, key, b'ssn', back, _ssn_ok):09d}")


def _ipv4(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    n = permute(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, key, b"ipv4", back)
    return ".".join(map(str, n.to_bytes(4, "big")))


_FIRST, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()


def _late(n: int) -> bool:
    """Whether a date's day is no month's number."""
    return datetime.date.fromordinal(n + _FIRST).day > 12


def _date(text: str, key: bytes, back: bool) -> str | None:
    """Year first, or day before month, or month before day where only that is a date.

    Dates with a day over 12 and the others are permuted among themselves, so every image reads in the order it was written
    in, and a date has one image however it is written."""
    a, b, c = re.split(r"[-/.]", text)
    orders = {"ymd": (a, b, c)} if len(a) == 4 else {"dmy": (c, b, a), "mdy": (c, a, b)}
    for order, (y, m, d) in orders.items():
        try:
            n = datetime.date(int(y), int(m), int(d)).toordinal() - _FIRST
        except ValueError:
            continue
        if not 0 <= n < _DAYS:
            return None
        late = _late(n)
        new = datetime.date.fromordinal(permute(n, _DAYS, key, b"date", back, lambda x: _late(x) == late) + _FIRST)
        fields = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        parts = iter([fields[x] for x in order])
        return re.sub(r"\d+", lambda _: next(parts), text)
    return None


_LOWERCASE = "abcdefghijklmnopqrstuvwxyz"


def _email(text: str, key: bytes, back: bool) -> str | None:
    """The name before the @: letters among letters, digits among digits; case and signs stay."""
    name, at, host = text.rpartition("@")
    low = name.lower()
    if len(low) != len(name):
        return None
    new = _put(low, _digits(_only(low, _LOWERCASE), key, b"email", back, _LOWERCASE), _LOWERCASE)
    new = _put(new, _digits(_only(low), key, b"emaildigits", back))
    return "".join(n.upper() if c.isupper() else n for c, n in zip(name, new, strict=True)) + at + host


def _secret(text: str, key: bytes, back: bool) -> str | None:
    """Long hexadecimal strings: keys and tokens."""
    if not any(c.isdigit() for c in text) or not any(c.isalpha() for c in text):
        return None
    low = _digits(text.lower(), key, b"secret", back, "0123456789abcdef")
    return low.upper() if text.isupper() else low


#: In order of preference at the same place.
KINDS: tuple[tuple[str, str, Callable[[str, bytes, bool], str | None]], ...] = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    ("secret", r"\b(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})\b", _secret),
    ("ipv4", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _ipv4),
    ("date", r"(?<![\d/.-])(?:\d{4}([-/.])\d\d\1\d\d|\d\d([-/.])\d\d\2\d{4})(?![\d]|[/.-]\d)", _date),
    ("ssn", r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d]|-\d)", _ssn),
    ("phone", r"(?<![\d.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d]|[.-]\d)|(?<![\d.+-])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\d]|[.-]\d)", _phone),
)
#: Where cards may be, between the other values.
_RUN = re.compile(r"(?<![\d.-])\d(?:[ -]?\d){12,}(?![\d]|[.-]\d)")
_FOUND = {name: re.compile(pattern) for name, pattern, _ in KINDS}
_RULE = {name: rule for name, _, rule in KINDS}
_HINT = re.compile(r"\d[\d .()/-]{5,}\d|@|[0-9a-fA-F]{32}|[A-Z]{2}\d\d")


def replacements(text: str, key: bytes, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym), without overlap: the earliest first, then by KINDS; an invalid value doesn't block.

    Card numbers are looked for in what is between the other values."""
    if not _HINT.search(text):
        return []
    found = []
    for order, (name, _, rule) in enumerate(KINDS):
        m = _FOUND[name].search(text)
        while m:
            value = m.group()
            if name == "iban":
                value = _iban_value(text, m)
            new = _known(name, value, key, back)
            if new is not None:
                found.append((m.start(), order, m.start() + len(value), name, new))
            # what fails may hide another that starts in it
            m = _FOUND[name].search(text, m.start() + (len(value) if new is not None or name != "iban" else 1))
    out, at = [], 0
    for start, _, end, name, new in [*sorted(found), (len(text), 0, len(text), "", "")]:
        if start >= at:
            for m in _RUN.finditer(text, at, start):
                out += [(m.start() + a, m.start() + b, "card", card) for a, b, card in sorted(_cards(m.group(), key, back))]
            if name:
                out.append((start, end, name, new))
            at = end
    return out


@lru_cache(100_000)
def _known(name: str, value: str, key: bytes, back: bool) -> str | None:
    return _RULE[name](value, key, back)


def _run(key: bytes, back: bool) -> Callable:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(column: pa.Array) -> pa.Array:
        texts, spans = [], []
        for value in column:
            text = value.as_py()
            found = replacements(text, key, back) if text else []
            if found:
                parts, at = [], 0
                for start, end, _, new in found:
                    parts += [text[at:start], new]
                    at = end
                text = "".join(parts) + text[at:]
            texts.append(text)
            spans.append([{"start": s, "end": e, "kind": k} for s, e, k, _ in found])
        out = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(spans, span)], ["text", "spans"])
        give_back()
        return out

    return run


def pseudonymise(rows: DataFrame, key: bytes, text_col: str = "text", back: bool = False, spans_col: str | None = "spans") -> DataFrame:
    """rows with the text's personal values replaced, and spans (start, end in the old text's characters, kind).

    back=True undoes it with the same key. Null and empty texts stay as they are, with no spans. All other columns, whatever
    their names, and all rows stay. The spans stand last, under spans_col (None: they are left out); if a column of rows has
    that name, in whatever case, it stays and the spans' name gets underscores until it is free. An empty table gives an
    empty result."""
    if not key:
        raise ValueError("a key is needed")
    done = F.arrow_udf(_run(key, back), "text string, spans array<struct<start:int,end:int,kind:string>>")(F.col(f"`{text_col}`").cast("string"))
    # one struct holds the row, so no name can clash with a helper's
    out = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), done.alias("done"))
    columns = [F.col("done.text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in rows.columns]
    if spans_col is not None:
        columns.append(F.col("done.spans").alias(free_name(rows, spans_col)))
    return out.select(*columns)
