"""Column functions on private values: normal forms, opaque ids, redaction, tolerant parsing, spans of time."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Typographic quotes and dashes, and what stands for them.
TYPOGRAPHIC, PLAIN = "‘’“”–—", "''\"\"--"


def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def normalized(text: Column) -> Column:
    """NFKC (no function of Spark's does it, so an Arrow batch), plain quotes and dashes, white space collapsed."""
    return F.trim(F.regexp_replace(F.translate(F.pandas_udf(_nfkc, "string")(text), TYPOGRAPHIC, PLAIN), r"\s+", " "))


def private_value(value: Column, kind: Column, short_kinds: Sequence[str] = (), least: int = 3) -> Column:
    """P10: trimmed and collapsed; null if shorter than `least` and not of a kind that may be short."""
    clean = F.trim(F.regexp_replace(value, r"\s+", " "))
    return F.when((F.length(clean) >= least) | (F.coalesce(kind.isin(*short_kinds), F.lit(False)) if short_kinds else F.lit(False)), F.nullif(clean, F.lit("")))


def collision_key(value: Column) -> Column:
    """P12, V05."""
    return F.lower(F.trim(value))


def opaque(prefix: str, *parts: Column, digits: int = 12) -> Column:
    """The first digits of a hash of the parts, null parts being empty, so that places don't shift."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, digits))


def path_name(path: Column) -> Column:
    """T09."""
    return F.regexp_replace(path, "[^a-zA-Z0-9_/-]", "_")


def _any_of(values: Sequence[str]) -> str:
    """A pattern for any of the literals, longer ones first; a boundary only beside a word character."""
    edge = lambda v, i: r"\b" if v[i].isalnum() or v[i] == "_" else ""
    return "(?i)(?:" + "|".join(edge(v, 0) + r"\Q" + v.replace(r"\E", r"\E\\E\Q") + r"\E" + edge(v, -1) for v in sorted({v for v in values if v}, key=lambda v: (-len(v), v))) + ")"


def stripped_of(text: Column, values: Sequence[str], by: str = "[REDACTED]") -> tuple[Column, Column]:
    """(text without the values, how many were replaced); case is not looked at, and longer values go first."""
    if not any(values):
        return text, F.when(text.isNotNull(), F.lit(0))
    pattern = _any_of(values)
    return F.regexp_replace(text, pattern, by.replace("\\", r"\\").replace("$", r"\$")), F.regexp_count(text, F.lit(pattern))


def redacted_map(metadata: Column, values: Sequence[str], skip: Sequence[str] = (), by: str = "[REDACTED]") -> Column:
    """A map whose values lose the private values, but for the keys in `skip`."""
    keep = (lambda k: k.isin(*skip)) if skip else (lambda k: F.lit(False))
    return F.transform_values(metadata, lambda k, v: F.when(keep(k), v).otherwise(stripped_of(v, values, by)[0]))


def json_within(text: Column, schema: str) -> Column:
    """The object from the first brace to the last of a text, fenced or not; null if that is no JSON object."""
    found = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(found).isNotNull(), F.from_json(found, schema))


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """How many characters two ranges share."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def spans_years(first: Column, last: Column, years: float = 9.0) -> Column:
    """Whether two days are at least so many years of 365.25 days apart; null dates are no evidence."""
    return F.coalesce(F.datediff(last, first) / 365.25 >= years, F.lit(False))


def lookback(day: Column, years: int) -> Column:
    """The same day so many years before; 29 February becomes the 28th."""
    return F.add_months(day, -12 * years)
