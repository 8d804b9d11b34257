"""Masking by a registry of aliases: each alias has a policy, from which the forms in which it may stand in a text follow."""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .residual import finder

#: Words that are masked only as whole words, besides values of up to two characters.
COMMON = frozenset("A AN THE AND OR BUT FOR NOT IN ON AT TO BY OF WITH AS IS IT BE DO GO SO UP NO IF AM ME MY US WE HE SHE".split())
#: How specific a form is, for ties of priority and length.
SPECIFIC = {"url": 10, "email": 9, "ticker_exchange": 8, "ticker_parenthesized": 7, "ticker": 6, "cik_padded": 6, "accession": 6, "domain": 5, "possessive": 4, "dash_variant": 3, "space_variant": 3, "literal": 2}
#: Kinds whose handles in social media are masked as well.
HANDLES = ("company", "ticker", "brand")
#: What stands for a masked value, within which nothing is masked again.
PLACEHOLDER = re.compile(r"\[[A-Za-z0-9_ ]+\]")


@dataclass(frozen=True)
class Alias:
    """A private value; `by` is None if its entity is unknown, which makes it [REDACTED]."""

    alias_id: str
    value: str
    by: str | None = None
    priority: int = 0
    policy: str = "literal"
    kind: str = ""
    whole_word: bool = False
    mutations: tuple[str, ...] = ()


@dataclass(frozen=True)
class Form:
    alias_id: str
    kind: str
    pattern: str
    by: str
    priority: int
    insensitive: bool


def unsafe(value: str) -> bool:
    """P13."""
    clean = value.strip().upper()
    return len(clean) <= 2 or clean in COMMON


def _cik(value: str) -> str:
    bare = re.escape(value.lstrip("0"))
    return rf"CIK\s*#?\s*0*{bare}\b|\b0*{bare}\b"


def _accession(value: str) -> str:
    dashed = f"{value[:10]}-{value[10:12]}-{value[12:]}" if "-" not in value and len(value) == 18 else value
    return re.escape(dashed)


def _url(value: str) -> str:
    return rf"https?://(?:www\.)?{re.escape(value)}\S*|{re.escape(value)}"


def _exchange(value: str) -> str:
    return rf"(?:NYSE|NASDAQ|NYSE\s*Arca)\s*:\s*{re.escape(value.upper())}\b"


def _policies(value: str, bounded: Callable[[str], str]) -> dict[str, list[tuple[str, str, int]]]:
    """(form, pattern, how much it adds to the priority) by policy; policies that are not named here are literal.

    Parenthesised tickers, contextual CIKs and accessions in URLs have forms of their own (Q17)."""
    ticker, domain = value.upper(), re.escape(value)
    parenthesized = ("ticker_parenthesized", rf"\({re.escape(ticker)}\)")
    bare = re.escape(value.lstrip("0"))
    return {
        "ticker_exact": [("ticker", bounded(ticker), 0), ("ticker_exchange", _exchange(value), 10), (*parenthesized, 5)],
        "ticker_with_exchange": [("ticker_exchange", _exchange(value), 0)],
        "ticker_parenthesized": [(*parenthesized, 0)],
        "cik_padded": [("cik_padded", _cik(value), 0)],
        "cik_contextual": [("cik_padded", rf"(?:CIK\s*#?\s*|cik=)0*{bare}\b", 0)],
        "accession_dashed": [("accession", _accession(value), 0)],
        "accession_url_form": [("accession", rf"{_accession(value)}|{re.escape(value.replace('-', ''))}", 0)],
        "domain_full": [("url", _url(value), 0), ("domain", bounded(value), 5)],
        "domain_email": [("email", rf"[\w.+-]+@{domain}", 0)],
        "url_full": [("url", _url(value), 0)],
        "whitespace_variant": [("literal", r"\s+".join(re.escape(w) for w in value.split()), 0)],
    }


def forms(alias: Alias) -> list[Form]:
    """The forms of an alias. Longer values go first, so the length of the value adds to the priority."""
    value = alias.value
    if not value.strip():
        return []
    whole = alias.whole_word or unsafe(value)
    edge = lambda c: r"\b" if whole and (c.isalnum() or c == "_") else ""
    bounded = lambda v: edge(v[0]) + re.escape(v) + edge(v[-1])
    found = list(_policies(value, bounded).get(alias.policy, [("literal", bounded(value), 0)]))
    if alias.kind.lower() in HANDLES:
        found.append(("social_handle", rf"@{re.escape(value)}\w*", 20))
    if "possessive" in alias.mutations or alias.policy == "possessive":
        found.append(("possessive", rf"{re.escape(value)}(?:'s\b|')|{re.escape(value)}s'", 1))
    if "dash_variant" in alias.mutations:
        found += [(name, bounded(other), 2) for name, other in (("dash_variant", value.replace(" ", "-")), ("space_variant", value.replace("-", " "))) if other != value]
    base = alias.priority + len(value)
    return [Form(alias.alias_id, kind, pattern, alias.by or "[REDACTED]", base + more, alias.policy == "case_insensitive") for kind, pattern, more in found]


def core(value: str) -> str:
    """What stands in every form of a value, but for case: its longest run of letters, or of ten digits at most; leading zeros
    may be missing, and digits may be cut apart behind the tenth and the twelfth."""
    runs = [r for r in re.split(r"[\W_]+", value.lstrip("0")) if r]
    best = max(runs, key=len, default="")
    return best[: max(0, 10 - (len(value) - len(value.lstrip("0"))))] if best.isdigit() else best


def masker(aliases: list[Alias]) -> Callable[[str | None], tuple[str | None, list[tuple[int, int, str, str]], int]]:
    """T04 to T06 for one text: (masked text, accepted (start, end, alias, form), how many spans were rejected).

    Of overlapping spans that with the greater priority stays, then the longer, the more specific, the earlier, the smaller
    alias id. Matches that begin or end within a placeholder do not count; empty matches neither."""
    every = [(a, f) for a in aliases for f in forms(a)]
    compiled = [(f, re.compile(f.pattern, re.IGNORECASE if f.insensitive else 0)) for _, f in every]
    find = finder([(core(a.value),) for a, _ in every])

    def run(text: str | None):
        if not text:
            return text, [], 0
        present = [compiled[i] for i in sorted(find(text))]
        masks = [m.span() for m in PLACEHOLDER.finditer(text)]
        starts = [s for s, _ in masks]

        def inside(at: int) -> bool:
            i = bisect.bisect_right(starts, at) - 1
            return i >= 0 and masks[i][0] <= at < masks[i][1]

        found = {(-f.priority, m.start() - m.end(), -SPECIFIC.get(f.kind, 0), m.start(), f.alias_id, m.end(), f.kind, f.by) for f, p in present for m in p.finditer(text) if m.end() > m.start() and not inside(m.start()) and not inside(m.end() - 1)}
        kept: list[tuple[int, int, str, str, str]] = []  # by start; none overlap
        for _, _, _, start, alias, end, kind, by in sorted(found):
            i = bisect.bisect_left(kept, (start,))
            if (i == 0 or kept[i - 1][1] <= start) and (i == len(kept) or kept[i][0] >= end):
                kept.insert(i, (start, end, alias, kind, by))
        out, at = [], 0
        for start, end, _, _, by in kept:
            out += [text[at:start], by]
            at = end
        return "".join(out) + text[at:], [k[:4] for k in kept], len(found) - len(kept)

    return run


def mask_documents(docs: DataFrame, aliases: list[Alias], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, masked, spans, rejected) of every row, in Arrow batches; the registry goes to the workers with the task.

    Null and empty texts stay as they are, without spans; rows may repeat; further columns are not looked at. The plan does
    not grow with the number of aliases; what a worker holds is the registry and one batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = masker(aliases)
        for frame in frames:
            done = [mask(None if x is None else x) for x in frame["text"].astype(object).where(frame["text"].notna(), None)]
            spans = [[dict(zip(("start", "end", "alias_id", "form"), s, strict=True)) for s in d[1]] for d in done]
            yield pd.DataFrame({"id": frame["id"], "masked": [d[0] for d in done], "spans": spans, "rejected": [d[2] for d in done]})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInPandas(run, f"id {kind}, masked string, spans array<struct<start:int,end:int,alias_id:string,form:string>>, rejected int")
    return out.withColumnRenamed("id", id_col)


def alias_faults(aliases: DataFrame, entities: DataFrame) -> DataFrame:
    """(alias_id, fault) of (alias_id, entity_id, value) rows: unknown entity, empty, or a value that an earlier alias has."""
    key = F.lower(F.trim("value"))
    first = aliases.groupBy(key.alias("_key")).agg(F.min("alias_id").alias("_first"))
    known = entities.select(F.col("entity_id").alias("_entity")).distinct()
    both = aliases.withColumn("_key", key).join(first, "_key", "left").join(known, F.col("entity_id") == F.col("_entity"), "left")
    faults = F.array(F.when(F.col("_entity").isNull(), "unknown entity"), F.when(F.coalesce("_key", F.lit("")) == "", "empty value"), F.when((F.col("_first") != F.col("alias_id")) & (F.col("_key") != ""), "repeated value"))
    return both.select("alias_id", F.explode(F.array_compact(faults)).alias("fault"))
