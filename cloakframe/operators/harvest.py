"""Harvesting: candidates for private values from texts and metadata, and the rules by which persons and handles are admitted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trimmed
from .discovery import all_spans, spans

#: The detectors in order: name, pattern, category, confidence, characters of context, least length, group of the value.
DETECTORS: tuple[tuple[str, str, str, float, int, int, int], ...] = (
    ("regex:url", r"https?://(?:www\.)?[^\s<>\"']+", "url", 0.95, 30, 0, 0),
    ("regex:email", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "email", 0.95, 30, 0, 0),
    ("regex:phone", r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", "phone", 0.85, 20, 7, 0),
    ("regex:phone_international", r"\+\d{1,3}[-.\s]?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", "phone", 0.85, 20, 7, 0),
    ("regex:standalone_domain", r"\b(?:[a-zA-Z0-9-]+\.)+(?:com|org|net|edu|gov|io|co|ai|app)\b", "domain", 0.7, 20, 0, 0),
    ("regex:org_suffix", r"\b[A-Z][A-Za-z&]+(?:\s+[A-Z][A-Za-z&]+){0,4}\s+(?:Inc\.?|Corp\.?|LLC|Ltd\.?|PLC|LP|GmbH)\b", "organization", 0.6, 20, 5, 0),
    ("regex:org_company", r"\b[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,4}\s+(?:Company|Corporation|Incorporated)\b", "organization", 0.6, 20, 5, 0),
    ("regex:org_pair", r"\b[A-Z][A-Za-z]+(?:\s+(?:and|&)\s+[A-Z][A-Za-z]+)\b", "organization", 0.6, 20, 5, 0),
    ("regex:title_name", r"\b(?:Mr\.|Mrs\.|Ms\.|Dr\.|Prof\.|Sen\.|Rep\.|Gov\.)\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?", "person", 0.7, 20, 0, 0),
    ("regex:executive", r"\b(?:CEO|CFO|COO|CTO|President|Chairman|Executive\s+Vice\s+President|Managing\s+Director)\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+", "person", 0.8, 20, 0, 0),
    ("regex:ticker_parenthesized", r"\(([A-Z]{1,5})\)", "ticker", 0.6, 20, 0, 1),
    ("regex:cik", r"(?i)CIK\s*#?\s*\d{6,10}\b", "cik", 0.9, 20, 0, 0),
    ("regex:legal_case", r"[A-Z][a-z]+\s+v\.?\s+[A-Z][a-z]+", "legal_identifier", 0.65, 20, 5, 0),
    ("regex:legal_in_re", r"In\s+re\s+[A-Z][A-Za-z\s]+", "legal_identifier", 0.65, 20, 5, 0),
    ("regex:legal_docket", r"No\.\s*\d{2}-\d{4,6}", "legal_identifier", 0.65, 20, 5, 0),
    ("regex:legal_number", r"Case\s+No\.?\s*\d+", "legal_identifier", 0.65, 20, 5, 0),
    ("regex:acquisition", r"[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,3}\s+acquisition\s+of\s+[A-Z]", "legal_identifier", 0.65, 20, 5, 0),
    ("regex:merger", r"[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,3}\s+merged\s+with\s+[A-Z]", "legal_identifier", 0.65, 20, 5, 0),
)
#: What in parentheses is no ticker.
NO_TICKER = ("NYSE", "NASDAQ", "AMEX", "ARCA", "THE", "AND", "FOR", "ARE", "NOT", "BUT", "HAS", "HAD", "ITS")
#: The metadata that is harvested, its category and confidence.
METADATA = (
    ("company_name", "company name", 0.85), ("issuer_name", "company name", 0.85), ("registrant_name", "company name", 0.85), ("address", "address", 0.85), ("phone", "phone", 0.85),
    ("website", "domain/url", 0.85), ("contact", "person", 0.85), ("accession_number", "accession_number", 0.9), ("cik", "cik", 0.9), ("ticker", "ticker", 0.9),
)
#: Sources in order: each detector, URLs and addresses with their domains behind them, then the metadata.
SOURCES = tuple(x for d in DETECTORS for x in ((d[0], f"extracted:{d[2]}_domain") if d[2] in ("url", "email") else (d[0],))) + tuple(f"metadata:{key}" for key, _, _ in METADATA)
CANDIDATE = "struct<value:string,category:string,source:string,start:int,end:int,context:string,confidence:double>"


def _candidate(value: Column, category: str, source: str, start: Column, end: Column, context: Column, confidence: float) -> Column:
    fields = zip(("value", "category", "source", "start", "end", "context", "confidence"), (value, F.lit(category), F.lit(source), start, end, context, F.lit(confidence)), strict=True)
    return F.struct(*[c.alias(n) for n, c in fields]).cast(CANDIDATE)


def candidates(text: Column, ascii_only: bool = False) -> Column:
    """Candidates of all detectors, in order of detector and place; URLs and addresses bring their domains with them."""
    return F.flatten(F.transform(F.array(all_spans(text, [d[1] for d in DETECTORS], ascii_only)), lambda every: _sorted_out(text, every)))


def _sorted_out(text: Column, every: Column) -> Column:
    return F.flatten(F.array(*[_of_detector(text, every, i, *d) for i, d in enumerate(DETECTORS)]))


def _of_detector(text: Column, every: Column, number: int, source: str, _: str, category: str, confidence: float, around: int, least: int, group: int) -> Column:
    """The candidates of one detector, each URL and address followed by its domain."""
    found = F.filter(every, lambda s: (s["pattern"] == number) & (F.length(trimmed(s["text"])) >= least))
    if category == "ticker":
        found = F.filter(found, lambda s: ~F.substring(s["text"], 2, 7).isin(*[f"{x})" for x in NO_TICKER]))

    def candidate(s: Column) -> Column:
        first = F.greatest(F.lit(0), s["start"] - around)
        context = F.replace(F.substring(text, first + 1, s["end"] + around - first), F.lit("\n"), F.lit(" "))
        value = F.regexp_replace(s["text"], r"^\(|\)$", "") if group else trimmed(s["text"])
        own = _candidate(value, category, source, s["start"], s["end"], context, confidence)
        if category not in ("url", "email"):
            return F.array(own)
        domain = F.regexp_extract(s["text"], r"https?://(?:www\.)?([^/ \t\n\f\r]+)", 1) if category == "url" else F.element_at(F.split(s["text"], "@"), 2)
        kind = "domain" if category == "url" else "email_domain"
        return F.array(own, _candidate(domain, kind, f"extracted:{category}_domain", s["start"], s["end"], F.substring(context, 1, 60), 0.9))

    return F.flatten(F.transform(found, candidate))


def from_metadata(metadata: Column) -> Column:
    """D04, metadata: candidates of the keys that are harvested."""
    none = F.lit(0)
    rows = [_candidate(F.trim(F.try_element_at(metadata, F.lit(key))), category, f"metadata:{key}", none, none, F.lit(""), confidence) for key, category, confidence in METADATA]
    return F.filter(F.array(*rows), lambda c: F.coalesce(c["value"], F.lit("")) != "")


def harvested(docs: DataFrame, metadata_col: str | None = None, id_col: str = "doc_id", text_col: str = "text", ascii_only: bool = False) -> DataFrame:
    """(id, place, value, category, source, start, end, context, confidence): of a document's candidates with one
    value, in whatever case, the first; null texts have none. Of rows that share an id the first detector's counts.
    ascii_only: as in all_spans."""
    found = candidates(F.coalesce(F.col(text_col).cast("string"), F.lit("")), ascii_only)
    if metadata_col is not None:
        found = F.concat(found, from_metadata(F.col(metadata_col)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(found).alias("place", "c")).select("doc_id", "place", "c.*")
    key = F.lower(trimmed(F.col("value")))
    fields = [c for c in rows.columns if c != "doc_id"]
    detector = F.array_position(F.array(*[F.lit(x) for x in SOURCES]), F.col("source"))
    first = rows.groupBy("doc_id", key.alias("_key")).agg(F.min_by(F.struct(*fields), F.struct(detector, "place")).alias("r"))
    return first.select("doc_id", "r.*")


def harvest_report(found: DataFrame) -> DataFrame:
    """(category, documents, candidates)."""
    return found.groupBy("category").agg(F.countDistinct("doc_id").alias("documents"), F.count("*").alias("candidates"))


#: Words that are no part of a name, contexts that a name must stand near, verbs that may not end it.
NO_NAME = "or and of us the authorized director officer executive chief president vice board committee registrant company".split()
CONTEXTS = (
    "SIGNATURES", "/s/", "Director", "Chief Executive Officer", "Chief Financial Officer", "President and Chief Executive Officer", "Executive Vice President", "Senior Vice President",
    "Named Executive Officer", "Board of Directors",
)
VERBS = "Signed Led Filed Approved Certifies Certified Directs Manages Oversees Served Joined Left Dated Has Was Is Are Had Acknowledged Attests".split()
#: What a name looks like, also behind the mark of a signature.
_NAME = r"(?:[A-Z][a-z]+|[A-Z]\.)(?:[ \t]+(?:[A-Z][a-z]+|[A-Z]\.)){1,3}"
SIGNATURE = rf"(?<!\w)/s/[ \t]*{_NAME}"
#: Endings of companies' names, of which one is taken off a handle.
ENDINGS = ("corp", "inc", "co", "holdings", "ltd", "llc")


def _is_no_name(token: Column) -> Column:
    return F.regexp_replace(F.lower(token), r"\.+$", "").isin(*NO_NAME)


def admit_person(value: Column, context: Column) -> Column:
    """(name, rejection) of a captured name: titles before it are taken off, and the first rule that fails is named.

    A name has two to four words in title case (or initials), none of them of NO_NAME, doesn't end with a verb, and stands
    near one of CONTEXTS."""
    words = F.filter(F.split(F.trim(value), r"\s+"), lambda w: w != "")
    size = F.size(words)
    keep = F.filter(F.transform(words, lambda w, i: F.when(~_is_no_name(w), i)), lambda i: i.isNotNull())
    first = F.get(keep, F.lit(0))
    name = F.when(first.isNotNull(), F.slice(words, first + 1, F.greatest(size - first, F.lit(1))))
    part = lambda w: F.split(w, "-")
    titled = lambda w: F.forall(part(w), lambda x: x.rlike(r"^\p{Lu}\p{L}*\p{Ll}\p{L}*$"))
    shaped = lambda w: w.rlike(r"^\p{Lu}\.$") | titled(w)
    fault = lambda w: F.when(_is_no_name(w), "person_hard_blocklist").when((F.lower(w) == w) & w.rlike(r"\p{Ll}"), "person_lowercase_function_word").when(~shaped(w), "person_invalid_token_shape")
    faults = F.filter(F.transform(name, fault), lambda x: x.isNotNull())
    last = F.regexp_replace(F.element_at(name, -1), r"\.+$", "")
    near = F.exists(F.array(*[F.lit(c.lower()) for c in CONTEXTS]), lambda c: F.contains(F.lower(context), c))
    rejection = (
        F.when(F.coalesce(name.isNull() | (size == 0), F.lit(True)), "person_hard_blocklist").when(~F.size(name).between(2, 4), "person_token_count_out_of_range").when(F.size(faults) > 0, F.get(faults, F.lit(0)))
        .when(F.initcap(last).isin(*VERBS), "person_trailing_verb").when(~F.coalesce(near, F.lit(False)), "person_no_high_confidence_context")
    )
    return F.struct(F.when(rejection.isNull(), F.array_join(name, " ")).alias("name"), rejection.alias("rejection"))


def persons(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, value, name, rejection) of every captured name, those behind signatures too; a span counts once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    signed = F.transform(spans(text, SIGNATURE), lambda s: F.struct((s["start"] + F.length(F.regexp_extract(s["text"], r"^/s/[ \t]*", 0))).alias("start"), s["end"].alias("end")))
    plain = F.transform(spans(text, _NAME), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    kind = "array<struct<start:int,end:int>>"
    both = F.array_distinct(F.concat(signed.cast(kind), plain.cast(kind)))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.explode(both).alias("s"))
    # the mark of a signature counts as context of its name, as the capture begins with it
    around = F.substring("text", F.greatest(F.lit(1), F.col("s.start") - 63), F.col("s.end") - F.col("s.start") + 124)
    rows = rows.select("doc_id", F.col("s.start").alias("start"), F.substring("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("value"), around.alias("around"))
    return rows.withColumn("p", admit_person(F.col("value"), F.col("around"))).select("doc_id", "start", "value", "p.*")


def stems(tickers: Sequence[str], companies: Sequence[str]) -> list[str]:
    """What a handle must share: tickers, and words of over two letters or digits of companies' names, in lower case."""
    import re

    words = {w.lower() for c in companies for w in re.split(r"[^A-Za-z0-9]+", c) if len(w) > 2}
    return sorted({t.strip().lower() for t in tickers if t.strip()} | words)


def admit_handle(handle: Column, roots: Sequence[str]) -> Column:
    """Whether a handle shares a stem of over two characters; without stems none does."""
    usable = [r for r in roots if len(r) > 2]
    if not usable:
        return F.lit(False)
    low = F.lower(handle)
    plain = F.regexp_replace(low, "[^a-z0-9]", "")
    short = plain
    for ending in reversed(ENDINGS):  # the first that fits wins, and only one is taken off
        short = F.when(plain.endswith(ending) & (F.length(plain) > len(ending) + 2), F.substring(plain, F.lit(1), F.length(plain) - len(ending))).otherwise(short)
    held = F.exists(F.array(*[F.lit(r) for r in usable]), lambda r: F.contains(low, r) | F.contains(plain, r) | F.contains(short, r))
    return F.coalesce(held & (F.length(handle) > 2), F.lit(False))


def handles(docs: DataFrame, roots: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, handle, variants, admitted): every handle behind an @ once a document; an admitted one in five variants."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"@([A-Za-z0-9_]+)"), F.lit(1)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("handle"))
    h = F.col("handle")
    variants = F.array_distinct(F.array(h, F.concat(F.lit("@"), h), F.lower(h), F.concat(F.lit("@"), F.lower(h)), F.upper(h)))
    ok = admit_handle(h, roots)
    return rows.select("doc_id", "handle", F.when(ok, variants).otherwise(F.array().cast("array<string>")).alias("variants"), ok.alias("admitted"))


def rejection_report(found: DataFrame) -> DataFrame:
    """(rejection, captures): the histogram of rules that rejected; the values themselves are not in it."""
    return found.filter("rejection is not null").groupBy("rejection").agg(F.count("*").alias("captures"))


def header_facts(filings: DataFrame, text_col: str = "text", id_col: str = "doc_id", head: int = 8192, tags: int = 65536) -> DataFrame:
    """(doc_id, source, value) of the first 8 KiB of a filing (registrant, CIK, accession, EIN) and of the XBRL tags in
    its first 64 KiB. The cuts are those of the published harvest: a header stands there."""
    top, more = F.substring(text_col, 1, head), F.substring(text_col, 1, tags)
    one = {
        "filing_header": r"(?i)COMPANY CONFORMED NAME:\s*([^\r\n]+)", "cik": r"(?i)CENTRAL INDEX KEY:\s*(\d+)", "accession": r"(\d{10}-\d{2}-\d{6})", "ein": r"(?i)IRS NUMBER:\s*(\d+)",
    }

    def of(part: Column, name: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(part, F.lit(pattern), F.lit(1)), lambda v: F.struct(F.lit(name).alias("source"), F.trim(v).alias("value")))

    found = [of(top, name, pattern) for name, pattern in one.items()]
    found.append(of(more, "xbrl_concept", r"<((?:us-gaap|dei|srt|ix|xbrli):[A-Za-z0-9]+)"))
    return filings.select(F.col(id_col).alias("doc_id"), F.inline(F.array_distinct(F.concat(*found))))
