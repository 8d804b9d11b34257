"""Scrubbing: structural identifiers, submission texts, filings' markup, publishers, and what may not stand in public texts.

Everything but the registry's own patterns is a chain of JVM-side replacements. SQL engines without look-around can say the
same with the character before a match captured, which is how the queries' SQL does it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Structural identifiers before a text goes to a model, in this order, in any case.
STRUCTURAL: tuple[tuple[str, str, str], ...] = (
    ("cik_phrase", r"\bcentral\s+index\s+key\b", "[CIK_REDACTED]"),
    ("ticker_symbol", r"\b(?:ticker|trading)\s+symbol\s*(?::|is)?\s*[A-Z]{1,5}\b", "[TICKER_SYMBOL_REDACTED]"),
    ("exchange_ticker", r"\b(?:NYSE|NASDAQ|NYSE\s*Arca)\s*:\s*[A-Z]{1,5}\b", "[EXCHANGE_TICKER_REDACTED]"),
    ("file_number", r"\b(?:333|001|002|003|005|811)-\d{5,8}\b", "[FILE_NUMBER_REDACTED]"),
    ("ein", r"\b\d{2}-\d{7}\b", "[EIN_REDACTED]"),
    ("cik_url", r"https?://[^\s]*?cik[=/_]?\d{6,10}[^\s]*", "[CIK_URL_REDACTED]"),
    ("accession", r"\b\d{10}-\d{2}-\d{6}\b|\b\d{18}\b", "[ACCESSION_REDACTED]"),
    ("archive_path", r"/Archives/edgar/data/\d{6,10}/", "[SEC_ARCHIVE_PATH_REDACTED]"),
    ("cik_attribute", r"EntityCentralIndexKey[^>]*?\"?(?:\d+)\"?", 'EntityCentralIndexKey="[CIK_REDACTED]"'),
)
#: What stands for values of these kinds; others have the pseudonym of their entity.
TAGS = {"cik": "[CIK_REDACTED]", "ticker": "[TICKER_REDACTED]", "company_domain": "[DOMAIN_REDACTED]", "company_email_domain": "[DOMAIN_REDACTED]"}

#: Identifiers in submissions, in this order, and the lines that are no text.
URL = r"(?i)https?://\S+|\bwww\.\S+"
PHONE_CORE = r"(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)\d{3}[-.\s]?\d{4}"
PHONE = rf"(?<![A-Za-z0-9]){PHONE_CORE}(?![A-Za-z0-9])"
EIN = r"(?i)\b\d{2}-\d{7}\b|\b(?:IRS\s+)?Employer Identification No\.?"
FILE_NUMBER = r"\b(?:000|001|002|003|005|033|333|811)-\d{4,8}\b"
ACCESSION = r"\b\d{10}-\d{2}-\d{6}\b|\b\d{18}\b"
DATE = r"(?i)\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},\s+\d{4}\b|\b\d{4}-\d{2}-\d{2}\b"
ADDRESS = r"(?i)\b\d{1,6}\s+[A-Za-z0-9 .'-]+(?:Street|St\.|Avenue|Ave\.|Road|Rd\.|Boulevard|Blvd\.|Drive|Dr\.|Lane|Ln\.|Way|Plaza|Suite)\b"
SUBMISSION: tuple[tuple[str, str], ...] = (
    (URL, "[URL_REMOVED]"), (PHONE, "[PHONE_REMOVED]"), (EIN, "[EIN_REMOVED]"), (FILE_NUMBER, "[FILING_ID]"), (ACCESSION, "[FILING_ID]"), (DATE, "[DATE_REMOVED]"), (ADDRESS, "[ADDRESS_REMOVED]"),
)
HEADER = r"(?i)Exact name of registrant|Commission File Number|SECURITIES AND EXCHANGE COMMISSION"
ROLE = r"(?i)\b(?:director|officer|chief|signer|auditor|by:|/s/|deloitte|pwc|ernst|kpmg)\b"
VOTE = r"(?i)\b(?:for\s+against\s+abstain|abstain|broker non-votes?|votes?)\b.*\d[\d,]{3,}"
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
TAXONOMY = r"(?i)\b(?:us-gaap|xbrli|iso4217|utr|srt):|TICKER_[A-Z0-9_]+Member"
#: Folders and settings that may not be named in public.
FORBIDDEN_PARTS = ("originals/", "private_maps/", "smoke_excerpts/", ".env", "/Users/", "/content/")

#: Publishers whose names are taken out.
PUBLISHERS = (
    "Reuters", "Bloomberg", "CNBC", "NASDAQ", "Yahoo", "WSJ", "New York Times", "Seeking Alpha", "MarketWatch", "Business Insider", "Barron's", "Fortune",
    "Investopedia", "Forbes", "AP News", "CNN", "Fox", "BBC News", "TheStreet", "Zacks", "TipRanks", "Motley Fool", "Wall Street Journal",
)


def _by(text: str) -> str:
    """A replacement taken as it is."""
    return text.replace("\\", r"\\").replace("$", r"\$")


def structural(text: Column, kinds: Sequence[str] | None = None) -> Column:
    """T15, structural part: the nine forms replaced in order, in any case."""
    for name, pattern, by in STRUCTURAL:
        if kinds is None or name in kinds:
            text = F.regexp_replace(text, f"(?i){pattern}", _by(by))
    return text


def model_scrub(rows: DataFrame, registry: Sequence, text_col: str = "text") -> DataFrame:
    """Rows whose text has the registry's aliases and then the structural forms replaced, and `precheck`.

    registry: aliases with a value, a kind and what stands for them (`masking.Alias`). The values go first, longest first, in any case,
    in every form of their kind, by the tag of their kind or their pseudonym; precheck is the exact scan of what is left
    (D07)."""
    from . import residual

    text = F.col(text_col)
    by: dict[str, list[str]] = {}
    for alias in registry:
        tag = TAGS.get(alias.kind, alias.by or "[REDACTED]")
        by.setdefault(tag, []).extend(residual.forms_of(alias.kind, alias.value).values())
    for tag, patterns in sorted(by.items(), key=lambda kv: (-max(map(len, kv[1])), kv[0])):
        joined = "|".join(sorted(set(patterns), key=lambda p: (-len(p), p)))
        text = F.regexp_replace(text, f"(?i)(?:{joined})", _by(tag))
    out = rows.withColumn(text_col, structural(text))
    out = out.withColumn("precheck", residual.hits(F.col(text_col), residual.exact_patterns((a.kind, a.value) for a in registry)))
    status = F.when(F.col("precheck.is_blocked"), "BLOCKED_PRECHECK").otherwise("PRECHECK_PASS")
    return out.withColumn("precheck", residual.scan_result(F.col("precheck"))).withColumn("precheck_status", status)


def submission_scrub(text: Column, private: Sequence[tuple[str, str]] = ()) -> Column:
    """Identifiers out, lines of headers, roles and votes out as a whole, private values replaced, blanks collapsed.

    private: (value, pseudonym); longer values go first, in any case, with no ASCII letter or digit beside them."""
    for pattern, by in SUBMISSION:
        text = F.regexp_replace(text, pattern, _by(by))
    removed = lambda line: line.rlike(HEADER) | line.rlike(ROLE) | line.rlike(VOTE)
    lines = F.transform(F.split(text, LINE_END), lambda line: F.when(removed(line), F.lit("[IDENTITY_FIELD_REMOVED]")).otherwise(line))
    text = F.array_join(lines, "\n")
    for value, pseudonym in sorted(private, key=lambda kv: (-len(kv[0]), kv[0])):
        if value:
            text = F.regexp_replace(text, rf"(?i)(?<![A-Za-z0-9])\Q{value}\E(?![A-Za-z0-9])", _by(pseudonym))
    return F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"^\s+|\s+$", "")


def forbidden_public(text: Column, tickers: Sequence[str] = ()) -> Column:
    """Whether any of the thirteen detectors finds something that may not stand in a public text."""
    patterns = [TAXONOMY, URL, PHONE, EIN, FILE_NUMBER, ACCESSION, ADDRESS, DATE, HEADER, ROLE, VOTE]
    if tickers:
        patterns.append(r"\b(?:" + "|".join(re.escape(t) for t in tickers) + r")\b")
    found = F.lit(False)
    for part in FORBIDDEN_PARTS:
        found = found | F.contains(text, F.lit(part))
    for pattern in patterns:
        found = found | text.rlike(pattern)
    return F.coalesce(found, F.lit(False))


def without_publishers(text: Column) -> Column:
    """Publishers and URLs out."""
    names = "|".join(re.escape(p) for p in PUBLISHERS)
    return F.regexp_replace(F.regexp_replace(text, rf"(?i)\b(?:{names})\b", "[PUBLISHER REMOVED]"), r"https?://\S+", "[URL REMOVED]")


def short_hash(value: str, digits: int = 12) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:digits]


def path_pseudonyms(ticker: str, cik: str, accessions: Sequence[str]) -> dict[str, str]:
    """What stands for a ticker, a CIK and accession numbers (dashed and not), and for the files named by them."""
    out = {ticker: f"TKR_{short_hash(ticker)}"} if ticker else {}
    if cik:
        out[cik] = f"CIK_{short_hash(cik)}"
    for i, accession in enumerate(accessions):
        name = f"F_{i:04d}_{short_hash(accession)}"
        plain = accession.replace("-", "")
        out |= {accession: name, plain: name, f"{plain}.md": f"{name}.md", f"{plain}.html": f"{name}.html"}
    return out


def public_path(path: Column, names: dict[str, str]) -> Column:
    """A path with the private names of files replaced, longer ones first."""
    pairs = sorted(((a, b) for a, b in names.items() if a.endswith((".md", ".html"))), key=lambda kv: (-len(kv[0]), kv[0]))
    if not pairs:
        return path
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    return F.aggregate(table, path, lambda p, n: F.replace(p, n["a"], n["b"]))


def public_filename(accession: Column, names: dict[str, str]) -> Column:
    """The pseudonym of an accession's file, or a hash of it where it has none."""
    known = F.create_map(*[F.lit(x) for a, b in sorted(names.items()) for x in (a, b)]) if names else None
    hashed = F.concat(F.lit("filing_"), F.substring(F.sha2(accession, 256), 1, 12), F.lit(".md"))
    return hashed if known is None else F.coalesce(F.concat(F.try_element_at(known, accession), F.lit(".md")), hashed)


def markup_scrub(text: Column, cik: str, names: dict[str, str] | None = None) -> Column:
    """A filer's CIK in attributes, contexts, URLs, identifier elements and paths, and accession numbers, by pseudonyms.

    names: accession (of over 12 characters) to pseudonym. Without a CIK the text stays."""
    if not cik:
        return text
    by = f"CIK_{short_hash(cik)}"
    either = "|".join(sorted({re.escape(cik.lstrip("0")), re.escape(cik.zfill(10))}, key=lambda x: -len(x)))
    rules = (
        (r"(?i)(<[^>]*?EntityCentralIndexKey[^>]*?\")(\d+)(\"[^>]*?>)", f"$1{by}$3"),
        (rf"(?i)(contextRef|cik)\s*=\s*\"?(?:{either})\"?", f'$1="{by}"'),
        (rf"(?i)cik=(?:{either})", f"cik={by}"),
        (rf"(?i)(<identifier[^>]*>)\s*(?:{either})\s*(</identifier>)", f"$1 {by} $2"),
        (rf"/(?:{either})/", f"/{by}/"),
    )
    for pattern, new in rules:
        text = F.regexp_replace(text, pattern, new)
    held = {a: b for a, b in (names or {}).items() if len(a) > 12 and not a.endswith((".md", ".html"))}
    for accession in sorted(held, key=lambda a: (-len(a), a)):
        text = F.replace(text, F.lit(accession), F.lit(held[accession]))
    return text


def filings_masked(rows: DataFrame, registry: Sequence, cik: str = "", names: dict[str, str] | None = None, text_col: str = "html") -> DataFrame:
    """Filings (accession, html) as (name, text): HTML as Markdown (T21), markup scrubbed (T13), aliases masked (T04 to
    T06), under a public name."""
    from ..functions import markup
    from . import masking

    as_text = rows.withColumn("text", markup_scrub(markup.markdown(F.col(text_col)), cik, names))
    masked = masking.mask_documents(as_text.select(F.col("accession").alias("doc_id"), "text"), list(registry))
    return masked.select(public_filename(F.col("doc_id"), names or {}).alias("name"), F.col("masked").alias("text"))
