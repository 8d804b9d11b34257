"""What a text is good for: reasons for rejection, summaries, events, numbers, risk. All are JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import trimmed

#: Tags of financial taxonomies. A tag may stand behind any but ASCII's letters, digits and _, as in SQL.
TAXONOMY = r"(?i)(?<![a-z0-9_])(?:us-gaap|xbrli|iso4217|utr|srt):|TICKER_[A-Z0-9_]+Member"
#: Keywords in order, and the category of the first that a text holds.
CATEGORIES = (
    ("shareholder", "shareholder meeting"), ("annual meeting", "shareholder meeting"), ("auditor", "accounting and audit matter"), ("accounting", "accounting and audit matter"),
    ("executive compensation", "executive compensation matter"), ("compensation", "executive compensation matter"), ("financing", "financing/capital markets matter"), ("debt", "financing/capital markets matter"),
    ("note offering", "financing/capital markets matter"), ("capital markets", "financing/capital markets matter"), ("operational", "operational/business update"), ("business update", "operational/business update"),
    ("restructuring", "operational/business update"),
)
#: Event types in order of precedence, and the words that tell them.
EVENTS = (
    ("earnings_release", "earnings|net income|EPS|guidance|outlook|preliminary results|quarterly results|revenue|margin"),
    ("merger_acquisition", "acquir|merger|acquisition|takeover|buyout|bid for|to buy"),
    ("product_or_service", "launch|unveil|introduce|announce .{0,15} (?:product|platform|service|chip|processor)|new (?:product|platform|service)"),
    ("executive_change", "CEO|CFO|COO|CTO|chief [a-z]+ officer|appointed|named|joins as|departs|resigns|step down"),
    ("regulatory_legal", "lawsuit|settlement|investigation|probe|regulator|regulatory|FTC|antitrust|subpoena|indictment"),
    ("capital_return", "dividend|buyback|repurchase|capital return|special dividend|recapitalization"),
    ("capital_markets", "IPO|public offering|secondary offering|follow-on offering|priced at"),
    ("partnership", "partnership|joint venture|alliance|collaboration|teaming up"),
    ("analyst_action", "downgrade|upgrade|price target|analyst rating|initiates coverage|raises rating"),
    ("macro_economic", "federal reserve|interest rate|inflation|recession|tariff|trade war|macro"),
)
#: Amounts with an optional suffix.
NUMBER = r"\$?\s*(\d[\d,]*(?:\.\d+)?)\s*([KkMm]|[Bb]illion|[Mm]illion|%)?"
LINES = r"\r\n|\n|\r"
#: A blank as in SQL; Java's has the vertical tab too.
BLANK = r"[ \t\n\f\r]"
SENTENCE = r"[A-Z][^.!?]{25,}[.!?]"
HEADING = r"(?i)item\s+\d+[a-z]?\.?|page\s+\d+|table of contents|\s"


def compact(text: Column) -> Column:
    return trimmed(F.regexp_replace(text, f"{BLANK}+", " "))


def noisy_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(text, LINES), lambda line: line.rlike(TAXONOMY)))


def line_count(text: Column) -> Column:
    """A line break at the very end begins no line."""
    return F.when(text == "", 0).otherwise(F.size(F.split(F.regexp_replace(text, r"(?:\r\n|\n|\r)\z", ""), LINES)))


def rejection(text: Column) -> Column:
    """Why a text is of no use, or null. A null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    bound = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))  # noqa: E731  a value is made once, not for each use
    noisy = bound(noisy_lines(text), lambda n: (n >= 3) | ((n > 1) & (n > F.floor(line_count(text) / 6))))
    return bound(compact(text), lambda one: (
        F.when(F.length(F.regexp_replace(one, "[^A-Za-z]+", "")) < 500, "fewer than 500 meaningful characters")
        .when(F.regexp_count(one, F.lit(SENTENCE)) < 5, "fewer than 5 usable sentences")
        .when(noisy, "taxonomy or XBRL noise")
        .when(F.regexp_replace(one, HEADING.replace(r"\s", BLANK), "") == "", "heading-only section")
    ))


def summary(text: Column, sentences: int = 8, limit: int = 2200) -> Column:
    """The first sentences of over 35 characters without taxonomy tags; null where the text or the summary is rejected."""
    # by a lambda: a function of two arguments would be given the place of the sentence as the characters to trim
    parts = F.transform(F.split(trimmed(F.regexp_replace(text, r"[ \t]+", " ")), rf"(?<=[.!?]){BLANK}+"), lambda x: trimmed(x))
    kept = F.filter(parts, lambda x: (F.length(x) > 35) & ~x.rlike(TAXONOMY))
    out = trimmed(F.substring(F.array_join(F.slice(kept, 1, sentences), " "), 1, limit))
    # the transform binds the summary once; it would be made again for each rule
    return F.when(rejection(text).isNull(), F.get(F.transform(F.array(out), lambda o: F.when(rejection(o).isNull(), o)), F.lit(0)))


def event_category(text: Column) -> Column:
    """The category of the first keyword in order that the text holds."""
    lowered = F.lower(F.regexp_replace(text, r"\s+", " "))
    out = F
    for word, name in CATEGORIES:
        out = out.when(F.contains(lowered, F.lit(word)), F.lit(name))
    return out.otherwise(F.lit("general current-report disclosure"))


def event_type(text: Column) -> Column:
    """The first event type, in order, whose words the text holds."""
    out = F
    for name, words in EVENTS:
        out = out.when(text.rlike(rf"(?i)\b(?:{words})\b"), F.lit(name))
    return out.otherwise(F.lit("general_corporate"))


def topic(text: Column) -> Column:
    """Coarse topic of a news brief."""
    low = F.lower(text)
    return F.when(F.contains(low, F.lit("earn")), "earnings").when(F.contains(low, F.lit("stock")) | F.contains(low, F.lit("share")), "market_performance").otherwise("corporate_update")


def numbers(text: Column) -> Column:
    """Amounts of 1 and more as doubles, K, M and billions multiplied out."""
    found = F.transform(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)), lambda m: F.struct(F.regexp_replace(F.regexp_extract(m, NUMBER, 1), ",", "").try_cast("double").alias("v"), F.lower(F.regexp_extract(m, NUMBER, 2)).alias("s")))
    scaled = F.transform(found, lambda x: x["v"] * F.when(x["s"] == "k", 1e3).when(x["s"].isin("m", "million"), 1e6).when(x["s"].isin("b", "billion"), 1e9).otherwise(1.0))
    return F.filter(scaled, lambda v: v >= 1)


def cased_grams(text: Column, least: int = 3, most: int = 7) -> Column:
    """Lower-cased runs of 3 to 7 words with a capitalised word among them."""
    words = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))

    def of(w: Column, n: int) -> Column:
        last = F.size(w) - n + 1
        runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.slice(w, i, n))
        cased = F.filter(runs, lambda r: F.exists(r, lambda x: x.rlike(r"^\p{Lu}")))
        return F.when(last > 0, F.transform(cased, lambda r: F.lower(F.array_join(r, " ")))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(F.array(words), lambda w: F.flatten(F.array(*[of(w, n) for n in range(least, most + 1)]))))


def band(score: Column) -> Column:
    """The band of a score."""
    return F.when(score >= 0.75, "CRITICAL").when(score >= 0.55, "HIGH").when(score >= 0.35, "MEDIUM").otherwise("LOW")


#: Suffixes of companies' names, as they stand between blanks before and, some, behind.
LEGAL_SUFFIXES = (" INC ", " LLC ", " CORP ", " CORPORATION", " HOLDINGS", " PARTNERS", " GROUP", " LIMITED", " LP", " PLC")


def risk(value: Column, confidence: Column, providers: Column, occurrences: Column, registered: Column, missed: Column) -> Column:
    """Risk of a candidate, 0 to 1: confidence, agreement, frequency, registration and the shape of the value."""
    upper = F.upper(value)
    padded = F.concat(F.lit(" "), upper, F.lit(" "))
    shaped = ((F.length(upper) <= 5) & upper.rlike("[A-Z]") & upper.rlike("[^A-Z]")) | upper.rlike(r"\.(COM|ORG|NET)$")
    legal = padded.rlike("|".join(LEGAL_SUFFIXES))
    proper = value.rlike(r"^\p{Lu}") & value.rlike(r"\p{Ll}")
    add = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0.0))
    total = confidence * 0.4 + (providers - 1) * 0.1 + F.least(occurrences * 0.02, F.lit(0.15)) + add(registered, 0.1) + add(missed, 0.2) + add(shaped, 0.15) + add(legal, 0.1) + add(proper, 0.1)
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 3)


def verdict(guessed: Column, direct: Column, confidence: Column, clues: Column) -> Column:
    """FAIL on a right guess, direct identifiers or a confidence over 0.60 (or an unknown one); REVIEW from 0.35 or with clues."""
    return F.when(F.coalesce(guessed, F.lit(True)) | F.coalesce(direct, F.lit(True)) | F.coalesce(confidence > 0.60, F.lit(True)), "FAIL").when((confidence >= 0.35) | F.coalesce(clues, F.lit(True)), "REVIEW").otherwise("PASS")
