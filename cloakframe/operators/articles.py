"""News: selection, identity strip, surrogates with provenance, briefs, and the template of a recent event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import governance, quality, scrub

#: The label of a surrogate, and the typed placeholders of private values.
LABEL = "Synthetic Financial News Surrogate"
PLACEHOLDER_OF = {
    "executive": "Executive", "product": "Product", "brand": "Product", "proprietary_platform": "Platform", "supplier": "Supplier", "competitor": "Competitor", "headquarters": "Location",
    "facility": "Location", "auditor": "Auditor", "law_firm": "LawFirm", "business_segment": "Segment",
}
BODY = 5000


def placeholder(kind: Column, value: Column, company: str) -> Column:
    """What stands for a private value: the company's name, a domain of it, or its kind and six digits of its hash; null for
    values of fewer than three characters."""
    digits = F.upper(F.substring(F.sha2(value, 256), 1, 6))
    kinds = F.create_map(*[F.lit(x) for kv in PLACEHOLDER_OF.items() for x in kv])
    other = F.concat(F.lit("["), F.coalesce(F.try_element_at(kinds, kind), F.lit("Entity")), F.lit("-"), digits, F.lit("]"))
    by = F.when(kind.isin("company", "ticker"), company).when(kind == "company_domain", f"{company.lower()}.example.com").otherwise(other)
    return F.when(F.length(F.trim(value)) >= 3, by)


def replacements(values: DataFrame, ticker: str, company: str) -> list[tuple[str, str]]:
    """(value, placeholder) of (kind, value) rows and of the ticker, longest first; a registry fits the driver."""
    rows = values.select(F.trim("value").alias("v"), placeholder(F.col("kind"), F.trim("value"), company).alias("by")).filter("by is not null").distinct().collect()
    pairs = {r.v: r.by for r in rows} | {ticker: company}
    return sorted(pairs.items(), key=lambda kv: (-len(kv[0]), kv[0]))


def stripped(text: Column, pairs: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(text with whole-word values replaced in any case, one after the other, how many were)."""
    total = F.lit(0)
    for value, by in pairs:
        pattern = rf"(?i)\b\Q{value}\E\b"
        total = total + F.regexp_count(text, F.lit(pattern))
        text = F.regexp_replace(text, pattern, by.replace("\\", r"\\").replace("$", r"\$"))
    return text, total


def selected(articles: DataFrame, body: int = BODY) -> DataFrame:
    """Articles (headline, url, published_timestamp, body, place), of one URL the first by place; those without a URL all
    stay; bodies are cut as published.

    Rows of one URL are combined before the shuffle; rows without one are not grouped at all."""
    cut = articles.withColumn("body", F.substring("body", 1, body))
    named = F.coalesce("url", F.lit("")) != ""
    columns = cut.columns
    first = cut.filter(named).groupBy(F.col("url").alias("_url")).agg(F.min_by(F.struct(*columns), "place").alias("r")).select("r.*")
    return first.unionByName(cut.filter(~named))


def news_coverage(articles: DataFrame) -> DataFrame:
    """One row: records, urls, bodies, first and last timestamp, and whether they span nine years."""
    stamp = F.nullif(F.col("published_timestamp").cast("string"), F.lit(""))
    url = F.nullif(F.col("url"), F.lit(""))
    out = articles.agg(F.count("*").alias("records"), F.countDistinct(url).alias("unique_urls"), F.count_if(F.coalesce(F.length("body"), F.lit(0)) > 0).alias("bodies"), F.min(stamp).alias("earliest"), F.max(stamp).alias("latest"))
    span = F.datediff(F.col("latest").try_cast("timestamp"), F.col("earliest").try_cast("timestamp")) / 365.25
    return out.withColumn("ten_years", F.coalesce(span >= 9.0, F.lit(False)))


def _whole(rows: DataFrame) -> Column:
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    text = F.trim(F.concat_ws(" ", part("headline"), part("summary"), F.substring(part("body"), 1, BODY)))
    return F.when(text == "", "[empty article]").otherwise(text)


def article_id(ticker: str) -> Column:
    """By the URL's hash, or else by place and the timestamp's hash."""
    url, stamp = F.coalesce("url", F.lit("")), F.coalesce(F.col("published_timestamp").cast("string"), F.lit(""))
    by_place = F.concat(F.lit(f"news_{ticker.lower()}_"), F.format_string("%03d", F.col("place")), F.lit("_"), F.substring(F.sha2(stamp, 256), 1, 8))
    return F.when(url != "", F.concat(F.lit("news_"), F.substring(F.sha2(url, 256), 1, 16))).otherwise(by_place)


def surrogates(articles: DataFrame, pairs: Sequence[tuple[str, str]], ticker: str, company: str, now: Column) -> DataFrame:
    """(article_id, event_type, period, replaced, text, original_text_hash, original_url_hash) of articles
    (place, headline, summary, body, url, published_timestamp)."""
    whole = _whole(articles)
    stamp = F.col("published_timestamp").cast("string")
    when = F.coalesce(stamp.try_cast("timestamp"), F.timestamp_seconds(stamp.try_cast("double")))
    rows = articles.select(article_id(ticker).alias("article_id"), whole.alias("whole"), quality.event_type(whole).alias("event_type"), governance.period(when, now).alias("period"), F.sha2(F.coalesce("url", F.lit("")), 256).alias("original_url_hash"))
    clean, count = stripped(F.col("whole"), pairs)
    rows = rows.select("*", F.trim(scrub.without_publishers(clean)).alias("clean"), count.alias("replaced"))
    lines = [
        F.lit(f"# {LABEL}\n\n**Surrogate ID:** "), F.col("article_id"), F.lit(f"\n**Synthetic Company:** {company}\n**Event Type:** "), F.col("event_type"), F.lit("\n**Relative Period:** "), F.col("period"),
        F.lit(f"\n**Label:** {LABEL}\n\n---\n\n## Event Summary\n\n"), F.col("clean"),
        F.lit("\n\n---\n\n## Provenance & Disclosure\n\nNames, links, publishers and exact times were taken out; the kind of event and its relative period are kept.\nHashes of the original are held privately.\n"),
    ]
    return rows.select("article_id", "event_type", "period", "replaced", F.concat(*lines).alias("text"), F.sha2("whole", 256).alias("original_text_hash"), "original_url_hash")


def event_histogram(rows: DataFrame) -> DataFrame:
    """G30."""
    return rows.groupBy("event_type").agg(F.count("*").alias("articles"))


def briefs(articles: DataFrame, ticker: str, peers: Sequence[str], private: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(place, topic, reason, summary) of articles: those that name a peer are excluded, and those of which
    scrubbing leaves nothing, or a URL; the rest have a topic and a summary without any of the article's words."""
    text = F.trim(F.concat(F.coalesce("headline", F.lit("")), F.lit(". "), F.coalesce("summary", F.lit(""))))
    others = [p for p in peers if p != ticker]
    topic = quality.topic(text)
    raw = F.when(F.coalesce("summary", F.lit("")) != "", F.col("summary")).otherwise(F.concat(F.lit("A financial news item discussed "), topic, F.lit(".")))
    clean = F.regexp_replace(scrub.submission_scrub(raw, private), r"\b(?:COMPANY|TICKER)_\d{3}\b", "the company")
    names = "|".join([*others, ticker]) if others or ticker else None
    clean = F.regexp_replace(clean, rf"\b(?:{names})\b", "the company") if names else clean
    peer = text.rlike(r"\b(?:" + "|".join(others) + r")\b") if others else F.lit(False)
    reason = F.when(peer, "named peer company").when((clean == "") | clean.rlike(scrub.URL), "nothing left")
    said = F.concat(F.lit("A recent financial news item discussed "), F.replace(topic, F.lit("_"), F.lit(" ")), F.lit(" for the company."))
    return articles.select("place", topic.alias("topic"), reason.alias("reason"), F.when(reason.isNull(), said).alias("summary"))


#: What a current report's summary says was taken out.
TAKEN_OUT = (
    "street address", "city/state/zip", "phone number", "tax employer ID", "SEC filing identifier numbers", "filing identifier", "filing URL", "leadership and signatory names", "audit firm names",
    "vote tables and exact vote counts", "raw filing headers and execution blocks",
)


def recent_event(text: Column, company: Column, form: str = "8-K") -> Column:
    """A fixed text about a current report with the category of its event alone."""
    category = F.when(F.trim(F.coalesce(text, F.lit(""))) != "", quality.event_category(text))
    inferred = F.when(category.isNotNull(), F.concat(F.lit("\nInferred event category: "), category, F.lit(".\n"))).otherwise(F.lit(""))
    out = "\n".join(f"* {x}" for x in TAKEN_OUT)
    return F.concat(
        F.lit("# Recent Event Summary\n\n* Company: "), company, F.lit(f"\n* Source form: {form}\n* Summary status: OK\n* Relative filing period: RECENT_PERIOD\n\n## Event Type\n\nRecent current-report filing.\n"),
        inferred, F.lit(f"\n## Sanitized Summary\n\nA current report was on file; its text is left out, as its cover and signatures identify the company.\n\n## Identity Risk Removed\n\n{out}\n"),
    )
