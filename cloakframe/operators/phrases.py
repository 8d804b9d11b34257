"""The semantic attacks: surviving phrases by a ladder of nine tiers, retrieval, numeric similarity, and their report."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import documents, governance, quality

#: The tiers in order of precedence, and whether a phrase of the tier blocks a release.
TIERS: tuple[tuple[str, bool], ...] = (
    ("synthetic_placeholder", False),
    ("product_or_platform_phrase", True),
    ("raw_direct_identifier", True),
    ("accounting_taxonomy_boilerplate", False),
    ("sec_xbrl_boilerplate", False),
    ("date_period_boilerplate", False),
    ("low_information_ngram", False),
    ("generic_financial_phrase", False),
    ("company_specific_business_phrase", True),
)
LOW_INFORMATION, LEAST_DOCUMENTS, LEAST_VALUE = 0.30, 5, 4
#: Words of filings, which make a phrase boilerplate.
FILING_WORDS = (
    "cik dei us-gaap xbrl ixbrl iso4217 srt edgar fasb gaap ifrs sec form filing filings shares share document entity registrant consolidated unaudited interim condensed statements "
    "schedule amendment exhibit item report reports subsidiary subsidiaries hereto hereunder herein thereto thereunder therein thereof hereof whereas foregoing aforesaid herewith therewith "
    "pursuant furnished incorporated reference"
).split()
#: Phrases of accounting, which make a longer phrase boilerplate.
ACCOUNTING = (
    "consolidated financial statements", "balance sheet", "cash flows", "statement of operations", "net income", "gross margin", "operating expenses", "retained earnings", "accumulated deficit",
    "comprehensive income", "stockholders equity", "common stock outstanding", "common stock", "table of contents", "annual report on form 10-k", "annual report on form 10-q",
    "quarterly report on form 10-q", "current report on form 8-k", "report on form 10-k", "report on form 10-q", "report on form 8-k", "on form 10-k", "on form 10-q", "on form 8-k",
    "fiscal year ended", "fiscal quarter ended", "interim financial statements", "unaudited consolidated", "unaudited interim", "notes to consolidated financial", "notes to financial",
    "financial statements", "financial condition", "results of operations", "liquidity and capital resources", "critical accounting policies", "quantitative and qualitative disclosures",
    "internal control over financial", "evaluation of disclosure controls", "part ii other information", "part i financial information", "legal proceedings", "risk factors",
    "forward-looking statements", "cautionary note regarding forward", "statement of cash flows", "statement of stockholders equity", "notes to unaudited condensed", "basis of presentation",
    "summary of significant accounting", "recently issued accounting", "recently adopted accounting", "fair value measurements", "property and equipment", "goodwill and intangible",
    "intangible assets", "restricted stock units", "earnings per share", "basic net income per share", "diluted net income per share", "weighted average shares", "outstanding common stock",
    "accumulated other comprehensive", "other comprehensive income", "comprehensive income loss",
)
#: Common words of finance, and words that count for nothing beside them.
FINANCIAL_WORDS = (
    "revenue revenues cost costs expense expenses operations operating income margin margins earnings loss losses profit share shares dividend dividends diluted basic growth decline increase "
    "decrease quarterly annual fiscal period year total net gross effective rate tax taxes returns sales guidance outlook demand supply inventory channel market markets customer customers "
    "supplier suppliers board directors officers executives assets liabilities equity debt cash capital stock treasury investment investments securities balance sheet flow flows statement "
    "financial accounting audit auditor valuation allowance amortization depreciation accrued deferred payable receivable disclosure disclosures presentation recognition measurement transition "
    "segment segments geographic domestic international restructuring acquisition acquisitions merger goodwill impairment intangible stock-based compensation performance results amounts amount "
    "ended months"
).split()
EMPTY_WORDS = (
    "the a an of for in on to by as at and or with from is are was were been not its their our we this that these those such each all any other may will shall would could should has have had "
    "during including which about also into through after before between under over no only if but"
).split()
#: What placeholders look like.
PLACEHOLDER = (
    r"(?i)\b(?:syn|hash|sha)_[a-f0-9]{4,}\b|\b(?:company|executive|person|product|location|region|platform)\s*_?\s*\d{1,4}\b"
    r"|\[(?:URL|PUBLISHER|PERIOD\s+DATE|FILING\s+DATE)\s+REMOVED\]|\bsynthetic\s+(?:financial\s+)?(?:disclosure|news)\s+surrogate\b"
)
#: Dates and periods. A phrase has no capitals and no signs between words, so some forms cover others.
MONTH = r"(?:january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)"
PERIOD = "(?i)" + "|".join((
    rf"as of {MONTH}", rf"{MONTH}\.?\s+\d{{1,2}}", rf"{MONTH}\.?\s+\d{{4}}", r"fiscal (?:year|quarter|month)", r"(?:fiscal )?(?:years?|quarters?|months?) ended", r"as of \d{4}", r"fiscal \d{4}",
    rf"period ended {MONTH}", rf"ended {MONTH}", r"form\s+(?:10-k|10-q|8-k|s-\d|20-f|6-k|40-f|def\s*14a)", r"(?:annual|quarterly|current) report",
))


def within(haystack: Column, needles: Sequence[str]) -> Column:
    """Whether any needle stands in a text as whole words; white space on both sides must be squashed alike."""
    wanted = sorted({n for n in needles if n}, key=lambda n: (-len(n), n))
    return haystack.rlike(r"\b(?:" + "|".join(re.escape(n) for n in wanted) + r")\b") if wanted else F.lit(False)


def squashed(text: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), r"\s+", " "))


def tier(phrase: Column, df: Column, documents_: Column, private: Sequence[str], products: Sequence[str]) -> Column:
    """The first tier of the ladder that a squashed phrase falls in.

    private and products are lower-cased values; those of fewer than four characters only count as a whole phrase."""
    words = F.split(phrase, " ")
    long = lambda xs: [x for x in xs if len(x) >= LEAST_VALUE]
    left = F.filter(words, lambda w: ~w.isin(*EMPTY_WORDS))
    share = F.when(documents_ > 0, df / documents_).otherwise(F.lit(0.0))
    is_private = within(phrase, long(private))
    if private:
        is_private = is_private | phrase.isin(*private)
    rules = {
        "synthetic_placeholder": phrase.rlike(PLACEHOLDER),
        "product_or_platform_phrase": within(phrase, long(products)),
        "raw_direct_identifier": is_private,
        "accounting_taxonomy_boilerplate": within(phrase, ACCOUNTING),
        "sec_xbrl_boilerplate": F.exists(words, lambda w: w.isin(*FILING_WORDS)),
        "date_period_boilerplate": phrase.rlike(PERIOD),
        "low_information_ngram": (documents_ >= LEAST_DOCUMENTS) & (share >= LOW_INFORMATION),
        "generic_financial_phrase": (F.size(left) > 0) & F.forall(left, lambda w: w.isin(*FINANCIAL_WORDS, *FILING_WORDS)),
    }
    out = None
    for name, rule in rules.items():
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out.otherwise(TIERS[-1][0])


def split_values(values: Mapping[str, Sequence[str]]) -> tuple[list[str], list[str]]:
    """(private, products) of private values by bucket, lower-cased; placeholders are neither."""
    private, products = set(), set()
    for bucket, items in values.items():
        for item in items:
            low = item.strip().lower()
            if low and not re.search(PLACEHOLDER, low):
                (products if bucket in ("product", "platform") else private).add(low)
    return sorted(private), sorted(products)


def surviving_phrases(docs: DataFrame, values: Mapping[str, Sequence[str]], least: int = 3, most: int = 7) -> DataFrame:
    """(phrase, n, df, tier, blocking) of every phrase of 3 to 7 words with a capital that is no private value.

    Counts are combined by document first, where a phrase's repeats are, so a common phrase costs a task one row."""
    private, products = split_values(values)
    grams = docs.select("doc_id", F.explode(quality.cased_grams(F.col("text"), least, most)).alias("phrase"))
    counted = grams.groupBy("phrase", "doc_id").agg(F.count("*").alias("n")).groupBy("phrase").agg(F.sum("n").alias("n"), F.count("*").alias("df"))
    total = docs.agg(F.greatest(F.count("*"), F.lit(1)).alias("documents"))
    kept = counted.filter(~F.col("phrase").isin(*private)) if private else counted
    of = tier(F.col("phrase"), F.col("df"), F.col("documents"), private, products)
    blocking = F.col("tier").isin(*[name for name, blocks in TIERS if blocks])
    return kept.crossJoin(F.broadcast(total)).select("phrase", "n", "df", of.alias("tier")).withColumn("blocking", blocking)  # total is one row


def rare_phrase_attack(docs: DataFrame, values: Mapping[str, Sequence[str]], top: int = 20) -> DataFrame:
    """(blocking, rank, phrase_hash, tier, n): of each side the `top` phrases by (-n, phrase), as hashes."""
    found = surviving_phrases(docs, values)
    rank = F.row_number().over(Window.partitionBy("blocking").orderBy(F.desc("n"), "phrase"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.select("blocking", "rank", F.substring(F.sha2("phrase", 256), 1, 12).alias("phrase_hash"), "tier", "n")


def phrase_verdict(docs: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row: how many phrases survive, how many of them block, by tier, and whether the attack passes."""
    counted = surviving_phrases(docs, values).groupBy("tier", "blocking").agg(F.count("*").alias("phrases"))
    by_tier = F.map_from_entries(F.array_sort(F.collect_list(F.struct("tier", "phrases"))))
    blocking = F.coalesce(F.sum(F.when(F.col("blocking"), F.col("phrases"))), F.lit(0))
    return counted.agg(F.coalesce(F.sum("phrases"), F.lit(0)).alias("surviving"), blocking.alias("blocking"), by_tier.alias("by_tier"), (blocking == 0).alias("passed"))


def retrieval_attack(source: DataFrame, masked: DataFrame, answer: str | int | None = None, top: int = 10, compat: bool = False) -> DataFrame:
    """BM25 of the masked texts as one query against the source corpus; one row.

    An empty corpus fails and one of a single document passes vacuously. Otherwise the attack passes if the document
    `answer` is not among the `top`; compat=True (and no answer) always passes with rank 1, as published."""
    text = F.array_join(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).getField("text"), "\n")
    query = masked.agg(text.alias("text")).select(F.lit(0).alias("query_id"), "text")
    ranked = documents.bm25(source, query, top=top)
    same = F.col("doc_id") == F.lit(answer)
    best = ranked.agg(F.min(F.when(same, F.col("rank"))).alias("found"), F.count("*").alias("listed"))
    out = source.agg(F.count("*").alias("corpus")).crossJoin(F.broadcast(best))  # one row each
    rank = F.when(F.col("corpus") == 0, -1).when(F.lit(compat or answer is None), 1).otherwise(F.coalesce("found", F.lit(-1)))
    passed = F.when(F.col("corpus") == 0, False).when(F.col("corpus") == 1, True).when(F.lit(compat or answer is None), True).otherwise(F.col("found").isNull())
    return out.select("corpus", rank.alias("source_rank"), (F.col("corpus") == 1).alias("vacuous"), passed.alias("passed"))


def numeric_attack(public: DataFrame, source: DataFrame, most: float = 0.95) -> DataFrame:
    """Cosine of the histograms of two sets of numbers (value); passes up to `most`, and where either side is empty.

    Numbers that are not positive have no logarithm and take no part."""
    both = public.select("value", F.lit("a").alias("side")).unionByName(source.select("value", F.lit("b").alias("side"))).filter("value > 0")
    sizes = both.agg(F.count_if(F.col("side") == "a").alias("public_values"), F.count_if(F.col("side") == "b").alias("source_values"))
    out = sizes.crossJoin(F.broadcast(governance.histogram_cosine(both)))  # one row each
    empty = (F.col("public_values") == 0) | (F.col("source_values") == 0)
    return out.withColumn("no_data", empty).withColumn("passed", empty | (F.col("cosine") <= most))


def semantic_suite(sections: DataFrame, news: DataFrame, source: DataFrame, values: Mapping[str, Sequence[str]], public_numbers: DataFrame, source_numbers: DataFrame, answer: str | int | None = None) -> DataFrame:
    """(attack, passed) of the four semantic attacks on masked filings, masked news and the source corpus."""
    every = sections.select("doc_id", "text").unionByName(news.select("doc_id", "text"))
    parts = {
        "rare_phrase": phrase_verdict(every, values),
        "lexical_retrieval": retrieval_attack(source, sections, answer),
        "multi_document": retrieval_attack(source, every, answer),
        "structured_numeric_similarity": numeric_attack(public_numbers, source_numbers),
    }
    out = None
    for name, part in parts.items():
        row = part.select(F.lit(name).alias("attack"), "passed")
        out = row if out is None else out.unionByName(row)
    return out


def suite_report(results: DataFrame) -> DataFrame:
    """One row: attacks, failures and whether all pass; no results are no pass."""
    failed = F.count_if(~F.coalesce("passed", F.lit(False)))
    return results.agg(F.count("*").alias("attacks"), failed.alias("failures"), ((F.count("*") > 0) & (failed == 0)).alias("passed"))
