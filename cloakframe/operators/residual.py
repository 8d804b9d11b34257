"""Residual scans: private values that still stand in texts, names, metadata and trees of files.

The values are a table of some thousands at most, held by every worker. One automaton over all of them tells which stand in a
text at all, so the forms of a value are only tried on texts that have it, and a plan does not grow with the values."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The kinds of which one hit blocks a release.
BLOCKING = ("company", "former_company_name", "ticker", "cik", "sec_accession_number", "sec_primary_document", "company_domain", "company_email_domain", "canary")
#: The exchanges that stand before a ticker.
EXCHANGES = r"(?:NYSE|NASDAQ|NYSE\s*Arca)"
HIT = "struct<kind:string,value:string,form:string,found:string,start:int,context:string,blocking:boolean>"

Value = tuple[str, str]  # kind and value


@dataclass(frozen=True)
class Pattern:
    kind: str
    value: str
    form: str
    regex: str
    cores: tuple[str, ...]  # one of these stands in every text that the regex matches, but for case
    blocking: bool
    any_case: bool = False


def forms_of(kind: str, value: str) -> dict[str, str]:
    """The forms in which a value of a kind is looked for, by name."""
    literal = re.escape(value)
    if kind == "cik":
        number = re.escape(value.lstrip("0"))
        return {"padded": rf"CIK\s*#?\s*0*{number}\b|\b0*{number}\b"}
    forms = {"literal": literal}
    if kind == "sec_accession_number":
        forms = {"url": re.escape(value.replace("-", "")) + "|" + literal, "literal": literal}
    elif kind in ("company_domain", "company_email_domain"):
        forms = {"url": rf"https?://(?:www\.)?{literal}[^\s]*|{literal}", "email": rf"[\w.+-]+@{literal}", "literal": rf"\b{literal}\b"}
    elif kind in ("company", "former_company_name"):
        forms["possessive"] = rf"(?:{literal})'s\b"
    elif kind == "ticker":
        upper = re.escape(value.upper())
        forms |= {"exchange": rf"{EXCHANGES}\s*:\s*{upper}\b", "parenthesised": rf"\({upper}\)"}
    return forms


def _cores(kind: str, value: str, form: str) -> tuple[str, ...]:
    if kind == "cik":
        return (value.lstrip("0"),)
    return (value, value.replace("-", "")) if (kind, form) == ("sec_accession_number", "url") else (value,)


def exact_patterns(values: Iterable[Value]) -> list[Pattern]:
    """Every form of every value; values of white space are left out."""
    held = [(k, v) for k, v in values if v.strip()]
    return [Pattern(k, v, form, regex, _cores(k, v, form), k in BLOCKING) for k, v in held for form, regex in forms_of(k, v).items()]


def phrase_patterns(phrases: Iterable[str]) -> list[Pattern]:
    """Phrases in any case; every hit blocks."""
    return [Pattern("phrase", p, "phrase", re.escape(p), (p,), True, True) for p in phrases if p.strip()]


def bounded_patterns(values: Iterable[Value]) -> list[Pattern]:
    """Values in any case with no letter or digit (of ASCII) beside them."""
    return [Pattern(k, v, "bounded", rf"(?<![A-Za-z0-9]){re.escape(v)}(?![A-Za-z0-9])", (v,), True, True) for k, v in values if v.strip()]


def finder(cores: Sequence[tuple[str, ...]]) -> Callable[[str], set[int]]:
    """Which of the groups of cores have one in a text, in whatever case: one pass, by an automaton."""
    places: dict[str, list[int]] = {}
    for i, group in enumerate(cores):
        for core in group:
            places.setdefault(core.casefold(), []).append(i)
    always = set(places.pop("", []))
    if not places:
        return lambda text: always
    try:
        import ahocorasick
    except ImportError:  # slower, with the same result
        return lambda text: always | {i for core, at in places.items() if core in text.casefold() for i in at}
    automaton = ahocorasick.Automaton()
    for core, at in places.items():
        automaton.add_word(core, at)
    automaton.make_automaton()
    return lambda text: always | {i for _, at in automaton.iter(text.casefold()) for i in at}


def hits(text: Column, patterns: Sequence[Pattern], context: int = 20, once: bool = False) -> Column:
    """An array of hits (kind, value, form, found, start, context, blocking), in order of pattern and start.

    Matches of one pattern do not overlap; `once` keeps a value's first. Values are escaped, so no pattern can be invalid.
    Null and empty texts have none."""
    fields = [("kind", pa.string()), ("value", pa.string()), ("form", pa.string()), ("found", pa.string()), ("start", pa.int32()), ("context", pa.string()), ("blocking", pa.bool_())]
    kind = pa.list_(pa.struct(fields))
    patterns = list(patterns)

    def run(column: pa.Array) -> pa.Array:
        find = finder([p.cores for p in patterns])
        compiled = [re.compile(p.regex, re.IGNORECASE if p.any_case else 0) for p in patterns]
        out = []
        for item in column:
            body, found = item.as_py() or "", []
            for i in sorted(find(body)) if body else ():
                p = patterns[i]
                for m in compiled[i].finditer(body):
                    around = body[max(0, m.start() - context) : m.end() + context].replace("\n", " ")
                    found.append({"kind": p.kind, "value": p.value, "form": p.form, "found": m.group(), "start": m.start(), "context": around, "blocking": p.blocking})
                    if once:
                        break
            out.append(found)
        return pa.array(out, kind)

    return F.arrow_udf(run, f"array<{HIT}>")(F.coalesce(text.cast("string"), F.lit("")))


def metadata_text(metadata: Column) -> Column:
    """`key: value` lines of a map, by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(metadata)), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None")))), "\n")


def scanned(rows: DataFrame, values: Sequence[Value], text_col: str = "text", metadata_col: str | None = None) -> DataFrame:
    """Rows with `hits` of text (and of metadata) and `scan` (total, blocking, allowed, is_blocked, by_kind)."""
    patterns = exact_patterns(values)
    found = hits(F.col(text_col), patterns)
    if metadata_col is not None:
        found = F.concat(found, hits(metadata_text(F.col(metadata_col)), patterns))
    return rows.withColumn("hits", found).withColumn("scan", scan_result(F.col("hits")))


def scan_result(found: Column) -> Column:
    """(total, blocking, allowed, is_blocked, by_kind) of an array of hits."""
    blocking = F.size(F.filter(found, lambda h: h["blocking"]))
    kinds = F.array_sort(F.array_distinct(F.transform(found, lambda h: h["kind"])))
    by_kind = F.map_from_entries(F.transform(kinds, lambda k: F.struct(k, F.size(F.filter(found, lambda h: h["kind"] == k)))))
    return F.struct(F.size(found).alias("total"), blocking.alias("blocking"), (F.size(found) - blocking).alias("allowed"), (blocking > 0).alias("is_blocked"), by_kind.alias("by_kind"))


def long_hits(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row a hit: the id and the hit's fields."""
    return rows.select(id_col, F.inline("hits"))


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def digital_hits(text: Column, domains: Sequence[str] = (), emails: Sequence[str] = (), phones: Sequence[str] = ()) -> Column:
    """(urls, domains, emails, phones, total): every URL, listed domains by case, listed addresses in any case (one hit
    a text each), and every place of a listed phone number. JVM-side."""
    clean = lambda xs: sorted({x.strip() for x in xs if x.strip()})
    urls = F.regexp_count(text, F.lit(r"https?://[^\s]+"))
    of_domains = F.size(F.filter(_literals(clean(domains)), lambda d: F.contains(text, d)))
    of_emails = F.size(F.filter(_literals(sorted({e.lower() for e in clean(emails)})), lambda e: F.contains(F.lower(text), e)))
    places = lambda p: ((F.length(text) - F.length(F.replace(text, p, F.lit("")))) / F.length(p)).cast("int")
    of_phones = F.aggregate(_literals(clean(phones)), F.lit(0), lambda n, p: n + places(p))
    parts = [urls, of_domains, of_emails, of_phones]
    return F.struct(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for c, n in zip(parts, ("urls", "domains", "emails", "phones"), strict=True)])


def name_hits(names: DataFrame, values: Sequence[Value], name_col: str = "name") -> DataFrame:
    """(name, kind, value) of each value that a file's name holds, in any case. JVM-side."""
    table = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("value")) for k, v in values if v.strip()])
    held = F.filter(table, lambda v: F.contains(F.lower("_name"), F.lower(F.trim(v["value"]))))
    rows = names.select(F.col(name_col).alias("_name"))
    empty = rows.select(F.col("_name").alias("name"), F.lit("").alias("kind"), F.lit("").alias("value")).limit(0)
    return rows.select(F.col("_name").alias("name"), F.inline(held)) if any(v.strip() for _, v in values) else empty


def scan_tree(spark: SparkSession, folder: str, values: Sequence[Value], compat: bool = False) -> DataFrame:
    """(path, hits, scan) of the Markdown and JSON files under a folder.

    compat=True gives hits only of files with a blocking one, as published."""
    rows = spark.read.option("pathGlobFilter", "*.{md,json}").option("recursiveFileLookup", True).text(folder, wholetext=True)
    out = scanned(rows.select(F.input_file_name().alias("path"), F.col("value").alias("text")), values).drop("text")
    if not compat:
        return out
    shown = F.when(F.col("scan.is_blocked"), F.col("hits")).otherwise(F.filter("hits", lambda h: F.lit(False)))
    return out.withColumn("hits", shown).withColumn("scan", scan_result(F.col("hits")))


#: What an accession number looks like in a path, and what marks raw XML.
ACCESSION = r"\d{10}-\d{2}-\d{6}|\d{18}"
XBRL_TAG = r"(?i)<(ix:|xbrli:|link:|xlink:|us-gaap:)"
NAMESPACE = r"(?i)xmlns[^=]*=[\"']([^\"']*)[\"']"
SCHEMA = r"(?i)xsi:schemaLocation=[\"']([^\"']*)[\"']"
CIK_ATTRIBUTE = r"(?i)EntityCentralIndexKey[^>]*?\"?(\d+)\"?"
CIK_URL = r"(?i)cik[=:/]\d+"
LINK = r"\[[^\]]*\]\(([^)]+)\)"


def _held(text: Column, values: Sequence[str], least: int = 3) -> Column:
    """How many of the values of `least` characters stand in a text, by case."""
    return F.size(F.filter(_literals([v for v in values if len(v) >= least]), lambda v: F.contains(text, v))).cast("long")


def _held_in_all(texts: Column, values: Sequence[str], least: int = 3) -> Column:
    return F.aggregate(F.transform(texts, lambda t: _held(t, values, least)), F.lit(0).cast("long"), lambda a, n: a + n)


def namespace_findings(files: DataFrame, values: Sequence[str]) -> DataFrame:
    """(path, detector, hits) of files (path, text) under a release, for every detector with a hit. JVM-side.

    path and filename look for values and accession numbers; the others read the text by the file's ending: json, csv, md
    (text and link targets), xml and html (tags, namespaces, schema references, CIK attributes and URLs), manifest."""
    path, text = F.col("path"), F.coalesce("text", F.lit(""))
    name = F.element_at(F.split(path, "/"), -1)
    ends = lambda *kinds: F.lower(name).rlike(r"\.(" + "|".join(kinds) + ")$")
    every = lambda pattern, group=1: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    numbers = [v.lstrip("0") for v in values if v.strip("0").isdigit()]
    of_cik = F.size(F.filter(every(CIK_ATTRIBUTE), lambda n: F.ltrim(n, F.lit("0")).isin(*numbers) if numbers else F.lit(False))).cast("long")
    flag = lambda c: c.cast("long")
    detectors = {
        "path": _held(path, values) + flag(path.rlike(ACCESSION)),
        "filename": flag(name.rlike(ACCESSION)),
        "json": F.when(ends("json"), _held(text, values)),
        "csv": F.when(ends("csv"), _held(text, values)),
        "markdown": F.when(ends("md"), _held(text, values) + _held_in_all(every(LINK), values)),
        "xml": F.when(ends("xml", "html?", "xbrl"), flag(text.rlike(XBRL_TAG)) + _held_in_all(every(NAMESPACE), values) + of_cik + _held_in_all(every(SCHEMA), values) + flag(text.rlike(CIK_URL))),
        "manifest": F.when(F.contains(F.lower(name), F.lit("manifest")), _held(text, values, 4)),
    }
    rows = F.array(*[F.struct(F.lit(n).alias("detector"), F.coalesce(c, F.lit(0)).alias("hits")) for n, c in detectors.items()])
    return files.select("path", F.inline(rows)).filter("hits > 0")


def table_findings(table: DataFrame, values: Sequence[str]) -> DataFrame:
    """D15, Parquet: (column, hits) of columns whose name holds a value, or one of whose string cells does; all rows are read."""
    names = [(c, sum(v in c for v in values if len(v) >= 3)) for c in table.columns]
    strings = [c for c, kind in table.dtypes if kind == "string"]
    wanted = [v for v in values if len(v) >= 4]
    held = [F.coalesce(F.count_if(F.contains(F.col(f"`{c}`"), F.lit(v))), F.lit(0)).alias(f"{i}_{j}") for i, c in enumerate(strings) for j, v in enumerate(wanted)]
    counted = F.array(*[F.struct(F.lit(c).alias("column"), (F.lit(n) + sum((F.when(F.col(f"`{strings.index(c)}_{j}`") > 0, 1).otherwise(0) for j in range(len(wanted))), F.lit(0)) if c in strings else F.lit(n)).cast("long").alias("hits")) for c, n in names])
    return table.agg(F.count("*").alias("rows"), *held).select(F.inline(counted)).filter("hits > 0")


def release_findings(files: DataFrame, values: Sequence[str]) -> DataFrame:
    """(path, finding, value): the first value in a file's path, and the first one in its text; one content finding a file."""
    first = lambda c: F.get(F.filter(_literals(sorted({v for v in values if len(v) >= 3})), lambda v: F.contains(c, v)), F.lit(0))
    found = F.array(*[F.struct(F.lit(n).alias("finding"), first(c).alias("value")) for n, c in (("path", F.col("path")), ("content", F.coalesce("text", F.lit(""))))])
    return files.select("path", F.inline(found)).filter("value is not null")


#: Pseudonyms of the system, which are no hits.
COUNTED = (
    "Company FormerCompanyName Ticker Cik SecAccessionNumber SecPrimaryDocument CompanyDomain CompanyEmailDomain Executive BoardMember Subsidiary BusinessSegment Product Brand "
    "ProprietaryPlatform Facility Headquarters AcquisitionTarget JointVenture Auditor LawFirm Customer Supplier Competitor Regulator Person Region"
).split()
PLACEHOLDERS = ("PERIOD DATE", "PUBLISHER REMOVED", "URL REMOVED", r"Executive-\*", r"Product-\*", r"Source-\*", r"Region-\*", r"Brand-\*", r"Subsidiary-\*")
SUPPRESSED = rf"^(?:(?:{'|'.join(COUNTED)})\s+\d{{1,4}}|synthetic financial (?:disclosure|news) surrogate|\[(?:{'|'.join(PLACEHOLDERS)})\])$"


def suppressible(value: Column) -> Column:
    """Whether a value as a whole is a pseudonym of the system."""
    return F.coalesce(F.trim(value).rlike(SUPPRESSED), F.lit(False))


def privacy_report(found: DataFrame, replaced: int, maskable: int, top: int = 10, id_col: str = "doc_id") -> dict[str, DataFrame]:
    """by_file, by_kind, top_values and summary of the hits (id, kind, found) that masking left.

    Pseudonyms of the system are counted apart and are no hits. Top values are cut to 30 characters. replacement_rate is
    replaced / maskable, 1 where nothing was maskable."""
    judged = found.withColumn("suppressed", suppressible(F.col("found")))
    real = judged.filter("not suppressed")
    shown = F.when(F.length("found") > 30, F.concat(F.substring("found", 1, 30), F.lit("..."))).otherwise(F.col("found"))
    rate = replaced / maskable if maskable > 0 else 1.0
    total = F.count_if(~F.col("suppressed"))
    return {
        "by_file": judged.groupBy(id_col).agg(total.alias("total_hits"), F.count_if("suppressed").alias("suppressed_hits"), (total > 0).alias("is_blocked")),
        "by_kind": real.groupBy("kind").agg(F.countDistinct("found").alias("values"), F.count("*").alias("hits")),
        "top_values": real.groupBy(shown.alias("value")).agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "value").limit(top),
        "summary": judged.agg(total.alias("post_mask_hits"), F.count_if("suppressed").alias("suppressed"), F.lit(rate).alias("replacement_rate"), (total == 0).alias("passed")),
    }
