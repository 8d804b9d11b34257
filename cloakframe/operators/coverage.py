"""Coverage, retention and profiles: what masking keeps, what discovery finds, what was collected, and what may be shown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers of finance, each form counted.
FINANCIAL = (r"\$\s*[\d,.]+", r"[\d,.]+%", r"\d+\.\d+x", r"\d+\s*(?:million|billion|thousand)")
WEIGHTS = {"tokens_kept": 0.25, "sections_kept": 0.25, "tables_kept": 0.15, "numbers_kept": 0.35}


def financial_numbers(text: Column) -> Column:
    """How many of each form stand in a text, added up; a number may count in two forms, as published."""
    return sum((F.regexp_count(text, F.lit(f"(?i){p}")) for p in FINANCIAL), F.lit(0))


def document_utility(pairs: DataFrame) -> DataFrame:
    """(doc_id, tokens_kept, sections_kept, tables_kept, numbers_kept, utility, warnings) of pairs (doc_id, source, masked,
    source_sections, masked_sections); what the source does not have counts as kept."""
    words = lambda c: F.size(F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\s+"), lambda w: w != ""))
    tables = lambda c: F.regexp_count(F.coalesce(F.col(c), F.lit("")), F.lit(r"\|.*\|"))
    numbers = lambda c: financial_numbers(F.coalesce(F.col(c), F.lit("")))
    share = lambda f: F.when(f("source") > 0, f("masked") / f("source")).otherwise(F.lit(1.0))
    known = (F.coalesce("source_sections", F.lit(0)) > 0) & (F.coalesce("masked_sections", F.lit(0)) > 0)
    sections = F.when(known, F.col("masked_sections") / F.col("source_sections")).otherwise(F.lit(1.0))
    out = pairs.select("doc_id", share(words).alias("tokens_kept"), sections.alias("sections_kept"), share(tables).alias("tables_kept"), share(numbers).alias("numbers_kept"))
    total = sum((F.col(c) * w for c, w in WEIGHTS.items()), F.lit(0.0))
    warnings = F.array_compact(F.array(F.when(F.col("tokens_kept") < 0.85, "few tokens"), F.when(F.col("numbers_kept") < 0.90, "few numbers")))
    return out.withColumn("utility", total).withColumn("warnings", warnings).select("doc_id", *[F.round(c, 6).alias(c) for c in (*WEIGHTS, "utility")], "warnings")


def masking_coverage(found: DataFrame, masked: DataFrame) -> DataFrame:
    """(doc_id, total, masked, unmasked, high_confidence_unmasked, coverage_pct, by_kind, warnings) of what was discovered
    (doc_id, kind, start, end, confidence) against the masked ranges (doc_id, start, end): any overlap counts as masked."""
    m = masked.select(F.col("doc_id").alias("_doc"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    over = (F.col("doc_id") == F.col("_doc")) & (F.col("start") < F.col("_end")) & (F.col("end") > F.col("_start"))
    hidden = found.join(m, over, "left_semi").withColumn("hidden", F.lit(True))
    rows = hidden.unionByName(found.join(m, over, "left_anti").withColumn("hidden", F.lit(False)))
    kinds = rows.groupBy("doc_id", "kind").agg(F.count("*").alias("n"), F.count_if("hidden").alias("hidden"), F.count_if(~F.col("hidden") & (F.col("confidence") >= 0.7)).alias("sure"))
    out = kinds.groupBy("doc_id").agg(F.sum("n").alias("total"), F.sum("hidden").alias("masked"), F.sum("sure").alias("high_confidence_unmasked"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("by_kind"))
    pct = F.round(F.col("masked") / F.col("total") * 100, 1)
    warnings = F.array_compact(F.array(F.when(F.col("high_confidence_unmasked") > 0, "high-confidence entities left"), F.when(pct < 50, "low coverage")))
    return out.select("doc_id", "total", "masked", (F.col("total") - F.col("masked")).alias("unmasked"), "high_confidence_unmasked", pct.alias("coverage_pct"), "by_kind", warnings.alias("warnings"))


def whole_bars(bars: DataFrame) -> DataFrame:
    """(entity_id, valid): whether high and low bound open and close in every bar of a series."""
    ok = (F.col("high") >= F.col("low")) & (F.col("high") >= F.col("open")) & (F.col("high") >= F.col("close")) & (F.col("low") <= F.col("open")) & (F.col("low") <= F.col("close"))
    return bars.groupBy("entity_id").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("valid"))


def to_bars(raw: DataFrame, columns: Sequence[str] = ("Open", "High", "Low", "Close", "Volume")) -> DataFrame:
    """Rows of text or numbers (entity_id, bar_idx, Open, ...) as bars; rows with what is no number go, and an adjusted close
    that lacks is the close."""
    values = [F.col(c).cast("string").try_cast("double").alias(c.lower()) for c in columns]
    adjusted = F.col("Adj Close").cast("string").try_cast("double") if "Adj Close" in raw.columns else F.lit(None).cast("double")
    out = raw.select("entity_id", "bar_idx", *values, adjusted.alias("adj_close"))
    whole = out.dropna(subset=[c.lower() for c in columns])
    return whole.withColumn("adj_close", F.coalesce("adj_close", "close"))


def profile(table: DataFrame) -> DataFrame:
    """One row: rows, columns, missing values and a hash of the column names."""
    missing = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in table.columns), F.lit(0))
    return table.agg(F.count("*").alias("rows"), F.lit(len(table.columns)).alias("columns"), missing.alias("missing")).withColumn("columns_hash", F.substring(F.sha2(F.lit("|".join(sorted(table.columns))), 256), 1, 16))


def source_coverage(results: DataFrame) -> DataFrame:
    """(source, artifacts, successful, rows, filings, by_form, has_data, warnings) of collected artefacts (source,
    artifact_type, status, row_count, forms)."""
    ok = F.col("status") == "success"
    forms = results.select("source", F.explode("forms").alias("form")).groupBy("source", "form").agg(F.count("*").alias("n"))
    forms = forms.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("form", "n")))).alias("by_form"))
    empty_facts = F.max((F.col("artifact_type") == "companyfacts") & (F.coalesce("row_count", F.lit(0)) == 0))
    out = results.groupBy("source").agg(
        F.count("*").alias("artifacts"), F.count_if(ok).alias("successful"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
        F.coalesce(F.max(F.when(F.col("artifact_type") == "filing_documents", F.col("row_count"))), F.lit(0)).alias("filings"), empty_facts.alias("_empty"),
    )
    warnings = F.when(F.coalesce("_empty", F.lit(False)), F.array(F.lit("company facts are empty"))).otherwise(F.array().cast("array<string>"))
    return out.join(forms, "source", "left").select("source", "artifacts", "successful", "rows", "filings", "by_form", (F.col("successful") > 0).alias("has_data"), warnings.alias("warnings"))


def inventory_report(files: DataFrame) -> DataFrame:
    """(dimension, value, files, bytes) by ticker (`unknown` where there is none), form and year, and of all."""
    values = {"all": F.lit(""), "ticker": F.coalesce("ticker", F.lit("unknown")), "form": F.col("form"), "year": F.col("year").cast("string")}
    rows = F.array(*[F.struct(F.lit(n).alias("dimension"), v.alias("value")) for n, v in values.items()])
    return files.select("length", F.inline(rows)).filter("value is not null").groupBy("dimension", "value").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def archive_coverage(files: DataFrame) -> DataFrame:
    """(ticker, form, year, files) with subtotals by ticker and form, by ticker, and of all (null where a level is summed)."""
    rows = files.select(F.coalesce("ticker", F.lit("unknown")).alias("ticker"), F.coalesce("form", F.lit("unknown")).alias("form"), F.coalesce("year", F.lit(0)).alias("year"))
    return rows.rollup("ticker", "form", "year").agg(F.count("*").alias("files"))


#: What may be shown of metadata, of a backtest, of a review.
SHOWN = {"backtest": ("submission_id", "trade_rate", "hit_rate", "turnover", "status"), "review": ("ticker", "samples", "verdict", "max_confidence", "review_status")}


def sanitised_metadata(meta: DataFrame) -> DataFrame:
    """Metadata with the ticker as ANON and, of its summary, kind, status and rows alone."""
    parts = F.transform("collection_summary", lambda s: F.struct(s["artifact_type"].alias("artifact_type"), s["status"].alias("status"), s["row_count"].alias("row_count")))
    return meta.select(F.lit("ANON").alias("ticker"), "collection_timestamp", "years_requested", parts.alias("collection_summary"))


def projected(rows: DataFrame, kind: str) -> DataFrame:
    """Of a result only what may be shown: no returns, dates, curves, guesses or texts."""
    return rows.select(*[c for c in SHOWN[kind] if c in rows.columns])


def fiscal(day: Column) -> Column:
    """(year, quarter) of a date as text; null for what is no date."""
    whole = F.substring(day, 1, 10).try_cast("date")
    return F.struct(F.substring(day, 1, 4).try_cast("int").alias("year"), F.quarter(whole).alias("quarter"))


def filtered_filings(rows: DataFrame, forms: Sequence[str] = (), accessions: Sequence[str] = (), years: Sequence[int] = (), quarters: Sequence[int] = (), first: str | None = None, last: str | None = None, lookback: int | None = None, as_of: str | None = None) -> DataFrame:
    """Filings (form, accessionNumber, reportDate, filingDate) by form, accession, year and quarter of the report's
    date (else the filing's), bounds of the filing date as text, and years before `as_of`."""
    day = F.coalesce(F.nullif("reportDate", F.lit("")), F.col("filingDate"))
    facts = fiscal(day)
    out = rows
    out = out.filter(F.col("form").isin(*forms)) if forms else out
    out = out.filter(F.col("accessionNumber").isin(*accessions)) if accessions else out
    out = out.filter(facts["year"].isin(*years)) if years else out
    out = out.filter(facts["quarter"].isin(*quarters)) if quarters else out
    out = out.filter(F.col("filingDate") >= first) if first else out
    out = out.filter(F.col("filingDate") <= last) if last else out
    if lookback is not None and as_of is not None:
        out = out.filter(F.col("filingDate").try_cast("date") >= F.add_months(F.lit(as_of).cast("date"), -12 * lookback))
    return out


#: A form in a file's name.
FORM_IN_NAME = {"10-K": r"(?i)(?:^|[_-])10[-_]?K(?:[_-]|$)", "10-Q": r"(?i)(?:^|[_-])10[-_]?Q(?:[_-]|$)", "8-K": r"(?i)(?:^|[_-])8[-_]?K(?:[_-]|$)"}


def parse_limits(text: str | None) -> dict[str, int]:
    """`10-K:1,10-Q:2` as form to number; without a number 1, and of a form that stands twice the larger. What is no form or
    no whole number from 1 is an error."""
    import re

    out: dict[str, int] = {}
    for token in (t.strip() for t in (text or "").split(",")):
        if token:
            form, colon, count = (x.strip() for x in token.partition(":"))
            if not re.fullmatch(r"[0-9A-Za-z-]+", form) or (colon and not re.fullmatch(r"0*[1-9]\d*", count)):
                raise ValueError(f"not a form limit: {token!r}")
            out[form.upper()] = max(out.get(form.upper(), 0), int(count) if colon else 1)
    return out


def inferred_form(name: Column) -> Column:
    """The form in a file's name, without its ending; null if there is none."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    out = None
    for form, pattern in FORM_IN_NAME.items():
        out = F.when(stem.rlike(pattern), form) if out is None else out.when(stem.rlike(pattern), form)
    return out


def limited(files: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Files (name) with their form, of each form with a limit the first so many by name; the rest all stay."""
    from pyspark.sql import Window

    rows = files.withColumn("form", inferred_form(F.col("name")))
    if not limits:
        return rows
    most = F.try_element_at(F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]), F.col("form"))
    capped = rows.withColumn("_most", most)
    nth = F.row_number().over(Window.partitionBy("form").orderBy("name"))
    held = capped.filter("_most is not null").withColumn("_n", nth).filter("_n <= _most").drop("_n")
    return held.unionByName(capped.filter("_most is null")).drop("_most")


#: The numeric data sets that a release must have, and what a Markdown filing may not hold.
DATASETS = (
    "metrics/ohlcv.parquet", "metrics/dividends.parquet", "metrics/splits.parquet", "statements/income_statement_annual.parquet", "statements/balance_sheet_annual.parquet",
    "statements/cash_flow_annual.parquet", "sec/companyfacts.parquet",
)


def missing_datasets(files: DataFrame) -> DataFrame:
    """The required data sets that no path (path) ends with."""
    wanted = files.sparkSession.createDataFrame([(d,) for d in DATASETS], "dataset string")
    return wanted.join(files.select("path"), F.expr("endswith(path, dataset)"), "left_anti")


def format_faults(files: DataFrame) -> DataFrame:
    """(path, fault) of Markdown filings (path, text): raw markup at the start, tags, namespaces, schema references, little
    prose, or too short."""
    from . import residual

    text = F.coalesce("text", F.lit(""))
    prose = F.length(F.regexp_replace(text, r"[\s\d\p{P}]", ""))
    rules = {
        "raw markup": F.regexp_like(F.ltrim(text), F.lit(r"^(?:<html|<HTML|<xml|<\?xml|<ix:|<xbrli:)")), "xbrl tags": text.rlike(residual.XBRL_TAG), "namespaces": text.rlike(residual.NAMESPACE),
        "schema references": text.rlike(residual.SCHEMA), "little prose": prose < 20, "too short": F.length(F.trim(text)) < 50,
    }
    return files.select("path", F.explode(F.array_compact(F.array(*[F.when(c, n) for n, c in rules.items()]))).alias("fault"))


#: Names of settings whose values are secrets.
SECRET = r"(?i)(key|token|secret|password|auth|credential)"


def redacted_log(line: Column) -> Column:
    """A line of a log with the values of secret names as \"***\", written with = or : or as JSON."""
    plain = F.regexp_replace(line, r"(?i)(\w*(?:key|token|secret|password|auth|credential)\w*)\s*([=:])\s*[\"']?([^\"'\s]+)[\"']?", '$1$2"***"')
    return F.regexp_replace(plain, r"(?i)[\"'](\w*(?:key|token|secret|password|auth|credential)\w*)[\"']\s*:\s*[\"']([^\"']+)[\"']", '"$1":"***"')


def redacted_fields(values: Column) -> Column:
    """A map of settings with secret names' values as ***."""
    return F.transform_values(values, lambda k, v: F.when(k.rlike(SECRET), F.lit("***")).otherwise(v))


def forbidden_keys(rows: DataFrame, keys: Sequence[str], json_col: str = "report", id_col: str = "id") -> DataFrame:
    """(id, path) of keys, at any depth of a JSON text, that may not be there.

    Objects and arrays are opened level by level, up to 16 of them, by variant_explode; deeper ones are an error."""
    level = rows.select(F.col(id_col).alias("id"), F.lit("$").alias("path"), F.try_parse_json(F.col(json_col)).alias("v")).filter("v is not null")
    found, spark = None, rows.sparkSession
    for depth in range(17):
        level.createOrReplaceTempView(f"_cloakframe_keys_{depth}")
        opened = spark.sql(f"SELECT t.id, t.path, e.key, e.pos, e.value AS v FROM _cloakframe_keys_{depth} t, LATERAL variant_explode(t.v) e")
        named = opened.select("id", F.concat(F.col("path"), F.when(F.col("key").isNotNull(), F.concat(F.lit("."), "key")).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))).alias("path"), "key", "v")
        hits = named.filter(F.col("key").isin(*keys)).select("id", "path") if keys else named.select("id", "path").limit(0)
        found = hits if found is None else found.unionByName(hits)
        level = named.filter(F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")).select("id", "path", "v")
        if depth == 16 and not level.isEmpty():
            raise ValueError("more than 16 levels")
        if level.isEmpty():
            break
    return found


def private_looking(value: Column, marks: Sequence[str]) -> Column:
    """Whether a text holds one of the marks of private data, in any case."""
    return F.coalesce(F.exists(F.array(*[F.lit(m.lower()) for m in marks]).cast("array<string>"), lambda m: F.contains(F.lower(value), m)), F.lit(False))


def sanitised_paths(text: Column, private_root: str = "", repository: str = "") -> Column:
    """A path or message with the private folder and the repository's replaced by their names."""
    for root, name in ((private_root, "[PRIVATE_ROOT]"), (repository, "[REPO_ROOT]")):
        if root:
            text = F.replace(text, F.lit(root), F.lit(name))
    return text
