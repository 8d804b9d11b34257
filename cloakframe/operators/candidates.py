"""Candidates of discovery providers: construction, keys, agreement, ranking, proposals, sanitised summaries, chunk risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quality
from .residual import _literals

#: The kind of a provider's label; unknown labels are UNKNOWN.
LABELS = {
    "company or organization name": "company", "company": "company", "organization name": "company", "corporation": "company", "former company name": "former_company_name",
    "executive or board member": "executive", "executive": "executive", "ceo": "executive", "cfo": "executive", "chief executive officer": "executive", "chief financial officer": "executive",
    "board member": "board_member", "company subsidiary": "subsidiary", "subsidiary": "subsidiary", "business segment": "business_segment", "division": "business_segment",
    "commercial product or brand": "product", "product": "product", "product name": "product", "brand": "brand", "brand name": "brand",
}
#: The counters of a provider's validation.
COUNTERS = ("missing_span", "invalid_offsets", "out_of_range", "invalid_score", "text_mismatch", "below_threshold", "unknown_label", "duplicate", "accepted", "rejected")


def canonical(label: Column) -> Column:
    """H10."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), label), F.lit("UNKNOWN"))


def span_key(start: Column, end: Column) -> Column:
    """`start:end`; null for a span that is none."""
    return F.when((start >= 0) & (end > start), F.concat_ws(":", start.cast("string"), end.cast("string")))


def shapes(value: Column) -> Column:
    """(ticker, domain, legal_suffix, proper_noun): what a value looks like; a ticker's shape needs a sign that is no letter."""
    upper = F.upper(value)
    ticker = (F.length(upper) <= 5) & upper.rlike("[A-Z]") & upper.rlike("[^A-Z]")
    legal = F.concat(F.lit(" "), upper, F.lit(" ")).rlike("|".join(quality.LEGAL_SUFFIXES))
    proper = value.rlike(r"^\p{Lu}") & value.rlike(r"\p{Ll}")
    return F.struct(ticker.alias("ticker"), upper.rlike(r"\.(COM|ORG|NET)$").alias("domain"), legal.alias("legal_suffix"), proper.alias("proper_noun"))


def built(spans: DataFrame, chunks: DataFrame) -> DataFrame:
    """Spans (chunk_id, start, end, label, score, provider) as candidates with places in the document and an opaque id.

    chunks: (chunk_id, doc_id, start_offset, text); spans of unknown chunks are left out."""
    both = spans.join(chunks.select("chunk_id", "doc_id", "start_offset", "text"), "chunk_id")
    at = F.col("start_offset") + F.col("start")
    text = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))
    ident = F.concat(F.lit("cand-"), F.substring(F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), "provider", at.cast("string"), F.col("end").cast("string"), "label"), 256), 1, 16))
    return both.select(ident.alias("candidate_id"), "doc_id", "provider", canonical(F.col("label")).alias("entity_type"), at.alias("start"), (F.col("start_offset") + F.col("end")).alias("end"), text.alias("text"), F.col("score").alias("confidence"))


def concatenated(responses: Sequence[DataFrame]) -> DataFrame:
    """The candidates of all providers; columns that one lacks are null."""
    out = responses[0]
    for more in responses[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def deduplicated(candidates: DataFrame) -> DataFrame:
    """Of candidates with one span of a document the most confident (then the smallest id), with the ids and providers
    of all in `group`; candidates without a valid span all stay.

    Groups are formed by an aggregate, so a span that very many name is combined before the shuffle."""
    key = span_key(F.col("start"), F.col("end"))
    columns = candidates.columns
    rows = candidates.withColumn("_key", key)
    order = F.struct(-F.col("confidence"), "candidate_id")
    grouped = rows.filter("_key is not null").groupBy("doc_id", "_key").agg(F.min_by(F.struct(*columns), order).alias("r"), F.sort_array(F.collect_set("candidate_id")).alias("group"), F.count_distinct("provider").alias("providers"))
    alone = rows.filter("_key is null").select(*columns, F.array("candidate_id").alias("group"), F.lit(1).cast("long").alias("providers"))
    return grouped.select("r.*", "group", "providers").unionByName(alone)


def ranked(candidates: DataFrame) -> DataFrame:
    """Candidates of a document by confidence, then id, numbered from 1."""
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("confidence"), "candidate_id"))
    return candidates.withColumn("rank", nth)


def sanitised(candidates: DataFrame) -> DataFrame:
    """What may be shown of a candidate: ids (an opaque one from the id, not the text), kind, confidence, band, agreement."""
    opaque = F.substring(F.sha2(F.concat(F.lit("opaque:"), "candidate_id"), 256), 1, 16)
    return candidates.select("candidate_id", opaque.alias("opaque_id"), "entity_type", "provider", "confidence", quality.band(F.col("confidence")).alias("risk_band"), F.size("group").alias("agreement"))


def merged_counters(rows: DataFrame) -> DataFrame:
    """The sum of each counter over (provider, counters map); counters that a provider leaves out count as 0."""
    sums = [F.coalesce(F.sum(F.try_element_at("counters", F.lit(c))), F.lit(0)).alias(c) for c in COUNTERS]
    return rows.groupBy("provider").agg(*sums)


def discovery_report(candidates: DataFrame) -> DataFrame:
    """(dimension, value, candidates): how many by kind, by band and by review status."""
    rows = candidates.select("entity_type", quality.band(F.col("confidence")).alias("band"), F.coalesce("review_status", F.lit("pending")).alias("status") if "review_status" in candidates.columns else F.lit("pending").alias("status"))
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(c).alias("value")) for n, c in (("entity_type", "entity_type"), ("risk_band", "band"), ("review_status", "status"))])
    return rows.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count("*").alias("candidates"))


def proposals(reviews: DataFrame) -> DataFrame:
    """(proposal_id, entity_type, value, aliases, candidate_ids) of accepted reviews (candidate_id, status, kind, value, alias), by kind and value."""
    kept = reviews.filter("status = 'accepted'")
    ident = F.concat(F.lit("prop-"), F.substring(F.sha2(F.concat_ws(":", F.coalesce("kind", F.lit("UNKNOWN")), F.coalesce("value", F.lit(""))), 256), 1, 8))
    out = kept.groupBy(F.coalesce("kind", F.lit("UNKNOWN")).alias("entity_type"), F.coalesce("value", F.lit("")).alias("value"), ident.alias("proposal_id"))
    return out.agg(F.sort_array(F.collect_set("alias")).alias("aliases"), F.sort_array(F.collect_set("candidate_id")).alias("candidate_ids"))


def conflicts(proposed: DataFrame, entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(proposal_id, conflict, value): proposed values that the registry has, as an entity or as an alias, in any case."""
    key = lambda c: F.upper(F.trim(c))
    known = entities.select(key(F.col("value")).alias("_key")).distinct()
    held = aliases.select(key(F.col("value")).alias("_key")).distinct()
    own = proposed.select("proposal_id", "value", key(F.col("value")).alias("_key")).join(known, "_key").select("proposal_id", F.lit("canonical_entity_exists").alias("conflict"), "value")
    more = proposed.select("proposal_id", F.explode("aliases").alias("value")).withColumn("_key", key(F.col("value"))).join(held, "_key").select("proposal_id", F.lit("alias_value_exists").alias("conflict"), "value")
    return own.unionByName(more)


def promote(proposed: DataFrame, entities: DataFrame, aliases: DataFrame, priority: int = 200) -> tuple[DataFrame, DataFrame]:
    """(entities, aliases) with the proposals that have no conflict; their aliases have priority 200."""
    free = proposed.join(conflicts(proposed, entities, aliases).select("proposal_id").distinct(), "proposal_id", "left_anti")
    ident = F.concat(F.lit("ent-"), F.col("proposal_id"))
    new = free.select(ident.alias("entity_id"), "entity_type", "value", F.lit(None).cast("string").alias("pseudonym"))
    names = free.select(ident.alias("entity_id"), "entity_type", F.posexplode("aliases").alias("place", "value"))
    rows = names.select(F.format_string("ali-%s-%03d", F.col("entity_id"), F.col("place")).alias("alias_id"), "entity_id", "entity_type", "value", F.lit("literal").alias("match_policy"), F.lit(priority).alias("priority"), F.array().cast("array<string>").alias("mutations"))
    return entities.unionByName(new.select(*entities.columns)), aliases.unionByName(rows.select(*aliases.columns))


def benchmark_documents(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans, faults) of expected entities (doc_id, text, entity, kind, start, end).

    A span without places is where its entity first stands; one whose places do not hold its entity has drifted and is a
    fault, and so is an entity that the text does not hold."""
    found = F.expr("instr(text, entity) - 1")
    start = F.coalesce("start", F.when(found >= 0, found))
    end = F.coalesce("end", start + F.length("entity"))
    rows = items.select("doc_id", "kind", "entity", start.alias("start"), end.alias("end"), F.expr("substring(text, coalesce(start, instr(text, entity) - 1) + 1, coalesce(end - start, length(entity)))").alias("held"))
    fault = F.when(F.col("start").isNull(), "not in the text").when(F.col("held") != F.col("entity"), "drifted")
    judged = rows.withColumn("fault", fault)
    return judged.filter("fault is null").select("doc_id", "kind", "start", "end"), judged.filter("fault is not null").select("doc_id", "entity", "fault")


#: Weights of a chunk's risks, and the patterns that each weigh 4.5.
HEAD, LEAK, REGISTRY, DIRECT = 3.0, 5.0, 4.0, 4.5
PATTERNS = {
    "cik_pattern": r"(?i)(?:CIK[:#\s]+|cik=)(0\d{6,9}|\d{6,10})", "accession_pattern": r"\b\d{10}-\d{2}-\d{6}\b",
    "ticker_pattern": r"\b(?:NYSE|NASDAQ|NYSE\s*Arca)\s*:\s*[A-Z]{1,5}\b|\b(?:ticker|trading)\s+symbol\s*(?::|is)?\s*[A-Z]{1,5}\b",
    "domain_pattern": r"https?://(?:www\.)?[a-z0-9\-\.]+\.[a-z]{2,}[^\s]*|https?://[^\s]*?(?:cik|CIK)[=/_]?\d{6,10}[^\s]*",
}


def holds_clue(text: Column, clues: Sequence[str]) -> Column:
    """Whether a text holds a leaked clue (of three characters at least, without signs around it), in any case."""
    clean = sorted({c.strip().strip("'\".,;:!?").lower() for c in clues if len(c) >= 3} - {""})
    return F.exists(_literals(clean), lambda c: F.contains(F.lower(text), c))


def holds_value(text: Column, values: Sequence[str]) -> Column:
    """Whether a text holds a private value, by case."""
    return F.exists(_literals(sorted({v for v in values if v})), lambda v: F.contains(text, v))


def chunk_risk(chunks: DataFrame, clues: Sequence[str] = (), values: Sequence[str] = ()) -> DataFrame:
    """Chunks (doc_id, chunk, text) with risk_score and reasons."""
    text = F.coalesce("text", F.lit(""))
    rules = {"structural_head": (F.col("chunk") == 0, HEAD), "leaked_clue": (holds_clue(text, clues), LEAK), "registry_alias": (holds_value(text, values), REGISTRY)}
    rules |= {name: (text.rlike(pattern), DIRECT) for name, pattern in PATTERNS.items()}
    score = sum((F.when(c, F.lit(w)).otherwise(F.lit(0.0)) for c, w in rules.values()), F.lit(0.0))
    return chunks.withColumn("risk_score", score).withColumn("reasons", F.array_compact(F.array(*[F.when(c, n) for n, (c, _) in rules.items()])))


def risky_chunks(scored: DataFrame, most: int) -> DataFrame:
    """Of each document the chunks with a score, the highest first, then in order, up to `most`; `skipped` says how many
    the cap leaves out."""
    w = Window.partitionBy("doc_id")
    eligible = scored.filter("risk_score > 0").withColumn("rank", F.row_number().over(w.orderBy(F.desc("risk_score"), "chunk"))).withColumn("skipped", F.greatest(F.lit(0), F.count("*").over(w) - most))
    return eligible.filter(F.col("rank") <= most)
