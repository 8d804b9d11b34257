"""Registries of private entities and aliases: from YAML and atlases, their faults, changes, hashes and buckets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import identity
from .masking import Alias

#: Kinds whose values may be shorter than three characters.
SHORT_KINDS = ("ticker", "cik", "sec_accession_number", "sec_primary_document")
#: Prose that is no private value, in lower case.
PROSE = (
    "or director", "authorized us", "authorized officer", "authorized officer of us", "director of the company", "chief executive officer", "chief executive", "vice president", "by:", "by :", "/s/",
)
#: The bucket of each kind for scans; all others are `names`.
BUCKETS = {
    "ticker": "ticker", "cik": "cik", "sec_accession_number": "accession", "sec_primary_document": "accession", "company": "company_name", "former_company_name": "company_name",
    "executive": "person", "board_member": "person", "product": "product", "brand": "product", "proprietary_platform": "platform", "facility": "location", "headquarters": "location",
    "subsidiary": "company_name", "company_domain": "domain", "company_email_domain": "domain",
}
#: The kind of each sub-type of an atlas, and the registry's policy for an atlas's; others are company and literal.
KIND_OF = {
    "legal_name": "company", "former_name": "former_company_name", "ticker": "ticker", "cik": "cik", "lei": "company", "exchange_identifier": "ticker", "executive": "executive", "director": "board_member",
    "founder": "executive", "subsidiary": "subsidiary", "acquired_company": "acquisition_target", "auditor": "auditor", "transfer_agent": "auditor", "regulator": "regulator", "brand": "brand",
    "product_name": "product", "service_name": "product", "program_name": "proprietary_platform", "headquarters": "headquarters", "office": "facility", "branch": "facility",
    "domain": "company_domain", "email_domain": "company_email_domain", "website": "company_domain",
}
POLICY_OF = {
    "exact": "literal", "normalized": "literal", "case_insensitive": "case_insensitive", "fuzzy": "case_insensitive", "possessive": "possessive", "punctuation_variant": "punctuation_variant",
    "whitespace_variant": "whitespace_variant", "domain": "domain_full", "url": "url_full", "abbreviation": "case_insensitive",
}
#: Sub-types of which a match blocks a release.
BLOCKING_TYPES = (
    "legal_name former_name ticker cik ein lei exchange_identifier executive director founder subsidiary acquired_company product_name brand headquarters domain email_domain phone_number acquisition "
    "legal_proceeding distinctive_event slogan"
).split()
#: The pseudonyms' prefixes by category; people and organisations have their sub-type's name.
PREFIX_OF = {"issuer": "ISSUER", "products": "PRODUCT_LINE", "locations": "LOCATION", "digital": "DIGITAL", "semantic_fingerprints": "FINGERPRINT"}
#: The sub-types that a category must have, and those that it should.
REQUIRED = {
    "issuer": ("legal_name", "ticker"), "people": ("executive",), "organizations": ("auditor",), "products": (), "locations": ("headquarters",), "digital": ("domain",), "semantic_fingerprints": (),
}
RECOMMENDED = {
    "issuer": ("former_name", "cik", "lei"), "people": ("director", "founder"), "organizations": ("subsidiary",), "products": ("brand", "product_name"), "locations": ("office",),
    "digital": ("email_domain", "website"), "semantic_fingerprints": ("distinctive_event",),
}

ENTITIES = "entity_id string, entity_type string, value string, pseudonym string"
ALIASES = "alias_id string, entity_id string, entity_type string, value string, match_policy string, priority int, mutations array<string>"


def is_prose(value: Column) -> Column:
    """P11."""
    return F.coalesce(F.lower(F.trim(value)).isin(*PROSE), F.lit(False))


def _text(item: object) -> str | None:
    """YAML's numbers as text: 320193 and 320193.0 are the same."""
    if item is None or isinstance(item, bool):
        return None
    return str(int(item)) if isinstance(item, float) and item.is_integer() else str(item)


def parse_registry(spark: SparkSession, yaml_text: str) -> tuple[DataFrame, DataFrame]:
    """(entities, aliases) as they stand in a registry's YAML, numbered by `place`; a document that is no mapping is empty.

    Items that are no mappings become rows of nulls, so that they are counted as skipped."""
    import yaml

    try:
        found = yaml.safe_load(yaml_text)
    except yaml.YAMLError:
        found = None
    found = found if isinstance(found, Mapping) else {}

    def rows(key: str, names: Sequence[tuple[str, ...]]) -> list[tuple]:
        out = []
        for place, item in enumerate(found.get(key) or []):
            item = item if isinstance(item, Mapping) else {}
            out.append((place, *[next((_text(item[n]) for n in options if item.get(n) is not None), None) for options in names]))
        return out

    entity_names = [("entity_id",), ("entity_type",), ("canonical_private_value",), ("assigned_pseudonym",)]
    alias_names = [("alias_id",), ("canonical_entity_id",), ("entity_type",), ("private_alias_value",), ("match_policy",), ("priority",)]
    entities = spark.createDataFrame(rows("entities", entity_names), "place int, " + ENTITIES)
    aliases = spark.createDataFrame(rows("aliases", alias_names), "place int, alias_id string, entity_id string, entity_type string, value string, match_policy string, priority string")
    mutations = {i: [str(m).lower() for m in (a.get("enabled_mutation_policies") or [])] for i, a in enumerate(found.get("aliases") or []) if isinstance(a, Mapping)}
    held = spark.createDataFrame([(i, m) for i, m in mutations.items()], "place int, mutations array<string>")
    return entities, aliases.withColumn("priority", F.coalesce(F.col("priority").try_cast("int"), F.lit(100))).join(held, "place", "left")


def _clean(value: Column, kind: Column) -> Column:
    return identity.private_value(value, kind, SHORT_KINDS)


def load_registry(entities: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, aliases, counters) of rows (place, ...) as `parse_registry` gives them.

    An entity without an id or a value, or whose value is prose, is skipped; of entities with one id the first stays. An alias
    without an id is skipped, of aliases with one id the first stays, one of an unknown entity is an error (of an entity that
    was prose: skipped), and so is one without a value skipped. counters is one row: entities_loaded, aliases_loaded,
    skipped_empty, duplicates, load_errors, blocking (no alias, or an error)."""
    kind = F.lower(F.coalesce("entity_type", F.lit("company")))
    rows = entities.select("place", F.trim("entity_id").alias("entity_id"), kind.alias("entity_type"), _clean(F.col("value"), kind).alias("value"), "pseudonym")
    empty = (F.coalesce("entity_id", F.lit("")) == "") | F.col("value").isNull()
    rows = rows.withColumn("fate", F.when(empty, "skipped").when(is_prose(F.col("value")), "prose"))
    nth = F.row_number().over(Window.partitionBy("entity_id").orderBy("place"))
    fresh = rows.filter("fate is null").withColumn("fate", F.when(nth > 1, "duplicate").otherwise("loaded"))
    judged = fresh.unionByName(rows.filter("fate is not null"))
    loaded = judged.filter("fate = 'loaded'")

    own = F.lower(F.coalesce("entity_type", F.lit("company")))
    held = aliases.select("place", F.trim("alias_id").alias("alias_id"), F.trim("entity_id").alias("entity_id"), own.alias("entity_type"), _clean(F.col("value"), own).alias("value"), F.lower(F.coalesce("match_policy", F.lit("literal"))).alias("match_policy"), "priority", "mutations")
    held = held.withColumn("fate", F.when(F.coalesce("alias_id", F.lit("")) == "", "skipped"))
    first = F.row_number().over(Window.partitionBy("alias_id").orderBy("place"))
    named = held.filter("fate is null").withColumn("fate", F.when(first > 1, "duplicate"))
    known = loaded.select("entity_id", F.lit(True).alias("known"))
    prose = judged.filter("fate = 'prose'").select("entity_id", F.lit(True).alias("was_prose")).distinct()
    named = named.join(known, "entity_id", "left").join(prose, "entity_id", "left")
    orphan = F.when(F.coalesce("was_prose", F.lit(False)), "skipped").otherwise("error")
    fate = F.when(F.col("fate").isNotNull(), F.col("fate")).when(F.col("known").isNull(), orphan).when(F.col("value").isNull() | is_prose(F.col("value")), "skipped").otherwise("loaded")
    named = named.withColumn("fate", fate).drop("known", "was_prose").unionByName(held.filter("fate is not null"))

    count = lambda name: F.count_if(F.col("fate") == name)
    fates = judged.select("fate", F.lit("entity").alias("of")).unionByName(named.select("fate", F.lit("alias").alias("of")))
    of = lambda side: F.count_if((F.col("fate") == "loaded") & (F.col("of") == side))
    counters = fates.agg(of("entity").alias("entities_loaded"), of("alias").alias("aliases_loaded"), (count("skipped") + count("prose")).alias("skipped_empty"), count("duplicate").alias("duplicates"), count("error").alias("load_errors"))
    counters = counters.withColumn("blocking", (F.col("aliases_loaded") == 0) | (F.col("load_errors") > 0))
    columns = [c.split()[0] for c in ALIASES.replace("array<string>", "x").split(", ")]
    return loaded.select("entity_id", "entity_type", "value", "pseudonym"), named.filter("fate = 'loaded'").select(*columns), counters


def load_report(counters: DataFrame, path: str) -> DataFrame:
    """The counters with the registry's path by its hash alone, and a status."""
    status = F.when(F.col("aliases_loaded") == 0, "EMPTY").when(F.col("load_errors") > 0, "ERRORS").otherwise("LOADED")
    return counters.select(F.substring(F.sha2(F.lit(path), 256), 1, 16).alias("path_hash"), "*", status.alias("status"))


def to_aliases(entities: DataFrame, aliases: DataFrame) -> list[Alias]:
    """The registry as the masker takes it, with the pseudonyms of the entities; a registry fits the driver."""
    rows = aliases.join(entities.select("entity_id", "pseudonym"), "entity_id", "left").orderBy("alias_id").collect()
    return [Alias(r.alias_id, r.value, r.pseudonym, r.priority, r.match_policy, r.entity_type, mutations=tuple(m for m in r.mutations or ())) for r in rows]


def scan_values(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(kind, value), each once: the values of entities and aliases, with kinds in lower case."""
    both = entities.select(F.col("entity_type").alias("kind"), "value").unionByName(aliases.select(F.col("entity_type").alias("kind"), "value"))
    return both.filter("value is not null").distinct()


def _place(order: int, key: Column) -> Column:
    return F.struct(F.lit(order).alias("order"), key.alias("key")).alias("at")


def buckets(entities: DataFrame, aliases: DataFrame, ticker: str = "") -> DataFrame:
    """(bucket, value): each value once, in the bucket of its first kind (entities before aliases, then by id), and all of
    them in `names`; a fallback ticker comes first."""
    both = entities.select("entity_type", "value", _place(1, F.col("entity_id")))
    both = both.unionByName(aliases.select("entity_type", "value", _place(2, F.col("alias_id"))))
    if ticker:
        first = entities.sparkSession.range(1).select(F.lit("ticker").alias("entity_type"), F.lit(ticker).alias("value"), _place(0, F.lit("")))
        both = both.unionByName(first)
    one = both.filter("value is not null").groupBy("value").agg(F.min_by("entity_type", "at").alias("kind"))
    table = F.create_map(*[F.lit(x) for kv in BUCKETS.items() for x in kv])
    bucket = F.coalesce(F.try_element_at(table, F.col("kind")), F.lit("names"))
    return one.select(F.explode(F.array_distinct(F.array(bucket, F.lit("names")))).alias("bucket"), "value")


def added(aliases: DataFrame, more: DataFrame) -> DataFrame:
    """Aliases with more; an alias whose id is taken is left out."""
    return aliases.unionByName(more.join(aliases.select("alias_id"), "alias_id", "left_anti").select(*aliases.columns))


def removed(entities: DataFrame, aliases: DataFrame, entity_ids: Sequence[str] = (), alias_ids: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(entities, aliases) without these; the aliases of a removed entity go with it."""
    keep = entities.filter(~F.col("entity_id").isin(*entity_ids)) if entity_ids else entities
    left = aliases.filter(~F.col("entity_id").isin(*entity_ids)) if entity_ids else aliases
    return keep, left.filter(~F.col("alias_id").isin(*alias_ids)) if alias_ids else left


def counters(entities: DataFrame) -> DataFrame:
    """(entity_type, next_number): one more than the largest number in the pseudonyms of a kind."""
    number = F.regexp_extract(F.coalesce("pseudonym", F.lit("")), r"(\d+)\D*$", 1).try_cast("int")
    return entities.groupBy("entity_type").agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_number"))


def merged(curated: DataFrame, harvested: DataFrame, prefix: str = "harvest-") -> DataFrame:
    """Curated aliases and those harvested values that they lack, under free numbered ids, in order of kind and value."""
    key = F.lower(F.trim("value"))
    fresh = harvested.withColumn("_key", key).join(curated.select(key.alias("_key")).distinct(), "_key", "left_anti")
    fresh = fresh.groupBy("_key").agg(F.min("value").alias("value"), F.min("entity_type").alias("entity_type"), F.min("entity_id").alias("entity_id"))
    number = F.coalesce(F.regexp_extract("alias_id", rf"^{re.escape(prefix)}(\d+)$", 1).try_cast("int"), F.lit(0))
    taken = curated.agg(F.coalesce(F.max(number), F.lit(0)).alias("taken"))
    # harvested values are the registry's size, so one order over all of them is small
    nth = F.row_number().over(Window.orderBy("entity_type", "_key")) + F.col("taken")
    rows = fresh.crossJoin(F.broadcast(taken)).select(F.concat(F.lit(prefix), F.format_string("%05d", nth)).alias("alias_id"), "entity_id", "entity_type", "value", F.lit("literal").alias("match_policy"), F.lit(100).alias("priority"), F.array().cast("array<string>").alias("mutations"))
    return curated.unionByName(rows.select(*curated.columns))


def registry_hash(rows: DataFrame, key: str, digits: int = 16) -> DataFrame:
    """One row: a hash of all rows as JSON, in order of the key; a set of the registry's size."""
    row = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    text = F.array_join(F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), row.alias("j")))).getField("j"), "\n")
    return rows.agg(F.substring(F.sha2(text, 256), 1, digits).alias("hash"))


def parse_atlas(spark: SparkSession, yaml_text: str) -> DataFrame:
    """(entry_id, category, sub_type, private_value, normalized_value, match_policy, priority, active) of an atlas's YAML."""
    import yaml

    found = yaml.safe_load(yaml_text)
    items = (found.get("entries") if isinstance(found, Mapping) else None) or []
    names = ("entry_id", "category", "sub_type", "private_value", "normalized_value", "match_policy")
    rows = [(*[_text(i.get(n)) for n in names], int(i.get("priority") or 100), bool(i.get("active", True))) for i in items if isinstance(i, Mapping)]
    out = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", priority int, active boolean")
    lowered = {c: F.lower(c) for c in ("category", "sub_type", "match_policy")}
    return out.withColumns(lowered).withColumn("normalized_value", F.coalesce("normalized_value", F.trim(F.regexp_replace("private_value", r"\s+", " "))))


def entry_pattern(value: str, policy: str) -> str:
    """The pattern of an atlas entry; policies without one of their own are literal."""
    literal = re.escape(value)
    if policy == "case_insensitive":
        return f"(?i){literal}"
    if policy == "possessive":
        return rf"(?:{literal})'s?\b|{literal}'"
    if policy == "punctuation_variant" and (" " in value or "-" in value):
        return f"(?:{literal}|{re.escape(value.replace(' ', '-') if ' ' in value else value.replace('-', ' '))})"
    if policy == "url":
        return rf"https?://(?:www\.)?{literal}[^\s]*|{literal}"
    return value if policy == "regex" else literal


def compiled(entries: DataFrame) -> DataFrame:
    """Active entries with pattern, pseudonym and blocking.

    Pseudonyms are numbered within their prefix by entry id; the issuer's legal name is [ISSUER]."""
    pattern = F.udf(entry_pattern, "string")  # a row an entry: an atlas has hundreds
    prefix = F.create_map(*[F.lit(x) for kv in PREFIX_OF.items() for x in kv])
    rows = entries.filter("active").withColumn("prefix", F.coalesce(F.try_element_at(prefix, F.col("category")), F.upper("sub_type"), F.lit("ENTITY")))
    nth = F.row_number().over(Window.partitionBy("prefix").orderBy("entry_id"))
    issuer = (F.col("category") == "issuer") & (F.col("sub_type") == "legal_name")
    rows = rows.withColumn("pseudonym", F.when(issuer, "[ISSUER]").otherwise(F.format_string("[%s_%02d]", F.col("prefix"), nth)))
    return rows.select("entry_id", "category", "sub_type", "normalized_value", "match_policy", "priority", pattern("private_value", "match_policy").alias("pattern"), "pseudonym", F.col("sub_type").isin(*BLOCKING_TYPES).alias("blocking"))


def from_plan(plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, aliases) of compiled entries; an empty plan is an error."""
    if plan.isEmpty():
        raise ValueError("a plan without entries makes no registry")
    kinds = F.create_map(*[F.lit(x) for kv in KIND_OF.items() for x in kv])
    policies = F.create_map(*[F.lit(x) for kv in POLICY_OF.items() for x in kv])
    kind = F.coalesce(F.try_element_at(kinds, F.col("sub_type")), F.lit("company"))
    policy = F.coalesce(F.try_element_at(policies, F.col("match_policy")), F.lit("literal"))
    entity = F.concat(F.lit("ent-"), F.col("entry_id"))
    entities = plan.select(entity.alias("entity_id"), kind.alias("entity_type"), F.col("normalized_value").alias("value"), "pseudonym")
    aliases = plan.select(F.concat(F.lit("ali-"), F.col("entry_id"), F.lit("-001")).alias("alias_id"), entity.alias("entity_id"), kind.alias("entity_type"), F.col("normalized_value").alias("value"), policy.alias("match_policy"), "priority", F.array().cast("array<string>").alias("mutations"))
    return entities, aliases


def atlas_completeness(entries: DataFrame) -> DataFrame:
    """(category, missing_required, missing_recommended, score, complete) of every category; score is covered / listed."""
    spark = entries.sparkSession
    listed = spark.createDataFrame([(c, list(REQUIRED[c]), list(RECOMMENDED[c])) for c in REQUIRED], "category string, required array<string>, recommended array<string>")
    present = entries.filter("active").groupBy("category").agg(F.collect_set("sub_type").alias("present"))
    both = listed.join(F.broadcast(present), "category", "left").withColumn("present", F.coalesce("present", F.array().cast("array<string>")))
    every = F.array_union("required", "recommended")
    score = F.size(F.array_intersect("present", every)) / F.greatest(F.lit(1), F.size(every))
    missing = F.array_sort(F.array_except("required", "present"))
    return both.select("category", missing.alias("missing_required"), F.array_sort(F.array_except("recommended", "present")).alias("missing_recommended"), F.round(score, 6).alias("score"), (F.size(missing) == 0).alias("complete"))


def from_metadata(companies: DataFrame, accessions: DataFrame | None = None, most: int = 50) -> tuple[DataFrame, DataFrame]:
    """(entities, aliases) of companies (ticker, long_name, short_name, website, city, state, country, address, phone,
    exchange, cik) and of the first `most` filings (ticker, place, accession) of each.

    Aliases are the long name, its first word, the short name, the ticker in both cases, and the domain with and without www."""
    t = F.col("ticker")
    domain = F.nullif(F.regexp_extract(F.coalesce("website", F.lit("")), r"^(?:https?://)?(?:www\.)?([^/\s]+)", 1), F.lit(""))
    entity = lambda part, kind, value: F.struct(F.concat_ws("_", t, F.lit(part)).alias("entity_id"), F.lit(kind).alias("entity_type"), value.alias("value"))
    pairs = [
        ("company", "company", F.col("long_name")), ("ticker", "ticker", t), ("domain", "company_domain", domain), ("hq_city", "headquarters", F.col("city")), ("hq_state", "headquarters", F.col("state")),
        ("hq_country", "headquarters", F.col("country")), ("address", "facility", F.col("address")), ("phone", "company", F.col("phone")), ("exchange", "company", F.col("exchange")), ("cik", "cik", F.col("cik")),
    ]
    entities = companies.select(F.inline(F.array(*[entity(*p) for p in pairs]))).filter("coalesce(value, '') <> ''")
    if accessions is not None:
        nth = F.row_number().over(Window.partitionBy("ticker").orderBy("place")) - 1
        first = accessions.withColumn("nth", nth).filter((F.col("nth") < most) & (F.coalesce("accession", F.lit("")) != ""))
        entities = entities.unionByName(first.select(F.format_string("%s_acc_%d", t, F.col("nth")).alias("entity_id"), F.lit("sec_accession_number").alias("entity_type"), F.col("accession").alias("value")))
    short = F.when(F.contains(F.trim("long_name"), F.lit(" ")), F.element_at(F.split(F.trim("long_name"), r"\s+"), 1))
    other = F.when(F.col("short_name") != F.coalesce("long_name", F.lit("")), F.col("short_name"))
    alias = lambda part, of, kind, value, policy: F.struct(F.concat_ws("_", t, F.lit(part)).alias("alias_id"), F.concat_ws("_", t, F.lit(of)).alias("entity_id"), F.lit(kind).alias("entity_type"), value.alias("value"), F.lit(policy).alias("match_policy"))
    named = [
        ("company_alias", "company", "company", F.col("long_name"), "case_insensitive"), ("company_shortform", "company", "company", short, "case_insensitive"), ("company_short", "company", "company", other, "case_insensitive"),
        ("ticker_alias", "ticker", "ticker", t, "ticker_exact"), ("ticker_lower", "ticker", "ticker", F.lower(t), "case_insensitive"),
        ("domain_alias", "domain", "company_domain", domain, "domain_full"), ("domain_www", "domain", "company_domain", F.concat(F.lit("www."), domain), "domain_full"),
    ]
    aliases = companies.select(F.inline(F.array(*[alias(*n) for n in named]))).filter("coalesce(value, '') <> ''")
    return entities.withColumn("pseudonym", F.lit(None).cast("string")), aliases.withColumns({"priority": F.lit(100), "mutations": F.array().cast("array<string>")})
