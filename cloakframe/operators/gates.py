"""Release gates: conditions as rows, decisions from them, roll-ups over companies, and guards.

Every gate fails closed: what is unknown or absent counts as failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Variants that may never be released, and those that may.
NEVER = ("s0_control", "s1_basic", "s2_privacy", "s2_incomplete", "s3a_daily_bucketed")
RELEASABLE = ("s3b_weekly_features", "s3c_block_features")
#: The evidence that a manifest must hold.
EVIDENCE = (
    "source_manifest_validation", "atlas_compilation", "masking_results", "text_attacks", "structured_attacks", "utility_evaluation", "determinism_check", "provenance", "boundary_scan", "dossier_scan",
)
CONDITION = "struct<condition_id:string,passed:boolean,blocking:boolean,evidence:string>"


class IneligibleVariant(ValueError):
    """A variant that may not be released was about to be."""


def assert_releasable(variant: str, marker: str = "") -> None:
    """Raises for a variant that may never be released, whatever its marker says, and for the marker of a diagnostic."""
    if variant in NEVER or marker == "non_releasable_diagnostic":
        raise IneligibleVariant(f"{variant!r} (marker {marker!r}) may not be released")


def ineligible(variants: DataFrame) -> DataFrame:
    """One row: the variants (variant) of a run that may not be released, and how many."""
    found = F.array_sort(F.collect_set(F.when(F.col("variant").isin(*NEVER), F.col("variant"))))
    return variants.agg(found.alias("ineligible"), F.size(found).alias("ineligible_count"))


def _condition(name: str, passed: Column, blocking: Column | bool, evidence: Column) -> Column:
    blocks = blocking if isinstance(blocking, Column) else F.lit(blocking)
    return F.struct(F.lit(name).alias("condition_id"), F.coalesce(passed, F.lit(False)).alias("passed"), blocks.alias("blocking"), evidence.cast("string").alias("evidence")).cast(CONDITION)


def manifest_conditions(references: DataFrame, manifests: DataFrame) -> DataFrame:
    """The five conditions of each manifest (release_id, run_id, source_id) on its references (release_id,
    evidence_type, artifact_hash, run_id, source_id): complete, no placeholders, one run, one set of ids, required types."""
    own = manifests.select("release_id", F.col("run_id").alias("_run"), F.col("source_id").alias("_source"))
    both = own.join(references.withColumnRenamed("run_id", "of_run").withColumnRenamed("source_id", "of_source"), "release_id", "left")
    other = lambda c, own_: F.coalesce(F.col(c), F.lit("")).isin("") | (F.col(c) == F.col(own_))
    present = F.col("evidence_type").isNotNull()
    held = both.groupBy("release_id").agg(
        F.collect_set("evidence_type").alias("types"),
        F.count_if(present & F.coalesce(F.col("artifact_hash").isin("", "placeholder"), F.lit(True))).alias("placeholders"),
        F.count_if(present & ~other("of_run", "_run")).alias("runs"),
        F.count_if(present & ~other("of_source", "_source")).alias("ids"),
        F.count_if(present & (F.coalesce("of_run", F.lit("")) != F.col("_run"))).alias("stale"),
        F.count_if(present & (F.coalesce("of_source", F.lit("")) != F.col("_source"))).alias("foreign"),
    )
    missing = F.array_sort(F.array_except(F.array(*[F.lit(e) for e in EVIDENCE]), F.col("types")))
    complete = (F.size(missing) == 0) & (F.col("stale") == 0) & (F.col("foreign") == 0)
    rows = F.array(
        _condition("evidence_manifest_complete", complete, True, F.array_join(missing, ",")), _condition("manifest_no_placeholders", F.col("placeholders") == 0, True, F.col("placeholders")),
        _condition("manifest_same_run", F.col("runs") == 0, True, F.col("runs")), _condition("manifest_id_consistency", F.col("ids") == 0, True, F.col("ids")),
        _condition("manifest_required_types", F.size(missing) == 0, True, F.array_join(missing, ",")),
    )
    # without a complete manifest nothing else is looked at
    return held.select("release_id", F.inline(F.when(complete, rows).otherwise(F.slice(rows, 1, 1))))


#: The columns of an assessment and what an absent one counts as.
ASSESSMENT: dict[str, tuple[str, object]] = {
    "variant": ("string", ""), "exact_identity_hits": ("long", None), "unique_phrase_hits": ("long", None), "digital_hits": ("long", None), "filename_hits": ("long", None), "source_rank": ("long", None),
    "llm_blocked": ("boolean", None), "deterministic_reproduced": ("boolean", None), "all_attacks_ran": ("boolean", None), "provenance_complete": ("boolean", None), "private_paths": ("long", None),
    "unhandled_errors": ("long", None), "review_implemented": ("boolean", False), "review_decision": ("string", "NOT_RUN"), "final_submission": ("boolean", False),
}


def release_conditions(assessments: DataFrame, phrase_limit: int = 0, top: int = 10, llm_required: bool = False, compat: bool = False) -> DataFrame:
    """The thirteen conditions of each assessment (release_id and ASSESSMENT), one row a condition.

    A variant that may not be released has that condition alone, failed. A source that was not ranked (null or below 1)
    fails; compat=True lets a rank below 0 pass, as published. The model's review blocks only final submissions (Q37)."""
    rows = assessments.withColumns({c: (F.coalesce(F.col(c).cast(k), F.lit(d).cast(k)) if c in assessments.columns else F.lit(d).cast(k)) for c, (k, d) in ASSESSMENT.items()})
    rank = F.col("source_rank")
    outside = (rank > top) | ((rank < 0) if compat else F.lit(False))
    none = lambda c: F.col(c) == 0
    review = F.col("review_decision")
    conditions = F.array(
        _condition("exact_identity", none("exact_identity_hits"), True, F.col("exact_identity_hits")), _condition("unique_phrase", F.col("unique_phrase_hits") <= phrase_limit, True, F.col("unique_phrase_hits")),
        _condition("digital_identifiers", none("digital_hits"), True, F.col("digital_hits")), _condition("filename_metadata", none("filename_hits"), True, F.col("filename_hits")),
        _condition("structured_ranking", outside, True, rank), _condition("llm_attack", ~F.col("llm_blocked"), llm_required, F.col("llm_blocked")),
        _condition("deterministic_reproduction", F.col("deterministic_reproduced"), True, F.col("deterministic_reproduced")), _condition("all_attacks_ran", F.col("all_attacks_ran"), True, F.col("all_attacks_ran")),
        _condition("provenance_complete", F.col("provenance_complete"), True, F.col("provenance_complete")), _condition("no_private_paths", none("private_paths"), True, F.col("private_paths")),
        _condition("no_unhandled_errors", none("unhandled_errors"), True, F.col("unhandled_errors")), _condition("review_implemented", F.col("review_implemented"), F.col("final_submission"), review),
        _condition("review_decision", ~review.isin("FAIL", "NOT_RUN"), F.col("final_submission"), review),
    )
    barred = F.array(_condition("release_variant_eligibility", F.lit(False), True, F.col("variant")))
    return rows.select("release_id", F.inline(F.when(F.col("variant").isin(*NEVER), barred).otherwise(conditions)))


def reanonymise_conditions(assessments: DataFrame, least_rate: float = 0.99) -> DataFrame:
    """What the second gate adds: no hits after masking, a replacement rate of 0.99, aliases, no load errors, no critical
    gap in coverage, and the semantic attacks."""
    columns = {"post_mask_hits": "long", "replacement_rate": "double", "aliases_loaded": "long", "load_errors": "long", "critical_warnings": "long", "semantic_passed": "boolean"}
    rows = assessments.withColumns({c: F.col(c).cast(k) if c in assessments.columns else F.lit(None).cast(k) for c, k in columns.items()})
    conditions = F.array(
        _condition("post_mask_hits", F.col("post_mask_hits") == 0, True, F.col("post_mask_hits")), _condition("replacement_rate", F.col("replacement_rate") >= least_rate, True, F.col("replacement_rate")),
        _condition("aliases_loaded", F.col("aliases_loaded") > 0, True, F.col("aliases_loaded")), _condition("registry_load", F.col("load_errors") == 0, True, F.col("load_errors")),
        _condition("critical_coverage", F.col("critical_warnings") == 0, True, F.col("critical_warnings")), _condition("semantic_privacy", F.col("semantic_passed"), True, F.col("semantic_passed")),
    )
    return rows.select("release_id", F.inline(conditions))


def decisions(conditions: DataFrame, releases: DataFrame | None = None, digits: int = 16) -> DataFrame:
    """(release_id, conditions, blocking_failures, warnings, decision, gate_hash) of each release.

    FAIL if a blocking condition fails, REVIEW_REQUIRED if another does, else PASS. A release of `releases` (release_id)
    without conditions fails. The hash is over the decision and all conditions by id."""
    failed = ~F.coalesce("passed", F.lit(False))
    blocks = F.coalesce("blocking", F.lit(True))
    lines = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "condition_id", F.coalesce("passed", F.lit(False)).cast("string")))), "\n")
    out = conditions.groupBy("release_id").agg(F.count("*").alias("conditions"), F.count_if(failed & blocks).alias("blocking_failures"), F.count_if(failed & ~blocks).alias("warnings"), lines.alias("lines"))
    if releases is not None:
        out = releases.select("release_id").distinct().join(out, "release_id", "left")
    out = out.fillna(0, ["conditions", "blocking_failures", "warnings"])
    decision = F.when((F.col("conditions") == 0) | (F.col("blocking_failures") > 0), "FAIL").when(F.col("warnings") > 0, "REVIEW_REQUIRED").otherwise("PASS")
    out = out.withColumn("decision", decision)
    return out.withColumn("gate_hash", F.substring(F.sha2(F.concat_ws("\n", "decision", "lines"), 256), 1, digits)).drop("lines")


#: The counts that must be zero, and the statuses that must be these.
COUNTS = (
    "exact_identifier_count", "unresolved_candidate_count", "blocking_finding_count", "path_identifier_count", "filename_identifier_count", "manifest_identifier_count", "review_parse_error_count",
    "review_fail_count", "required_numeric_dataset_failure_count", "required_sec_format_failure_count", "required_coverage_failure_count", "private_artifact_export_count", "original_artifact_export_count",
)
PASSING = {"collection_status": "clean", "privacy_status": "clean", "format_status": "clean", "numeric_data_status": "complete", "coverage_status": "clean"}


def pipeline_gate(summaries: DataFrame) -> DataFrame:
    """Summaries with release_safe and overall_status: thirteen counts of zero, five passing statuses, and a review that
    passed where it is enabled (or is off where it is not). Unknown counts and statuses do not pass."""
    safe = F.lit(True)
    for c in COUNTS:
        safe = safe & F.coalesce(F.col(c) == 0, F.lit(False))
    for c, wanted in PASSING.items():
        safe = safe & F.coalesce(F.col(c) == wanted, F.lit(False))
    reviewed = F.when(F.coalesce("review_enabled", F.lit(False)), F.col("review_status") == "passed").otherwise(F.col("review_status").isin("disabled", "not_configured"))
    out = summaries.withColumn("release_safe", safe & F.coalesce(reviewed, F.lit(False)))
    status = F.when(F.col("collection_status") == "failed", "collection_failed").when(F.col("release_safe"), "qa_passed").otherwise("qa_failed")
    return out.withColumn("overall_status", status)


#: Statuses of a review from the least to the worst.
SEVERITY = ("passed", "disabled", "not_configured", "skipped", "partial", "degraded", "unavailable", "skipped_dirty_scan", "failed_no_samples", "failed_empty", "failed_parse", "failed_correct_guess", "failed_both", "failed", "unknown")


def rolled_up(tickers: DataFrame) -> DataFrame:
    """One row over all companies: counts summed, statuses at their worst.

    tickers: (ticker, status, review_status, and the counts that it has). No companies at all are unknown."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) if c in tickers.columns else F.lit(0).cast("long").alias(c) for c in COUNTS]
    worst = lambda bad, name, good: F.when(F.count("*") == 0, "unknown").when(bad > 0, name).otherwise(good)
    any_ = lambda c: F.count_if(c)
    more = lambda c: F.coalesce(F.sum(c), F.lit(0)) if c in tickers.columns else F.lit(0)
    rank = F.coalesce(F.try_element_at(F.create_map(*[x for i, s in enumerate(SEVERITY) for x in (F.lit(s), F.lit(i))]), F.coalesce("review_status", F.lit("disabled"))), F.lit(len(SEVERITY) - 1))
    return tickers.agg(
        F.count("*").alias("companies"), *sums,
        worst(any_(F.col("status") == "failed_collection"), "failed", "clean").alias("collection_status"), worst(any_(F.col("status") == "failed_privacy"), "failed", "clean").alias("privacy_status"),
        worst(more("required_sec_format_failure_count"), "failed", "clean").alias("format_status"), worst(more("required_numeric_dataset_failure_count"), "failed", "complete").alias("numeric_data_status"),
        worst(more("required_coverage_failure_count"), "degraded", "clean").alias("coverage_status"),
        F.get(F.array(*[F.lit(s) for s in SEVERITY]), F.coalesce(F.max(rank), F.lit(len(SEVERITY) - 1))).alias("review_status"),
    )


def review_outcome(reviews: DataFrame) -> DataFrame:
    """(ticker, samples, parse_errors, failures, rewrites, max_confidence, verdicts, review_status) of the
    samples (ticker, verdict, parse_error, rewritten, confidence) of each review; no samples are a failure."""
    errors, failures = F.count_if("parse_error"), F.count_if(F.col("verdict") == "FAIL")
    seen = F.count("verdict") + F.count_if(F.col("verdict").isNull() & F.coalesce("parse_error", F.lit(False)))
    status = F.when(seen == 0, "failed_empty").when((errors > 0) & (failures > 0), "failed_both").when(errors > 0, "failed_parse").when(failures > 0, "failed_correct_guess").otherwise("passed")
    counts = [F.count_if(F.col("verdict") == v).alias(v.lower()) for v in ("PASS", "REVIEW", "FAIL")]
    return reviews.groupBy("ticker").agg(seen.alias("samples"), errors.alias("parse_errors"), F.count_if("rewritten").alias("rewrites"), F.max("confidence").alias("max_confidence"), *counts, status.alias("review_status"))


def ticker_status(rows: DataFrame) -> DataFrame:
    """Rows (exact_ids, unresolved, review_status, parse_errors, correct_guess, companyfacts_rows, has_filings, archive_mode,
    has_archive) with `failures` and `status`: privacy before review before coverage."""
    on = ~F.col("review_status").isin("disabled", "not_configured", "skipped_dirty_scan")
    coverage = {
        "archive_path_missing": F.col("archive_mode") & ~F.col("has_archive"), "companyfacts_row_count_zero": F.coalesce(F.col("companyfacts_rows") == 0, F.lit(False)), "sec_no_data": ~F.col("has_filings"),
    }
    review = {
        "review_parse_errors": on & (F.col("parse_errors") > 0), "review_correct_guess": F.col("correct_guess"), "review_failed": F.col("review_status") == "failed",
        "review_skipped_dirty_scan": F.col("review_status") == "skipped_dirty_scan", "review_unavailable": F.col("review_status") == "unavailable",
    }
    privacy = {"exact_identifiers": F.col("exact_ids") > 0, "unresolved_candidates": F.col("unresolved") > 0}
    rules = {**privacy, **review, **coverage}
    failures = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), n) for n, c in rules.items()]))
    some = lambda names: F.arrays_overlap("failures", F.array(*[F.lit(n) for n in names]))
    status = (
        F.when(some(privacy), "failed_privacy").when((F.col("parse_errors") > 0) & (F.size("failures") > 0) | some(["review_correct_guess", "review_failed"]), "failed_review").when(some(coverage), "degraded_source_coverage")
        .when(F.size("failures") > 0, "failed").otherwise("completed_clean")
    )
    return rows.withColumn("failures", failures).withColumn("status", status)


#: The fields that evidence must have at its top.
EVIDENCE_FIELDS = ("variant", "attack_name", "ablation", "true_source_rank", "candidate_universe_size", "percentile_rank", "top_1", "top_5", "top_10", "score", "status")
#: The statuses of an attack.
ATTACK_STATUS = ("completed", "blocked", "missing_evidence", "malformed")


def evidence_rows(raw: DataFrame, variant: str) -> DataFrame:
    """The JSON evidence (evidence) of each row as typed columns with `issues`; a row without issues is valid.

    Issues: what is no object, fields that lack or stand under `metrics`, ranks and sizes that are no whole numbers, a
    percentile outside 0 to 100, flags that are no booleans, another variant, an unknown status."""
    parsed = raw.withColumn("v", F.try_parse_json("evidence"))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    there = lambda path: F.try_variant_get("v", path, "variant").isNotNull()
    whole = lambda c: F.regexp_like(F.coalesce(get(f"$.{c}", "string"), F.lit("")), F.lit(r"^-?\d+$")) & (F.schema_of_variant(F.try_variant_get("v", f"$.{c}", "variant")) != "STRING")
    boolean = lambda c: F.schema_of_variant(F.try_variant_get("v", f"$.{c}", "variant")) == "BOOLEAN"
    percentile = get("$.percentile_rank", "double")
    rules = {"not an object": F.col("v").isNull() | ~F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))}
    rules |= {f"missing {c}": ~there(f"$.{c}") for c in EVIDENCE_FIELDS if c not in ("score", "status")}
    rules |= {f"nested {c}": there(f"$.metrics.{c}") for c in EVIDENCE_FIELDS}
    rules |= {
        "rank": ~whole("true_source_rank") | (get("$.true_source_rank", "long") < -1), "size": ~whole("candidate_universe_size") | (get("$.candidate_universe_size", "long") < 0),
        "percentile": percentile.isNull() | (percentile < 0) | (percentile > 100), "variant": get("$.variant", "string") != variant,
        "status": there("$.status") & ~get("$.status", "string").isin(*ATTACK_STATUS),
    } | {f"flag {c}": ~boolean(c) for c in ("top_1", "top_5", "top_10")}
    issues = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True) if n in ("not an object", "rank", "size", "percentile", "variant") or n.startswith(("missing", "flag")) else F.lit(False)), n) for n, c in rules.items()]))
    columns = {"variant": "string", "attack_name": "string", "ablation": "string", "true_source_rank": "long", "candidate_universe_size": "long", "percentile_rank": "double", "score": "double"}
    return parsed.select(*raw.columns, *[get(f"$.{c}", k).alias(c) for c, k in columns.items()], F.when(F.array_contains(issues, "not an object"), F.array(F.lit("not an object"))).otherwise(issues).alias("issues"))


def evidence_gate(evidence: DataFrame, variant: str, required: Sequence[str], reconstructed: bool = False, forbidden: Sequence[str] = (), top: int = 10, fail_percent: float = 5.0, review_percent: float = 1.0, least_universe: int = 50) -> DataFrame:
    """One row (reasons, decision) for a variant's evidence (variant, attack_name, ablation, true_source_rank,
    candidate_universe_size, percentile_rank, issues), with `required` keys `attack/ablation`.

    In this order, and alone: a variant that may not be released, a reconstruction that succeeded, forbidden fields, and
    incomplete evidence (keys that lack, repeat or are not asked for, another variant, faults) fail. Then a source among the
    first `top` or `fail_percent` per cent fails; one at the 99th percentile, or a small universe, needs a review."""
    first = None
    if variant in NEVER or variant not in RELEASABLE:
        first = "ineligible variant"
    elif reconstructed:
        first = "reconstruction succeeded"
    elif forbidden:
        first = "forbidden fields"
    key = F.concat_ws("/", "attack_name", "ablation")
    wanted = F.array(*[F.lit(k) for k in sorted(required)]).cast("array<string>")
    rank, size = F.col("true_source_rank"), F.col("candidate_universe_size")
    near = (rank > 0) & ((rank <= top) | ((size > 0) & ((1 - rank / F.nullif(size, F.lit(0))) * 100 >= 100 - fail_percent)))
    held = evidence.agg(
        F.collect_list(key).alias("keys"), F.count_if(F.size("issues") > 0).alias("faulty"), F.count_if(F.coalesce(F.col("variant") != variant, F.lit(True))).alias("others"),
        F.count_if(F.coalesce(near, F.lit(False))).alias("near"), F.count_if((rank > 0) & (F.col("percentile_rank") >= 100 - review_percent)).alias("close"), F.coalesce(F.max(size), F.lit(0)).alias("universe"),
        F.count_if(F.coalesce(rank, F.lit(-1)) < 1).alias("unranked"),
    )
    lacking = F.size(F.array_except(wanted, F.col("keys"))) > 0
    more = F.size(F.array_except(F.col("keys"), wanted)) > 0
    twice = F.size("keys") != F.size(F.array_distinct("keys"))
    incomplete = {"missing attacks": lacking, "unexpected attacks": more, "repeated attacks": twice, "malformed evidence": F.col("faulty") > 0, "other variants": F.col("others") > 0, "source not ranked": F.col("unranked") > 0}
    gaps = F.array_compact(F.array(*[F.when(c, n) for n, c in incomplete.items()]))
    worse = F.array_compact(F.array(F.when(F.col("near") > 0, "source near the top")))
    unsure = F.array_compact(F.array(F.when(F.col("close") > 0, "source among the first per cent"), F.when(F.col("universe") < least_universe, "small universe")))
    if first is not None:
        return held.select(F.lit(variant).alias("variant"), F.array(F.lit(first)).alias("reasons"), F.lit("FAIL").alias("decision"))
    reasons = F.when(F.size(gaps) > 0, gaps).when(F.size(worse) > 0, worse).otherwise(unsure)
    decision = F.when((F.size(gaps) > 0) | (F.size(worse) > 0), "FAIL").when(F.size(unsure) > 0, "REVIEW_REQUIRED").otherwise("PASS_CANDIDATE")
    return held.select(F.lit(variant).alias("variant"), reasons.alias("reasons"), decision.alias("decision"))


def frozen_release(evidence: DataFrame, candidates: int, best_rank: int, policy_keys: Sequence[str]) -> DataFrame:
    """One row: whether the evidence of a frozen release is the one that was approved: so many candidates, that best rank,
    none in the first ten, and the keys of the policy."""
    keys = F.array_sort(F.collect_set(F.concat_ws("/", "attack_name", "ablation")))
    checks = {
        "same_candidates": (F.min("candidate_universe_size") == candidates) & (F.max("candidate_universe_size") == candidates), "same_best_rank": F.min("true_source_rank") == best_rank,
        "none_in_top_10": F.min("true_source_rank") > 10, "same_keys": keys == F.array(*[F.lit(k) for k in sorted(policy_keys)]).cast("array<string>"),
    }
    out = evidence.agg(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    every = F.lit(True)
    for n in checks:
        every = every & F.col(n)
    return out.withColumn("verified", every)


def latest_decision(rows: DataFrame, group: str, order: Column) -> DataFrame:
    """The last decision of each group; FAIL where it is null."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(order.desc()))
    return rows.withColumn("_n", nth).filter("_n = 1").drop("_n").withColumn("decision", F.coalesce("decision", F.lit("FAIL")))
