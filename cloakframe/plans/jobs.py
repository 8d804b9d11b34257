"""Jobs: thin chains of the operators over files, as the command line runs them.

Each returns its result and the program's exit code: 0, 2 for bad input, 3 where privacy fails, 5 for a variant that may not be
released."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chunking, markup
from ..functions import series as s
from ..operators import attacks, candidates, coverage, discovery, gates, harvest, masking, registry, residual, scrub, sequences, statements, utility, variants
from ..sources import archives, bars, files, packages

OK, BAD_INPUT, PRIVACY, FAILED, INELIGIBLE = 0, 2, 3, 4, 5
Result = tuple[DataFrame | dict | str, int]

VARIANTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "s0": ("s0_control", variants.s0_control), "s1": ("s1_basic", variants.s1_basic), "s2": ("s2_privacy", variants.s2_residual), "s3a": ("s3a_daily_bucketed", variants.s3a_daily),
    "s3b": ("s3b_weekly_features", variants.s3b_weekly), "s3c": ("s3c_block_features", variants.s3c_blocks),
}


def read_docs(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of the Markdown files of a folder; the name is the id."""
    return files.read_corpus(spark, folder).select(F.col("name").alias("doc_id"), "text")


def read_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return registry.load_registry(*registry.parse_registry(spark, Path(path).read_text()))


def registry_validate(spark: SparkSession, path: str) -> Result:
    """The load report; a registry that blocks is bad input."""
    counters = read_registry(spark, path)[2]
    row = registry.load_report(counters, path).first().asDict()
    return row, BAD_INPUT if row["blocking"] else OK


def registry_inventory(spark: SparkSession, path: str) -> Result:
    """How many values of each kind."""
    entities, aliases, _ = read_registry(spark, path)
    return registry.scan_values(entities, aliases).groupBy("kind").agg(F.count("*").alias("values")), OK


def identities_compile(spark: SparkSession, path: str) -> Result:
    """The plan of an atlas; one that lacks required sub-types is bad input."""
    atlas = registry.parse_atlas(spark, Path(path).read_text())
    whole = registry.atlas_completeness(atlas).filter("not complete").isEmpty()
    return registry.compiled(atlas), OK if whole else BAD_INPUT


def atlas_harvest(spark: SparkSession, folder: str) -> Result:
    """D04, G18."""
    return harvest.harvested(read_docs(spark, folder)), OK


def ingest(spark: SparkSession, folder: str) -> Result:
    """R11 to R13."""
    return archives.collected(archives.inventory(spark, folder)), OK


def extract(spark: SparkSession, folder: str) -> Result:
    """The sections of the HTML files of a folder."""
    rows = spark.read.option("pathGlobFilter", "*.{htm,html}").option("recursiveFileLookup", True).text(folder, wholetext=True)
    named = rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("doc_id"), markup.markdown(F.col("value")).alias("text"))
    return named.select("doc_id", F.inline(markup.item_sections(F.col("text")))), OK


def mask(spark: SparkSession, folder: str, registry_path: str) -> Result:
    """Masked texts; a registry without aliases is bad input, and nothing is masked."""
    entities, aliases, counters = read_registry(spark, registry_path)
    if counters.first().aliases_loaded == 0:
        return "the registry has no aliases", BAD_INPUT
    return masking.mask_documents(read_docs(spark, folder), registry.to_aliases(entities, aliases)).select("doc_id", F.col("masked").alias("text")), OK


def scan(spark: SparkSession, folder: str, registry_path: str) -> Result:
    """What is left of a registry's values; a blocking hit fails privacy."""
    entities, aliases, _ = read_registry(spark, registry_path)
    values = [(r.kind, r.value) for r in registry.scan_values(entities, aliases).collect()]
    out = residual.scan_tree(spark, folder, values)
    blocked = not out.filter("scan.is_blocked").isEmpty()
    return out.select("path", "scan.total", "scan.blocking", "scan.is_blocked"), PRIVACY if blocked else OK


def discover(spark: SparkSession, folder: str) -> Result:
    """D01."""
    return discovery.discovered(read_docs(spark, folder)), OK


def submission(spark: SparkSession, folder: str) -> Result:
    """Scrubbed texts; one that still holds what may not be public fails privacy."""
    out = read_docs(spark, folder).select("doc_id", scrub.submission_scrub(F.col("text")).alias("text"))
    return out, OK if out.filter(scrub.forbidden_public(F.col("text"))).isEmpty() else PRIVACY


def chunk(spark: SparkSession, folder: str, mode: str = "paragraph") -> Result:
    """Chunks with their risk."""
    return candidates.chunk_risk(chunking.chunk_rows(read_docs(spark, folder), mode)), OK


def transform(spark: SparkSession, folder: str, variant: str) -> Result:
    """X01 to X06 over the price files of a folder; the marker of what may not be released is in the folder's name."""
    if variant not in VARIANTS:
        return f"no such variant: {variant}", BAD_INPUT
    return VARIANTS[variant][1](bars.read_price_json(spark, folder)), OK


def s3_transform(spark: SparkSession, folder: str, variant: str) -> Result:
    """Only variants that may be released."""
    if variant not in VARIANTS:
        return f"no such variant: {variant}", BAD_INPUT
    try:
        gates.assert_releasable(VARIANTS[variant][0])
    except gates.IneligibleVariant as e:
        return str(e), INELIGIBLE
    return transform(spark, folder, variant)


def s3_attack(spark: SparkSession, folder: str, variant: str, source: str) -> Result:
    """The suite's ranks of a source file among the price files of a folder; an unknown source is bad input."""
    features, code = s3_transform(spark, folder, variant)
    if code:
        return features, code
    period = "relative_week" if variant == "s3b" else "relative_block"
    rows = features.filter(F.col("entity_id") == source)
    if rows.isEmpty():
        return f"no such source: {source}", BAD_INPUT
    return sequences.attack_suite(attacks.long_features(features, period), source), OK


def s3_assess(spark: SparkSession, evidence: str, variant: str, policy: str) -> Result:
    """The decision on a file of evidence (a JSON object a line) under a policy's keys."""
    keys = json.loads(Path(policy).read_text()).get("required_attack_keys") or []
    if not keys:
        return "the policy requires no attacks", BAD_INPUT
    rows = gates.evidence_rows(spark.read.text(evidence).withColumnRenamed("value", "evidence"), variant)
    row = gates.evidence_gate(rows, variant, keys).first().asDict()
    incomplete = {"missing attacks", "unexpected attacks", "repeated attacks", "malformed evidence", "other variants", "source not ranked"}
    code = OK if row["decision"] != "FAIL" else INELIGIBLE if row["reasons"] == ["ineligible variant"] else BAD_INPUT if incomplete & set(row["reasons"]) else PRIVACY
    return row, code


def attack_run(spark: SparkSession, source: str, masked: str) -> Result:
    """Masked price files against those of the same name; a blocked one fails privacy."""
    a, b = (bars.read_price_json(spark, p).select("entity_id", "bar_idx", F.col("close").alias(c)) for p, c in ((source, "a"), (masked, "b")))
    pairs = a.join(b, ["entity_id", "bar_idx"])
    pairs = pairs.select("*", F.coalesce(s.log_return("a"), F.lit(0.0)).alias("ra"), F.coalesce(s.log_return("b"), F.lit(0.0)).alias("rb"))
    out = attacks.structured_attacks(pairs)
    return out, OK if out.filter("blocked").isEmpty() else PRIVACY


def utility_evaluate(spark: SparkSession, source: str, masked: str) -> Result:
    """G11."""
    a, b = (bars.read_price_json(spark, p).select("entity_id", "bar_idx", F.col("close").alias(c)) for p, c in ((source, "a"), (masked, "b")))
    pairs = a.join(b, ["entity_id", "bar_idx"])
    return utility.structured_utility(pairs.select("*", F.coalesce(s.log_return("a"), F.lit(0.0)).alias("ra"), F.coalesce(s.log_return("b"), F.lit(0.0)).alias("rb"))), OK


def evaluate_submission(spark: SparkSession, path: str, truth: str) -> Result:
    """The shown metrics of a submission's actions on the true returns; faults are bad input."""
    given, returns = json.loads(Path(path).read_text()), json.loads(Path(truth).read_text())["period_returns"]
    periods, actions = given.get("relative_periods") or [], given.get("binary_actions") or []
    faults = {
        "no periods": not periods, "lengths differ": len(periods) != len(actions), "invalid action": any(a not in (0, 1) for a in actions),
        "periods do not increase": any(b <= a for a, b in zip(periods, periods[1:], strict=False)), "more periods than returns": len(periods) > len(returns),
    }
    found = [k for k, v in faults.items() if v]
    if found:
        return {"faults": found}, BAD_INPUT
    rows = spark.createDataFrame([("submission", i, a, float(r)) for i, (a, r) in enumerate(zip(actions, returns, strict=False))], "entity_id string, bar_idx long, action int, ret double")
    return coverage.projected(utility.backtest(rows).withColumnRenamed("entity_id", "submission_id"), "backtest"), OK


def release_assess(spark: SparkSession, path: str) -> Result:
    """Decisions on assessments (a JSON object a line); a failure fails privacy, a barred variant is ineligible."""
    rows = spark.read.json(path)
    if "release_id" not in rows.columns:
        return "assessments need a release_id", BAD_INPUT
    conditions = gates.release_conditions(rows)
    out = gates.decisions(conditions, rows)
    barred = not conditions.filter("condition_id = 'release_variant_eligibility'").isEmpty()
    return out, INELIGIBLE if barred else PRIVACY if not out.filter("decision = 'FAIL'").isEmpty() else OK


def release_export(spark: SparkSession, root: str, target: str, registry_path: str) -> Result:
    """A zip file of a package, if nothing in it holds a value of the registry."""
    entities, aliases, _ = read_registry(spark, registry_path)
    values = [r.value for r in registry.scan_values(entities, aliases).collect()]
    try:
        return str(packages.write_zip(root, target, {}, packages.leaking(values))), OK
    except ValueError as e:
        return str(e), PRIVACY


def classroom_build(spark: SparkSession, features: str, target: str) -> Result:
    """K07."""
    rows = spark.read.parquet(features)
    return str(packages.write_classroom(target, rows, {"rows": rows.count()}, rows.select(rows.columns[0]).distinct().count())), OK


def boundary_diag(spark: SparkSession, private: str, repository: str) -> Result:
    """P20."""
    try:
        return str(packages.private_root(private, repository)), OK
    except ValueError as e:
        return str(e), BAD_INPUT


def numeric_package(spark: SparkSession, ticker: str) -> Result:
    """Synthetic annual statements; identities that do not hold fail."""
    rows = statements.annual(spark.createDataFrame([(ticker,)], "ticker string"))
    return rows, OK if statements.identity_faults(rows).isEmpty() else FAILED


def campaign(spark: SparkSession, path: str) -> Result:
    """The companies of a configuration, checked."""
    try:
        return {"companies": sorted(packages.load_companies(path))}, OK
    except (ValueError, OSError) as e:
        return str(e), BAD_INPUT


def reanonymise(spark: SparkSession, folder: str, registry_path: str, work: str) -> Result:
    """Extract, mask, scan and decide, a written table a stage; stages whose checkpoint is valid are not run
    again. A release that does not pass fails privacy."""
    texts, masked = f"{work}/texts", f"{work}/masked"
    held = packages.digest(Path(registry_path).read_text())

    def parts(path: str) -> list[Path]:
        return sorted(Path(path).glob("*.parquet"))

    def run_extract() -> list[Path]:
        rows = spark.read.option("pathGlobFilter", "*.{htm,html}").option("recursiveFileLookup", True).text(folder, wholetext=True)
        rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("doc_id"), markup.markdown(F.col("value")).alias("text")).write.mode("overwrite").parquet(texts)
        return parts(texts)

    def run_mask() -> list[Path]:
        entities, aliases, _ = read_registry(spark, registry_path)
        masking.mask_documents(spark.read.parquet(texts), registry.to_aliases(entities, aliases)).write.mode("overwrite").parquet(masked)
        return parts(masked)

    entities, aliases, counters = read_registry(spark, registry_path)
    loaded = counters.first()
    if loaded.aliases_loaded == 0:
        return packages.decision_or_fail(f"{work}/decision.json"), BAD_INPUT
    ran = packages.resumed(work, "run", [("extract", run_extract), ("mask", run_mask)], packages.digest(folder), held, "1")
    out = spark.read.parquet(masked)
    values = [(r.kind, r.value) for r in registry.scan_values(entities, aliases).collect()]
    found = residual.long_hits(residual.scanned(out.select("doc_id", F.col("masked").alias("text")), values))
    spans = out.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("n"), F.coalesce(F.sum("rejected"), F.lit(0)).alias("r")).first()
    summary = residual.privacy_report(found, spans.n, spans.n)["summary"].first()
    row = (str(Path(work).name), summary.post_mask_hits, summary.replacement_rate, loaded.aliases_loaded, loaded.load_errors, 0, True)
    kind = "release_id string, post_mask_hits long, replacement_rate double, aliases_loaded long, load_errors long, critical_warnings long, semantic_passed boolean"
    decided = gates.decisions(gates.reanonymise_conditions(spark.createDataFrame([row], kind))).first().asDict()
    packages.write_json(f"{work}/decision.json", decided | {"stages_run": ran})
    return decided, OK if decided["decision"] == "PASS" else PRIVACY


def pilot(spark: SparkSession, folder: str, variant: str, source: str, policy: str, work: str) -> Result:
    """Features, attacks and the decision on them, in files under `work`."""
    evidence, code = s3_attack(spark, folder, variant, source)
    if code:
        return evidence, code
    rows = evidence.withColumn("variant", F.lit(VARIANTS[variant][0])).withColumn("status", F.when(F.col("status") == "missing", "missing_evidence").otherwise(F.col("status")))
    lines = [json.loads(r) for r in rows.toJSON().collect()]  # sixteen attacks
    packages.write_lines(f"{work}/evidence.jsonl", lines)
    out, code = s3_assess(spark, f"{work}/evidence.jsonl", VARIANTS[variant][0], policy)
    packages.write_json(f"{work}/decision.json", out)
    return out, code
