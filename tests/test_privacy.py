"""Residual scans, scrubbing, registries, harvesting, phrases, gates, articles and statements on small examples."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cloakframe.functions import chunking
from cloakframe.operators import articles, candidates, coverage, gates, harvest, masking, models, phrases, registry, residual, scrub, statements


def one(spark, column, text="x", kind="string"):
    return spark.createDataFrame([(text,)], f"t {kind}").select(column.alias("r")).first().r


def found(spark, text, values, **more):
    hits = one(spark, residual.hits(F.col("t"), residual.exact_patterns(values), **more), text)
    return [(h.kind, h.form, h.found, h.start) for h in hits]


def test_exact_forms(spark):
    text = "Acme's CIK #0001234, NYSE: ABC (ABC) abc; 000001234 and 0001234567-24-000001 or 000123456724000001; mail x.y@acme.com, http://www.acme.com/a b"
    got = found(spark, text, [("company", "Acme"), ("ticker", "ABC"), ("cik", "0000001234"), ("sec_accession_number", "0001234567-24-000001"), ("company_domain", "acme.com"), ("product", " "), ("person", "acme")])
    forms = {(k, f) for k, f, _, _ in got}
    assert forms == {
        ("company", "literal"), ("company", "possessive"), ("ticker", "literal"), ("ticker", "exchange"), ("ticker", "parenthesised"), ("cik", "padded"), ("sec_accession_number", "url"), ("sec_accession_number", "literal"),
        ("company_domain", "url"), ("company_domain", "email"), ("company_domain", "literal"), ("person", "literal"),
    }
    assert ("cik", "padded", "CIK #0001234", text.index("CIK")) in got and ("cik", "padded", "000001234", text.index("000001234")) in got
    assert [s for k, f, _, s in got if (k, f) == ("ticker", "literal")] == [text.index("ABC"), text.index("(ABC") + 1]
    assert found(spark, "", [("company", "a")]) == [] == found(spark, None, [("company", "a")]) == found(spark, "a (b [c", [("person", "a (b [d")])
    assert found(spark, "a (b [c", [("person", "(b [")]) == [("person", "literal", "(b [", 2)]


def test_scan_of_documents_and_metadata(spark):
    rows = spark.createDataFrame([(1, "Acme here", {"owner": "Acme", "n": None}), (2, None, None)], "doc_id long, text string, meta map<string,string>")
    out = {r.doc_id: r.scan for r in residual.scanned(rows, [("company", "Acme"), ("product", "here")], metadata_col="meta").collect()}
    assert (out[1].total, out[1].blocking, out[1].allowed, out[1].is_blocked, out[1].by_kind) == (3, 2, 1, True, {"company": 2, "product": 1}) and out[2].total == 0


def test_bounded_and_phrase_scans(spark):
    hits = lambda p, t, **m: [h.found for h in one(spark, residual.hits(F.col("t"), p, **m), t)]
    assert hits(residual.bounded_patterns([("v", "ABC")]), "xABC abc. ABC1 (aBc)") == ["abc", "aBc"]
    assert hits(residual.bounded_patterns([("v", "ABC")]), "abc ABC", once=True) == ["abc"]
    assert hits(residual.phrase_patterns(["Big Deal", " "]), "a BIG deal, big deal") == ["BIG deal", "big deal"]


def test_trees_and_tables(spark, tmp_path):
    (tmp_path / "a.md").write_text("Acme product [x](http://acme.com/1)")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.json").write_text('{"k": "only a product"}')
    (tmp_path / "c.txt").write_text("Acme")
    values = [("company", "Acme"), ("product", "product")]
    out = {r.path.rsplit("/", 1)[-1]: (r.scan.total, r.scan.is_blocked) for r in residual.scan_tree(spark, str(tmp_path), values).collect()}
    assert out == {"a.md": (2, True), "b.json": (1, False)}
    old = {r.path.rsplit("/", 1)[-1]: r.scan.total for r in residual.scan_tree(spark, str(tmp_path), values, compat=True).collect()}
    assert old == {"a.md": 2, "b.json": 0}
    files = spark.createDataFrame([("rel/0001234567-24-000001.md", "see [a](http://acme.com) Acme"), ("rel/x.xml", '<ix:a xmlns:q="http://acme.com/1" EntityCentralIndexKey="0042"> cik=42'), ("rel/ok.csv", "fine")], "path string, text string")
    got = {(r.path, r.detector): r.hits for r in residual.namespace_findings(files, ["acme.com", "Acme", "00042", "xy"]).collect()}
    assert got == {("rel/0001234567-24-000001.md", "path"): 1, ("rel/0001234567-24-000001.md", "filename"): 1, ("rel/0001234567-24-000001.md", "markdown"): 3, ("rel/x.xml", "xml"): 4}
    table = spark.createDataFrame([("an Acme", 1), (None, 2)], "acme_name string, Acme long")
    assert {(r.column, r.hits) for r in residual.table_findings(table, ["Acme", "acme"]).collect()} == {("acme_name", 2), ("Acme", 1)}
    assert [tuple(r) for r in residual.release_findings(files, ["Acme", "rel/x"]).collect()] == [("rel/0001234567-24-000001.md", "content", "Acme"), ("rel/x.xml", "path", "rel/x")]
    names = spark.createDataFrame([("ACME_1.md",), ("b",)], "name string")
    assert [r.value for r in residual.name_hits(names, [("c", "acme"), ("c", "zz")]).collect()] == ["acme"] and residual.name_hits(names, []).count() == 0


def test_privacy_report(spark):
    rows = spark.createDataFrame([(1, "company", "Acme"), (1, "person", "Executive 042"), (2, "company", "A" * 40)], "doc_id long, kind string, found string")
    out = residual.privacy_report(rows, 99, 100)
    assert {(r.doc_id, r.total_hits, r.suppressed_hits, r.is_blocked) for r in out["by_file"].collect()} == {(1, 1, 1, True), (2, 1, 0, True)}
    assert {r.value for r in out["top_values"].collect()} == {"Acme", "A" * 30 + "..."}
    s = out["summary"].first()
    assert (s.post_mask_hits, s.suppressed, s.replacement_rate, s.passed) == (2, 1, 0.99, False)
    assert residual.privacy_report(rows.limit(0), 0, 0)["summary"].first().passed
    for text, ok in (("Executive 042", True), ("the company", False), ("[URL REMOVED]", True), ("x Executive 042", False), ("synthetic financial news surrogate", True), (None, False)):
        assert one(spark, residual.suppressible(F.col("t")), text) is ok


def test_submission_scrub(spark):
    text = "Visit www.a.com or call (212) 555-0123 now.  EIN 12-3456789\nfiled 333-123456 on Jan. 5, 2020 at 12 Main Street\nThe Director signed\nabstain votes 12,345\r\nAcmeX Acme, ACME\n0001234567-24-000001"
    got = one(spark, scrub.submission_scrub(F.col("t"), [("Acme", "Company 001"), ("AcmeX", "Product 1"), ("", "q")]), text)
    assert got == "Visit [URL_REMOVED] or call [PHONE_REMOVED] now. EIN [EIN_REMOVED]\nfiled [FILING_ID] on [DATE_REMOVED] at [ADDRESS_REMOVED]\n[IDENTITY_FIELD_REMOVED]\n[IDENTITY_FIELD_REMOVED]\nProduct 1 Company 001, Company 001\n[PHONE_REMOVED]-24-000001"
    for bad in ("us-gaap:Cash", "http://a", "212-555-0123", "12-3456789", "001-12345", "2020-01-31", "Commission File Number", "an auditor", "XY up", "see /Users/me"):
        assert one(spark, scrub.forbidden_public(F.col("t"), ["XY"]), bad)
    assert not one(spark, scrub.forbidden_public(F.col("t"), ["XY"]), "clean text about revenue") and not one(spark, scrub.forbidden_public(F.col("t")), None)


def test_model_scrub(spark):
    registry_ = [masking.Alias("a", "Acme Corp", "Company 001", kind="company"), masking.Alias("b", "0000001234", None, kind="cik"), masking.Alias("c", "ABC", None, kind="ticker")]
    rows = spark.createDataFrame([("ACME Corp's CIK 1234 (abc) file 333-12345, central index key",), ("nothing",), (None,)], "text string")
    out = scrub.model_scrub(rows, registry_).collect()
    assert out[0].text.startswith("Company 001") and "1234 " not in out[0].text and "[TICKER_REDACTED]" in out[0].text and "[FILE_NUMBER_REDACTED]" in out[0].text and "[CIK_PHRASE" not in out[0].text
    assert [r.precheck_status for r in out] == ["PRECHECK_PASS"] * 3 and out[2].text is None


def test_markup_and_paths(spark):
    names = scrub.path_pseudonyms("ABC", "1234", ["0001234567-24-000001"])
    text = '<a EntityCentralIndexKey="77"> contextRef="1234" cik=0000001234 <identifier s="x"> 1234 </identifier> /1234/ 000123456724000001'
    got = one(spark, scrub.markup_scrub(F.col("t"), "0000001234", names), text)
    by = f"CIK_{scrub.short_hash('0000001234')}"
    assert got == f'<a EntityCentralIndexKey="{by}"> contextRef="{by}" cik="{by}" <identifier s="x"> {by} </identifier> /{by}/ {names["000123456724000001"]}'
    assert one(spark, scrub.markup_scrub(F.col("t"), ""), text) == text
    assert one(spark, scrub.public_path(F.col("t"), names), "a/000123456724000001.md") == f"a/{names['000123456724000001']}.md"
    filings = spark.createDataFrame([("0001234567-24-000001", "<p>Acme made</p><script>x</script>"), ("9", None)], "accession string, html string")
    out = {r.name: r.text for r in scrub.filings_masked(filings, [masking.Alias("a", "Acme", "Company 001")], "1234", names).collect()}
    assert out == {f"{names['0001234567-24-000001']}.md": "Company 001 made", f"filing_{scrub.short_hash('9')}.md": None}


YAML = """
metadata: {registry_id: r1}
entities:
  - {entity_id: e1, entity_type: COMPANY, canonical_private_value: " Acme   Corp ", assigned_pseudonym: Company 001}
  - {entity_id: e2, entity_type: cik, canonical_private_value: 320193}
  - {entity_id: e3, entity_type: rare_phrase, canonical_private_value: Vice President}
  - {entity_id: e1, entity_type: company, canonical_private_value: Other}
  - just text
  - {entity_id: e4, entity_type: company, canonical_private_value: ab}
aliases:
  - {alias_id: 1, canonical_entity_id: e1, entity_type: company, private_alias_value: Acme, match_policy: POSSESSIVE, enabled_mutation_policies: [POSSESSIVE]}
  - {alias_id: 2, canonical_entity_id: e2, entity_type: cik, private_alias_value: 320193.0, match_policy: cik_padded, priority: 7}
  - {alias_id: 1, canonical_entity_id: e1, entity_type: company, private_alias_value: Again}
  - {alias_id: 3, canonical_entity_id: e3, entity_type: company, private_alias_value: Orphan of prose}
  - {alias_id: 4, canonical_entity_id: e9, entity_type: company, private_alias_value: Orphan}
  - {alias_id: 5, canonical_entity_id: e1, entity_type: company, private_alias_value: or director}
"""


def test_registry_from_yaml(spark):
    entities, aliases, counters = registry.load_registry(*registry.parse_registry(spark, YAML))
    assert counters.first().asDict() == {"entities_loaded": 2, "aliases_loaded": 2, "skipped_empty": 5, "duplicates": 2, "load_errors": 1, "blocking": True}
    assert {(r.entity_id, r.entity_type, r.value) for r in entities.collect()} == {("e1", "company", "Acme Corp"), ("e2", "cik", "320193")}
    masked = masking.masker(registry.to_aliases(entities, aliases))
    assert masked("Acme's CIK 0000320193 and ACME")[0] == "Company 001 [REDACTED] and ACME"
    assert registry.load_report(counters, "/private/x").first().status == "ERRORS"
    empty = registry.load_registry(*registry.parse_registry(spark, "- a list"))[2].first()
    assert empty.blocking and empty.entities_loaded == 0 and registry.load_registry(*registry.parse_registry(spark, ": : :"))[2].first().aliases_loaded == 0
    got = {(r.bucket, r.value) for r in registry.buckets(entities, aliases, "F").collect()}
    assert got == {("ticker", "F"), ("names", "F"), ("company_name", "Acme Corp"), ("names", "Acme Corp"), ("cik", "320193"), ("names", "320193"), ("company_name", "Acme"), ("names", "Acme")}
    left = registry.removed(entities, aliases, ["e1"])
    assert [r.entity_id for r in left[0].collect()] == ["e2"] and [r.alias_id for r in left[1].collect()] == ["2"]
    assert registry.added(aliases, aliases).count() == 2 and {r.entity_type: r.next_number for r in registry.counters(entities).collect()} == {"company": 2, "cik": 1}
    assert registry.registry_hash(entities, "entity_id").first().hash == registry.registry_hash(entities.orderBy(F.desc("value")), "entity_id").first().hash


def test_atlas(spark):
    text = json.dumps({"entries": [
        {"entry_id": "1", "category": "ISSUER", "sub_type": "legal_name", "private_value": "Acme Corp", "match_policy": "POSSESSIVE"}, {"entry_id": "2", "category": "people", "sub_type": "executive", "private_value": "Jane Doe", "priority": 5},
        {"entry_id": "3", "category": "digital", "sub_type": "domain", "private_value": "acme.com", "match_policy": "url"}, {"entry_id": "4", "category": "people", "sub_type": "executive", "private_value": "Old", "active": False},
    ]})
    atlas = registry.parse_atlas(spark, text)
    plan = {r.entry_id: r for r in registry.compiled(atlas).collect()}
    assert {k: v.pseudonym for k, v in plan.items()} == {"1": "[ISSUER]", "2": "[EXECUTIVE_01]", "3": "[DIGITAL_01]"} and plan["1"].pattern == r"(?:Acme\ Corp)'s?\b|Acme\ Corp'"
    entities, aliases = registry.from_plan(registry.compiled(atlas))
    assert {(r.entity_type, r.value) for r in entities.collect()} == {("company", "Acme Corp"), ("executive", "Jane Doe"), ("company_domain", "acme.com")}
    assert {r.match_policy for r in aliases.collect()} == {"possessive", "literal", "url_full"}
    with pytest.raises(ValueError):
        registry.from_plan(registry.compiled(atlas.limit(0)))
    score = {r.category: (r.missing_required, r.score, r.complete) for r in registry.atlas_completeness(atlas).collect()}
    assert score["issuer"] == (["ticker"], 0.2, False) and score["people"] == ([], round(1 / 3, 6), True) and score["products"] == ([], 0.0, True)


def test_registry_from_metadata(spark):
    companies = spark.createDataFrame([("ABC", "Acme Corp", "Acme", "https://www.acme.com/x", "Town", None, "US", None, "1-2", "NYS", "0000042")], "ticker string, long_name string, short_name string, website string, city string, state string, country string, address string, phone string, exchange string, cik string")
    filings = spark.createDataFrame([("ABC", i, f"a{i}") for i in range(60)], "ticker string, place int, accession string")
    entities, aliases = registry.from_metadata(companies, filings)
    assert entities.filter("entity_type = 'sec_accession_number'").count() == 50 and {r.value for r in entities.filter("entity_type = 'headquarters'").collect()} == {"Town", "US"}
    assert {r.value for r in aliases.collect()} == {"Acme Corp", "Acme", "ABC", "abc", "acme.com", "www.acme.com"}


def test_harvest(spark):
    text = "Dr. Jane Doe of Acme Widget Corp. (ABC) (NYSE) wrote j@acme.com, http://www.acme.com/a, CEO John Smith; Smith v. Jones, No. 12-3456, CIK 1234567, (212) 555-0123"
    docs = spark.createDataFrame([(1, text, {"company_name": "ACME WIDGET CORP", "ticker": " XY "}), (2, None, None)], "doc_id long, text string, meta map<string,string>")
    got = {(r.value, r.category) for r in harvest.harvested(docs, "meta").collect()}
    assert {("Dr. Jane Doe", "person"), ("Acme Widget Corp", "organization"), ("ABC", "ticker"), ("j@acme.com", "email"), ("acme.com", "domain"), ("CEO John Smith", "person"), ("No. 12-3456", "legal_identifier"), ("CIK 1234567", "cik"), ("(212) 555-0123", "phone"), ("XY", "ticker")} <= got
    assert ("NYSE", "ticker") not in got and not any(c == "company name" for _, c in got)  # an equal value came first


@pytest.mark.parametrize(("name", "context", "expected"), [
    ("Jane Q. Smith", "/s/ Jane Q. Smith", ("Jane Q. Smith", None)), ("Director John Smith", "Director John Smith", ("John Smith", None)), ("Mary A. Johnson", "Mary A. Johnson, Executive Vice President", ("Mary A. Johnson", None)),
    ("or director", "or director", (None, "person_hard_blocklist")), ("Smith", "Director", (None, "person_token_count_out_of_range")), ("Jane Director Doe", "Director", (None, "person_hard_blocklist")), ("Jane foo", "Director", (None, "person_lowercase_function_word")),
    ("Jane NVDA", "Director", (None, "person_invalid_token_shape")), ("Jane Doe Signed", "Director", (None, "person_trailing_verb")), ("Jane Doe", "nothing", (None, "person_no_high_confidence_context")), ("Jane Smith-Jones", "Director", ("Jane Smith-Jones", None)),
])
def test_admission_of_persons(spark, name, context, expected):
    assert tuple(one(spark, harvest.admit_person(F.lit(name), F.lit(context)))) == expected


def test_persons_and_handles(spark):
    docs = spark.createDataFrame([(1, "SIGNATURES\n/s/ Jane Q. Smith\nby John Roe"), (2, "The Quick Fox")], "doc_id long, text string")
    out = harvest.persons(docs)
    assert {(r.doc_id, r.name) for r in out.filter("name is not null").collect()} >= {(1, "Jane Q. Smith")} and harvest.rejection_report(out).filter("rejection = 'person_no_high_confidence_context'").count() == 1
    roots = harvest.stems(["ABC"], ["Acme Widget Holdings"])
    assert roots == ["abc", "acme", "holdings", "widget"]
    handles = {r.handle: (r.admitted, len(r.variants)) for r in harvest.handles(spark.createDataFrame([(1, "@AcmeCorp @other @xy @ab")], "doc_id long, text string"), roots).collect()}
    assert handles == {"AcmeCorp": (True, 5), "other": (False, 0), "xy": (False, 0), "ab": (False, 0)}
    assert not one(spark, harvest.admit_handle(F.lit("AcmeCorp"), []))
    header = spark.createDataFrame([(1, "COMPANY CONFORMED NAME: Acme\nCENTRAL INDEX KEY: 42\n<us-gaap:Cash>")], "doc_id long, text string")
    assert {(r.source, r.value) for r in harvest.header_facts(header).collect()} == {("filing_header", "Acme"), ("cik", "42"), ("xbrl_concept", "us-gaap:Cash")}


@pytest.mark.parametrize(("phrase", "expected"), [
    ("company 042 net income", "synthetic_placeholder"), ("the widget pro line", "product_or_platform_phrase"), ("about acme today", "raw_direct_identifier"), ("total net income rose", "accounting_taxonomy_boilerplate"), ("the edgar thing here", "sec_xbrl_boilerplate"),
    ("on may 5 2024", "date_period_boilerplate"), ("the revenue growth", "generic_financial_phrase"), ("blue frogs sing", "company_specific_business_phrase"), ("the of and", "company_specific_business_phrase"),
])
def test_phrase_ladder(spark, phrase, expected):
    assert one(spark, phrases.tier(F.col("t"), F.lit(1), F.lit(4), ["acme", "xyz"], ["widget pro"]), phrase) == expected


def test_phrase_attack(spark):
    docs = spark.createDataFrame([(i, "Blue frogs sing loudly here") for i in range(5)] + [(9, None)], "doc_id long, text string")
    rows = phrases.surviving_phrases(docs, {"names": ["blue frogs sing"]}).collect()
    assert {r.phrase for r in rows} == {"blue frogs sing loudly", "blue frogs sing loudly here"} and {r.tier for r in rows} == {"raw_direct_identifier"}
    rows = phrases.surviving_phrases(docs, {}).collect()
    assert {r.tier for r in rows} == {"low_information_ngram"} and phrases.phrase_verdict(docs, {}).first().passed
    assert phrases.phrase_verdict(docs.limit(0), {}).first().surviving == 0
    top = phrases.rare_phrase_attack(docs, {"names": ["frogs sing"]}, top=2).collect()
    assert len(top) == 2 and all(r.blocking and len(r.phrase_hash) == 12 for r in top)


def test_retrieval_rules(spark):
    corpus = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta"), (3, "beta")], "doc_id long, text string")
    query = spark.createDataFrame([(7, "alpha beta")], "doc_id long, text string")
    got = phrases.retrieval_attack(corpus, query, answer=1).first()
    assert (got.corpus, got.source_rank, got.passed) == (3, 1, False) and phrases.retrieval_attack(corpus, query, answer=2).first().passed
    empty, single = phrases.retrieval_attack(corpus.limit(0), query, answer=1).first(), phrases.retrieval_attack(corpus.filter("doc_id = 1"), query, answer=1).first()
    assert (empty.passed, empty.source_rank) == (False, -1) and single.passed and single.vacuous
    assert phrases.retrieval_attack(corpus, query, compat=True).first().source_rank == 1
    numbers = spark.createDataFrame([(5.0,), (50.0,), (-1.0,)], "value double")
    assert not phrases.numeric_attack(numbers, numbers).first().passed and phrases.numeric_attack(numbers, numbers.limit(0)).first().passed
    results = phrases.semantic_suite(corpus, query, corpus, {}, numbers, numbers, answer=1)
    assert {r.attack for r in results.collect()} == {"rare_phrase", "lexical_retrieval", "multi_document", "structured_numeric_similarity"} and not phrases.suite_report(results).first().passed
    assert not phrases.suite_report(results.limit(0)).first().passed


def test_release_gate(spark):
    with pytest.raises(gates.IneligibleVariant):
        gates.assert_releasable("s3a_daily_bucketed")
    with pytest.raises(gates.IneligibleVariant):
        gates.assert_releasable("s3b_weekly_features", "non_releasable_diagnostic")
    clean = dict(release_id="a", exact_identity_hits=0, unique_phrase_hits=0, digital_hits=0, filename_hits=0, source_rank=40, llm_blocked=False, deterministic_reproduced=True, all_attacks_ran=True, provenance_complete=True, private_paths=0, unhandled_errors=0)
    rows = [clean | {"review_implemented": True, "review_decision": "PASS"}, clean | {"release_id": "b"}, clean | {"release_id": "c", "source_rank": -1}, clean | {"release_id": "d", "digital_hits": 1}, clean | {"release_id": "e", "final_submission": True}]
    kind = "release_id string, exact_identity_hits long, unique_phrase_hits long, digital_hits long, filename_hits long, source_rank long, llm_blocked boolean, deterministic_reproduced boolean, all_attacks_ran boolean, provenance_complete boolean, private_paths long, unhandled_errors long, review_implemented boolean, review_decision string, final_submission boolean"
    names = [k.split()[0] for k in kind.split(", ")]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], kind)
    got = {r.release_id: r.decision for r in gates.decisions(gates.release_conditions(df), df.unionByName(df.limit(1).withColumn("release_id", F.lit("z")))).collect()}
    assert got == {"a": "PASS", "b": "REVIEW_REQUIRED", "c": "FAIL", "d": "FAIL", "e": "FAIL", "z": "FAIL"}
    assert {r.release_id: r.decision for r in gates.decisions(gates.release_conditions(df, compat=True)).collect()}["c"] == "REVIEW_REQUIRED"
    assert gates.decisions(gates.release_conditions(df.select("release_id"))).filter("decision <> 'FAIL'").count() == 0
    assert gates.ineligible(spark.createDataFrame([("s1_basic",), ("s3b_weekly_features",)], "variant string")).first().ineligible == ["s1_basic"]


def test_manifest_conditions(spark):
    whole = [("r", e, "h", "run", "src") for e in gates.EVIDENCE]
    manifests = spark.createDataFrame([("r", "run", "src")], "release_id string, run_id string, source_id string")
    of = lambda rows: {r.condition_id: r.passed for r in gates.manifest_conditions(spark.createDataFrame(rows, "release_id string, evidence_type string, artifact_hash string, run_id string, source_id string"), manifests).collect()}
    assert len(of(whole)) == 5 and all(of(whole).values())
    assert of(whole[1:]) == {"evidence_manifest_complete": False} == of([(*w[:3], "other", w[4]) for w in whole])
    assert not of([(w[0], w[1], "placeholder", w[3], w[4]) for w in whole])["manifest_no_placeholders"]
    assert of([]) == {"evidence_manifest_complete": False}


def evidence(**more):
    row = dict(variant="s3b_weekly_features", attack_name="exact", ablation="all", true_source_rank=60, candidate_universe_size=100, percentile_rank=40.0, top_1=False, top_5=False, top_10=False, score=0.5, status="completed")
    return json.dumps({k: v for k, v in (row | more).items() if v != "drop"})


def test_evidence(spark):
    cases = {
        "ok": (evidence(), []), "no object": ("[1]", ["not an object"]), "broken": ("{", ["not an object"]), "rank": (evidence(true_source_rank=1.5), ["rank"]), "text rank": (evidence(true_source_rank="3"), ["rank"]), "lacks": (evidence(top_1="drop"), ["missing top_1", "flag top_1"]),
        "percentile": (evidence(percentile_rank=101), ["percentile"]), "variant": (evidence(variant="s3c_block_features"), ["variant"]), "status": (evidence(status="done"), ["status"]), "nested": (evidence(metrics={"top_5": True}), ["nested top_5"]), "flag": (evidence(top_10=1), ["flag top_10"]), "no score": (evidence(score=None), []),
    }
    rows = gates.evidence_rows(spark.createDataFrame([(k, v) for k, (v, _) in cases.items()], "name string, evidence string"), "s3b_weekly_features")
    assert {r["name"]: r.issues for r in rows.collect()} == {k: v for k, (_, v) in cases.items()}


def test_evidence_gate(spark):
    def decide(rows, required=("exact/all", "dtw/all"), **more):
        df = spark.createDataFrame([(r,) for r in rows], "evidence string")
        out = gates.evidence_gate(gates.evidence_rows(df, "s3b_weekly_features"), more.pop("variant", "s3b_weekly_features"), required, **more).first()
        return out.decision, out.reasons

    two = [evidence(), evidence(attack_name="dtw")]
    assert decide(two) == ("PASS_CANDIDATE", []) and decide(two, variant="s1_basic")[1] == ["ineligible variant"] and decide(two, reconstructed=True)[1] == ["reconstruction succeeded"] and decide(two, forbidden=["x"])[1] == ["forbidden fields"]
    assert decide(two[:1])[1] == ["missing attacks"] and decide([*two, evidence()])[1] == ["repeated attacks"] and decide([*two, evidence(attack_name="q")])[1] == ["unexpected attacks"] and decide([])[0] == "FAIL"
    assert decide([evidence(true_source_rank=10), two[1]]) == ("FAIL", ["source near the top"]) and decide([evidence(true_source_rank=30, candidate_universe_size=1000), two[1]])[0] == "FAIL"
    assert decide([evidence(percentile_rank=99.5), two[1]])[0] == "REVIEW_REQUIRED" and decide([evidence(candidate_universe_size=40, true_source_rank=30), evidence(attack_name="dtw", candidate_universe_size=40, true_source_rank=30)])[1] == ["small universe"]
    assert "source not ranked" in decide([evidence(true_source_rank=-1), two[1]])[1] and "malformed evidence" in decide([evidence(top_1="x"), two[1]])[1]
    held = gates.evidence_rows(spark.createDataFrame([(r,) for r in two], "evidence string"), "s3b_weekly_features")
    assert gates.frozen_release(held, 100, 60, ["exact/all", "dtw/all"]).first().verified and not gates.frozen_release(held, 100, 61, ["exact/all", "dtw/all"]).first().verified


def test_statuses(spark):
    kind = "exact_ids int, unresolved int, review_status string, parse_errors int, correct_guess boolean, companyfacts_rows int, has_filings boolean, archive_mode boolean, has_archive boolean"
    rows = [(0, 0, "disabled", 0, False, 5, True, False, False), (1, 0, "passed", 0, False, 5, True, False, False), (0, 0, "passed", 2, False, 5, True, False, False), (0, 0, "disabled", 0, False, 0, True, False, False), (0, 0, "disabled", 0, False, 5, True, True, False), (0, 0, "unavailable", 0, False, 5, True, False, False)]
    assert [r.status for r in gates.ticker_status(spark.createDataFrame(rows, kind)).collect()] == ["completed_clean", "failed_privacy", "failed_review", "degraded_source_coverage", "degraded_source_coverage", "failed"]
    assert gates.rolled_up(spark.createDataFrame([], "ticker string, status string, review_status string")).first().collection_status == "unknown"


def test_articles(spark):
    kind = "place long, headline string, summary string, body string, url string, published_timestamp string"
    rows = spark.createDataFrame([(0, "Reuters: Acme earnings", None, "acme at https://a.b/c", "u1", "2024-01-02T03:04:05Z"), (1, "x", "", None, "u1", ""), (2, "XY merger", "s", None, "", "1700000000"), (3, None, None, None, None, None)], kind)
    assert [r.place for r in articles.selected(rows).orderBy("place").collect()] == [0, 2, 3]
    out = articles.surrogates(rows, [("Acme", "Aster")], "XY", "Aster", F.make_date(F.lit(2024), F.lit(2), F.lit(1))).collect()
    first = next(r for r in out if r.replaced == 2)
    assert first.event_type == "earnings_release" and first.period == "Q1 2024 (1 month ago)" and "Acme" not in first.text and "[PUBLISHER REMOVED]" in first.text and "https://a.b" not in first.text
    assert sum("[empty article]" in r.text for r in out) == 1 and articles.event_histogram(articles.surrogates(rows, [], "XY", "Aster", F.current_date())).count() >= 2
    assert [tuple(r) for r in articles.briefs(rows, "ABC", ["ABC", "XY"]).select("place", "reason").orderBy("place").collect()][2] == (2, "named peer company")
    values = spark.createDataFrame([("executive", "Jane Doe"), ("company", "Acme"), ("company_domain", "acme.com"), ("brand", "ab"), ("other", "Thing")], "kind string, value string")
    pairs = dict(articles.replacements(values, "ABC", "Aster"))
    assert pairs["Acme"] == "Aster" and pairs["acme.com"] == "aster.example.com" and pairs["Jane Doe"].startswith("[Executive-") and pairs["Thing"].startswith("[Entity-") and "ab" not in pairs and pairs["ABC"] == "Aster"
    event = one(spark, articles.recent_event(F.col("t"), F.lit("Company 001")), "The shareholder meeting of Acme")
    assert "shareholder meeting" in event and "Acme" not in event and "street address" in event


def test_statements(spark):
    tickers = spark.createDataFrame([("abc",), ("XY",)], "ticker string")
    rows = statements.annual(tickers)
    assert rows.count() == 10 and statements.identity_faults(rows).count() == 0 and statements.identity_faults(rows.withColumn("net_income", F.lit(1e9))).count() == 10
    assert {r.relative_year for r in rows.collect()} == {-5, -4, -3, -2, -1} and rows.filter("total_assets <> total_liabilities + total_equity and abs(total_assets - total_liabilities - total_equity) > 1").count() == 0
    assert statements.quarterly(tickers).count() == 16 and statements.regime(statements.weekly(tickers)).count() == 2
    lines = spark.createDataFrame([(1, "income", i, f"l{i}", (-1.0 if i else float("nan"))) for i in range(20)], "entity_id int, statement string, place int, line_item string, value double")
    got = statements.binned_lines(lines).collect()
    assert len(got) == 12 and {r.value_bin for r in got} == {"UNAVAILABLE", "negative"}


def test_candidates(spark):
    chunks = spark.createDataFrame([("k", 1, 100, "Acme pays Jane")], "chunk_id string, doc_id long, start_offset int, text string")
    spans = spark.createDataFrame([("k", 0, 4, "company", 0.9, "a"), ("k", 0, 4, "brand", 0.5, "b"), ("k", 10, 10, "ceo", 0.4, "a"), ("z", 0, 1, "ceo", 0.4, "a")], "chunk_id string, start int, end int, label string, score double, provider string")
    built = candidates.built(spans, chunks)
    assert {(r.entity_type, r.start, r.end, r.text) for r in built.collect()} == {("company", 100, 104, "Acme"), ("brand", 100, 104, "Acme"), ("executive", 110, 110, "")}
    kept = candidates.deduplicated(built)
    best = next(r for r in kept.collect() if r.start == 100)
    assert kept.count() == 2 and best.entity_type == "company" and len(best.group) == 2 and best.providers == 2
    assert {r.risk_band for r in candidates.sanitised(kept).collect()} == {"CRITICAL", "MEDIUM"} and "text" not in candidates.sanitised(kept).columns
    assert candidates.ranked(kept).filter("rank = 1").first().confidence == 0.9
    reviews = spark.createDataFrame([("c1", "accepted", "company", "Acme", "ACME"), ("c2", "accepted", "company", "Acme", "Acme Co"), ("c3", "rejected", "company", "No", "No"), ("c4", "accepted", "brand", "Zed", "Zed")], "candidate_id string, status string, kind string, value string, alias string")
    entities = spark.createDataFrame([("e1", "brand", "zed", None)], registry.ENTITIES)
    aliases = spark.createDataFrame([], registry.ALIASES)
    proposed = candidates.proposals(reviews)
    assert {(r.value, tuple(r.aliases)) for r in proposed.collect()} == {("Acme", ("ACME", "Acme Co")), ("Zed", ("Zed",))}
    assert [r.conflict for r in candidates.conflicts(proposed, entities, aliases).collect()] == ["canonical_entity_exists"]
    more, names = candidates.promote(proposed, entities, aliases)
    assert more.count() == 2 and {(r.value, r.priority) for r in names.collect()} == {("ACME", 200), ("Acme Co", 200)}
    counted = candidates.merged_counters(spark.createDataFrame([("a", {"accepted": 2}), ("a", {"accepted": 1, "rejected": 4}), ("b", None)], "provider string, counters map<string,int>"))
    assert {(r.provider, r.accepted, r.rejected, r.duplicate) for r in counted.collect()} == {("a", 3, 4, 0), ("b", 0, 0, 0)}
    items = spark.createDataFrame([(1, "Acme pays Jane", "Jane", "person", None, None), (1, "Acme pays", "Acme", "company", 1, 5), (1, "x", "Zed", "company", None, None)], "doc_id long, text string, entity string, kind string, start int, end int")
    spans_, faults = candidates.benchmark_documents(items)
    assert [tuple(r) for r in spans_.collect()] == [(1, "person", 10, 14)] and {r.fault for r in faults.collect()} == {"drifted", "not in the text"}


def test_coverage(spark):
    assert coverage.parse_limits("10-K:2, 10-q ,10-K") == {"10-K": 2, "10-Q": 1} and coverage.parse_limits(None) == {} == coverage.parse_limits(" , ")
    for bad in ("10-K:0", "10-K:x", "10 K", "10-K:"):
        with pytest.raises(ValueError):
            coverage.parse_limits(bad)
    raw = spark.createDataFrame([("a", 0, "1", "2", "0.5", "1.5", "10", None), ("a", 1, "x", "2", "1", "1", "1", "7")], "entity_id string, bar_idx int, Open string, High string, Low string, Close string, Volume string, `Adj Close` string")
    assert [(r.open, r.adj_close) for r in coverage.to_bars(raw).collect()] == [(1.0, 1.5)]
    assert coverage.profile(raw).first()[:3] == (2, 8, 1)
    log = one(spark, coverage.redacted_log(F.col("t")), 'api_key=abc "token": "t1" user=me my_secret : "q"')
    assert "abc" not in log and "t1" not in log and "user=me" in log and '"q"' not in log
    keys = spark.createDataFrame([("1", '{"a": [{"guess": 1}], "b": {"guess": {"c": 2}}}'), ("2", "no json")], "id string, report string")
    assert {(r.id, r.path) for r in coverage.forbidden_keys(keys, ["guess", "c"]).collect()} == {("1", "$.a[0].guess"), ("1", "$.b.guess"), ("1", "$.b.guess.c")}
    assert one(spark, coverage.sanitised_paths(F.col("t"), "/priv", "/repo"), "/priv/a at /repo/b") == "[PRIVATE_ROOT]/a at [REPO_ROOT]/b" and one(spark, coverage.private_looking(F.col("t"), ["Secret"]), "a SECRET")
    files = spark.createDataFrame([("x/metrics/ohlcv.parquet", "<ix:a>"), ("b.md", "<html> <ix:a xmlns:q='z'>"), ("c.md", "A fine long text of many words that says something about the business here.")], "path string, text string")
    assert coverage.missing_datasets(files).count() == 6 and {r.fault for r in coverage.format_faults(files.filter("path = 'b.md'")).collect()} == {"raw markup", "xbrl tags", "namespaces", "little prose", "too short"} and coverage.format_faults(files.filter("path = 'c.md'")).count() == 0
    meta = spark.createDataFrame([("ABC", "t", 5, [("p", "ok", 3, "secret")])], "ticker string, collection_timestamp string, years_requested int, collection_summary array<struct<artifact_type:string,status:string,row_count:int,path:string>>")
    assert coverage.sanitised_metadata(meta).first().asDict(True) == {"ticker": "ANON", "collection_timestamp": "t", "years_requested": 5, "collection_summary": [{"artifact_type": "p", "status": "ok", "row_count": 3}]}
    assert coverage.projected(spark.createDataFrame([(1, 0.5, 9.0)], "submission_id int, hit_rate double, total_return double"), "backtest").columns == ["submission_id", "hit_rate"]


def test_chunks(spark):
    text = "alpha beta gamma delta " * 20
    places = chunking.fixed(text, 50, 10)
    assert places[0][0] == 0 and places[-1][1] == len(text) and all(b[0] < a[1] <= b[1] and b[0] > a[0] for a, b in zip(places, places[1:], strict=False)) and all(e == len(text) or text[e] == " " for _, e in places)
    doc = "one\ntwo\n\n\nthree " + "x" * 30 + "\n  \nfour"
    got = chunking.by_paragraph(doc, 20, 0)
    assert [doc[a:b] for a, b in got] == ["one\ntwo", "three " + "x" * 30, "four"]
    assert chunking.fixed("", 5, 1) == [] == chunking.by_paragraph(" \n ", 5, 1) and [p for _, p in chunking.paragraphs("a\n\nb\nc")] == ["a", "b\nc"]
    docs = spark.createDataFrame([(1, "aa bb. cc dd.", [(0, 6, "A"), (7, None, "B")]), (2, None, None)], "doc_id long, text string, s array<struct<char_start:int,char_end:int,title:string>>")
    rows = chunking.chunk_rows(docs, "section", 100, 0, "s").collect()
    assert [(r.chunk, r.text, r.section) for r in rows] == [(0, "aa bb.", "A"), (1, "cc dd.", "B")] and chunking.chunk_rows(docs, "section", 100, 0, "s").collect() == rows
    with pytest.raises(ValueError):
        chunking.chunker("words")
    best = one(spark, chunking.section_between(F.col("t"), r"item 1\.", [r"item 2\."]), "Item 1. short Item 2. x ITEM 1. the longer one  here Item 2. end")
    assert best == "ITEM 1. the longer one here " and one(spark, chunking.section_between(F.col("t"), "zzz", ["q"]), "a") == ""
    sections = spark.createDataFrame([([("Item 1", "T", 0, 3, "abc"), ("Item 2", "U", 3, 5, "de")],)], "s array<struct<item:string,title:string,start_line:int,end_line:int,content:string>>")
    r = sections.select(chunking.section_of(F.col("s"), "item 2").alias("a"), chunking.section_summary(F.col("s")).alias("b"), chunking.rebuilt(F.col("s"), F.array(F.lit("X"))).alias("c")).first()
    assert r.a.title == "U" and tuple(r.b) == (2, ["Item 1", "Item 2"], 5, 5) and [x.content for x in r.c] == ["X", "de"]


def test_models(spark):
    rows = spark.createDataFrame([(1, 0, "secret Acme"), (1, 1, "fine"), (2, 0, "boom"), (2, 1, None)], "doc_id long, chunk int, text string")

    def attack(prompt):
        if "boom" in prompt:
            raise RuntimeError
        return '```json\n{"guess": "Acme Corp", "confidence": 0.9}\n```' if "Acme" in prompt else '{"guess": "", "confidence": 0.1}'

    out = {(r.doc_id, r.chunk): r for r in models.attack_and_rewrite(rows, attack, lambda p: "Here is the text:\n" + p.replace("Acme", "it"), "acme").collect()}
    assert (out[1, 0].first_verdict, out[1, 0].verdict, out[1, 0].rewritten, out[1, 0].text) == ("FAIL", "PASS", True, "secret it") and out[1, 1].verdict == "PASS" and out[2, 0].parse_error and out[2, 0].verdict == "FAIL"
    prompts = spark.createDataFrame([(1, ["a" * 3000, "b", "c", "d"])], "id long, texts array<string>").select("id", models.guess_prompt(F.col("texts"), F.lit("{}"), "bank").alias("prompt"))
    assert prompts.first().prompt.count("Excerpt") == 3 and "a" * 2001 not in prompts.first().prompt
    told = models.guess_attack(prompts, lambda p: '{"guesses": [{"rank": 1, "guess": "Acme", "confidence": 0.8, "clue_types": ["x"]}]}').first()
    assert told.blocked and told.guesses[0].guess == "[REDACTED]" and models.guess_attack(prompts, lambda p: "no").first().blocked
    review = models.artefact_review(spark.createDataFrame([("p", "t")], "path string, text string"), lambda p: '{"risks": [{"value": "Executive 042", "kind": "x"}]}').first()
    assert review.status == "PASS" and one(spark, models.repaired(F.col("t"), [("Acme", "X"), (" ", "y")]), "ACME acme") == "X X"
    assert models.retry_delay(3, 1.0, 60.0) == 4.0 and models.retry_delay(9, 1.0, 60.0) == 60.0 and models.retry_delay(1, after=5.0) == 5.0
    calls = []
    with pytest.raises(RuntimeError):
        models.asked(lambda p: calls.append(p) or (_ for _ in ()).throw(RuntimeError()), "q", 3, sleep=lambda s: None)
    assert len(calls) == 3 and models.json_in("x {bad") is None and models.judged(None, "a") == "FAIL" and models.judged({"guess": "", "confidence": 0.4}, "a") == "REVIEW"
    spans = models.recognised(spark.createDataFrame([("k", "ab"), ("l", None)], "chunk_id string, text string"), lambda: lambda t: [(0, len(t), "company", 0.5)])
    assert [tuple(r) for r in spans.collect()] == [("k", 0, 2, "company", 0.5, "local")]
