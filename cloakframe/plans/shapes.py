"""Tables in the shapes that the operators take, made from the driver's tables.

Each is one SELECT in the part of SQL that Spark and DuckDB share, so a query and its SQL begin from the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Orders as filings, with a text that holds every kind of identifier.
FILINGS = """
    SELECT o_orderkey AS filing_id, o_custkey AS cust,
        lpad(CAST(o_custkey AS STRING), 10, '0') || '-' || lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') || '-' || lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '0') AS accessionNumber,
        CASE o_orderkey % 4 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '8-K' ELSE 'S-1' END AS form,
        CASE o_custkey % 4 WHEN 0 THEN 'ABC' WHEN 1 THEN 'XY' WHEN 2 THEN 'F' ELSE 'QRST' END AS ticker,
        CAST(CAST(o_orderdate AS DATE) AS STRING) AS filingDate,
        CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS reportDate,
        'COMPANY CONFORMED NAME: Customer ' || CAST(o_custkey AS STRING) || ' Inc.' || chr(10)
        || 'Central  Index Key: ' || lpad(CAST(o_custkey AS STRING), 10, '0') || ' NYSE: ABC trading symbol is XY' || chr(10)
        || 'see https://www.example.com/browse?cik=' || lpad(CAST(o_custkey AS STRING), 10, '0') || '&x=1 and /Archives/edgar/data/' || lpad(CAST(o_custkey AS STRING), 7, '0') || '/ for 333-' || lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0') || chr(10)
        || 'EIN ' || lpad(CAST(o_custkey % 100 AS STRING), 2, '0') || '-' || lpad(CAST(o_orderkey % 10000000 AS STRING), 7, '0') || ', call (212) 555-' || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') || ' before Jan 5, 2020 or ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '.' || chr(10)
        || CASE o_orderkey % 5 WHEN 0 THEN 'The Director of the board signed.' WHEN 1 THEN 'Abstain votes 12,345 were cast' WHEN 2 THEN 'Commission File Number' ELSE 'Revenue was $' || CAST(o_custkey AS STRING) || '.5 million, up 4% at 12 Main Street' END || chr(10)
        || 'Filed  under' || chr(9) || lpad(CAST(o_custkey AS STRING), 10, '0') || '-' || lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') || '-' || lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '0')
        || ' by Customer ' || CAST(o_custkey AS STRING) || '''s agent ABC (ABC); ABCD stays' AS text
    FROM orders"""

#: Events as news articles.
ARTICLES = """
    SELECT event_id AS place, CASE event_id % 4 WHEN 0 THEN 'Reuters: ABC earnings beat' WHEN 1 THEN 'Lawsuit filed against Customer Corp' WHEN 2 THEN 'XY shares rise on merger talk' ELSE '' END AS headline,
        CASE event_id % 3 WHEN 0 THEN 'Bloomberg reports that ABC and Customer Corp agree, see https://news.example.com/a?b=1 for more.' WHEN 1 THEN '' ELSE 'The dividend was raised by customer corp.' END AS summary,
        CASE event_id % 7 WHEN 0 THEN NULL ELSE 'Body ' || event_type || ' of user ' || CAST(user_id AS STRING) || ' on Yahoo Finance' END AS body,
        CASE event_id % 5 WHEN 0 THEN '' ELSE 'https://news.example.com/' || CAST(event_id % 977 AS STRING) END AS url,
        CASE event_id % 11 WHEN 0 THEN '' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS published_timestamp
    FROM events"""

#: Suppliers as entities of a registry, with faults, and customers as aliases of them.
ENTITIES = """
    SELECT CAST(s_suppkey AS INT) AS place, CASE WHEN s_suppkey % 9 = 0 THEN '' WHEN s_suppkey % 7 = 0 THEN 'e1' ELSE 'e' || CAST(s_suppkey AS STRING) END AS entity_id,
        CASE s_suppkey % 4 WHEN 0 THEN 'ticker' WHEN 1 THEN 'COMPANY' WHEN 2 THEN 'product' ELSE 'executive' END AS entity_type,
        CASE WHEN s_suppkey % 8 = 0 THEN ' F ' WHEN s_suppkey % 10 = 0 THEN 'Vice  President' WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_name || '  Corp ' END AS value, CAST(NULL AS STRING) AS pseudonym
    FROM supplier"""
ALIASES = """
    SELECT CAST(c_custkey AS INT) AS place, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'a1' ELSE 'a' || CAST(c_custkey AS STRING) END AS alias_id,
        'e' || CAST(c_custkey % 12 AS STRING) AS entity_id, CASE c_custkey % 3 WHEN 0 THEN 'company' WHEN 1 THEN 'ticker' ELSE 'brand' END AS entity_type,
        CASE WHEN c_custkey % 19 = 0 THEN 'ab' WHEN c_custkey % 23 = 0 THEN '/s/' ELSE c_name END AS value, 'LITERAL' AS match_policy, 100 AS priority
    FROM customer"""

#: Nations as releases to be assessed.
ASSESSMENTS = """
    SELECT n_name AS release_id, CASE WHEN n_nationkey = 3 THEN 's3a_daily_bucketed' ELSE 's3b_weekly_features' END AS variant, CASE WHEN n_nationkey % 10 = 1 THEN 2 ELSE 0 END AS exact_identity_hits, 0 AS unique_phrase_hits,
        CASE WHEN n_nationkey = 4 THEN 1 ELSE 0 END AS digital_hits, 0 AS filename_hits, CASE WHEN n_nationkey = 5 THEN NULL WHEN n_nationkey = 6 THEN -1 ELSE 8 + n_nationkey END AS source_rank, n_nationkey % 9 = 2 AS llm_blocked,
        n_nationkey <> 7 AS deterministic_reproduced, TRUE AS all_attacks_ran, TRUE AS provenance_complete, 0 AS private_paths, CASE WHEN n_nationkey = 8 THEN NULL ELSE 0 END AS unhandled_errors,
        n_nationkey % 2 = 0 AS review_implemented, CASE n_nationkey % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'REVIEW' ELSE 'NOT_RUN' END AS review_decision, n_nationkey > 18 AS final_submission,
        CASE WHEN n_nationkey % 6 = 0 THEN 3 ELSE 0 END AS post_mask_hits, CAST(1.0 - n_nationkey / 1000.0 AS DOUBLE) AS replacement_rate, n_nationkey AS aliases_loaded, 0 AS load_errors, 0 AS critical_warnings, n_nationkey % 5 <> 4 AS semantic_passed
    FROM nation"""

#: Customers as companies with counts and statuses.
SUMMARIES = """
    SELECT c_custkey AS ticker, CASE WHEN c_custkey % 50 = 0 THEN 'failed_collection' WHEN c_custkey % 31 = 0 THEN 'failed_privacy' ELSE 'completed_clean' END AS status,
        CASE c_custkey % 4 WHEN 0 THEN 'passed' WHEN 1 THEN 'disabled' WHEN 2 THEN 'failed_parse' ELSE 'passed' END AS review_status, c_custkey % 4 <> 1 AS review_enabled,
        CASE WHEN c_custkey % 29 = 0 THEN 'failed' ELSE 'clean' END AS collection_status, CASE WHEN c_custkey % 31 = 0 THEN 'failed' ELSE 'clean' END AS privacy_status, 'clean' AS format_status,
        CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'complete' END AS numeric_data_status, 'clean' AS coverage_status,
        CAST(CASE WHEN c_custkey % 41 = 0 THEN 2 ELSE 0 END AS BIGINT) AS exact_identifier_count, CAST(0 AS BIGINT) AS unresolved_candidate_count, CAST(0 AS BIGINT) AS blocking_finding_count, CAST(0 AS BIGINT) AS path_identifier_count,
        CAST(0 AS BIGINT) AS filename_identifier_count, CAST(0 AS BIGINT) AS manifest_identifier_count, CAST(0 AS BIGINT) AS review_parse_error_count, CAST(0 AS BIGINT) AS review_fail_count,
        CAST(0 AS BIGINT) AS required_numeric_dataset_failure_count, CAST(CASE WHEN c_custkey % 43 = 0 THEN 1 ELSE 0 END AS BIGINT) AS required_sec_format_failure_count, CAST(0 AS BIGINT) AS required_coverage_failure_count,
        CAST(0 AS BIGINT) AS private_artifact_export_count, CAST(0 AS BIGINT) AS original_artifact_export_count
    FROM customer"""

#: Events as a review's samples, and as collected artefacts.
REVIEWS = """
    SELECT user_id % 40 AS ticker, CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN CASE WHEN user_id % 40 < 4 THEN 'FAIL' ELSE 'PASS' END WHEN 2 THEN 'REVIEW' ELSE 'PASS' END AS verdict,
        event_id % 9 = 0 AND user_id % 3 = 0 AS parse_error, event_id % 5 = 0 AS rewritten, CAST((event_id % 100) / 100.0 AS DOUBLE) AS confidence
    FROM events"""
CANDIDATES = """
    SELECT 'c' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS candidate_id, l_orderkey AS doc_id, CASE l_suppkey % 3 WHEN 0 THEN 'rules' WHEN 1 THEN 'local' ELSE 'remote' END AS provider,
        CASE l_partkey % 4 WHEN 0 THEN 'company' WHEN 1 THEN 'executive' WHEN 2 THEN 'product' ELSE 'UNKNOWN' END AS entity_type, CAST(l_partkey % 6 - 1 AS INT) AS start, CAST(l_partkey % 6 + l_suppkey % 3 AS INT) AS end_,
        CAST(l_discount * 10 AS DOUBLE) AS confidence, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'rejected' ELSE 'pending' END AS review_status
    FROM lineitem"""

SHAPES = {
    "filings": (FILINGS, "orders"), "articles": (ARTICLES, "events"), "entities": (ENTITIES, "supplier"), "aliases": (ALIASES, "customer"), "assessments": (ASSESSMENTS, "nation"), "summaries": (SUMMARIES, "customer"),
    "reviews": (REVIEWS, "events"), "candidates": (CANDIDATES, "lineitem"),
}


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    select, table = SHAPES[name]
    return spark.sql(select.replace(f"FROM {table}", "FROM {rows}"), rows=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def cte(name: str) -> str:
    """`name AS (...)` for a WITH clause."""
    return f"{name} AS ({SHAPES[name][0]})"
