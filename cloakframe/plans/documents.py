"""Queries over documents, pages, events and tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import documents as d
from ..operators import governance as g
from ..sources.bars import table

#: Fixed values of the queries: private values (value, what stands in for it, priority).
ALIASES = (("MIT License", "[LICENSE_01]", 30), ("GNU General Public License", "[LICENSE_02]", 30), ("Public License", "[LICENSE_03]", 20), ("License", "[LICENSE_04]", 10), ("Apache", "[ORG_01]", 20), ("example.com", "[DOMAIN_01]", 40), ("mail1", "[HOST_01]", 15))
VALUES = tuple(a[0] for a in ALIASES)


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def t22_strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", t.stripped_html(F.col("html")).alias("text"))


def t29_token_counts(spark, sf_dir):
    words = t.tokens(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.size(words).cast("long").alias("tokens"), F.size(F.array_distinct(words)).cast("long").alias("distinct_tokens"))


def g19_document_frequency(spark, sf_dir):
    """Words with the number of documents and of places, for words in two documents at least."""
    words = docs(spark, sf_dir).select("doc_id", F.explode(t.tokens(F.col("text"))).alias("term"))
    counted = words.groupBy("term", "doc_id").agg(F.count("*").alias("c")).groupBy("term").agg(F.count("*").alias("df"), F.sum("c").alias("n"))
    return counted.filter("df >= 2")


def x12_rare_phrases(spark, sf_dir):
    return d.rare_phrases(docs(spark, sf_dir))


def x13_bm25(spark, sf_dir):
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return d.bm25(docs(spark, sf_dir), asked)


def d09_identity_scan(spark, sf_dir):
    return d.identity_scan(docs(spark, sf_dir), VALUES)


def d11_identifier_scan(spark, sf_dir):
    return d.identifier_scan(docs(spark, sf_dir))


def t04_masking(spark, sf_dir):
    return d.masked(docs(spark, sf_dir), ALIASES).select("doc_id", F.sha2("masked", 256).alias("sha"), "accepted", "rejected")


def t15_scrub(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.sha2(t.scrubbed(F.col("text")), 256).alias("sha"))


def t19_event_categories(spark, sf_dir):
    """Ordered patterns over the event stream's types and values."""
    kind = F.when(F.col("event_type").rlike("(?i)error"), "incident").when(F.col("event_type").rlike("(?i)purchase|buy"), "sale").when(F.col("event_type").rlike("(?i)click|view"), "interest").otherwise("general")
    return table(spark, sf_dir, "events").groupBy(kind.alias("category")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def t23_sections(spark, sf_dir):
    return d.sections(docs(spark, sf_dir), r"^\S+\.$")


def t27_chunks(spark, sf_dir):
    return d.chunked(docs(spark, sf_dir))


def r13_deduplicate(spark, sf_dir):
    return d.deduplicated(docs(spark, sf_dir))


def g13_retention(spark, sf_dir):
    source = docs(spark, sf_dir)
    return d.retention(source, source.select("doc_id", t.scrubbed(F.col("text")).alias("text")))


def p03_pseudonymise(spark, sf_dir):
    return g.pseudonymised(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name"])


def p21_capped(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return g.capped(rows, "o_orderpriority", [F.desc("o_totalprice"), "o_orderkey"], 5)


def w23_pseudonyms(spark, sf_dir):
    return g.counted_pseudonyms(table(spark, sf_dir, "part"), "p_brand", "p_name")


def m02_histogram_cosine(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.lit("a").alias("side"), F.col("o_totalprice").alias("value"))
    return g.histogram_cosine(a.union(table(spark, sf_dir, "lineitem").select(F.lit("b"), "l_extendedprice")))


def m04_size_bins(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(g.size_bin(F.col("o_totalprice") * 1e5).alias("bin")).agg(F.count("*").alias("n"))


def e01_periods(spark, sf_dir):
    now = F.make_date(F.lit(1998), F.lit(8), F.lit(2))
    return table(spark, sf_dir, "orders").groupBy(g.period(F.to_date("o_orderdate"), now).alias("period")).agg(F.count("*").alias("n"))


def h04_flatten(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", g.flattened(F.col("props")).alias("p")).select("event_id", F.col("p.key").alias("path"), F.col("p.value").alias("leaf"))


def j05_orphans(spark, sf_dir):
    """Customers without orders."""
    orders = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


def j12_completeness(spark, sf_dir):
    required = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"))
    return g.completeness(required, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key")))


def g15_report(spark, sf_dir):
    """Counts by language, by source and in all."""
    rows = table(spark, sf_dir, "documents").select("lang", "source", "n_chars")
    return rows.groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def g26_inventory(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")).cube("o_orderstatus", "year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def x17_release_gate(spark, sf_dir):
    """Conditions over the masked corpus: no identifier is left, words are kept, no document is lost."""
    source = docs(spark, sf_dir)
    scrubbed = source.select("doc_id", t.scrubbed(F.col("text")).alias("text"))
    left = d.identifier_scan(scrubbed).agg(F.count("*").alias("n"))
    kept = d.retention(source, scrubbed).agg(F.avg("words_kept").alias("kept"), F.count("*").alias("n"))
    conditions = left.select(F.lit("no_identifiers").alias("id"), (F.col("n") == 0).alias("passed"), F.lit(True).alias("blocking"))
    conditions = conditions.union(kept.select(F.lit("words_kept"), F.col("kept") > 0.9, F.lit(False))).union(kept.select(F.lit("documents"), F.col("n") > 0, F.lit(True)))
    return g.gate(conditions)


def r17_first_turns(spark, sf_dir):
    """The first text of each conversation by role."""
    rows = table(spark, sf_dir, "conversations")
    return rows.groupBy("conv_id", "role").agg(F.min("turn").alias("first_turn"), F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"))


def _scrub_sql(column: str) -> str:
    for _, pattern, name in t.FORMS:
        column = f"regexp_replace({column}, '{pattern}', '{name}', 'g')"
    return column


_TOK = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')"
_COUNT = "CAST(len(regexp_extract_all({c}, '{p}')) AS BIGINT)"
_FORM_COUNTS = ", ".join(f"{_COUNT.format(c='text', p=p)} AS {n}" for n, p, _ in t.FORMS)
_SCAN = f"scan AS (SELECT doc_id, {_FORM_COUNTS} FROM src), found AS (SELECT * FROM scan WHERE {' + '.join(n for n, _, _ in t.FORMS)} > 0)"
_KEEP = "round(CASE WHEN {b} = 0 THEN 1.0 ELSE {a} / {b} END, 6)"


def _kept(p: str) -> str:
    return _KEEP.format(a=f"len(regexp_extract_all(m, '{p}'))", b=f"len(regexp_extract_all(text, '{p}'))")


SQL = {
    "t22_strip_html": """SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', ' ', 'g'), '(?is)<style\\b.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')) AS text FROM pages""",
    "t29_token_counts": f"SELECT doc_id, len({_TOK}) AS tokens, len(list_distinct({_TOK})) AS distinct_tokens FROM documents",
    "g19_document_frequency": f"WITH w AS (SELECT doc_id, unnest({_TOK}) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS df, count(*) AS n FROM w GROUP BY term HAVING count(DISTINCT doc_id) >= 2",
    "x12_rare_phrases": f"""WITH w AS (SELECT doc_id, {_TOK} AS t FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, len(t) - 2), lambda i: array_to_string(t[i:i + 3], ' '))) AS ngram FROM w WHERE len(t) >= 4),
        c AS (SELECT ngram, count(*) AS n, count(DISTINCT doc_id) AS df FROM g GROUP BY ngram), r AS (SELECT regexp_matches(ngram, '\\d') AS blocking, ngram, n FROM c WHERE df = 1 AND n > 1),
        k AS (SELECT blocking, CAST(row_number() OVER (PARTITION BY blocking ORDER BY n DESC, ngram) AS INTEGER) AS rank, ngram, n FROM r) SELECT * FROM k WHERE rank <= 20""",
    "x13_bm25": f"""WITH w AS (SELECT doc_id, {_TOK} AS t FROM documents), st AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM w), q AS (SELECT item_id AS query_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TOK}) AS term FROM benchmark) GROUP BY ALL),
        p AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM w) WHERE term IN (SELECT term FROM q) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM p GROUP BY ALL),
        s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean)) * qtf), 4) AS score FROM q JOIN f USING (term) JOIN p USING (term) CROSS JOIN st GROUP BY ALL),
        k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s) SELECT * FROM k WHERE rank <= 10""",
    "d09_identity_scan": "WITH v AS (SELECT unnest([" + ", ".join(f"'{v}'" for v in VALUES) + """]) AS value), h AS (SELECT doc_id, value, CAST((length(text) - length(replace(text, value, ''))) / length(value) AS BIGINT) AS exact, CAST(contains(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), lower(value)) AS BIGINT) AS normalised FROM documents CROSS JOIN v) SELECT * FROM h WHERE exact > 0 OR normalised > 0""",
    "d11_identifier_scan": f"WITH src AS (SELECT * FROM documents), {_SCAN} SELECT * FROM found",
    "t15_scrub": f"SELECT doc_id, sha256({_scrub_sql('text')}) AS sha FROM documents",
    "t19_event_categories": "SELECT CASE WHEN regexp_matches(event_type, '(?i)error') THEN 'incident' WHEN regexp_matches(event_type, '(?i)purchase|buy') THEN 'sale' WHEN regexp_matches(event_type, '(?i)click|view') THEN 'interest' ELSE 'general' END AS category, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "t23_sections": "WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), l AS (SELECT doc_id, unnest(range(0, len(l))) AS line, unnest(l) AS content FROM s), q AS (SELECT *, CAST(sum(CASE WHEN regexp_matches(content, '^\\S+\\.$') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS BIGINT) AS seq FROM l) SELECT doc_id, seq, min(line) AS start_line, max(line) AS end_line, CAST(sum(length(content)) AS BIGINT) AS chars FROM q GROUP BY ALL",
    "t27_chunks": "WITH c AS (SELECT doc_id, text, unnest(range(0, greatest(1, CAST(ceil((length(text) - 200) / 1800) AS BIGINT)))) AS chunk FROM documents) SELECT doc_id, chunk, chunk * 1800 AS start, sha256(substring(text, chunk * 1800 + 1, 2000)) AS sha FROM c",
    "r13_deduplicate": "SELECT md5(text) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY ALL",
    "g13_retention": f"WITH s AS (SELECT doc_id, text, {_scrub_sql('text')} AS m FROM documents) SELECT doc_id, {_kept('[\\p{L}\\p{N}_]+')} AS words_kept, {_kept('[0-9]+')} AS numbers_kept FROM s",
    "p03_pseudonymise": "SELECT c_custkey, CASE WHEN c_name IS NOT NULL AND c_name <> '' THEN 'PSEUDO_' || substring(sha256(c_name), 1, 8) ELSE c_name END AS c_name, c_mktsegment FROM customer",
    "p21_capped": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 5",
    "w23_pseudonyms": "WITH o AS (SELECT p_brand AS kind, lower(trim(p_name)) AS key, min(p_name) AS value FROM part GROUP BY ALL) SELECT *, printf('%s_%03d', upper(regexp_replace(kind, '[^A-Za-z0-9]', '', 'g')), row_number() OVER (PARTITION BY kind ORDER BY key)) AS pseudonym FROM o",
    "m02_histogram_cosine": "WITH v AS (SELECT 'a' AS side, o_totalprice AS value FROM orders UNION ALL SELECT 'b', l_extendedprice FROM lineitem), h AS (SELECT least(99, greatest(0, CAST(floor(log10(value)) AS INTEGER))) AS bucket, count(*) FILTER (WHERE side = 'a') AS a, count(*) FILTER (WHERE side = 'b') AS b FROM v WHERE value > 0 GROUP BY ALL) SELECT round(coalesce(CAST(sum(a * b) AS DOUBLE) / nullif(sqrt(CAST(sum(a * a) AS DOUBLE)) * sqrt(CAST(sum(b * b) AS DOUBLE)), 0), 0.0), 6) AS cosine FROM h",
    "m04_size_bins": "SELECT CASE WHEN o_totalprice * 1e5 < 0 THEN 'negative' WHEN o_totalprice * 1e5 < 1e9 THEN 'small' WHEN o_totalprice * 1e5 < 1e10 THEN 'medium' WHEN o_totalprice * 1e5 < 1e11 THEN 'large' ELSE 'mega' END AS bin, count(*) AS n FROM orders GROUP BY ALL",
    "e01_periods": """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, 1998 - year(o_orderdate) AS y, (1998 - year(o_orderdate)) * 12 + 8 - month(o_orderdate) AS m FROM orders)
        SELECT 'Q' || quarter(d) || ' ' || year(d) || ' (' || CASE WHEN m <= 0 THEN 'current period' WHEN y = 0 THEN CASE WHEN m = 1 THEN '1 month ago' ELSE m || ' months ago' END WHEN y = 1 THEN 'prior year' ELSE y || ' years ago' END || ')' AS period, count(*) AS n FROM o GROUP BY ALL""",
    "h04_flatten": "WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS path FROM events) SELECT event_id, path, json_extract_string(props, '$.' || path) AS leaf FROM k",
    "j05_orphans": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "j12_completeness": "SELECT doc_id AS key, 'missing' AS issue FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT DISTINCT doc_id, 'unexpected' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "g15_report": "SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY GROUPING SETS ((lang), (source), ())",
    "g26_inventory": "SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, year(o_orderdate))",
    "x17_release_gate": f"WITH s AS (SELECT doc_id, text, {_scrub_sql('text')} AS m FROM documents), src AS (SELECT doc_id, m AS text FROM s), {_SCAN}, k AS (SELECT avg({_kept('[\\p{L}\\p{N}_]+')}) AS kept, count(*) AS n FROM s), c AS (SELECT (SELECT count(*) FROM found) = 0 AS passed, true AS blocking UNION ALL SELECT kept > 0.9, false FROM k UNION ALL SELECT n > 0, true FROM k), x AS (SELECT count(*) AS conditions, count(*) FILTER (WHERE NOT passed AND blocking) AS blocking_failures, count(*) FILTER (WHERE NOT passed AND NOT blocking) AS warnings FROM c) SELECT *, CASE WHEN blocking_failures > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'REVIEW_REQUIRED' ELSE 'PASS' END AS decision FROM x",
    "r17_first_turns": "SELECT conv_id, role, min(turn) AS first_turn, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY ALL",
}
QUERIES = {f.__name__: f for f in (t22_strip_html, t29_token_counts, g19_document_frequency, x12_rare_phrases, x13_bm25, d09_identity_scan, d11_identifier_scan, t04_masking, t15_scrub, t19_event_categories, t23_sections, t27_chunks, r13_deduplicate, g13_retention, p03_pseudonymise, p21_capped, w23_pseudonyms, m02_histogram_cosine, m04_size_bins, e01_periods, h04_flatten, j05_orphans, j12_completeness, g15_report, g26_inventory, x17_release_gate, r17_first_turns)}
