"""Queries over released features, discovery and the quality of texts, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup
from ..operators import discovery, masking, quality, sequences, validation, variants
from ..sources.bars import bars, grouped, table
from .documents import docs
from .series import BARS, LONG, SOURCE, W, features

#: Fixed values of the queries: words that are no names.
SAFE = ("The", "In", "This", "We", "And")
REGISTRY = [
    masking.Alias("a1", "MIT License", "[LICENSE 01]", 30), masking.Alias("a2", "License", "[LICENSE 02]", 10, mutations=("possessive",)), masking.Alias("a3", "apache", "[ORG 01]", 20, "case_insensitive", "company"),
    masking.Alias("a4", "example.com", "[DOMAIN 01]", 40, "domain_full"), masking.Alias("a5", "example.com", "[MAIL 01]", 60, "domain_email"),
]


def x06_s3c_blocks(spark, sf_dir):
    return variants.s3c_blocks(bars(spark, sf_dir))


def a01_warped_distance(spark, sf_dir):
    """Warped distance of each entity's weekly closes, as multiples of the first, from the source's."""
    weeks = grouped(bars(spark, sf_dir), 5, 3).select("entity_id", "bar_idx", "close")
    path = F.array_sort(F.collect_list(F.struct("bar_idx", "close"))).getField("close")
    rows = weeks.groupBy("entity_id").agg(path.alias("p")).select("entity_id", F.transform("p", lambda x: x / F.get("p", F.lit(0))).alias("path"))
    own = rows.filter(F.col("entity_id") == SOURCE).select(F.col("path").alias("own"))
    return rows.join(F.broadcast(own)).select("entity_id", F.round(sequences.dtw("own", "path"), 6).alias("distance"))  # own is one row


def a05_transition_similarity(spark, sf_dir):
    rows = sequences.sequences(features(spark, sf_dir))
    own = rows.filter(F.col("entity_id") == SOURCE).select("feature", F.col("states").alias("own"))
    both = rows.join(own, "feature")
    return both.select("entity_id", "feature", F.round(sequences.transition(F.col("own"), F.col("states")), 6).alias("similarity"), F.round(sequences.jaccard(F.col("own"), F.col("states")), 6).alias("jaccard"))


def x10_attack_suite(spark, sf_dir):
    return sequences.attack_suite(features(spark, sf_dir), SOURCE)


def x10_block_attack_suite(spark, sf_dir):
    """The same attacks on the block features."""
    from ..operators.attacks import long_features

    return sequences.attack_suite(long_features(variants.s3c_blocks(bars(spark, sf_dir)), "relative_block"), SOURCE)


def g12_feature_utility(spark, sf_dir):
    """Features of the bars against features of the same bars with closes off by a hundredth on every third day."""
    rows = bars(spark, sf_dir)
    off = rows.withColumn("close", F.when(F.col("bar_idx") % 3 == 0, F.col("close") * 1.01).otherwise(F.col("close")))
    return validation.feature_utility(variants.s3b_weekly(rows), variants.s3b_weekly(off), "relative_week")


def p06_feature_faults(spark, sf_dir):
    """What is wrong with the control series as a release."""
    return validation.feature_faults(variants.s0_control(bars(spark, sf_dir)).withColumn("close_rebased", F.round("close_rebased", 6)), "day_index")


def p08_universe_faults(spark, sf_dir):
    return validation.universe_faults(bars(spark, sf_dir), SOURCE, 2000)


def p09_submission_faults(spark, sf_dir):
    """Customers' orders as submissions: days as periods, finished or not as actions, balances as returns to trade on."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("submission_id"), F.col("o_orderkey").alias("pos"), F.unix_date(F.to_date("o_orderdate")).alias("period"), F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).otherwise(2).alias("action"))
    return validation.submission_faults(orders, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("submission_id"), F.lit(14).alias("periods")))


def x24_review_state(spark, sf_dir):
    """Orders as a log of decisions on customers."""
    rows = table(spark, sf_dir, "orders")
    decision = F.when(F.col("o_orderstatus") == "F", "accept").when(F.col("o_orderstatus") == "O", "defer").otherwise("unknown")
    return discovery.review_state(rows.select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("candidate_id"), decision.alias("decision"), F.when(F.col("o_orderkey") % 2 == 0, "seen").alias("reason"), F.col("o_orderpriority").alias("kind"), F.col("o_orderkey").cast("string").alias("value")))


def d01_discovery(spark, sf_dir):
    """How many residual identifiers of each kind a document holds, and how many characters they take."""
    found = discovery.discovered(docs(spark, sf_dir), SAFE)
    return found.groupBy("doc_id", "kind").agg(F.count("*").alias("n"), F.sum(F.length("found")).alias("chars"))


def t07_registry_masking(spark, sf_dir):
    """Documents masked by a registry: what each form of an alias took, and the hash of what is left."""
    out = masking.mask_documents(docs(spark, sf_dir), REGISTRY)
    return out.select("doc_id", F.sha2("masked", 256).alias("sha"), F.size("spans").alias("accepted"), "rejected", F.array_join(F.array_sort(F.array_distinct(F.transform("spans", lambda s: F.concat_ws("/", s["alias_id"], s["form"])))), ",").alias("forms"))


def g22_recognition(spark, sf_dir):
    """E-mail addresses and links as expected, against the same with links cut by a character."""
    found = discovery.discovered(docs(spark, sf_dir), SAFE).filter("kind in ('email', 'url')").select("doc_id", "start", "end", "kind")
    return discovery.recognised(found, found.withColumn("end", F.when(F.col("kind") == "url", F.col("end") - 1).otherwise(F.col("end"))))


def p17_rejection(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", quality.rejection(F.col("text")).alias("reason"))


def t31_summary(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.sha2(quality.summary(F.col("text")), 256).alias("sha"))


def t19_event_types(spark, sf_dir):
    text = F.col("text")
    return docs(spark, sf_dir).groupBy(quality.event_type(text).alias("event"), quality.event_category(text).alias("category"), quality.topic(text).alias("topic")).agg(F.count("*").alias("n"))


def m05_numbers(spark, sf_dir):
    """How many amounts of each order of magnitude the texts hold."""
    rows = docs(spark, sf_dir).select(F.explode(quality.numbers(F.col("text"))).alias("v"))
    return rows.groupBy(F.least(F.lit(99), F.floor(F.log10("v")).cast("int")).alias("decade")).agg(F.count("*").alias("n"), F.max("v").alias("largest"))


def m06_risk(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.initcap("p_name").alias("value"), (F.col("p_size") / 50).alias("confidence"))
    score = quality.risk(F.col("value"), F.col("confidence"), F.lit(1), F.col("p_partkey") % 10, F.col("p_partkey") % 2 == 0, F.lit(False))
    return rows.select("p_partkey", score.alias("score"), quality.band(score).alias("band"))


def t30_cased_phrases(spark, sf_dir):
    """Distinctive phrases of each title: lower-cased runs of 3 to 7 words with a capital, in benchmark items."""
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.explode(quality.cased_grams(F.col("text"))).alias("phrase"))
    return rows.groupBy("phrase").agg(F.count_distinct("item_id").alias("items"), F.count("*").alias("n"))


def t21_markdown(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.markdown("html").alias("text"))


def t23_item_sections(spark, sf_dir):
    """Items of the pages as Markdown."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.inline(markup.item_sections(markup.markdown("html"))))
    return rows.select("page_id", "item", "title", "start_line", "end_line", F.length("content").alias("chars"))


def t28_paragraph_chunks(spark, sf_dir):
    chunked = markup.paragraph_chunker(2000, 200)
    return docs(spark, sf_dir).select("doc_id", F.inline(chunked("text"))).select("doc_id", "chunk", F.length("text").alias("chars"), F.sha2("text", 256).alias("sha"))


def _edges(value: str, rule: str, n: int) -> str:
    x = f"list_sort(list({value}) FILTER (WHERE {rule} AND {value} IS NOT NULL))"
    return "[" + ", ".join(f"{x}[CASE WHEN len({x}) * {i} // {n} > 0 THEN len({x}) * {i} // {n} ELSE len({x}) END]" for i in range(1, n + 1)) + "]"


def _three(v: str) -> str:
    return f"CASE WHEN {v} <= e_{v}[1] THEN 'LOW' WHEN {v} <= e_{v}[2] THEN 'MEDIUM' ELSE 'HIGH' END"


_FIVE = "CASE WHEN m <= coalesce(e_m[1], 0.0) THEN 'VERY_LOW' WHEN m <= e_m[2] THEN 'LOW' WHEN m <= e_m[3] THEN 'MEDIUM' WHEN m <= e_m[4] THEN 'HIGH' ELSE 'VERY_HIGH' END"
_LOG = "CASE WHEN lag(close) OVER w IS NULL THEN NULL WHEN lag(close) OVER w > 0 AND close > 0 THEN ln(close / lag(close) OVER w) ELSE 0.0 END"
_BLOCK = "WINDOW w AS (PARTITION BY entity_id, g ORDER BY bar_idx)"
_TAX = "regexp_matches({}, '(?i)\\b(?:us-gaap|xbrli|iso4217|utr|srt):|TICKER_[A-Z0-9_]+Member')"


def _rejection(text: str) -> str:
    one = f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"
    lines = f"string_split_regex({text}, '\\r\\n|\\n|\\r')"
    noise = f"len(list_filter({lines}, lambda l: {_TAX.format('l')}))"
    count = f"CASE WHEN {text} = '' THEN 0 ELSE len(string_split_regex(regexp_replace({text}, '(?:\\r\\n|\\n|\\r)$', ''), '\\r\\n|\\n|\\r')) END"
    return f"""CASE WHEN length(regexp_replace({one}, '[^A-Za-z]', '', 'g')) < 500 THEN 'fewer than 500 meaningful characters' WHEN len(regexp_extract_all({one}, '[A-Z][^.!?]{{25,}}[.!?]')) < 5 THEN 'fewer than 5 usable sentences'
        WHEN {noise} >= 3 OR {noise} > greatest(1, ({count}) // 6) THEN 'taxonomy or XBRL noise' WHEN regexp_replace({one}, '{quality.HEADING}', '', 'g') = '' THEN 'heading-only section' END"""


def _case(rules, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {rule} THEN '{name}'" for name, rule in rules) + f" ELSE '{otherwise}' END"


_DETECT = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, trim(unnest(regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}'))) AS found FROM documents" for k, p, _ in discovery.DETECTORS)
_SAFE = "[" + ", ".join(f"'{w.upper()}'" for w in SAFE) + "]"
_EVENT = _case([(n, f"regexp_matches(text, '(?i)\\b(?:{w})\\b')") for n, w in quality.EVENTS], "general_corporate")
_CATEGORY = _case([(c, f"contains(lower(regexp_replace(text, '\\s+', ' ', 'g')), '{k}')") for k, c in quality.CATEGORIES], "general current-report disclosure")
_TOPIC = _case([("earnings", "contains(lower(text), 'earn')"), ("market_performance", "contains(lower(text), 'stock') OR contains(lower(text), 'share')")], "corporate_update")

SQL = {
    "x06_s3c_blocks": BARS + f"""r AS (SELECT *, bar_idx // 20 AS g FROM bars QUALIFY max(bar_idx) OVER (PARTITION BY entity_id) >= 19),
        m AS (SELECT *, {_LOG} AS move, CASE WHEN max(close) OVER w > 0 THEN (close - max(close) OVER w) / max(close) OVER w ELSE 0.0 END AS dd FROM r {_BLOCK}),
        t AS (SELECT *, sign(move) <> lag(sign(move)) OVER w AS turned FROM m {_BLOCK}),
        b AS (SELECT entity_id, g, max_by(close, bar_idx) AS close, avg(volume) AS volume, coalesce(stddev_pop(move), 0.0) AS vol, min(dd) AS dd, count(move) AS moves, count(*) FILTER (WHERE move > 0) AS up, count(*) FILTER (WHERE move < 0) AS down, (count(*) FILTER (WHERE turned)) / greatest(1, count(move)) AS flips FROM t GROUP BY ALL HAVING count(*) >= 10),
        n AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY g) - 1 AS bar_idx FROM b), q AS (SELECT *, {_LOG} AS ret FROM n {W}),
        x AS (SELECT *, coalesce(ret - avg(ret) OVER (PARTITION BY entity_id), 0.0) AS excess, coalesce(ret, 0.0) AS m FROM q),
        e AS (SELECT entity_id, {", ".join(f"{_edges(v, 'bar_idx < 13', 3)} AS e_{v}" for v in ("vol", "volume", "dd", "excess", "flips"))}, {_edges('ret', 'bar_idx <= 13', 5)} AS e_m FROM x GROUP BY entity_id)
        SELECT entity_id, bar_idx AS relative_block, CASE WHEN up > 0.6 * moves THEN 'STRONG_UP' WHEN down > 0.6 * moves THEN 'STRONG_DOWN' WHEN up > down THEN 'MILD_UP' WHEN down > up THEN 'MILD_DOWN' ELSE 'NEUTRAL' END AS dominant_trend_regime,
            {_FIVE} AS aggregate_momentum_bucket, {_three('vol')} AS volatility_regime, {_three('volume')} AS volume_regime, {_three('dd')} AS drawdown_regime, {_three('excess')} AS market_relative_regime, {_three('flips')} AS trend_consistency_bucket, 'MEDIUM' AS sector_relative_regime, {_three('flips')} AS reversal_frequency_bucket
        FROM x JOIN e USING (entity_id)""",
    "a05_transition_similarity": LONG + """, mv AS (SELECT entity_id, feature, lag(state) OVER (PARTITION BY entity_id, feature ORDER BY relative_week) AS a, state AS b FROM feats), c AS (SELECT entity_id, feature, a, b, count(*) AS n FROM mv WHERE a IS NOT NULL GROUP BY ALL),
        sh AS (SELECT *, n / sum(n) OVER (PARTITION BY entity_id, feature, a) AS p FROM c), ks AS (SELECT DISTINCT entity_id, feature FROM feats),
        al AS (SELECT entity_id, feature, a, b, p, 0.0 AS q FROM sh UNION ALL SELECT ks.entity_id, feature, a, b, 0.0, p FROM ks JOIN (SELECT feature, a, b, p FROM sh WHERE entity_id = 1) USING (feature)),
        df AS (SELECT entity_id, feature, a, b, sum(p) - sum(q) AS d FROM al GROUP BY ALL), nm AS (SELECT entity_id, feature, sum(d * d) AS f FROM df GROUP BY ALL),
        st AS (SELECT DISTINCT entity_id, feature, state FROM feats), so AS (SELECT feature, state FROM st WHERE entity_id = 1),
        un AS (SELECT entity_id, feature, count(*) AS n, count(*) FILTER (WHERE k = 2) AS shared FROM (SELECT entity_id, feature, state, count(*) AS k FROM (SELECT * FROM st UNION ALL SELECT ks.entity_id, feature, state FROM ks JOIN so USING (feature)) GROUP BY ALL) GROUP BY ALL)
        SELECT entity_id, feature, round(1 - least(1.0, f / n), 6) AS similarity, round(shared / n, 6) AS jaccard FROM nm JOIN un USING (entity_id, feature) WHERE feature IN (SELECT feature FROM so)""",
    "p06_feature_faults": BARS + f"c AS (SELECT entity_id, bar_idx AS period, round(close * (CASE WHEN first(close) OVER w > 0 THEN 100.0 / first(close) OVER w ELSE 1.0 END), 6) AS v FROM bars {W}) SELECT entity_id, period, 'continuous value' AS fault, 'close_rebased' AS detail FROM c WHERE v > 1e10 OR v <> floor(v) UNION ALL SELECT NULL, NULL, 'forbidden name', 'close_rebased'",
    "p08_universe_faults": BARS + "x AS (SELECT 1) SELECT entity_id, 'too few observations' AS fault FROM bars GROUP BY entity_id HAVING count(*) < 2000 UNION ALL SELECT entity_id, 'negative price' FROM bars GROUP BY entity_id HAVING min(close) < 0",
    "p09_submission_faults": """WITH r AS (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS d, lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before, o_orderstatus AS s FROM orders), f AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE s NOT IN ('F', 'O')) AS odd, count(*) FILTER (WHERE d <= before) AS late FROM r GROUP BY id),
        b AS (SELECT coalesce(c_custkey, id) AS submission_id, c_custkey, f.* FROM customer FULL JOIN f ON c_custkey = id), l AS (SELECT submission_id, unnest([CASE WHEN n IS NULL THEN 'no periods' END, CASE WHEN c_custkey IS NULL THEN 'unknown submission' END, CASE WHEN c_custkey IS NOT NULL AND n > 14 THEN 'more periods than returns' END, CASE WHEN odd > 0 THEN 'invalid action' END, CASE WHEN late > 0 THEN 'periods do not increase' END]) AS fault FROM b) SELECT * FROM l WHERE fault IS NOT NULL""",
    "x24_review_state": """WITH l AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN o_orderkey % 2 = 0 WHEN 'O' THEN true ELSE false END AS ok FROM orders), g AS (SELECT o_custkey AS candidate_id, max_by(o_orderstatus, o_orderkey) FILTER (WHERE ok) AS s, max_by(o_orderpriority, o_orderkey) FILTER (WHERE ok) AS kind, CAST(max(o_orderkey) FILTER (WHERE ok) AS VARCHAR) AS value, count(*) FILTER (WHERE NOT ok) AS refused FROM l GROUP BY ALL)
        SELECT candidate_id, CASE s WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'deferred' ELSE 'pending' END AS status, kind, value, refused FROM g""",
    "d01_discovery": f"WITH f AS ({_DETECT}), w AS (SELECT *, string_split_regex(upper(replace(found, '''', '')), '\\s+') AS u FROM f), k AS (SELECT * FROM w WHERE NOT CASE kind WHEN 'capitalized_phrase' THEN length(found) <= 3 OR regexp_matches(found, '(?i)^(?:Item|Part)\\s+\\d+[A-Z]?\\.?\\s*') OR list_contains({_SAFE}, u[1]) OR regexp_matches(found, '^[A-Z][a-z]+ \\d{{3}}\\b') WHEN 'ticker_pattern' THEN regexp_replace(found, '[()]', '', 'g') IN ('NYSE', 'NASDAQ', 'AMEX', 'ARCA') ELSE false END) SELECT doc_id, kind, count(*) AS n, CAST(sum(length(found)) AS BIGINT) AS chars FROM k GROUP BY ALL",
    "p17_rejection": f"SELECT doc_id, {_rejection('text')} AS reason FROM documents",
    "t31_summary": f"""WITH s AS (SELECT doc_id, text, list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(text, '[ \\t]+', ' ', 'g')), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) > 35 AND NOT {_TAX.format('x')}) AS l FROM documents),
        o AS (SELECT doc_id, text, trim(substring(array_to_string(l[1:8], ' '), 1, 2200)) AS out FROM s) SELECT doc_id, CASE WHEN ({_rejection('text')}) IS NULL AND ({_rejection('out')}) IS NULL THEN sha256(out) END AS sha FROM o""",
    "t19_event_types": f"SELECT {_EVENT} AS event, {_CATEGORY} AS category, {_TOPIC} AS topic, count(*) AS n FROM documents GROUP BY ALL",
    "m06_risk": f"""WITH v AS (SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS value, p_size / 50 AS confidence FROM part), u AS (SELECT *, upper(value) AS u FROM v),
        s AS (SELECT p_partkey, confidence * 0.4 + least((p_partkey % 10) * 0.02, 0.15) + CASE WHEN p_partkey % 2 = 0 THEN 0.1 ELSE 0.0 END + CASE WHEN (length(u) <= 5 AND regexp_matches(u, '[A-Z]') AND regexp_matches(u, '[^A-Z]')) OR regexp_matches(u, '\\.(COM|ORG|NET)$') THEN 0.15 ELSE 0.0 END
            + CASE WHEN regexp_matches(' ' || u || ' ', '{"|".join(quality.LEGAL_SUFFIXES)}') THEN 0.1 ELSE 0.0 END + CASE WHEN regexp_matches(value, '^\\p{{Lu}}') AND regexp_matches(value, '\\p{{Ll}}') THEN 0.1 ELSE 0.0 END AS x FROM u),
        r AS (SELECT p_partkey, round_even(greatest(0.0, least(1.0, x)), 3) AS score FROM s) SELECT p_partkey, score, CASE WHEN score >= 0.75 THEN 'CRITICAL' WHEN score >= 0.55 THEN 'HIGH' WHEN score >= 0.35 THEN 'MEDIUM' ELSE 'LOW' END AS band FROM r""",
    "m05_numbers": f"""WITH m AS (SELECT unnest(regexp_extract_all(text, '{quality.NUMBER}')) AS t FROM documents), p AS (SELECT TRY_CAST(replace(regexp_extract(t, '{quality.NUMBER}', 1), ',', '') AS DOUBLE) AS v, lower(regexp_extract(t, '{quality.NUMBER}', 2)) AS s FROM m),
        x AS (SELECT v * CASE WHEN s = 'k' THEN 1e3 WHEN s IN ('m', 'million') THEN 1e6 WHEN s IN ('b', 'billion') THEN 1e9 ELSE 1.0 END AS v FROM p) SELECT least(99, CAST(floor(log10(v)) AS INTEGER)) AS decade, count(*) AS n, max(v) AS largest FROM x WHERE v >= 1 GROUP BY ALL""",
    "t30_cased_phrases": "WITH w AS (SELECT item_id, regexp_extract_all(text, '[\\p{L}\\p{N}_]+') AS t FROM benchmark), n AS (SELECT item_id, t, unnest(range(3, 8)) AS k FROM w), g AS (SELECT item_id, unnest(list_transform(range(1, len(t) - k + 2), lambda i: t[i:i + k - 1])) AS r FROM n WHERE len(t) >= k), c AS (SELECT item_id, lower(array_to_string(r, ' ')) AS phrase FROM g WHERE len(list_filter(r, lambda x: regexp_matches(x, '^\\p{Lu}'))) > 0) SELECT phrase, count(DISTINCT item_id) AS items, count(*) AS n FROM c GROUP BY ALL",
}
QUERIES = {f.__name__: f for f in (x06_s3c_blocks, a01_warped_distance, a05_transition_similarity, x10_attack_suite, x10_block_attack_suite, g12_feature_utility, p06_feature_faults, p08_universe_faults, p09_submission_faults, x24_review_state, d01_discovery, t07_registry_masking, g22_recognition, p17_rejection, t31_summary, t19_event_types, m05_numbers, m06_risk, t30_cased_phrases, t21_markdown, t23_item_sections, t28_paragraph_chunks)}
