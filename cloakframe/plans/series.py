"""Queries over price series, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import series as s
from ..operators import attacks, governance, sequences, utility, variants
from ..sources.bars import bars, grouped, table

SOURCE = 1  # the entity that attacks look for


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select("entity_id", "bar_idx", s.log_return().alias("ret")).filter("ret is not null")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source close and the open as its masked twin, with both log returns."""
    return bars(spark, sf_dir).select("entity_id", "bar_idx", F.col("close").alias("a"), F.col("open").alias("b"), F.coalesce(s.log_return("close"), F.lit(0.0)).alias("ra"), F.coalesce(s.log_return("open"), F.lit(0.0)).alias("rb"))


def w01_log_returns(spark, sf_dir):
    return returns(spark, sf_dir).select("entity_id", "bar_idx", F.round("ret", 6).alias("ret"))


def g01_weekly_bars(spark, sf_dir):
    return grouped(bars(spark, sf_dir), 5, 3)


def g02_blocks(spark, sf_dir):
    """20-bar blocks with 10 bars at least: mean volume, return deviation, worst drawdown, share of up moves."""
    rows = bars(spark, sf_dir).select("entity_id", "bar_idx", "volume", "close", s.log_return().alias("ret"), F.floor(F.col("bar_idx") / 20).alias("block"))
    peak = F.max("close").over(Window.partitionBy("entity_id", "block").orderBy("bar_idx"))
    rows = rows.withColumn("dd", (F.col("close") - peak) / peak)
    out = rows.groupBy("entity_id", "block").agg(
        F.count("*").alias("n"), F.round(F.avg("volume"), 6).alias("mean_volume"), F.round(F.coalesce(F.stddev_pop("ret"), F.lit(0.0)), 6).alias("deviation"), F.round(F.min("dd"), 6).alias("max_drawdown"),
        F.count_if(F.col("ret") > 0).alias("ups"), F.count_if(F.col("ret") < 0).alias("downs"),
    )
    strong = F.when(F.col("ups") > 0.6 * F.col("n"), "STRONG_UP").when(F.col("downs") > 0.6 * F.col("n"), "STRONG_DOWN")
    return out.filter("n >= 10").withColumn("trend", strong.when(F.col("ups") > F.col("downs"), "MILD_UP").when(F.col("ups") < F.col("downs"), "MILD_DOWN").otherwise("NEUTRAL"))


def x01_s0_control(spark, sf_dir):
    out = variants.s0_control(bars(spark, sf_dir))
    return out.withColumn("close_rebased", F.round("close_rebased", 6))


def x02_s1_basic(spark, sf_dir):
    out = variants.s1_basic(bars(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("open", "high", "low", "close", "volume_percentile")})


def x03_s2_residual(spark, sf_dir):
    """The pseudo-price as its logarithm against the base (prices themselves run over many magnitudes), the others by their ratio to it."""
    out = variants.s2_residual(bars(spark, sf_dir), sectors=sectors(spark, sf_dir))
    value = F.round(F.ln(F.col("pseudo_close") / 100), 6)
    ratios = [F.round(F.col(f"pseudo_{c}") / F.col("pseudo_close"), 6).alias(f"{c}_ratio") for c in ("open", "high", "low")]
    # no negative zero
    return out.select("entity_id", "day_index", F.when(value == 0, F.lit(0.0)).otherwise(value).alias("log_price"), *ratios, F.round("volume_percentile", 6).alias("volume_percentile"))


def sectors(spark, sf_dir):
    """A nation's region is its sector."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("entity_id"), F.col("n_regionkey").alias("sector"))


def x04_s3a_daily(spark, sf_dir):
    return variants.s3a_daily(bars(spark, sf_dir), sectors=sectors(spark, sf_dir))


def weekly(spark, sf_dir):
    return variants.s3b_weekly(bars(spark, sf_dir), sectors=sectors(spark, sf_dir))


def x05_s3b_weekly(spark, sf_dir):
    return weekly(spark, sf_dir)


def x05_s3b_fundamentals(spark, sf_dir):
    """Buckets by week with fundamentals made from the suppliers' balances."""
    mean = F.avg("s_acctbal")
    metrics = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").cast("long").alias("entity_id")).agg((mean / 250).alias("pe"), (mean / 50_000).alias("roe"), F.when(F.count("*") % 2 == 0, mean / 5_000).alias("debt_equity"))
    out = variants.with_fundamentals(weekly(spark, sf_dir), metrics)
    return out.select("entity_id", "relative_week", *[n for n, *_ in variants.FUNDAMENTALS])


def features(spark, sf_dir):
    return attacks.long_features(weekly(spark, sf_dir), "relative_week")


def x07_universe_rank(spark, sf_dir):
    return attacks.universe_rank(returns(spark, sf_dir), SOURCE)


def x08_structured_attacks(spark, sf_dir):
    return attacks.structured_attacks(pairs(spark, sf_dir))


def x08_ranked_attacks(spark, sf_dir):
    """The suite with the ranks of the sources of the masked series (the opens) among all closes."""
    rows = pairs(spark, sf_dir)
    side = lambda c: rows.filter("bar_idx > 0").select("entity_id", "bar_idx", F.col(c).alias("ret"))
    return attacks.structured_attacks(rows, attacks.masked_ranks(side("rb"), side("ra"))).select("entity_id", "direct", "rank", "blocked")


def a04_weighted_hamming(spark, sf_dir):
    rows = sequences.sequences(features(spark, sf_dir))
    own = rows.filter(F.col("entity_id") == SOURCE).select("feature", F.col("states").alias("own"))
    return rows.join(own, "feature").select("entity_id", "feature", F.round(sequences.hamming(F.col("own"), F.col("states"), {"UP": 2.0, "LOW": 0.5}), 6).alias("distance"))


def a03_categorical_scores(spark, sf_dir):
    out = attacks.categorical_scores(features(spark, sf_dir), SOURCE)
    return out.select("entity_id", "feature", F.round("exact", 6).alias("exact"), F.round("hamming", 6).alias("hamming"), "n")


def x09_categorical_rank(spark, sf_dir):
    return attacks.categorical_rank(features(spark, sf_dir), SOURCE)


def a06_ngram_jaccard(spark, sf_dir):
    return attacks.ngram_jaccard(features(spark, sf_dir), SOURCE)


def g21_transitions(spark, sf_dir):
    return attacks.transitions(features(spark, sf_dir))


def x18_privacy_gate(spark, sf_dir):
    return governance.privacy_gate(attacks.categorical_rank(features(spark, sf_dir), SOURCE), SOURCE)


def g11_structured_utility(spark, sf_dir):
    return utility.structured_utility(pairs(spark, sf_dir))


def g27_backtest(spark, sf_dir):
    """Buys when the last return was up."""
    rows = bars(spark, sf_dir).select("entity_id", "bar_idx", F.coalesce(s.log_return(), F.lit(0.0)).alias("ret"))
    return utility.backtest(rows.withColumn("action", (F.col("ret") > 0).cast("int")))


def p01_bar_faults(spark, sf_dir):
    """Whole bars have none; the check is run on bars whose close was raised by a tenth."""
    return governance.bar_faults(bars(spark, sf_dir).withColumn("close", F.col("close") * 1.1))


BARS = """WITH daily AS (
    SELECT CAST(s_nationkey AS BIGINT) AS entity_id, CAST(l_shipdate AS DATE) AS day,
           min_by(l_extendedprice, l_orderkey * 10 + l_linenumber + l_extendedprice / 1e7) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
           max_by(l_extendedprice, l_orderkey * 10 + l_linenumber + l_extendedprice / 1e7) AS close, sum(l_quantity) AS volume
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
bars AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY day) - 1 AS bar_idx FROM daily),
"""
RET = "CASE WHEN lag(close) OVER w IS NULL THEN NULL WHEN lag(close) OVER w > 0 AND close > 0 THEN ln(close / lag(close) OVER w) ELSE 0.0 END"
RETURNS = BARS + f"rets AS (SELECT entity_id, bar_idx, {RET} AS ret FROM bars WINDOW w AS (PARTITION BY entity_id ORDER BY bar_idx)),\n"
WEEKS = """groups AS (
    SELECT entity_id, bar_idx // 5 AS g, min_by(open, bar_idx) AS open, max(high) AS high, min(low) AS low, max_by(close, bar_idx) AS close, sum(volume) AS volume, count(*) AS n
    FROM bars GROUP BY ALL HAVING count(*) >= 3),
weeks AS (SELECT entity_id, open, high, low, close, volume, row_number() OVER (PARTITION BY entity_id ORDER BY g) - 1 AS bar_idx FROM groups),
"""


def _momentum(k: int) -> str:
    return f"coalesce(CASE WHEN lag(close, {k}) OVER w > 0 THEN (close - lag(close, {k}) OVER w) / lag(close, {k}) OVER w END, 0.0)"


def _edges(value: str, fit: int, name: str) -> str:
    k = ", ".join(f"x[CASE WHEN len(x) * {i} // 5 > 0 THEN len(x) * {i} // 5 ELSE len(x) END]" for i in range(1, 6))
    return f"(SELECT [{k}] FROM (SELECT list_sort(list({value}) FILTER (WHERE bar_idx < {fit} AND {value} IS NOT NULL)) AS x)) AS {name}"


def _bucket(value: str, edges: str) -> str:
    return f"CASE WHEN {value} <= {edges}[1] THEN 'VERY_LOW' WHEN {value} <= {edges}[2] THEN 'LOW' WHEN {value} <= {edges}[3] THEN 'MEDIUM' WHEN {value} <= {edges}[4] THEN 'HIGH' ELSE 'VERY_HIGH' END"


def _bounds(source: str, fit: int, values: list[str]) -> str:
    sorted_ = ", ".join(f"list_sort(list({v}) FILTER (WHERE bar_idx < {fit} AND {v} IS NOT NULL)) AS s_{v}" for v in values)
    edge = ", ".join("[" + ", ".join(f"s_{v}[CASE WHEN len(s_{v}) * {i} // 5 > 0 THEN len(s_{v}) * {i} // 5 ELSE len(s_{v}) END]" for i in range(1, 6)) + f"] AS e_{v}" for v in values)
    return f"sorted AS (SELECT entity_id, {sorted_} FROM {source} GROUP BY entity_id), bounds AS (SELECT entity_id, {edge} FROM sorted)"


def _references(source: str) -> str:
    """refs: the returns of a CTE (entity_id, bar_idx, ret) with the means of all and of the region's nations."""
    return f"""r AS (SELECT x.entity_id, x.bar_idx, x.ret, n_regionkey AS region FROM {source} x JOIN nation ON n_nationkey = x.entity_id WHERE x.ret IS NOT NULL),
        rm AS (SELECT bar_idx, avg(ret) AS market FROM r GROUP BY ALL), rs AS (SELECT region, bar_idx, avg(ret) AS sector FROM r GROUP BY ALL),
        refs AS (SELECT entity_id, bar_idx, ret, market, sector FROM r JOIN rm USING (bar_idx) JOIN rs USING (region, bar_idx)),
"""


_DD = "CASE WHEN max(close) OVER w > 0 THEN (close - max(close) OVER w) / max(close) OVER w ELSE 0.0 END"
S3B = BARS + WEEKS + f"""w1 AS (SELECT *, {RET} AS own FROM weeks WINDOW w AS (PARTITION BY entity_id ORDER BY bar_idx)),
w2 AS (SELECT *, lead(own) OVER w AS ret, CASE WHEN close > open * 1.005 THEN 'UP' WHEN close < open * 0.995 THEN 'DOWN' ELSE 'FLAT' END AS direction FROM w1 WINDOW w AS (PARTITION BY entity_id ORDER BY bar_idx)),
w3 AS (SELECT *, {_momentum(4)} AS m4, {_momentum(12)} AS m12, {_momentum(26)} AS m26, {_DD} AS dd,
    CASE WHEN ret IS NOT NULL THEN CASE WHEN bar_idx >= 4 THEN stddev_pop(ret) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) ELSE 0.0 END END AS v4,
    CASE WHEN ret IS NOT NULL THEN CASE WHEN bar_idx >= 12 THEN stddev_pop(ret) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) ELSE 0.0 END END AS v12,
    avg(close) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS fast, avg(close) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS slow,
    len(list_filter(list(direction) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), lambda d: d = direction)) AS same
    FROM w2 WINDOW w AS (PARTITION BY entity_id ORDER BY bar_idx)),
{_references('w3')}
w4 AS (SELECT w3.*, coalesce(refs.ret - market, 0.0) AS om, coalesce(refs.ret - sector, 0.0) AS os FROM w3 LEFT JOIN refs USING (entity_id, bar_idx)),
{_bounds('w4', 52, ['m4', 'm12', 'm26', 'v4', 'v12', 'dd', 'om', 'os'])},
s3b AS (SELECT entity_id, bar_idx AS relative_week, direction AS weekly_direction_category, {_bucket('m4', 'e_m4')} AS momentum_4w_bucket, {_bucket('m12', 'e_m12')} AS momentum_12w_bucket, {_bucket('m26', 'e_m26')} AS momentum_26w_bucket,
    CASE WHEN v4 IS NULL THEN 'MEDIUM' ELSE {_bucket('v4', 'e_v4')} END AS volatility_4w_bucket, CASE WHEN v12 IS NULL THEN 'MEDIUM' ELSE {_bucket('v12', 'e_v12')} END AS volatility_12w_bucket,
    'MEDIUM' AS volume_activity_bucket, {_bucket('dd', 'e_dd')} AS drawdown_bucket, {_bucket('om', 'e_om')} AS market_relative_strength_bucket, {_bucket('os', 'e_os')} AS sector_relative_strength_bucket,
    CASE WHEN bar_idx < 4 THEN 'NEUTRAL' WHEN fast > slow * 1.01 THEN 'ABOVE' WHEN fast < slow * 0.99 THEN 'BELOW' ELSE 'NEUTRAL' END AS moving_average_regime,
    CASE WHEN bar_idx < 4 THEN 'SHORT' WHEN same >= 3 THEN 'PERSISTENT' WHEN same >= 2 THEN 'MODERATE' ELSE 'SHORT' END AS trend_persistence_bucket
    FROM w4 JOIN bounds USING (entity_id))"""
LONG = S3B + ", feats AS (UNPIVOT s3b ON COLUMNS(* EXCLUDE (entity_id, relative_week)) INTO NAME feature VALUE state), own AS (SELECT relative_week, feature, state AS own FROM feats WHERE entity_id = 1)"
_ORD = "coalesce(map {%s}[%%s], 1)" % ", ".join(f"'{k}': {v}" for k, v in attacks.ORDINALS.items())
RANK = """, score AS (SELECT entity_id, feature, avg(CASE WHEN state = own THEN 1.0 ELSE 0.0 END) AS exact FROM feats JOIN own USING (relative_week, feature) GROUP BY ALL),
total AS (SELECT entity_id, round(sum(exact * CASE WHEN contains(feature, 'direction') THEN 3.0 ELSE 1.0 END) / greatest(1.0, sum(CASE WHEN contains(feature, 'direction') THEN 3.0 ELSE 1.0 END)), 6) AS score FROM score GROUP BY ALL),
ranked AS (SELECT entity_id, score, CAST(row_number() OVER w AS INTEGER) AS rank, lag(score) OVER w AS up, lead(score) OVER w AS down FROM total WINDOW w AS (ORDER BY score DESC, entity_id))"""
PAIRS = BARS + f"""pairs AS (SELECT entity_id, bar_idx, close AS a, open AS b, coalesce({RET}, 0.0) AS ra, coalesce({RET.replace('close', 'open')}, 0.0) AS rb FROM bars WINDOW w AS (PARTITION BY entity_id ORDER BY bar_idx))"""


def _corr(a: str, b: str) -> str:
    return f"round(coalesce(CASE WHEN isnan(corr({a}, {b})) THEN 0.0 ELSE corr({a}, {b}) END, 0.0), 6)"


W = "WINDOW w AS (PARTITION BY entity_id ORDER BY bar_idx)"
SQL = {
    "w01_log_returns": RETURNS + "x AS (SELECT 1) SELECT entity_id, bar_idx, round(ret, 6) AS ret FROM rets WHERE ret IS NOT NULL",
    "g01_weekly_bars": BARS + WEEKS + "x AS (SELECT 1) SELECT * FROM weeks",
    "g02_blocks": BARS + f"""r AS (SELECT entity_id, bar_idx, volume, close, {RET} AS ret, bar_idx // 20 AS block FROM bars {W}),
        d AS (SELECT *, (close - max(close) OVER b) / max(close) OVER b AS dd FROM r WINDOW b AS (PARTITION BY entity_id, block ORDER BY bar_idx)),
        g AS (SELECT entity_id, block, count(*) AS n, round(avg(volume), 6) AS mean_volume, round(coalesce(stddev_pop(ret), 0.0), 6) AS deviation, round(min(dd), 6) AS max_drawdown,
              count(*) FILTER (WHERE ret > 0) AS ups, count(*) FILTER (WHERE ret < 0) AS downs FROM d GROUP BY ALL HAVING count(*) >= 10)
        SELECT *, CASE WHEN ups > 0.6 * n THEN 'STRONG_UP' WHEN downs > 0.6 * n THEN 'STRONG_DOWN' WHEN ups > downs THEN 'MILD_UP' WHEN ups < downs THEN 'MILD_DOWN' ELSE 'NEUTRAL' END AS trend FROM g""",
    "x01_s0_control": BARS + f"x AS (SELECT 1) SELECT entity_id, bar_idx AS day_index, round(close * (CASE WHEN first(close) OVER w > 0 THEN 100.0 / first(close) OVER w ELSE 1.0 END), 6) AS close_rebased FROM bars {W}",
    "x02_s1_basic": BARS + f"""v AS (SELECT *, list(volume) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS seen, CASE WHEN first(close) OVER w > 0 THEN 100.0 / first(close) OVER w ELSE 1.0 END AS f FROM bars {W})
        SELECT entity_id, bar_idx AS day_index, round(open * f, 6) AS open, round(high * f, 6) AS high, round(low * f, 6) AS low, round(close * f, 6) AS close,
               round(CASE WHEN len(seen) > 1 THEN len(list_filter(seen, lambda x: x < volume)) / len(seen) ELSE 0.5 END, 6) AS volume_percentile FROM v""",
    "x03_s2_residual": RETURNS + _references("rets") + f"""
        model AS (SELECT entity_id, covar_pop(ret, market) FILTER (e) AS y1, covar_pop(ret, sector) FILTER (e) AS y2, var_pop(market) FILTER (e) AS s11, var_pop(sector) FILTER (e) AS s22, covar_pop(market, sector) FILTER (e) AS s12,
            avg(ret) FILTER (e) AS my, avg(market) FILTER (e) AS m1, avg(sector) FILTER (e) AS m2, stddev_pop(ret) AS src, count(*) AS n FROM (SELECT *, bar_idx <= 60 AS e FROM refs) GROUP BY ALL HAVING count(*) >= 60),
        betas AS (SELECT *, s11 * s22 - s12 * s12 AS d FROM model),
        l AS (SELECT refs.entity_id, bar_idx, n, src, ret - (my + (CASE WHEN d <> 0 THEN (y1 * s22 - s12 * y2) / d ELSE coalesce(y1 / nullif(s11, 0), 0.0) END) * (market - m1) + (CASE WHEN d <> 0 THEN (s11 * y2 - s12 * y1) / d ELSE 0.0 END) * (sector - m2)) AS res FROM refs JOIN betas USING (entity_id)),
        s AS (SELECT entity_id, stddev_pop(res) AS sd, list_sort(list(res)) AS x FROM l GROUP BY ALL),
        c AS (SELECT entity_id, bar_idx, greatest(x[1 + CAST(floor(len(x) * 0.025) AS BIGINT)], least(x[1 + least(len(x) - 1, CAST(floor(len(x) * 0.975) AS BIGINT))], res)) * (CASE WHEN sd > 1e-9 * src THEN src / sd ELSE 1.0 END) AS res FROM l JOIN s USING (entity_id)),
        p AS (SELECT b.*, c.res, list(volume) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS seen, round(coalesce(sum(c.res) OVER w, 0), 6) AS lp FROM bars b LEFT JOIN c USING (entity_id, bar_idx) WHERE entity_id IN (SELECT entity_id FROM model) {W})
        SELECT entity_id, bar_idx AS day_index, CASE WHEN lp = 0 THEN CAST(0 AS DOUBLE) ELSE lp END AS log_price,
               CASE WHEN bar_idx = 0 THEN 1.0 ELSE round(open / close, 6) END AS open_ratio, CASE WHEN bar_idx = 0 THEN 1.0 ELSE round(high / close, 6) END AS high_ratio, CASE WHEN bar_idx = 0 THEN 1.0 ELSE round(low / close, 6) END AS low_ratio,
               round(CASE WHEN len(seen) > 1 THEN len(list_filter(seen, lambda x: x < volume)) / len(seen) ELSE 0.5 END, 6) AS volume_percentile FROM p""".replace("FILTER (e)", "FILTER (WHERE e)"),
    "x04_s3a_daily": RETURNS + f"""b AS (SELECT bars.*, r.ret AS own FROM bars JOIN rets r USING (entity_id, bar_idx)), a AS (SELECT *, lead(own) OVER w AS ret, {_momentum(5)} AS m5, {_momentum(21)} AS m21, {_momentum(63)} AS m63, {_DD} AS dd,
            list(volume) OVER (w ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS seen, avg(close) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS fast, avg(close) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS slow FROM b {W}),
        v AS (SELECT *, CASE WHEN bar_idx >= 21 THEN stddev_pop(ret) OVER (w ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING) ELSE 0.0 END AS v21, CASE WHEN len(seen) > 1 THEN len(list_filter(seen, lambda x: x < volume)) / len(seen) ELSE 0.0 END AS vp FROM a {W}),
        k0 AS (SELECT * FROM v WHERE ret IS NOT NULL), {_references('k0')} k AS (SELECT k0.*, refs.ret - market AS om, refs.ret - sector AS os FROM k0 JOIN refs USING (entity_id, bar_idx)), sigma AS (SELECT entity_id, 0.5 * stddev_pop(ret) AS flat FROM k WHERE bar_idx < 252 GROUP BY ALL), {_bounds('k', 252, ['m5', 'm21', 'm63', 'v21', 'dd', 'om', 'os'])}
        SELECT entity_id, bar_idx AS relative_day, CASE WHEN ret > flat THEN 'UP' WHEN ret < -flat THEN 'DOWN' ELSE 'FLAT' END AS return_direction, {_bucket('m5', 'e_m5')} AS momentum_5d_bucket, {_bucket('m21', 'e_m21')} AS momentum_21d_bucket, {_bucket('m63', 'e_m63')} AS momentum_63d_bucket,
               {_bucket('v21', 'e_v21')} AS volatility_21d_bucket, {_bucket('dd', 'e_dd')} AS drawdown_bucket, {_bucket('om', 'e_om')} AS market_relative_bucket, {_bucket('os', 'e_os')} AS sector_relative_bucket, CASE WHEN vp < 0.33 THEN 'LOW' WHEN vp < 0.67 THEN 'MEDIUM' ELSE 'HIGH' END AS volume_activity_21d_bucket,
               CASE WHEN bar_idx < 20 THEN 'NEUTRAL' WHEN fast > slow * 1.01 THEN 'ABOVE' WHEN fast < slow * 0.99 THEN 'BELOW' ELSE 'CROSSED' END AS moving_average_state
        FROM k JOIN bounds USING (entity_id) JOIN sigma USING (entity_id)""",
    "x05_s3b_weekly": S3B + " SELECT * FROM s3b",
    "x05_s3b_fundamentals": S3B + """, f AS (SELECT s_nationkey AS entity_id, avg(s_acctbal) / 250 AS pe, avg(s_acctbal) / 50000 AS roe, CASE WHEN count(*) % 2 = 0 THEN avg(s_acctbal) / 5000 ELSE 1.0 END AS de FROM supplier GROUP BY ALL)
        SELECT entity_id, relative_week, CASE WHEN pe <= 15 THEN 'LOW' WHEN pe <= 20 THEN 'MEDIUM' ELSE 'HIGH' END AS valuation_bucket, CASE WHEN roe <= 0.05 THEN 'LOW' WHEN roe <= 0.1 THEN 'MEDIUM' ELSE 'HIGH' END AS profitability_bucket,
               CASE WHEN de <= 0.5 THEN 'LOW' WHEN de <= 1 THEN 'MEDIUM' ELSE 'HIGH' END AS leverage_bucket FROM s3b JOIN f USING (entity_id)""",
    "x07_universe_rank": RETURNS + f"""r AS (SELECT * FROM rets WHERE ret IS NOT NULL), o AS (SELECT bar_idx, ret AS src FROM r WHERE entity_id = 1),
        c AS (SELECT entity_id, {_corr('ret', 'src')} AS score FROM r JOIN o USING (bar_idx) GROUP BY ALL), k AS (SELECT entity_id, abs(score) AS score FROM c), n AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, entity_id) AS INTEGER) AS rank FROM k)
        SELECT *, entity_id = 1 AND rank <= 10 AS blocked FROM n""",
    "x08_structured_attacks": PAIRS + f""", g AS (SELECT *, lag(rb, 1) OVER w AS b1, lag(rb, 5) OVER w AS b5, lag(rb, 21) OVER w AS b21,
            CASE WHEN bar_idx >= 20 THEN stddev_samp(ra) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) END AS va, CASE WHEN bar_idx >= 20 THEN stddev_samp(rb) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) END AS vb,
            (a - max(a) OVER w) / max(a) OVER w AS da, (b - max(b) OVER w) / max(b) OVER w AS db FROM pairs {W}),
        c AS (SELECT entity_id, {_corr('ra', 'rb')} AS direct, {_corr('ra', 'b1')} AS lag_1, {_corr('ra', 'b5')} AS lag_5, {_corr('ra', 'b21')} AS lag_21, {_corr('va', 'vb')} AS volatility_similarity, {_corr('da', 'db')} AS drawdown_similarity FROM g GROUP BY ALL)
        SELECT *, direct > 0.9 OR greatest(lag_1, lag_5, lag_21) > 0.8 OR volatility_similarity > 0.85 OR drawdown_similarity > 0.85 AS blocked FROM c""",
    "x08_ranked_attacks": PAIRS + f""", r AS (SELECT entity_id, bar_idx, ra, rb FROM pairs WHERE bar_idx > 0), s AS (SELECT m.entity_id, c.entity_id AS candidate, abs({_corr('m.rb', 'c.ra')}) AS score FROM r m JOIN r c USING (bar_idx) GROUP BY ALL),
        o AS (SELECT entity_id, score AS own FROM s WHERE candidate = entity_id), k AS (SELECT entity_id, count(*) FILTER (WHERE score > own OR (score = own AND candidate < entity_id)) + 1 AS rank FROM s JOIN o USING (entity_id) GROUP BY ALL),
        g AS (SELECT *, lag(rb, 1) OVER w AS b1, lag(rb, 5) OVER w AS b5, lag(rb, 21) OVER w AS b21,
            CASE WHEN bar_idx >= 20 THEN stddev_samp(ra) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) END AS va, CASE WHEN bar_idx >= 20 THEN stddev_samp(rb) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) END AS vb,
            (a - max(a) OVER w) / max(a) OVER w AS da, (b - max(b) OVER w) / max(b) OVER w AS db FROM pairs {W}),
        c AS (SELECT entity_id, {_corr('ra', 'rb')} AS direct, {_corr('ra', 'b1')} AS l1, {_corr('ra', 'b5')} AS l5, {_corr('ra', 'b21')} AS l21, {_corr('va', 'vb')} AS v, {_corr('da', 'db')} AS d FROM g GROUP BY ALL)
        SELECT entity_id, direct, rank, direct > 0.9 OR greatest(l1, l5, l21) > 0.8 OR v > 0.85 OR d > 0.85 OR coalesce(rank <= 10, true) AS blocked FROM c LEFT JOIN k USING (entity_id)""",
    "a04_weighted_hamming": LONG + f" SELECT entity_id, feature, round(avg(abs({_ORD % 'state'} - {_ORD % 'own'}) / 4.0 * CASE own WHEN 'UP' THEN 2.0 WHEN 'LOW' THEN 0.5 ELSE 1.0 END), 6) AS distance FROM feats JOIN own USING (relative_week, feature) GROUP BY ALL",
    "a03_categorical_scores": LONG + f" SELECT entity_id, feature, round(avg(CASE WHEN state = own THEN 1.0 ELSE 0.0 END), 6) AS exact, round(1 - avg(abs({_ORD % 'state'} - {_ORD % 'own'}) / 4.0), 6) AS hamming, count(*) AS n FROM feats JOIN own USING (relative_week, feature) GROUP BY ALL",
    "x09_categorical_rank": LONG + RANK + " SELECT entity_id, score, rank, round(coalesce(CASE WHEN rank > 1 THEN up - score ELSE score - down END, 0.0), 6) AS margin FROM ranked",
    "a06_ngram_jaccard": LONG + """, gr AS (SELECT DISTINCT entity_id, feature, g FROM (SELECT entity_id, feature, [state, lead(state) OVER w, lead(state, 2) OVER w] AS g, lead(state, 2) OVER w AS l FROM feats WINDOW w AS (PARTITION BY entity_id, feature ORDER BY relative_week)) WHERE l IS NOT NULL),
        sz AS (SELECT entity_id, feature, count(*) AS n FROM gr GROUP BY ALL), k AS (SELECT gr.entity_id, gr.feature, count(*) AS k FROM gr JOIN gr o ON o.entity_id = 1 AND o.feature = gr.feature AND o.g = gr.g GROUP BY ALL)
        SELECT sz.entity_id, sz.feature, round(coalesce(k, 0) / (sz.n + m.n - coalesce(k, 0)), 6) AS jaccard FROM sz JOIN sz m ON m.entity_id = 1 AND m.feature = sz.feature LEFT JOIN k ON k.entity_id = sz.entity_id AND k.feature = sz.feature""",
    "g21_transitions": LONG + """, mv AS (SELECT entity_id, feature, lag(state) OVER (PARTITION BY entity_id, feature ORDER BY relative_week) AS from_state, state AS to_state FROM feats),
        c AS (SELECT entity_id, feature, from_state, to_state, count(*) AS n FROM mv WHERE from_state IS NOT NULL GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY entity_id, feature, from_state), 6) AS share FROM c""",
    "x18_privacy_gate": LONG + RANK + """, u AS (SELECT count(*) AS universe, max(CASE WHEN entity_id = 1 THEN rank END) AS source_rank FROM ranked)
        SELECT *, CASE WHEN source_rank IS NULL OR universe < 20 OR source_rank <= 10 OR source_rank * 100.0 / universe <= 5.0 THEN 'FAIL' WHEN source_rank * 100.0 / universe <= 1.0 THEN 'REVIEW_REQUIRED' ELSE 'PASS' END AS decision FROM u""",
    "g11_structured_utility": PAIRS + f""", g AS (SELECT *, {_momentum(5).replace('close', 'a')} AS ma, {_momentum(5).replace('close', 'b')} AS mb, (a - max(a) OVER w) / max(a) OVER w AS da, (b - max(b) OVER w) / max(b) OVER w AS db,
            rank() OVER (PARTITION BY entity_id ORDER BY ra) + (count(*) OVER (PARTITION BY entity_id, ra) - 1) / 2 AS kra, rank() OVER (PARTITION BY entity_id ORDER BY rb) + (count(*) OVER (PARTITION BY entity_id, rb) - 1) / 2 AS krb FROM pairs {W}),
        u AS (SELECT entity_id, round(avg(CASE WHEN (ra > 0) = (rb > 0) THEN 1.0 ELSE 0.0 END), 6) AS sign_agreement, {_corr('kra', 'krb')} AS rank_correlation, round(abs(stddev_samp(ra) - stddev_samp(rb)) / stddev_samp(ra), 6) AS volatility_distortion,
              round(avg(CASE WHEN (ma > 0) = (mb > 0) THEN 1.0 ELSE 0.0 END), 6) AS momentum_agreement, round(abs(min(da) - min(db)), 6) AS drawdown_distortion FROM g GROUP BY ALL)
        SELECT *, sign_agreement < 0.60 AS low_sign, volatility_distortion > 0.30 AS high_volatility FROM u""",
    "g27_backtest": BARS + f"""r AS (SELECT entity_id, bar_idx, coalesce({RET}, 0.0) AS ret FROM bars {W}), a AS (SELECT *, coalesce(lag(CASE WHEN ret > 0 THEN 1 ELSE 0 END) OVER w, 0) AS act FROM r {W}),
        t AS (SELECT *, abs(act - coalesce(lag(act) OVER w, 0)) AS turn FROM a {W}), p AS (SELECT *, act * ret - 0.001 * turn AS pnl FROM t), s AS (SELECT *, sum(pnl) OVER w AS cum FROM p {W}), d AS (SELECT *, cum - greatest(0.0, max(cum) OVER w) AS dd FROM s {W})
        SELECT entity_id, round(avg(act), 6) AS trade_rate, round(coalesce(avg(CASE WHEN act = 1 THEN CASE WHEN ret > 0 THEN 1.0 ELSE 0.0 END END), 0.0), 6) AS hit_rate, round(sum(pnl), 6) AS total_return, round(stddev_pop(pnl) * sqrt(252.0), 6) AS volatility,
               round(min(dd), 6) AS max_drawdown, CAST(sum(turn) AS BIGINT) AS turnover, round(sum(ret), 6) AS benchmark FROM d GROUP BY ALL""",
    "p01_bar_faults": BARS + """x AS (SELECT entity_id, bar_idx, open, high, low, close * 1.1 AS close, volume FROM bars), f AS (SELECT entity_id, bar_idx, concat_ws(',', CASE WHEN high < low THEN 'high<low' END, CASE WHEN high < open THEN 'high<open' END, CASE WHEN high < close THEN 'high<close' END, CASE WHEN low > open THEN 'low>open' END, CASE WHEN low > close THEN 'low>close' END, CASE WHEN volume < 0 THEN 'volume<0' END) AS faults FROM x)
        SELECT * FROM f WHERE faults <> ''""",
}
QUERIES = {f.__name__: f for f in (w01_log_returns, g01_weekly_bars, g02_blocks, x01_s0_control, x02_s1_basic, x03_s2_residual, x04_s3a_daily, x05_s3b_weekly, x05_s3b_fundamentals, x07_universe_rank, x08_structured_attacks, x08_ranked_attacks, a04_weighted_hamming, a03_categorical_scores, x09_categorical_rank, a06_ngram_jaccard, g21_transitions, x18_privacy_gate, g11_structured_utility, g27_backtest, p01_bar_faults)}
