"""The price variants S0 to S3C. Each takes bars of many entities and returns one row a bar, week or block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import series as s
from ..sources.bars import grouped


def s0_control(bars: DataFrame) -> DataFrame:
    """Closes rebased to 100. Never releasable."""
    return bars.select("entity_id", F.col("bar_idx").alias("day_index"), s.rebased("close").alias("close_rebased"))


def s1_basic(bars: DataFrame) -> DataFrame:
    """Rebased bars and the rolling volume percentile."""
    return bars.select("entity_id", F.col("bar_idx").alias("day_index"), *[s.rebased(c).alias(c) for c in ("open", "high", "low", "close")], s.volume_percentile(20, 0.5).alias("volume_percentile"))


def with_references(returns: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """Market and sector beside each return: the mean returns at the same place of all entities and of the entity's sector.

    sectors: (entity_id, sector), one row an entity; an entity without a sector, or no sectors at all, has a null there.
    Both means are aggregates of one row a place, so nothing is held by entity."""
    market = returns.groupBy("bar_idx").agg(F.avg("ret").alias("market"))
    if sectors is None:
        return returns.join(market, "bar_idx").withColumn("sector", F.lit(None).cast("double"))
    own = returns.join(sectors.select("entity_id", F.col("sector").alias("_in")), "entity_id", "left")
    sector = own.filter("_in is not null").groupBy("_in", "bar_idx").agg(F.avg("ret").alias("sector"))
    return own.join(market, "bar_idx").join(sector, ["_in", "bar_idx"], "left").drop("_in")


def _coefficients(early: Column) -> list[Column]:
    """Beta of market and sector by centred normal equations over the early rows; without a sector, or if the two are
    collinear, of the market alone; 0 if that is constant."""
    y, x1, x2 = (F.when(early, F.col(c)) for c in ("ret", "market", "sector"))
    s11, s22, s12 = F.var_pop(x1), F.var_pop(x2), F.covar_pop(x1, x2)
    sy1, sy2 = F.covar_pop(y, x1), F.covar_pop(y, x2)
    both = s11 * s22 - s12 * s12
    alone = F.coalesce(F.try_divide(sy1, s11), F.lit(0.0))
    whole = F.coalesce(both != 0, F.lit(False))
    beta = F.when(whole, F.try_divide(sy1 * s22 - s12 * sy2, both)).otherwise(alone)
    beta_sector = F.when(whole, F.try_divide(s11 * sy2 - s12 * sy1, both)).otherwise(F.lit(0.0))
    means = [F.avg(y).alias("my"), F.avg(x1).alias("m1"), F.coalesce(F.avg(x2), F.lit(0.0)).alias("m2")]
    return [beta.alias("beta"), beta_sector.alias("beta_sector"), *means, F.stddev_pop("ret").alias("src"), F.count("*").alias("n")]


def s2_residual(bars: DataFrame, fit: int = 60, winsor: float = 0.025, sectors: DataFrame | None = None) -> DataFrame:
    """Residuals of market and sector, rescaled to the source's deviation, winsorised, as prices from 100.

    G06: least squares over the first `fit` returns; W13: order statistics int(n p) and int(n (1 - p)); W14: exp of the
    running sum. Open, high and low keep their ratio to the close, volume is a rolling percentile. The first bar is 100
    throughout. Series with fewer than `fit` returns are left out (incomplete)."""
    returns = bars.select("entity_id", "bar_idx", s.log_return().alias("ret")).filter("ret is not null")
    both = with_references(returns, sectors)
    model = both.groupBy("entity_id").agg(*_coefficients(F.col("bar_idx") <= fit)).filter(F.col("n") >= fit)
    fitted = F.col("my") + F.col("beta") * (F.col("market") - F.col("m1")) + F.col("beta_sector") * (F.coalesce("sector", F.lit(0.0)) - F.col("m2"))
    left = both.join(model, "entity_id").withColumn("res", F.col("ret") - fitted)
    # the two order statistics by rank: no series is held in one row
    left = left.withColumn("_at", F.row_number().over(Window.partitionBy("entity_id").orderBy("res")) - 1)
    low, high = F.floor(F.col("n") * F.lit(winsor)), F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(1 - winsor)))
    spread = left.groupBy("entity_id").agg(F.stddev_pop("res").alias("sd"), F.max(F.when(F.col("_at") == low, F.col("res"))).alias("lower"), F.max(F.when(F.col("_at") == high, F.col("res"))).alias("upper"))
    # a sector of one entity explains it wholly: what is left is rounding, and is not blown up
    scale = F.when(F.col("sd") > 1e-9 * F.col("src"), F.col("src") / F.col("sd")).otherwise(F.lit(1.0))
    clipped = left.join(spread, "entity_id").select("entity_id", "bar_idx", (F.greatest("lower", F.least("upper", "res")) * scale).alias("res"))
    price = F.lit(100.0) * F.exp(F.coalesce(F.sum("res").over(s.frame(Window.unboundedPreceding, 0)), F.lit(0.0)))
    raw = bars.select("entity_id", "bar_idx", "open", "high", "low", "close", s.volume_percentile(20, 0.5).alias("volume_percentile"))
    out = raw.join(clipped, ["entity_id", "bar_idx"], "left").join(model.select("entity_id"), "entity_id", "left_semi").filter("bar_idx = 0 or res is not null").withColumn("pseudo_close", price)
    shaped = [F.when((F.col("bar_idx") > 0) & (F.col("close") > 0), F.col("pseudo_close") * F.col(c) / F.col("close")).otherwise(F.col("pseudo_close")).alias(f"pseudo_{c}") for c in ("open", "high", "low")]
    return out.select("entity_id", F.col("bar_idx").alias("day_index"), *shaped, "pseudo_close", "volume_percentile")


def _bucketed(rows: DataFrame, fit: int, values: dict[str, str]) -> DataFrame:
    """Adds a bucket for each value, by edges of the first `fit` rows of its entity: one aggregation and one join for all."""
    early = F.col("bar_idx") < fit
    bounds = rows.groupBy("entity_id").agg(*[s.edges(F.sort_array(F.collect_list(F.when(early, F.col(v)))), 5).alias(f"_{name}") for name, v in values.items()])
    out = rows.join(bounds, "entity_id")
    return out.withColumns({name: s.bucket(F.col(v), F.col(f"_{name}")) for name, v in values.items()})


def _excess(rows: DataFrame, sectors: DataFrame | None, references: bool) -> DataFrame:
    """rows with the return's excess over market and sector; 0 where there is no return, null without the reference."""
    if not references:
        return rows.withColumns({"over_market": F.lit(None).cast("double"), "over_sector": F.lit(None).cast("double")})
    known = with_references(rows.select("entity_id", "bar_idx", "ret").filter("ret is not null"), sectors)
    known = known.select("entity_id", "bar_idx", (F.col("ret") - F.col("market")).alias("over_market"), (F.col("ret") - F.col("sector")).alias("over_sector"))
    out = rows.join(known, ["entity_id", "bar_idx"], "left")
    none = F.col("ret").isNull()
    own = F.lit(False) if sectors is None else none
    return out.withColumns({"over_market": F.when(none, 0.0).otherwise(F.col("over_market")), "over_sector": F.when(own, 0.0).otherwise(F.col("over_sector"))})


def _or_medium(name: str, value: str) -> Column:
    """A bucket, or MEDIUM where there is no value."""
    return F.when(F.col(value).isNull(), F.lit("MEDIUM")).otherwise(F.col(name)).alias(name)


def s3a_daily(bars: DataFrame, fit: int = 252, sectors: DataFrame | None = None, references: bool = True) -> DataFrame:
    """Row i holds the return from bar i to i + 1 and all else as of bar i; one row fewer than bars.

    market_relative_bucket and sector_relative_bucket are those of the return's excess over `with_references`; without a
    reference they are MEDIUM."""
    w = s.by_series()
    rows = bars.select("entity_id", "bar_idx", "close", "volume", s.log_return().alias("own")).withColumn("ret", F.lead("own").over(w))
    rows = rows.select(
        "*", *[s.momentum("close", k).alias(f"m{k}") for k in (5, 21, 63)], s.volatility("ret", 21, "bar_idx").alias("v21"), s.drawdown().alias("dd"), s.volume_percentile(21, 0.0).alias("vp"),
        F.avg("close").over(s.frame(-5, -1)).alias("fast"), F.avg("close").over(s.frame(-20, -1)).alias("slow"),
    ).filter("ret is not null")
    sigma = rows.filter(F.col("bar_idx") < fit).groupBy("entity_id").agg((0.5 * F.stddev_pop("ret")).alias("flat"))
    names = {"momentum_5d_bucket": "m5", "momentum_21d_bucket": "m21", "momentum_63d_bucket": "m63", "volatility_21d_bucket": "v21", "drawdown_bucket": "dd"}
    relative = {"market_relative_bucket": "over_market", "sector_relative_bucket": "over_sector"}
    out = _bucketed(_excess(rows, sectors, references).join(sigma, "entity_id"), fit, names | relative)
    return out.select(
        "entity_id", F.col("bar_idx").alias("relative_day"), F.when(F.col("ret") > F.col("flat"), "UP").when(F.col("ret") < -F.col("flat"), "DOWN").otherwise("FLAT").alias("return_direction"), *names,
        *[_or_medium(n, v) for n, v in relative.items()],
        F.when(F.col("vp") < 0.33, "LOW").when(F.col("vp") < 0.67, "MEDIUM").otherwise("HIGH").alias("volume_activity_21d_bucket"),
        F.when(F.col("bar_idx") < 20, "NEUTRAL").when(F.col("fast") > F.col("slow") * 1.01, "ABOVE").when(F.col("fast") < F.col("slow") * 0.99, "BELOW").otherwise("CROSSED").alias("moving_average_state"),
    )


#: What a fundamental is taken to be where it is not known, and the upper edges of LOW and MEDIUM.
FUNDAMENTALS = (("valuation_bucket", "pe", 15.0, 15.0, 20.0), ("profitability_bucket", "roe", 0.1, 0.05, 0.10), ("leverage_bucket", "debt_equity", 1.0, 0.5, 1.0))


def with_fundamentals(features: DataFrame, metrics: DataFrame) -> DataFrame:
    """X05, optional part: features with buckets of (entity_id, pe, roe, debt_equity); a missing metric has its usual value."""
    of = [F.coalesce(F.col(m), F.lit(usual)) for _, m, usual, _, _ in FUNDAMENTALS]
    cut = [F.when(v <= a, "LOW").when(v <= b, "MEDIUM").otherwise("HIGH").alias(n) for v, (n, _, _, a, b) in zip(of, FUNDAMENTALS, strict=True)]
    return features.join(metrics, "entity_id", "left").select(*[F.col(c) for c in features.columns], *cut)


def s3b_weekly(bars: DataFrame, fit: int = 52, sectors: DataFrame | None = None, references: bool = True) -> DataFrame:
    """Weekly features; the release candidate. The last week has no return: its volatilities are MEDIUM and its excess 0."""
    weeks = grouped(bars, 5, 3)
    w = s.by_series()
    rows = weeks.select("entity_id", "bar_idx", "open", "close", s.log_return().alias("own"))
    rows = rows.withColumn("ret", F.lead("own").over(w)).withColumn("direction", F.when(F.col("close") > F.col("open") * 1.005, "UP").when(F.col("close") < F.col("open") * 0.995, "DOWN").otherwise("FLAT"))
    last4 = F.collect_list("direction").over(s.frame(-3, 0))
    rows = rows.select(
        "*", *[s.momentum("close", k).alias(f"m{k}") for k in (4, 12, 26)], *[F.when(F.col("ret").isNotNull(), s.volatility("ret", k, "bar_idx")).alias(f"v{k}") for k in (4, 12)], s.drawdown().alias("dd"),
        F.avg("close").over(s.frame(-4, -1)).alias("fast"), F.avg("close").over(s.frame(-12, -1)).alias("slow"), F.size(F.filter(last4, lambda d: d == F.col("direction"))).alias("same"),
    )
    names = {"momentum_4w_bucket": "m4", "momentum_12w_bucket": "m12", "momentum_26w_bucket": "m26", "volatility_4w_bucket": "v4", "volatility_12w_bucket": "v12", "drawdown_bucket": "dd"}
    names |= {"market_relative_strength_bucket": "over_market", "sector_relative_strength_bucket": "over_sector"}
    out = _bucketed(_excess(rows, sectors, references), fit, names)
    padded = [_or_medium(name, v) for name, v in names.items()]
    return out.select(
        "entity_id", F.col("bar_idx").alias("relative_week"), F.col("direction").alias("weekly_direction_category"), *padded, F.lit("MEDIUM").alias("volume_activity_bucket"),
        F.when(F.col("bar_idx") < 4, "NEUTRAL").when(F.col("fast") > F.col("slow") * 1.01, "ABOVE").when(F.col("fast") < F.col("slow") * 0.99, "BELOW").otherwise("NEUTRAL").alias("moving_average_regime"),
        F.when(F.col("bar_idx") < 4, "SHORT").when(F.col("same") >= 3, "PERSISTENT").when(F.col("same") >= 2, "MODERATE").otherwise("SHORT").alias("trend_persistence_bucket"),
    )


def s3c_blocks(bars: DataFrame, fit: int = 13, compat: bool = False) -> DataFrame:
    """Blocks of 20 bars (10 at least); the other release candidate. Series of fewer than 20 bars have none.

    Everything within a block is one aggregate, so what is held for an entity is one row a block. Momentum is the bucket of
    the block's own return (0 for the first); with `compat` it is the bucket of 0 in every row, as it is published."""
    block, series = Window.partitionBy("entity_id", "g").orderBy("bar_idx"), Window.partitionBy("entity_id")
    rows = bars.select("entity_id", "bar_idx", "close", "volume", F.floor(F.col("bar_idx") / 20).alias("g"), (F.max("bar_idx").over(series) >= 19).alias("whole")).filter("whole")
    before, peak = F.lag("close").over(block), F.max("close").over(block)
    rows = rows.select(
        "*", F.when(before.isNotNull(), F.when((before > 0) & (F.col("close") > 0), F.ln(F.col("close") / before)).otherwise(F.lit(0.0))).alias("move"),
        F.when(peak > 0, (F.col("close") - peak) / peak).otherwise(F.lit(0.0)).alias("dd"),
    )
    rows = rows.withColumn("way", F.signum("move")).withColumn("turned", F.col("way") != F.lag("way").over(block))
    blocks = rows.groupBy("entity_id", "g").agg(
        F.max_by("close", "bar_idx").alias("close"), F.avg("volume").alias("volume"), F.coalesce(F.stddev_pop("move"), F.lit(0.0)).alias("vol"), F.min("dd").alias("dd"), F.count("move").alias("moves"), F.count("*").alias("n"),
        F.count_if(F.col("way") > 0).alias("up"), F.count_if(F.col("way") < 0).alias("down"), (F.count_if("turned") / F.greatest(F.lit(1), F.count("move"))).alias("flips"),
    ).filter("n >= 10")
    blocks = blocks.withColumn("bar_idx", (F.row_number().over(Window.partitionBy("entity_id").orderBy("g")) - 1).cast("long"))
    blocks = blocks.withColumn("ret", s.log_return())
    blocks = blocks.withColumn("excess", F.coalesce(F.col("ret") - F.avg("ret").over(series), F.lit(0.0))).withColumn("momentum", F.lit(0.0) if compat else F.coalesce("ret", F.lit(0.0)))
    three = {"volatility_regime": "vol", "volume_regime": "volume", "drawdown_regime": "dd", "market_relative_regime": "excess", "trend_consistency_bucket": "flips"}
    sorted_of = lambda kept, v: F.sort_array(F.collect_list(F.when(kept, F.col(v))))
    bounds = blocks.groupBy("entity_id").agg(
        *[s.edges(sorted_of(F.col("bar_idx") < fit, v), 3).alias(f"_{v}") for v in three.values()],
        F.transform(s.edges(sorted_of(F.col("bar_idx") <= fit, "ret"), 5), lambda e: F.coalesce(e, F.lit(0.0))).alias("_momentum"),
    )
    trend = F.when(F.col("up") > 0.6 * F.col("moves"), "STRONG_UP").when(F.col("down") > 0.6 * F.col("moves"), "STRONG_DOWN")
    trend = trend.when(F.col("up") > F.col("down"), "MILD_UP").when(F.col("down") > F.col("up"), "MILD_DOWN").otherwise("NEUTRAL")
    buckets = {name: s.bucket(F.col(v), F.col(f"_{v}"), s.THREE) for name, v in three.items()}
    return blocks.join(bounds, "entity_id").select(
        "entity_id", F.col("bar_idx").alias("relative_block"), trend.alias("dominant_trend_regime"), s.bucket(F.col("momentum"), F.col("_momentum")).alias("aggregate_momentum_bucket"), *[c.alias(n) for n, c in buckets.items()],
        F.lit("MEDIUM").alias("sector_relative_regime"), buckets["trend_consistency_bucket"].alias("reversal_frequency_bucket"),
    )
