"""What a masked series still tells: agreement, distortion, backtests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import series as s
from .attacks import pearson


def _share(a: Column, b: Column) -> Column:
    return F.avg(((a > 0) == (b > 0)).cast("double"))


def structured_utility(pairs: DataFrame) -> DataFrame:
    """G08 to G11 for (entity_id, bar_idx, a, b, ra, rb): prices and returns of source and masked series."""
    year = F.sqrt(F.lit(252.0))
    base = pairs.select("*", s.momentum("a", 5).alias("ma"), s.momentum("b", 5).alias("mb"), s.drawdown("a").alias("da"), s.drawdown("b").alias("db"))
    ties = [((F.rank().over(Window.partitionBy("entity_id").orderBy(c)) + (F.count("*").over(Window.partitionBy("entity_id", c)) - 1) / 2)).alias(f"k{c}") for c in ("ra", "rb")]
    base = base.select("*", *ties)
    va, vb = F.stddev_samp("ra") * year, F.stddev_samp("rb") * year
    out = base.groupBy("entity_id").agg(
        F.round(_share(F.col("ra"), F.col("rb")), 6).alias("sign_agreement"), F.round(pearson("kra", "krb"), 6).alias("rank_correlation"), F.round(F.abs(va - vb) / va, 6).alias("volatility_distortion"),
        F.round(_share(F.col("ma"), F.col("mb")), 6).alias("momentum_agreement"), F.round(F.abs(F.min("da") - F.min("db")), 6).alias("drawdown_distortion"),
    )
    return out.withColumn("low_sign", F.col("sign_agreement") < 0.60).withColumn("high_volatility", F.col("volatility_distortion") > 0.30)


def backtest(trades: DataFrame, lag: int = 1, cost: float = 0.001) -> DataFrame:
    """Metrics of 0/1 actions on period returns, executed `lag` periods later; (entity_id, bar_idx, action, ret).

    Returns are added up, not compounded; drawdown is from the best sum so far, 0 at least."""
    w = s.by_series()
    rows = trades.withColumn("act", F.coalesce(F.lag("action", lag).over(w), F.lit(0)))
    rows = rows.withColumn("turn", F.abs(F.col("act") - F.coalesce(F.lag("act").over(w), F.lit(0)))).withColumn("pnl", F.col("act") * F.col("ret") - cost * F.col("turn"))
    rows = rows.withColumn("sum", F.sum("pnl").over(s.frame(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("dd", F.col("sum") - F.greatest(F.lit(0.0), F.max("sum").over(s.frame(Window.unboundedPreceding, 0))))
    hit = F.when(F.col("act") == 1, (F.col("ret") > 0).cast("double"))
    return rows.groupBy("entity_id").agg(
        F.round(F.avg("act"), 6).alias("trade_rate"), F.round(F.coalesce(F.avg(hit), F.lit(0.0)), 6).alias("hit_rate"), F.round(F.sum("pnl"), 6).alias("total_return"), F.round(F.stddev_pop("pnl") * F.sqrt(F.lit(252.0)), 6).alias("volatility"),
        F.round(F.min("dd"), 6).alias("max_drawdown"), F.sum("turn").alias("turnover"), F.round(F.sum("ret"), 6).alias("benchmark"),
    )
