"""Synthetic statements whose identities hold, ratio buckets, regimes, and price features of a submission.

Every number is drawn from a hash of the ticker and the number's name, so it is the same on any cluster and in SQL; the
published generator's own random numbers are not reproduced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import series as s
from . import governance

#: The upper bounds of the ratio buckets.
RATIO = {
    "current_ratio": ((0.8, "very_low"), (1.0, "low"), (1.5, "medium"), (2.5, "high")), "debt_to_equity": ((0.3, "very_low"), (0.6, "low"), (1.0, "medium"), (2.0, "high")),
    "net_margin": ((0.05, "very_low"), (0.10, "low"), (0.15, "medium"), (0.25, "high")),
}
WEEKLY = ((0.005, "very_low"), (0.015, "low"), (0.030, "medium"), (1.0, "high"))


def uniform(key: Column, name: str) -> Column:
    """A number in 0 to 1 (not 1) from the hash of a key and a name: eight digits of it over 16 ** 8."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", key, F.lit(name)), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def bucket(value: Column, bounds: Sequence[tuple[float, str]]) -> Column:
    """The first bound that a value is below; very_high above all of them."""
    out = None
    for most, name in bounds:
        out = F.when(value < most, name) if out is None else out.when(value < most, name)
    return out.otherwise("very_high")


def _seed(ticker: Column) -> Column:
    return F.conv(F.substring(F.sha2(F.upper(ticker), 256), 1, 8), 16, 10).cast("long")


def annual(tickers: DataFrame, years: int = 5) -> DataFrame:
    """(ticker, relative_year -years .. -1, 27 amounts): revenue grows from year to year, and assets are liabilities
    and equity."""
    seed = _seed(F.col("ticker"))
    growth = 0.05 + (seed % 9) / 200.0
    rows = tickers.select(F.upper("ticker").alias("ticker"), (800 + seed % 1200).cast("double").alias("base"), growth.alias("growth"))
    change = lambda i: 1 + F.col("growth") + (uniform(F.col("ticker"), f"growth{i}") - 0.5) * 0.04
    revenue, made = F.col("base") / F.pow(1 + F.col("growth"), years - 1), []
    for i in range(years):  # five years or so, each from the one before
        revenue = revenue * change(i)
        made.append(F.struct(F.lit(i - years).alias("relative_year"), revenue.alias("revenue")))
    rows = rows.select("ticker", F.inline(F.array(*made)))
    key = F.concat_ws("|", "ticker", F.col("relative_year").cast("string"))
    u = lambda name: uniform(key, name)
    r = F.col("revenue")
    rows = rows.withColumns({"cogs": r * (0.42 + (u("cogs") - 0.5) * 0.10), "operating_expenses": r * (0.20 + (u("opex") - 0.5) * 0.08), "interest_expense": r * (0.005 + u("interest") * 0.012)})
    rows = rows.withColumn("gross_profit", r - F.col("cogs")).withColumn("operating_income", F.col("gross_profit") - F.col("operating_expenses")).withColumn("pre_tax_income", F.col("operating_income") - F.col("interest_expense"))
    rows = rows.withColumn("tax_expense", F.greatest(F.col("pre_tax_income") * (0.21 + (u("tax") - 0.5) * 0.04), F.lit(0.0))).withColumn("net_income", F.col("pre_tax_income") - F.col("tax_expense"))
    rows = rows.withColumns({
        "cash": r * (0.10 + u("cash") * 0.20), "accounts_receivable": r * (0.07 + u("receivable") * 0.05), "inventory": F.col("cogs") * (0.07 + u("inventory") * 0.04), "ppe_net": r * (0.30 + u("ppe") * 0.20),
        "goodwill": r * (0.10 + u("goodwill") * 0.15), "accounts_payable": F.col("cogs") * (0.05 + u("payable") * 0.03), "short_term_debt": r * (0.02 + u("short") * 0.03), "long_term_debt": r * (0.10 + u("long") * 0.10),
    })
    rows = rows.withColumn("current_assets", F.col("cash") + F.col("accounts_receivable") + F.col("inventory")).withColumn("total_assets", F.col("current_assets") + F.col("ppe_net") + F.col("goodwill"))
    rows = rows.withColumn("current_liabilities", F.col("accounts_payable") + F.col("short_term_debt")).withColumn("total_liabilities", F.col("current_liabilities") + F.col("long_term_debt"))
    rows = rows.withColumn("total_equity", F.col("total_assets") - F.col("total_liabilities")).withColumn("common_stock", F.col("total_equity") * (0.30 + u("stock") * 0.10))
    rows = rows.withColumn("retained_earnings", F.col("total_equity") - F.col("common_stock"))
    paid = F.when(F.col("net_income") > 0, r * 0.02).otherwise(F.lit(0.0))
    rows = rows.withColumns({"operating_cash_flow": F.col("net_income") + r * 0.08, "investing_cash_flow": -(F.col("ppe_net") * 0.20), "financing_cash_flow": -F.col("long_term_debt") * 0.05 - paid})
    amounts = [c for c in rows.columns if c not in ("ticker", "relative_year")]
    return rows.select("ticker", "relative_year", *[F.bround(c, 0).alias(c) for c in amounts])


def identity_faults(statements: DataFrame) -> DataFrame:
    """(ticker, relative_year, faults): the identities of a statement that do not hold within rounding."""
    c = F.col
    tolerance = F.greatest(c("revenue") * 0.005, F.lit(1.0))
    rules = {
        "gross profit": F.abs(c("gross_profit") - (c("revenue") - c("cogs"))) > tolerance, "operating income": F.abs(c("operating_income") - (c("gross_profit") - c("operating_expenses"))) > tolerance,
        "net income": F.abs(c("net_income") - (c("pre_tax_income") - c("tax_expense"))) > tolerance,
        "balance": F.abs(c("total_assets") - (c("total_liabilities") + c("total_equity"))) > F.greatest(c("total_assets") * 0.005, F.lit(1.0)),
    }
    faults = F.array_compact(F.array(*[F.when(F.coalesce(x, F.lit(True)), n) for n, x in rules.items()]))
    return statements.select("ticker", "relative_year", F.array_join(faults, ",").alias("faults")).filter("faults <> ''")


def quarterly(tickers: DataFrame, quarters: int = 8) -> DataFrame:
    """(ticker, period 0 .. , amounts) of the last quarters, the latest first."""
    seed = _seed(F.col("ticker"))
    rows = tickers.select(F.upper("ticker").alias("ticker"), (F.shiftright(seed, 8) % 1000 + 200).cast("double").alias("base"), F.explode(F.sequence(F.lit(0), F.lit(quarters - 1))).alias("period"))
    key = F.concat_ws("|q", "ticker", F.col("period").cast("string"))
    u = lambda name: uniform(key, name)
    rows = rows.withColumn("revenue", F.col("base") * (1 - F.col("period") * 0.005 + (u("revenue") - 0.5) * 0.05))
    r = F.col("revenue")
    assets = r * 4 + (u("assets") - 0.5) * r * 0.15
    rows = rows.withColumns({"cogs": r * 0.45, "gross_profit": r * 0.55, "operating_income": r * 0.33, "net_income": r * 0.33 * 0.78, "total_assets": assets})
    rows = rows.withColumn("total_liabilities", F.col("total_assets") * (0.40 + (u("liabilities") - 0.5) * 0.10)).withColumn("total_equity", F.col("total_assets") - F.col("total_liabilities"))
    names = ("revenue", "cogs", "gross_profit", "operating_income", "net_income", "total_assets", "total_liabilities", "total_equity")
    return rows.select("ticker", "period", *[F.bround(c, 0).alias(c) for c in names])


def weekly(tickers: DataFrame, weeks: int = 13) -> DataFrame:
    """(ticker, week 0 .. , direction, change_bucket): no prices."""
    rows = tickers.select(F.upper("ticker").alias("ticker"), F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))).alias("week"))
    ret = (uniform(F.concat_ws("|w", "ticker", F.col("week").cast("string")), "return") - 0.5) * 0.06
    return rows.select("ticker", "week", F.when(ret > 0, "up").when(ret < 0, "down").otherwise("flat").alias("direction"), bucket(F.abs(ret), WEEKLY).alias("change_bucket"))


def regime(weeks: DataFrame, recent: int = 4) -> DataFrame:
    """(ticker, regime) from the last weeks' directions."""
    ups, downs = F.count_if(F.col("direction") == "up"), F.count_if(F.col("direction") == "down")
    name = F.when(ups >= 3, "early_expansion").when(downs >= 3, "contraction").when((ups == 2) & (downs <= 1), "mid_cycle").when((ups <= 1) & (downs >= 2), "late_cycle").otherwise("mid_cycle")
    return weeks.filter(F.col("week") < recent).groupBy("ticker").agg(name.alias("regime"))


def ratio_buckets(statements: DataFrame) -> DataFrame:
    """(ticker, current_ratio, debt_to_equity, net_margin) buckets of the latest statement; null where the lower side
    is not positive."""
    latest = statements.groupBy("ticker").agg(F.max_by(F.struct(*[c for c in statements.columns if c != "ticker"]), "relative_year").alias("x")).select("ticker", "x.*")
    sides = {"current_ratio": ("current_assets", "current_liabilities"), "debt_to_equity": ("total_liabilities", "total_equity"), "net_margin": ("net_income", "revenue")}
    return latest.select("ticker", *[F.when(F.col(b) > 0, bucket(F.try_divide(F.col(a), F.col(b)), RATIO[n])).alias(n) for n, (a, b) in sides.items()])


def price_features(bars: DataFrame) -> DataFrame:
    """(entity_id, relative_day, close_index, volume_index, direction, magnitude): percentages of the first day, and
    the day's change in three sizes."""
    w = s.frame(-10**9, 0)
    index = lambda c: F.round(F.try_divide(F.col(c), F.nullif(F.first(c).over(w), F.lit(0))) * 100, 4)
    before = F.lag("close").over(s.by_series())
    change = F.coalesce(F.try_divide(F.col("close") - before, F.nullif(before, F.lit(0))), F.lit(0.0))
    rows = bars.select("entity_id", "bar_idx", index("close").alias("close_index"), index("volume").alias("volume_index"), change.alias("change"))
    direction = F.when(F.col("change") > 0, "up").when(F.col("change") < 0, "down").otherwise("flat")
    size = F.when(F.abs("change") >= 0.03, "large").when(F.abs("change") >= 0.01, "medium").otherwise("small")
    return rows.select("entity_id", F.format_string("DAY_%04d", F.col("bar_idx")).alias("relative_day"), "close_index", "volume_index", direction.alias("direction"), size.alias("magnitude"))


def binned_lines(lines: DataFrame, most: int = 12) -> DataFrame:
    """(entity_id, statement, line_item, value_bin) of the first lines (place) of each statement."""
    kept = governance.capped(lines.withColumn("_of", F.struct("entity_id", "statement")), "_of", [F.col("place")], most)
    known = F.col("value").isNotNull() & ~F.isnan("value")
    return kept.select("entity_id", "statement", "line_item", F.when(known, governance.size_bin(F.col("value"))).otherwise("UNAVAILABLE").alias("value_bin"))
