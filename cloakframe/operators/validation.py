"""Checks of features, universes, submissions and filings; each returns rows that say what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.series import FIVE, THREE
from .sequences import DIRECTIONS, GROUPS

#: The states of a feature; other features of the groups in `sequences` have THREE or FIVE.
STATES: dict[str, tuple[str, ...]] = {
    "return_direction": ("DOWN", "FLAT", "UP"), "weekly_direction_category": ("DOWN", "FLAT", "UP"), "dominant_trend_regime": ("STRONG_DOWN", "MILD_DOWN", "NEUTRAL", "MILD_UP", "STRONG_UP"),
    "moving_average_state": ("BELOW", "CROSSED", "ABOVE", "NEUTRAL"), "moving_average_regime": ("BELOW", "CROSSED", "ABOVE", "NEUTRAL"), "trend_persistence_bucket": ("SHORT", "MODERATE", "PERSISTENT"),
}
#: Features with three states (besides all regimes).
THREE_STATES = ("volume_activity_21d_bucket", "volume_activity_bucket", "trend_consistency_bucket", "reversal_frequency_bucket", "valuation_bucket", "profitability_bucket", "leverage_bucket")
#: Names of columns that number the periods, and parts of names that no released feature has.
PERIODS = ("relative_day", "relative_week", "relative_block")
FORBIDDEN = ("close", "open", "high", "low", "price", "volume", "return", "date", "time", "ticker", "cik", "company")
#: Which metric a feature belongs to, and what each metric weighs.
METRICS = {
    "directional_classification_agreement": (0.25, ("return_direction", "weekly_direction_category")), "trend_regime_agreement": (0.15, ("dominant_trend_regime",)),
    "momentum_state_agreement": (0.15, ("momentum_5d_bucket", "momentum_21d_bucket", "momentum_4w_bucket", "momentum_12w_bucket")), "moving_average_state_agreement": (0.10, ("moving_average_state", "moving_average_regime")),
    "volatility_regime_agreement": (0.10, ("volatility_21d_bucket", "volatility_4w_bucket", "volatility_regime")), "drawdown_regime_agreement": (0.05, ("drawdown_bucket", "drawdown_regime")),
    "market_relative_state_agreement": (0.05, ("market_relative_bucket", "market_relative_strength_bucket", "market_relative_regime")), "sector_relative_state_agreement": (0.05, ("sector_relative_bucket", "sector_relative_strength_bucket")),
}


def states_of(feature: str) -> tuple[str, ...] | None:
    if feature in STATES:
        return STATES[feature]
    if not any(feature in members for members in GROUPS.values()) and feature != "trend_persistence_bucket":
        return None
    return THREE if feature in THREE_STATES or feature.endswith("_regime") else FIVE


def feature_faults(wide: DataFrame, period: str) -> DataFrame:
    """(entity_id, relative period, fault, detail) of released features, one row a fault; none if all is well.

    Names are judged once, from the schema (entity_id null): parts of forbidden names, and dates. Values are judged in every
    row: unknown states, numbers with a fraction or beyond 1e10 or not finite, periods that repeat (in order of period a
    decrease is a repeat)."""
    names = []
    for field in wide.schema.fields:
        low = field.name.lower()
        if field.name in ("entity_id", *PERIODS) or states_of(field.name):
            continue
        if any(part in low for part in FORBIDDEN):
            names.append(("forbidden name", field.name))
    rules: list[Column] = []
    for field in wide.schema.fields:
        if field.name in ("entity_id", period):
            continue
        c, allowed = F.col(field.name), states_of(field.name)
        if allowed and isinstance(field.dataType, T.StringType):
            rules.append(F.when(~c.isin(*allowed), F.struct(F.lit("unknown state").alias("fault"), F.concat(F.lit(field.name + "="), c).alias("detail"))))
        elif isinstance(field.dataType, T.DoubleType | T.FloatType):
            odd = F.isnan(c) | (F.abs(c) > 1e10) | (c != F.floor(c))
            rules.append(F.when(odd, F.struct(F.lit("continuous value").alias("fault"), F.lit(field.name).alias("detail"))))
    repeat = F.count("*").over(Window.partitionBy("entity_id", period)) > 1
    rules.append(F.when(F.col("_repeat"), F.struct(F.lit("repeated period").alias("fault"), F.lit(period).alias("detail"))))
    rows = wide.withColumn("_repeat", repeat).select("entity_id", F.col(period).cast("long").alias("period"), F.explode(F.array_compact(F.array(*rules))).alias("f")).select("entity_id", "period", "f.*")
    if not names:
        return rows
    of_names = wide.sparkSession.createDataFrame(names, "fault string, detail string").select(F.lit(None).cast(wide.schema["entity_id"].dataType).alias("entity_id"), F.lit(None).cast("long").alias("period"), "fault", "detail")
    return of_names.unionByName(rows)


def feature_utility(source: DataFrame, masked: DataFrame, period: str) -> DataFrame:
    """By entity, agreement by metric, agreement of decisions, retention, change rate and the weighted whole.

    Both sides have entity_id, the period and features. A feature that neither side has counts as agreement (both `MEDIUM`
    by default), as in the published measure; the decision is to trade when direction is up and momentum is not low."""
    known = [f for _, fs in METRICS.values() for f in fs]
    have = [f for f in known if f in source.columns or f in masked.columns]
    value = lambda side, f: F.coalesce(F.col(f"{side}.{f}"), F.lit("MEDIUM")) if f in (source if side == "s" else masked).columns else F.lit("MEDIUM")
    first = lambda cols, names: next((n for n in names if n in cols), None)

    def trades(side: str, cols: list[str]) -> Column:
        way, pace = first(cols, DIRECTIONS), first(cols, ("momentum_5d_bucket", "momentum_4w_bucket", "aggregate_momentum_bucket"))
        up = F.col(f"{side}.{way}").isin("UP", "BULLISH", "STRONG_UP", "MILD_UP") if way else F.lit(False)
        return F.coalesce(up, F.lit(False)) & (~F.coalesce(F.col(f"{side}.{pace}").isin("LOW", "VERY_LOW"), F.lit(False)) if pace else F.lit(True))

    both = source.alias("s").join(masked.alias("m"), ["entity_id", period])
    agreed = both.groupBy("entity_id").agg(F.count("*").alias("n"), *[F.avg((value("s", f) == value("m", f)).cast("double")).alias(f"_{f}") for f in have], F.round(F.avg((trades("s", source.columns) == trades("m", masked.columns)).cast("double")), 4).alias("binary_decision_agreement"))
    metric = {name: F.round(sum((F.col(f"_{f}") if f in have else F.lit(1.0) for f in fs), F.lit(0.0)) / len(fs), 4) for name, (_, fs) in METRICS.items()}
    own = [f for f in source.columns if f not in ("entity_id", period)]
    w = Window.partitionBy("entity_id").orderBy(period)
    moved = source.select("entity_id", sum(((F.lag(f).over(w) != F.col(f)).cast("int") for f in own), F.lit(0)).alias("moved"))
    periods = moved.groupBy("entity_id").agg(F.count("*").alias("periods"), F.round(F.coalesce(F.try_divide(F.sum("moved").cast("double"), (F.count("*") - 1) * len(own)), F.lit(0.0)), 4).alias("change_rate"))
    out = periods.join(agreed, "entity_id", "left").select("entity_id", *[F.coalesce(c, F.lit(0.0)).alias(n) for n, c in metric.items()], F.coalesce("binary_decision_agreement", F.lit(0.0)).alias("binary_decision_agreement"), F.round(F.coalesce(F.col("n") / F.col("periods"), F.lit(0.0)), 4).alias("period_retention"), "change_rate")
    whole = sum((F.col(n) * w_ for n, (w_, _) in METRICS.items()), F.lit(0.0)) + 0.10 * F.col("binary_decision_agreement")
    return out.withColumn("overall_utility", F.round(whole, 4))


def submission_faults(rows: DataFrame, available: DataFrame) -> DataFrame:
    """(submission_id, fault) of submitted (submission_id, pos, period, action) against `available` (submission_id, periods).

    Actions are 0 or 1, periods increase strictly, and there are no more than returns to trade on; no rows is a fault too."""
    before = F.lag("period").over(Window.partitionBy("submission_id").orderBy("pos"))
    judged = rows.withColumn("late", before.isNotNull() & (F.col("period") <= before))
    found = judged.groupBy("submission_id").agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col("action").isin(0, 1), F.lit(False))).alias("odd"), F.count_if("late").alias("late"), F.count_if(F.col("period").isNull()).alias("lacking"))
    both = available.join(found, "submission_id", "full")
    faults = F.array(
        F.when(F.col("n").isNull(), "no periods"), F.when(F.col("periods").isNull(), "unknown submission"), F.when(F.col("n") > F.col("periods"), "more periods than returns"), F.when(F.col("odd") > 0, "invalid action"),
        F.when(F.col("late") > 0, "periods do not increase"), F.when(F.col("lacking") > 0, "period is missing"),
    )
    return both.select("submission_id", F.explode(F.array_compact(faults)).alias("fault"))


def universe_faults(bars: DataFrame, source: int, least: int = 100) -> DataFrame:
    """(entity_id, fault) for candidates with too few bars, a negative price, or the source's very series."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bar_idx", "close"))), lambda b: b["close"].cast("string")), ",")
    each = bars.groupBy("entity_id").agg(F.count("*").alias("n"), F.min("close").alias("lowest"), F.sha2(joined, 256).alias("sha"))
    own = each.filter(F.col("entity_id") == source).select(F.col("sha").alias("own"))
    both = each.join(own, (F.col("sha") == F.col("own")) & (F.col("entity_id") != source), "left")
    faults = F.array(F.when(F.col("n") < least, "too few observations"), F.when(F.col("lowest") < 0, "negative price"), F.when(F.col("own").isNotNull(), "same series as the source"))
    return both.select("entity_id", F.explode(F.array_compact(faults)).alias("fault"))


def filings(rows: DataFrame, form: str | None = None, year: int | None = None, quarter: int | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """Filings by form, year and quarter of the report's date (else the filing's), and filing date as text within bounds."""
    day = F.coalesce(F.nullif("reportDate", F.lit("")), F.col("filingDate"))
    for wanted, rule in ((form, F.col("form") == form), (year, F.substring(day, 1, 4).try_cast("int") == year), (quarter, F.quarter(day.try_cast("date")) == quarter), (first, F.col("filingDate") >= first), (last, F.col("filingDate") <= last)):
        rows = rows.filter(rule) if wanted else rows
    return rows


def atlas_coverage(entries: DataFrame, required: dict[str, tuple[str, ...]]) -> DataFrame:
    """(category, score, missing) of required sub-types, for (category, sub_type) entries; a category without entries has score 0."""
    wanted = entries.sparkSession.createDataFrame([(c, list(v)) for c, v in required.items()], "category string, required array<string>")
    have = entries.groupBy("category").agg(F.collect_set("sub_type").alias("have"))
    both = wanted.join(have, "category", "left").withColumn("have", F.coalesce("have", F.array().cast("array<string>")))
    missing = F.array_sort(F.array_except("required", "have"))
    return both.select("category", F.round(F.size(F.array_intersect("required", "have")) / F.greatest(F.lit(1), F.size("required")), 6).alias("score"), missing.alias("missing"))
