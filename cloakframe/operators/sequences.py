"""Similarity of sequences of states, warped distances, and the suite of attacks on released features."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .attacks import ordinal

#: Features that weigh 3, and the groups of features that an ablation keeps.
DIRECTIONS = ("return_direction", "weekly_direction_category", "dominant_trend_regime")
GROUPS = {
    "direction": DIRECTIONS,
    "momentum": ("momentum_5d_bucket", "momentum_21d_bucket", "momentum_63d_bucket", "momentum_4w_bucket", "momentum_12w_bucket", "momentum_26w_bucket", "aggregate_momentum_bucket"),
    "volatility": ("volatility_21d_bucket", "volatility_4w_bucket", "volatility_12w_bucket", "volatility_regime"),
    "volume": ("volume_activity_21d_bucket", "volume_activity_bucket", "volume_regime"),
    "drawdown": ("drawdown_bucket", "drawdown_regime"),
    "market_relative": ("market_relative_bucket", "market_relative_strength_bucket", "market_relative_regime"),
    "sector_relative": ("sector_relative_bucket", "sector_relative_strength_bucket", "sector_relative_regime"),
    "technical_state": ("moving_average_state", "moving_average_regime", "trend_persistence_bucket", "trend_consistency_bucket", "reversal_frequency_bucket"),
    "fundamentals": ("valuation_bucket", "profitability_bucket", "leverage_bucket"),
}
MEASURES = ("exact", "weighted_hamming", "dtw", "transition", "ngram")
#: The sixteen attacks, as name/ablation.
SUITE = tuple(f"{m}/all" for m in (*MEASURES, "combined")) + tuple(f"combined/{g}" for g in ("direction", "momentum", "volatility", "drawdown", "market_relative", "sector_relative", "technical_state")) + ("lagged_1/all", "lagged_5/all", "lagged_21/all")


def warped(a: np.ndarray, b: np.ndarray) -> float:
    """Cheapest alignment of a and b within a band of a quarter of the shorter, over the sum of their lengths.

    Infinite if either is empty or the lengths differ by more than the band. A row of the table follows from the one before
    with prefix sums: going right from k to j costs the sum of what lies between, so the best k is a running minimum."""
    n, m = len(a), len(b)
    if not n or not m:
        return float("inf")
    band = max(1, min(n, m) // 4)
    if abs(n - m) > band:
        return float("inf")
    last = np.full(m + 1, np.inf)
    last[0] = 0.0
    for i in range(1, n + 1):
        lo, hi = max(1, i - band), min(m, i + band)
        cost = np.abs(a[i - 1] - b[lo - 1 : hi])
        total = np.cumsum(cost)
        entry = np.minimum(last[lo : hi + 1], last[lo - 1 : hi])
        last = np.full(m + 1, np.inf)
        last[lo : hi + 1] = total + np.minimum.accumulate(entry - (total - cost))
    return float(last[m]) / (n + m)


def _each(a: pd.Series, b: pd.Series) -> pd.Series:
    as_array = lambda x: np.asarray([] if x is None else x, dtype=float)
    return pd.Series([warped(as_array(x), as_array(y)) for x, y in zip(a, b, strict=True)], dtype=float)


def dtw(a: Column | str, b: Column | str) -> Column:
    """Banded warped distance of two arrays of doubles, in Arrow batches; a null array counts as empty."""
    return F.pandas_udf(_each, "double")(a, b)


def ordinals(states: Column) -> Column:
    return F.transform(states, lambda x: ordinal(x).cast("double"))


def quarters(states: Column) -> Column:
    """Ordinals over 4, so that the warped distance is that of ordinal costs."""
    return F.transform(ordinals(states), lambda x: x / 4)


def _aligned(a: Column, b: Column) -> Column:
    """How many places both have."""
    return F.least(F.size(a), F.size(b))


def exact(a: Column, b: Column) -> Column:
    """Share of equal places up to the shorter's length; 0 if there are none."""
    n = _aligned(a, b)
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y)
    return F.when(n > 0, F.size(F.filter(same, lambda x: x)) / n).otherwise(F.lit(0.0))


def hamming(a: Column, b: Column, weights: Mapping[str, float] | None = None) -> Column:
    """Mean distance of ordinals over 4, each weighed by a's state (1 if it has no weight); 1 if there are no places."""
    n = _aligned(a, b)
    first = F.slice(a, 1, n)
    gaps = F.zip_with(ordinals(first), F.slice(ordinals(b), 1, n), lambda x, y: F.abs(x - y) / 4)
    if weights:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        gaps = F.zip_with(gaps, F.transform(first, lambda x: F.coalesce(F.try_element_at(table, x), F.lit(1.0))), lambda g, w: g * w)
    return F.when(n > 0, F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x) / n).otherwise(F.lit(1.0))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(1.0))


def grams(states: Column, n: int) -> Column:
    last = F.size(states) - n + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(states, i, n), "\x1f"))).otherwise(F.array().cast("array<string>"))


def transition(a: Column, b: Column) -> Column:
    """1 - squared Frobenius distance of the row-normalised transition matrices / number of states, 0 at least."""
    states = F.size(F.array_union(a, b))

    def count(values: Column, value: Column) -> Column:
        return F.size(values) - F.size(F.array_remove(values, value))

    def share(side: Column, pair: Column) -> Column:
        row = count(side["heads"], F.substring_index(pair, "\x1f", 1))
        return F.coalesce(F.try_divide(count(side["pairs"], pair).cast("double"), row.cast("double")), F.lit(0.0))

    def of(both: Column) -> Column:
        gaps = F.transform(F.array_union(both["a"]["pairs"], both["b"]["pairs"]), lambda p: F.pow(share(both["a"], p) - share(both["b"], p), F.lit(2)))
        return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)

    def side(x: Column) -> Column:
        return F.struct(grams(x, 2).alias("pairs"), F.slice(x, 1, F.greatest(F.lit(0), F.size(x) - 1)).alias("heads"))

    # the pairs are bound by an outer transform, once for both arrays
    distance = F.element_at(F.transform(F.array(F.struct(side(a).alias("a"), side(b).alias("b"))), of), 1)
    return F.when(states > 0, 1 - F.least(F.lit(1.0), distance / states)).otherwise(F.lit(1.0))


def sequences(features: DataFrame) -> DataFrame:
    """(entity_id, feature, states): a feature's states in order of period. A row holds one series of one feature."""
    ordered = F.array_sort(F.collect_list(F.struct("period", "state")))
    return features.groupBy("entity_id", "feature").agg(ordered.getField("state").alias("states"))


def measured(features: DataFrame, source: int, lags: tuple[int, ...] = (0,)) -> DataFrame:
    """(entity_id, feature, lag, measures...): each candidate's sequences against the source's from place `lag` on.

    A lag that leaves nothing of the source takes the whole of it. The source has one row a feature."""
    rows = sequences(features)
    own = rows.filter(F.col("entity_id") == source).select("feature", F.col("states").alias("own"))
    both = rows.join(own, "feature").withColumn("lag", F.explode(F.array(*[F.lit(k) for k in lags])))
    both = both.withColumn("own", F.when(F.col("lag") < F.size("own"), F.slice("own", F.col("lag") + 1, F.greatest(F.lit(1), F.size("own")))).otherwise(F.col("own")))
    a, b = F.col("own"), F.col("states")
    return both.select(
        "entity_id", "feature", "lag", exact(a, b).alias("exact"), (1 - hamming(a, b)).alias("weighted_hamming"), (1 / (1 + dtw(quarters(a), quarters(b)))).alias("dtw"),
        transition(a, b).alias("transition"), jaccard(grams(a, 3), grams(b, 3)).alias("ngram"), jaccard(a, b).alias("jaccard"),
    )


def attack_suite(features: DataFrame, source: int, keys: tuple[str, ...] = SUITE, top_k: int = 10, compat: bool = False) -> DataFrame:
    """One row an attack (name/ablation): rank of the source among all candidates, percentile, score, margin.

    All similarities are computed in one pass; the attacks are sums over them. Ranks are counted (candidates ahead of the
    source, ties by id) rather than sorted, so no task holds the candidates of an attack. An unknown source or an ablation
    that no feature belongs to gives rank -1 (not blocked, but status `missing`). `compat` ranks by the distance where the
    name says weighted_hamming."""
    names = [k.partition("/")[0] for k in keys]
    lags = tuple(sorted({0} | {int(n.removeprefix("lagged_")) for n in names if n.startswith("lagged_")}))
    group = F.array(F.lit("all"), *[F.when(F.col("feature").isin(*members), F.lit(g)) for g, members in GROUPS.items()])
    rows = measured(features, source, lags).withColumn("ablation", F.explode(F.array_compact(group)))
    weight = F.when(F.col("feature").isin(*DIRECTIONS), F.lit(3.0)).otherwise(F.lit(1.0))
    mean = lambda m: F.sum(F.col(m) * weight) / F.greatest(F.lit(1.0), F.sum(weight))
    total = rows.groupBy("entity_id", "lag", "ablation").agg(*[(1 - mean(m) if compat and m == "weighted_hamming" else mean(m)).alias(m) for m in MEASURES], mean("jaccard").alias("jaccard"))
    total = total.withColumn("combined", sum((F.col(m) for m in MEASURES), F.lit(0.0)) / len(MEASURES))

    def scored(key: str) -> Column:
        name, _, ablation = key.partition("/")
        lag = int(name.removeprefix("lagged_")) if name.startswith("lagged_") else 0
        value = F.col("combined") if name.startswith("lagged_") else F.col(name if name in (*MEASURES, "combined", "jaccard") else "exact")
        return F.when((F.col("lag") == lag) & (F.col("ablation") == (ablation or "all")), F.struct(F.lit(key).alias("attack"), F.round(value, 9).alias("score")))

    scores = total.select("entity_id", F.explode(F.array_compact(F.array(*[scored(k) for k in keys]))).alias("s")).select("entity_id", "s.attack", "s.score")
    own = scores.filter(F.col("entity_id") == source).select("attack", F.col("score").alias("own"))
    ahead = (F.col("score") > F.col("own")) | ((F.col("score") == F.col("own")) & (F.col("entity_id") < source))
    other = F.col("entity_id") != source
    ranked = scores.join(own, "attack").groupBy("attack", "own").agg(
        F.count("*").alias("universe"), (F.count_if(ahead & other) + 1).alias("rank"), F.min(F.when(ahead & other, F.col("score"))).alias("above"), F.max(F.when(~ahead & other, F.col("score"))).alias("below"),
    )
    every = scores.sparkSession.createDataFrame([(k,) for k in keys], "attack string").join(ranked, "attack", "left")
    rank = F.coalesce("rank", F.lit(-1)).cast("long")
    margin = F.coalesce(F.col("own") - F.coalesce("above", "below"), F.lit(0.0))
    return every.select(
        F.substring_index("attack", "/", 1).alias("attack_name"), F.substring_index("attack", "/", -1).alias("ablation"), rank.alias("true_source_rank"), F.coalesce("universe", F.lit(0)).cast("long").alias("candidate_universe_size"),
        F.round(F.when(rank > 0, (1 - rank / F.col("universe")) * 100).otherwise(F.lit(0.0)), 2).alias("percentile_rank"), F.round(F.coalesce("own", F.lit(0.0)), 6).alias("score"), F.round(margin, 6).alias("score_margin"),
        *[((rank > 0) & (rank <= k)).alias(f"top_{k}") for k in (1, 5, 10)], F.when(rank < 0, "missing").when(rank <= top_k, "blocked").otherwise("completed").alias("status"),
    )
