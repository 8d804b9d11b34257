"""Attacks on series and features: how well a source is found among candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import series as s


def pearson(a: str, b: str):
    """0 if it is not defined."""
    return F.coalesce(F.nanvl(F.corr(a, b), F.lit(0.0)), F.lit(0.0))


def universe_rank(returns: DataFrame, source: int, top_k: int = 10) -> DataFrame:
    """Candidates ranked by absolute correlation with the source, ties by id; blocked if the source is among top_k.

    The source's series is joined by place, so each candidate's rows meet one row each."""
    own = returns.filter(F.col("entity_id") == source).select("bar_idx", F.col("ret").alias("src"))
    score = returns.join(own, "bar_idx").groupBy("entity_id").agg(F.round(F.abs(pearson("ret", "src")), 6).alias("score"))
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "entity_id"))
    return score.select("entity_id", "score", rank.alias("rank")).withColumn("blocked", (F.col("entity_id") == source) & (F.col("rank") <= top_k))


def lagged_correlation(pairs: DataFrame, lags: tuple[int, ...] = (1, 5, 21)) -> DataFrame:
    """Correlation of source[lag:] with masked[:-lag] for each lag; (entity_id, bar_idx, a, b)."""
    shifted = pairs.select("entity_id", "a", *[F.lag("b", k).over(s.by_series()).alias(f"b{k}") for k in lags])
    out = shifted.groupBy("entity_id").agg(*[F.round(pearson("a", f"b{k}"), 6).alias(f"lag_{k}") for k in lags])
    return out


def path_similarity(pairs: DataFrame, window: int = 20) -> DataFrame:
    """Correlations of rolling sample deviations and of drawdowns; (entity_id, bar_idx, a, b, ra, rb)."""
    rolled = pairs.select("entity_id", "bar_idx", *[F.stddev_samp(c).over(s.frame(-window, -1)).alias(f"v{c}") for c in ("ra", "rb")], s.drawdown("a").alias("da"), s.drawdown("b").alias("db"))
    rolled = rolled.withColumns({c: F.when(F.col("bar_idx") >= window, F.col(c)) for c in ("vra", "vrb")})
    return rolled.groupBy("entity_id").agg(F.round(pearson("vra", "vrb"), 6).alias("volatility_similarity"), F.round(pearson("da", "db"), 6).alias("drawdown_similarity"))


def structured_attacks(pairs: DataFrame, ranked: DataFrame | None = None, top_k: int = 10) -> DataFrame:
    """Direct, lagged and path similarities of (entity_id, bar_idx, a, b, ra, rb); blocked if any is over its threshold.

    ranked: (entity_id, rank) of each masked series' source among the candidates; a rank up to `top_k` blocks too, and so does
    one that is not there."""
    direct = pairs.groupBy("entity_id").agg(F.round(pearson("ra", "rb"), 6).alias("direct"))
    lagged = lagged_correlation(pairs.select("entity_id", "bar_idx", F.col("ra").alias("a"), F.col("rb").alias("b")))
    out = direct.join(lagged, "entity_id").join(path_similarity(pairs), "entity_id")
    late = F.greatest(*[c for c in lagged.columns if c != "entity_id"]) > 0.8
    blocked = (F.col("direct") > 0.9) | late | (F.col("volatility_similarity") > 0.85) | (F.col("drawdown_similarity") > 0.85)
    if ranked is None:
        return out.withColumn("blocked", blocked)
    out = out.join(ranked.select("entity_id", "rank"), "entity_id", "left")
    return out.withColumn("blocked", blocked | F.coalesce(F.col("rank") <= top_k, F.lit(True)))


def masked_ranks(masked: DataFrame, candidates: DataFrame) -> DataFrame:
    """(entity_id, rank): of each masked series (entity_id, bar_idx, ret) the rank of the candidate of its id among all
    candidates (entity_id, bar_idx, ret) by absolute correlation; ties by id.

    Ranks are counted, not sorted: candidates ahead of the source are one aggregate for each series."""
    other = candidates.select(F.col("entity_id").alias("candidate"), "bar_idx", F.col("ret").alias("own"))
    score = masked.join(other, "bar_idx").groupBy("entity_id", "candidate").agg(F.round(F.abs(pearson("ret", "own")), 6).alias("score"))
    source = score.filter(F.col("candidate") == F.col("entity_id")).select("entity_id", F.col("score").alias("source"))
    ahead = (F.col("score") > F.col("source")) | ((F.col("score") == F.col("source")) & (F.col("candidate") < F.col("entity_id")))
    return score.join(source, "entity_id").groupBy("entity_id").agg((F.count_if(ahead) + 1).alias("rank"))


#: The ordinals of the labels; any other label counts as 1.
ORDINALS = {
    "VERY_LOW": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3, "VERY_HIGH": 4, "DOWN": 0, "FLAT": 1, "UP": 2, "BEARISH": 0, "BULLISH": 2, "BELOW": 0, "CROSSED": 1, "ABOVE": 2,
    "SHORT": 0, "MODERATE": 1, "PERSISTENT": 2, "STRONG_DOWN": 0, "MILD_DOWN": 1, "NEUTRAL": 2, "MILD_UP": 3, "STRONG_UP": 4,
}


def ordinal(label):
    mapped = F.create_map(*[F.lit(x) for kv in ORDINALS.items() for x in kv])
    return F.coalesce(F.get(F.array(F.try_element_at(mapped, label)), F.lit(0)), F.lit(1))


def long_features(wide: DataFrame, period: str) -> DataFrame:
    """(entity_id, period, feature, state)."""
    names = [c for c in wide.columns if c not in ("entity_id", period)]
    return wide.unpivot(["entity_id", period], names, "feature", "state").withColumnRenamed(period, "period")


def categorical_scores(features: DataFrame, source: int) -> DataFrame:
    """A03, A04 by candidate and feature: share of equal states, and 1 - mean ordinal distance / 4."""
    own = features.filter(F.col("entity_id") == source).select("period", "feature", F.col("state").alias("own"))
    both = features.join(own, ["period", "feature"])
    gap = F.abs(ordinal(F.col("state")) - ordinal(F.col("own"))) / 4.0
    return both.groupBy("entity_id", "feature").agg(F.avg((F.col("state") == F.col("own")).cast("double")).alias("exact"), (1 - F.avg(gap)).alias("hamming"), F.count("*").alias("n"))


def categorical_rank(features: DataFrame, source: int) -> DataFrame:
    """Features combined (direction weighs 3), candidates ranked, with the margin to the neighbour."""
    scores = categorical_scores(features, source)
    weight = F.when(F.col("feature").contains("direction"), 3.0).otherwise(1.0)
    total = scores.groupBy("entity_id").agg(F.round(F.sum(F.col("exact") * weight) / F.greatest(F.lit(1.0), F.sum(weight)), 6).alias("score"))
    w = Window.orderBy(F.desc("score"), "entity_id")
    ranked = total.select("entity_id", "score", F.row_number().over(w).alias("rank"), F.lag("score").over(w).alias("up"), F.lead("score").over(w).alias("down"))
    margin = F.when(F.col("rank") > 1, F.col("up") - F.col("score")).otherwise(F.col("score") - F.col("down"))
    return ranked.select("entity_id", "score", "rank", F.round(F.coalesce(margin, F.lit(0.0)), 6).alias("margin"))


def transitions(features: DataFrame) -> DataFrame:
    """Share of each next state, by entity, feature and state."""
    w = Window.partitionBy("entity_id", "feature").orderBy("period")
    moves = features.select("entity_id", "feature", F.lag("state").over(w).alias("from_state"), F.col("state").alias("to_state")).filter("from_state is not null")
    n = moves.groupBy("entity_id", "feature", "from_state", "to_state").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("entity_id", "feature", "from_state")), 6))


def ngram_jaccard(features: DataFrame, source: int, n: int = 3) -> DataFrame:
    """Jaccard similarity of the sets of n states in a row; 1 if both are empty."""
    w = Window.partitionBy("entity_id", "feature").orderBy("period")
    states = F.struct(*[F.lead("state", k).over(w).alias(f"s{k}") for k in range(n)])
    grams = features.select("entity_id", "feature", states.alias("g")).filter(F.col(f"g.s{n - 1}").isNotNull()).distinct()
    sizes = grams.groupBy("entity_id", "feature").agg(F.count("*").alias("n"))
    own = grams.filter(F.col("entity_id") == source).select("feature", "g")
    shared = grams.join(own, ["feature", "g"]).groupBy("entity_id", "feature").agg(F.count("*").alias("k"))
    of_source = sizes.filter(F.col("entity_id") == source).select("feature", F.col("n").alias("m"))
    both = sizes.join(of_source, "feature").join(shared, ["entity_id", "feature"], "left")
    k = F.coalesce("k", F.lit(0))
    return both.select("entity_id", "feature", F.round(k / (F.col("n") + F.col("m") - k), 6).alias("jaccard"))
