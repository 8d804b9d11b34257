"""Registries, validation, reports and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pseudonymised(df: DataFrame, columns: list[str]) -> DataFrame:
    """PSEUDO_ and eight digits of the value's hash; null and empty stay."""
    return df.withColumns({c: F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.concat(F.lit("PSEUDO_"), F.substring(F.sha2(F.col(c), 256), 1, 8))).otherwise(F.col(c)) for c in columns})


def counted_pseudonyms(values: DataFrame, kind: str, value: str) -> DataFrame:
    """TYPE_001, ... in order of value within a kind; values equal but for case are one."""
    one = values.groupBy(F.col(kind).alias("kind"), F.lower(F.trim(value)).alias("key")).agg(F.min(value).alias("value"))
    n = F.row_number().over(Window.partitionBy("kind").orderBy("key"))
    return one.select("kind", "key", "value", F.format_string("%s_%03d", F.upper(F.regexp_replace("kind", "[^A-Za-z0-9]", "")), n).alias("pseudonym"))


def bar_faults(bars: DataFrame) -> DataFrame:
    """What is wrong with each bar that is wrong."""
    rules = {"high<low": F.col("high") < F.col("low"), "high<open": F.col("high") < F.col("open"), "high<close": F.col("high") < F.col("close"), "low>open": F.col("low") > F.col("open"), "low>close": F.col("low") > F.col("close"), "volume<0": F.col("volume") < 0}
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return bars.select("entity_id", "bar_idx", F.array_join(found, ",").alias("faults")).filter("faults <> ''")


def capped(rows: DataFrame, group: str, order: list, cap: int) -> DataFrame:
    """The first `cap` rows of each group."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_n") <= cap).drop("_n")


def size_bin(value: Column) -> Column:
    """Five bins by magnitude."""
    return F.when(value < 0, "negative").when(value < 1e9, "small").when(value < 1e10, "medium").when(value < 1e11, "large").otherwise("mega")


def histogram_cosine(values: DataFrame) -> DataFrame:
    """Cosine of the two histograms of (side 'a' or 'b', value), by whole decades clamped to 0 .. 99."""
    bucket = F.least(F.lit(99), F.greatest(F.lit(0), F.floor(F.log10("value")).cast("int")))
    counted = values.filter(F.col("value") > 0).groupBy(bucket.alias("bucket")).agg(F.count_if(F.col("side") == "a").alias("a"), F.count_if(F.col("side") == "b").alias("b"))
    norm = F.sqrt(F.sum(F.col("a") * F.col("a")).cast("double")) * F.sqrt(F.sum(F.col("b") * F.col("b")).cast("double"))
    return counted.agg(F.round(F.coalesce(F.try_divide(F.sum(F.col("a") * F.col("b")).cast("double"), norm), F.lit(0.0)), 6).alias("cosine"))


def completeness(required: DataFrame, observed: DataFrame) -> DataFrame:
    """Keys that lack and keys that are too many."""
    lacking = required.select("key").exceptAll(observed.select("key").distinct()).select("key", F.lit("missing").alias("issue"))
    return lacking.union(observed.select("key").distinct().join(required, "key", "left_anti").select("key", F.lit("unexpected").alias("issue")))


def evidence_issues(evidence: DataFrame) -> DataFrame:
    """What is wrong with each row of (key, rank, size, percentile)."""
    rules = {"rank": (F.col("rank") < 1) | (F.col("rank") > F.col("size")), "percentile": (F.col("percentile") < 0) | (F.col("percentile") > 100), "key": F.col("key").isNull() | (F.col("key") == "")}
    return evidence.select("key", F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules.items()])), ",").alias("issues"))


def gate(conditions: DataFrame) -> DataFrame:
    """FAIL if a blocking condition fails (or is unknown), REVIEW_REQUIRED if another does, else PASS.

    No conditions at all is missing evidence, which fails."""
    failed = ~F.coalesce("passed", F.lit(False))
    out = conditions.agg(F.count("*").alias("conditions"), F.count_if(failed & F.col("blocking")).alias("blocking_failures"), F.count_if(failed & ~F.col("blocking")).alias("warnings"))
    return out.withColumn("decision", F.when((F.col("blocking_failures") > 0) | (F.col("conditions") == 0), "FAIL").when(F.col("warnings") > 0, "REVIEW_REQUIRED").otherwise("PASS"))


def privacy_gate(ranked: DataFrame, source: int, least_universe: int = 20, fail_top: int = 10, review_percent: float = 1.0, fail_percent: float = 5.0, reconstructed: bool = False, forbidden: tuple[str, ...] = ()) -> DataFrame:
    """The source's rank among the candidates; an absent source fails (it is no evidence of safety).

    The source fails among the first `fail_top` or `fail_percent` hundredths. Whatever the ranks, a reconstruction that
    succeeded fails, forbidden fields in the output do, and so does incomplete evidence: ranks that are not 1 to the number
    of candidates, once each, of different candidates."""
    whole = (F.count("entity_id") == F.count("*")) & (F.countDistinct("entity_id") == F.count("*")) & (F.countDistinct("rank") == F.count("*")) & (F.min("rank") == 1) & (F.max("rank") == F.count("*"))
    out = ranked.agg(F.count("*").alias("universe"), F.max(F.when(F.col("entity_id") == source, F.col("rank"))).alias("source_rank"), F.coalesce(whole, F.lit(False)).alias("_whole"))
    percent = F.col("source_rank") * 100.0 / F.col("universe")
    short = F.lit(reconstructed or bool(forbidden)) | ~F.col("_whole")
    fails = short | F.col("source_rank").isNull() | (F.col("universe") < least_universe) | (F.col("source_rank") <= fail_top) | (percent <= fail_percent)
    return out.withColumn("decision", F.when(fails, "FAIL").when(percent <= review_percent, "REVIEW_REQUIRED").otherwise("PASS")).drop("_whole")


def period(ts: Column, now: Column) -> Column:
    """The quarter and how long ago it was, by calendar years and months; [PERIOD DATE] for what is no date."""
    years = F.year(now) - F.year(ts)
    months = years * 12 + F.month(now) - F.month(ts)
    within = F.when(months == 1, "1 month ago").otherwise(F.format_string("%d months ago", months))
    ago = F.when(months <= 0, "current period").when(years == 0, within).when(years == 1, "prior year").otherwise(F.format_string("%d years ago", years))
    return F.when(ts.isNotNull(), F.format_string("Q%d %d (%s)", F.quarter(ts), F.year(ts), ago)).otherwise("[PERIOD DATE]")


def flattened(json: Column) -> Column:
    """(path, leaf) of a flat JSON object, by key."""
    return F.explode(F.array_sort(F.map_entries(F.from_json(json, "map<string,string>"))))
