"""Price bars: from line items (one series a supplier nation), from price JSON, and weekly or block groups of bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(bars: DataFrame) -> DataFrame:
    """bar_idx from 0 in order of day; the sort is by entity, so no task holds more than one series."""
    return bars.withColumn("bar_idx", (F.row_number().over(Window.partitionBy("entity_id").orderBy("day")) - 1).cast("long"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, bar_idx, day, open, high, low, close, volume): extended prices of a nation's suppliers by shipping day.

    Line items are aggregated before any series is formed; suppliers are joined on the aggregate's small side."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", F.to_date("l_shipdate").alias("day"))
    nations = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("entity_id"))
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber") + F.col("l_extendedprice") / 1e7  # line numbers repeat: then the lower price is first
    daily = lines.join(nations, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("entity_id", "day").agg(
        F.min_by("l_extendedprice", place).alias("open"), F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"), F.max_by("l_extendedprice", place).alias("close"), F.sum("l_quantity").alias("volume")
    )
    return numbered(daily)


def read_price_json(spark: SparkSession, path: str) -> DataFrame:
    """{"records": [{date, open, ...}]} files as bars; a series is a file."""
    kind = "records array<struct<date:string,open:double,high:double,low:double,close:double,volume:double,adj_close:double>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("entity_id"), F.posexplode("records").alias("bar_idx", "r"))
    return rows.select("entity_id", F.col("bar_idx").cast("long").alias("bar_idx"), F.col("r.date").alias("day"), "r.open", "r.high", "r.low", "r.close", "r.volume", F.coalesce("r.adj_close", "r.close").alias("adj_close"))


def grouped(bars: DataFrame, size: int, least: int) -> DataFrame:
    """Consecutive groups of `size` bars with at least `least` of them, numbered from 0 as bar_idx."""
    out = bars.groupBy("entity_id", F.floor(F.col("bar_idx") / size).alias("g")).agg(
        F.min_by("open", "bar_idx").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bar_idx").alias("close"), F.sum("volume").alias("volume"), F.count("*").alias("n")
    )
    out = out.filter(F.col("n") >= least)
    return out.withColumn("bar_idx", (F.row_number().over(Window.partitionBy("entity_id").orderBy("g")) - 1).cast("long")).drop("g", "n")
