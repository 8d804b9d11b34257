"""Readers and writers of folders, JSON, CSV and archives, and checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a form, an accession number and a year look like in a path.
FORM, ACCESSION, YEAR = r"(?i)(?<![A-Za-z0-9])(10-K|10-Q|8-K)(?![A-Za-z0-9])", r"(?<!\d)(\d{10}-\d{2}-\d{6})(?!\d)", r"(?<!\d)(199\d|20[0-2]\d|2030)(?!\d)"


def read_corpus(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(name, text) of the files of a folder."""
    rows = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(folder, wholetext=True)
    return rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), F.col("value").alias("text"))


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Upper-cased tickers of the enabled rows of a CSV file (ticker, enabled)."""
    rows = spark.read.csv(path, header=True, schema="ticker string, enabled string")
    return rows.filter(F.lower(F.trim("enabled")).isin("true", "1", "yes")).select(F.upper(F.trim("ticker")).alias("ticker")).filter("ticker <> ''").distinct()


def read_news(spark: SparkSession, path: str) -> DataFrame:
    """Articles, nested fields before flat ones."""
    kind = "headline string, title string, publisher string, published_timestamp string, summary string, canonical_url string, url string, body string"
    rows = spark.read.schema(kind).json(path, multiLine=True)
    return rows.select(F.coalesce("headline", "title").alias("headline"), "publisher", "published_timestamp", "summary", F.coalesce("canonical_url", "url").alias("url"), F.substring("body", 1, 5000).alias("body"))


def path_facts(path):
    """Form, accession and fiscal year in a path."""
    first = lambda p: F.nullif(F.regexp_extract(path, p, 1), F.lit(""))
    return F.struct(F.upper(first(FORM)).alias("form"), first(ACCESSION).alias("accession"), first(YEAR).cast("int").alias("year"))


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size, hash and path facts of every file of a folder."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return rows.select("path", "length", F.sha2("content", 256).alias("sha256"), path_facts(F.col("path")).alias("facts")).select("path", "length", "sha256", "facts.*")


def write_table(df: DataFrame, path: str, kind: str = "parquet", by: list[str] | None = None) -> None:
    """Atomic by the commit protocol; columns in the order they have."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).format(kind).option("header", True).save(path)


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """`<sha>  <name>` of each file."""
    rows = inventory(spark, folder)
    return rows.select(F.concat_ws("  ", "sha256", F.element_at(F.split("path", "/"), -1)).alias("line"))


def columnar_rows(df: DataFrame, arrays: list[str]) -> DataFrame:
    """Parallel arrays as rows; what is missing becomes an empty string."""
    zipped = df.select(F.inline(F.arrays_zip(*arrays)))
    return zipped.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c.split(".")[-1]) for c in zipped.columns])


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """(candidate_id, bar_idx, ret, price) of candidate universes; `adjusted_returns` where there are no `returns`, returns as prices where there are none."""
    kind = "universe_id string, candidates array<struct<candidate_id:string,id:string,returns:array<double>,adjusted_returns:array<double>,prices:array<double>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.inline("candidates"))
    rets = F.coalesce("returns", "adjusted_returns", F.array().cast("array<double>"))
    rows = rows.select(F.coalesce("candidate_id", "id").alias("candidate_id"), F.posexplode(F.arrays_zip(rets.alias("ret"), F.coalesce("prices", rets).alias("price"))).alias("bar_idx", "x"))
    return rows.select("candidate_id", F.col("bar_idx").cast("long").alias("bar_idx"), "x.ret", "x.price")


def reference_returns(bars: DataFrame, reference: DataFrame) -> DataFrame:
    """Each bar with the reference's return (bar_idx, ret) at its place, 0 where that is too short; a longer one is cut."""
    return bars.join(reference.select("bar_idx", F.col("ret").alias("reference")), "bar_idx", "left").withColumn("reference", F.coalesce("reference", F.lit(0.0)))


def collected(files: DataFrame, forms: tuple[str, ...] = (), years: tuple[int, ...] = ()) -> DataFrame:
    """Of an inventory, the first path of each hash, then the first path of each accession; files without one all stay.

    Each pass is an aggregate, combined before its shuffle, so many copies of a file cost one row a task."""
    for name, wanted in (("form", forms), ("year", years)):
        files = files.filter(F.col(name).isin(*wanted)) if wanted else files
    columns = files.columns
    first = lambda df, key: df.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*[F.col(c) for c in columns]), "path").alias("r")).select("r.*")
    return first(first(files, F.col("sha256")), F.coalesce("accession", F.concat(F.lit("path:"), F.col("path"))))
