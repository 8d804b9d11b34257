"""Archives of filings: inventories of folders, zip and tar files, what their paths say, and their members' contents."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What tickers, forms, years and accession numbers look like in a path, in order of preference.
TICKERS = (r"(?i)(?:^|[/\\])([A-Z]{1,5})(?:[/\\]|$)", r"(?i)ticker[=_-]?([A-Z]{1,5})", r"(?i)([A-Z]{1,5})[-_]")
FORMS = (r"(?i)(10-K|10-Q|8-K|20-F|6-K|S-1|S-3)", r"(?i)form[=_-]?(10-K|10-Q|8-K)")
YEAR = r"(?:^|[^0-9])(?:(?:0[0-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01]))?((?:19|20)\d{2})(?=[^0-9]|$)"
ACCESSIONS = (r"(\d{10}-\d{2}-\d{6})", r"(\d{18})")
DOCUMENT = r"(?i)\.(?:html?|txt|xml|xbrl|pdf)$"
EDGE = 65536


def _first(path: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in patterns])


def path_facts(path: Column) -> Column:
    """(ticker, form, year, accession, document) of a path; years from 1990 to 2030, and null where nothing is found."""
    years = F.filter(F.transform(F.regexp_extract_all(path, F.lit(YEAR), F.lit(1)), lambda y: y.cast("int")), lambda y: y.between(1990, 2030))
    document = F.when(path.rlike(DOCUMENT), F.element_at(F.split(path, "/"), -1))
    return F.struct(F.upper(_first(path, TICKERS)).alias("ticker"), F.upper(_first(path, FORMS)).alias("form"), F.get(years, F.lit(0)).alias("year"), _first(path, ACCESSIONS).alias("accession"), document.alias("document"))


def quick_hash(content: Column, length: Column) -> Column:
    """Of the first 64 KiB, the last 64 KiB (of files of over 128 KiB) and the size."""
    head = F.substring(content, 1, EDGE)
    tail = F.when(length > 2 * EDGE, F.substring(content, -EDGE, EDGE)).otherwise(F.lit(b""))
    return F.sha2(F.concat(head, tail, length.cast("string").cast("binary")), 256)


def _is_zip(path: str) -> bool:
    return path.lower().endswith(".zip")


def _is_tar(path: str) -> bool:
    name = path.lower().rsplit("/", 1)[-1]
    return name.endswith((".gz", ".tgz", ".tar")) or ".tar." in name


def _members(read: bool):
    """(archive, path, length, mark, content) of the members of each archive; contents only if they are read."""

    def of(path: str, content: bytes) -> Iterator[tuple]:
        if _is_zip(path):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for m in z.infolist():
                    if not m.is_dir():
                        yield m.filename, m.file_size, f"{m.CRC}:{m.file_size}:{m.filename}", z.read(m) if read else None
        else:
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as t:
                for m in t:
                    if m.isfile():
                        held = t.extractfile(m) if read else None
                        yield m.name, m.size, f"{m.size}:{m.name}", held.read() if held else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows = [(path, *m) for m in of(path, bytes(content))]
                except (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError):  # a broken archive has no members
                    rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["archive", "path", "length", "mark", "content"])

    return run


_MEMBER = "archive string, path string, length long, mark string, content binary"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def members(spark: SparkSession, folder: str, read: bool = False) -> DataFrame:
    """The members of the zip and tar files under a folder, an archive a task; with their contents if `read`."""
    held = _files(spark, folder).filter(F.lower("path").rlike(r"\.zip$|\.tgz$|\.gz$|\.tar$|\.tar\.[^/]*$")).select("path", "content")
    return held.mapInPandas(_members(read), _MEMBER)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, path, length, hash, ticker, form, year, accession, document) of the plain files under a folder
    (archive null, paths below the folder) and of the members of its archives."""
    root = F.regexp_replace(F.col("path"), r"^.*?" + "\\Q" + folder.rstrip("/").split("://")[-1] + "/\\E", "")
    plain = _files(spark, folder).filter(~F.lower("path").rlike(r"\.zip$|\.tgz$|\.gz$|\.tar$|\.tar\.[^/]*$"))
    plain = plain.select(F.lit(None).cast("string").alias("archive"), root.alias("path"), "length", quick_hash(F.col("content"), F.col("length")).alias("hash"))
    inside = members(spark, folder).select("archive", "path", "length", F.sha2("mark", 256).alias("hash"))
    rows = plain.unionByName(inside)
    return rows.select("*", path_facts(F.col("path")).alias("facts")).select("archive", "path", "length", "hash", "facts.*")


def collected(files: DataFrame, ticker: str | None = None, forms: tuple[str, ...] = ("10-K", "10-Q", "8-K"), first_year: int | None = None) -> DataFrame:
    """Of an inventory the files of a ticker (or of none), of the forms, and from a year on (or of none): the first path of
    each hash, then of each accession; files without one all stay. Both are aggregates, combined before their shuffle."""
    if ticker:
        files = files.filter(F.col("ticker").isNull() | (F.col("ticker") == ticker.upper()))
    if forms:
        files = files.filter(F.col("form").isin(*[f.upper() for f in forms]))
    if first_year:
        files = files.filter(F.col("year").isNull() | (F.col("year") >= first_year))
    columns = files.columns
    first = lambda df, key: df.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*columns), "path").alias("r")).select("r.*")
    return first(first(files, F.col("hash")), F.coalesce("accession", F.concat(F.lit("path:"), F.col("path"))))


def read_html_corpus(spark: SparkSession, folder: str, most: int = 50_000) -> DataFrame:
    """(name, text) of HTML files, tags taken out; the published cut of 50,000 characters is a parameter."""
    from ..functions import text

    rows = spark.read.option("pathGlobFilter", "*.{htm,html}").option("recursiveFileLookup", True).text(folder, wholetext=True)
    return rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), F.substring(text.stripped_html(F.col("value")), 1, most).alias("text"))


def read_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files under a folder of runs, with their paths; columns that one lacks are null."""
    rows = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(folder)
    return rows.withColumn("_path", F.input_file_name())


def transport(spark: SparkSession, folder: str, kind: str, mode: str = "fixture") -> DataFrame:
    """(name, json) of the recorded answers of a kind (`submissions`, `documents`, `companyfacts`); a live mode needs a
    network and is an error here."""
    if mode != "fixture":
        raise ValueError("only recorded answers can be read; give mode='fixture'")
    rows = spark.read.option("pathGlobFilter", f"*{kind}*").option("recursiveFileLookup", True).text(folder, wholetext=True)
    return rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), F.col("value").alias("json"))


def filings_of(answers: DataFrame, forms: tuple[str, ...] = (), limit: int | None = None, order: str = "place") -> DataFrame:
    """Filings (cik, place, accessionNumber, filingDate, reportDate, form, primaryDocument) of recorded
    submissions: `filings.recent`, or the columns of an older page themselves; the first `limit` of each form."""
    from pyspark.sql import Window

    columns = ("accessionNumber", "filingDate", "reportDate", "form", "primaryDocument")
    arrays = ", ".join(f"{c}: array<string>" for c in columns)
    schema = f"cik string, filings struct<recent: struct<{arrays}>>, " + ", ".join(f"{c} array<string>" for c in columns)
    rows = answers.select("name", F.from_json("json", schema).alias("j"))
    of = [F.coalesce(F.col(f"j.filings.recent.{c}"), F.col(f"j.{c}"), F.array().cast("array<string>")).alias(c) for c in columns]
    zipped = rows.select(F.coalesce("j.cik", F.nullif(F.regexp_extract("name", r"CIK(\d{10})", 1), F.lit(""))).alias("cik"), F.posexplode(F.arrays_zip(*of)).alias("place", "f"))
    out = zipped.select(F.lpad("cik", 10, "0").alias("cik"), "place", *[F.coalesce(F.col(f"f.{c}"), F.lit("")).alias(c) for c in columns])
    out = out.filter(F.col("form").isin(*forms)) if forms else out
    if limit is None:
        return out
    nth = F.row_number().over(Window.partitionBy("cik", "form").orderBy(order))
    return out.withColumn("_n", nth).filter(F.col("_n") <= limit).drop("_n")


def resolved_cik(answers: DataFrame, ticker: str) -> DataFrame:
    """(ticker, cik) of a recorded ticker map, the CIK padded to ten digits."""
    rows = answers.select(F.explode(F.from_json("json", "map<string, struct<cik_str: long, ticker: string, title: string>>")).alias("k", "v"))
    return rows.filter(F.upper("v.ticker") == ticker.upper()).select(F.upper("v.ticker").alias("ticker"), F.lpad(F.col("v.cik_str").cast("string"), 10, "0").alias("cik"))
