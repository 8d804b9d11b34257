"""All queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import documents, privacy, release, series

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**series.QUERIES, **documents.QUERIES, **release.QUERIES, **privacy.QUERIES}
ORACLE_SQL: dict[str, str] = {**series.SQL, **documents.SQL, **release.SQL, **privacy.SQL}
FLAGSHIP = "x05_s3b_weekly"
