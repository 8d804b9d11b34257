"""Shared storage, size-checked joins and Arrow helpers of the operators in this subpackage."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows (of a few numbers each) up to which a side of a join is broadcast; a larger side is shuffled.
BROADCAST_ROWS = 100_000
#: Bytes of text that a numeric kernel works on at once; a longer document is a block of its own.
BLOCK_BYTES = 1 << 19

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on one machine, one that is made here."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cloakframe-"))
        found = spark.sparkContext.getCheckpointDir()
    return f"{found.rstrip('/')}/cloakframe/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, and a lost executor loses nothing.

    The shuffle files of the job go as soon as it has ended, where the session allows that. The tables stay, as results read
    them, until `clean_up` or the end of the program that started the session."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if spark.sparkContext.applicationId not in _registered:
        _registered.add(spark.sparkContext.applicationId)
        atexit.register(clean_up, spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


_registered: set[str] = set()


def clean_up(spark: SparkSession) -> None:
    """Delete all tables that this application has written to the shared folder; results that read them end with that."""
    with contextlib.suppress(Exception):  # the session may have ended
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if it was counted to have at most so many rows; else as it is, for a shuffled join.

    df must be cheap to count (a written table)."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if rows is None else rows) else df


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores until no column of df has it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [a, b) of at most `most` bytes together, or of one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column without a copy of the texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    if column.null_count:  # a null may own bytes in theory
        gone = np.asarray(column.is_null())
        if (np.diff(offsets)[gone] > 0).any():
            return utf8_column(column.fill_null(""))
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def trimmed(run: Callable) -> Callable:
    """An iterator function that gives freed memory back to the system when its task ends: workers live on for other tasks."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def ids_of(column: pa.Array) -> np.ndarray:
    """Long ids; null becomes the smallest long."""
    return np.asarray(column.cast(pa.int64()).fill_null(NULL_ID), dtype=np.int64)


#: Stands for a null id inside an operator.
NULL_ID = -(2**63)
