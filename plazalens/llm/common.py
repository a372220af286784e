"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.session import scratch_path, scratch_root

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(s: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` serves the all-ASCII strings."""
    return F.when(F.octet_length(s) == F.char_length(s), F.lower(s)).otherwise(
        F.translate(s, ASCII_UPPER, ASCII_LOWER))


def free_name(name: str, df: DataFrame) -> str:
    """``name`` with as many underscores as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """The paths of the tables that ``written`` makes inside; those still listed at the end are deleted."""
    _SCRATCH.append([])
    try:
        yield _SCRATCH[-1]
    finally:
        for path in _SCRATCH.pop():
            remove_table(spark, path)


def remove_table(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a re-read of committed files, and
    later passes see exactly the rows that were written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (cleaned with the frame)."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


_CACHE: dict = {}


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """The worker's one cached object: another key's is let go first."""
    if key not in _CACHE:
        release_worker_cache()
        _CACHE[key] = make()
    return _CACHE[key]


def release_worker_cache() -> None:
    """Frees what an earlier operator's tasks left in this Python worker."""
    if _CACHE:
        _CACHE.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc keeps what numpy freed, until it is asked
        trim(0)


def text_slices(column: pa.Array, limit: int = 8 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of texts of about ``limit`` bytes.

    ``offsets`` has one entry more than texts and starts at 0; a null text is
    empty. A longer text makes a run of its own.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n), data[offsets[lo]:offsets[min(hi, n)]], offsets[lo:min(hi, n) + 1] - offsets[lo]
        lo = hi
