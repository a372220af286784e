"""Null handling, duplicates, type conversions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


DUP_HASHES_MAX_ROWS = 2_000_000  # 8-byte hashes: a broadcast of a few tens of MB


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None,
               hash_prefilter: bool = False) -> DataFrame:
    """Exact-row duplicate removal (F8).

    Run it before any fill: a fill can make two different rows equal.
    Spark plans it as a partial hash aggregate on every column before the
    shuffle, so repeated rows collapse map-side first.

    ``hash_prefilter=True`` is for wide rows (long review texts) with few
    duplicates, where shipping every full row through the dedup shuffle is
    the dominant cost. A 64-bit hash of each row is aggregated first (8
    bytes per row through the shuffle); the hashes seen more than once are
    checkpointed to the shared checkpoint folder, and when there are at most
    ``DUP_HASHES_MAX_ROWS`` of them they are broadcast: rows with a unique
    hash are unique and stay where they are (anti join, map side); only rows
    whose hash repeats - the real duplicates and rare collisions - go
    through the exact dedup shuffle. The result equals the plain dedup
    (hashes only route rows, equality is still decided on the full row);
    beyond the bound, or with nested floating-point columns, the plain dedup
    runs. This runs one job (the hash counts) when called.
    """
    cols = list(subset) if subset else list(df.columns)
    if not hash_prefilter or _has_nested_float(df, cols):
        return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()
    from plazalens.operators.join import is_small

    hashed = df.withColumn("__h", F.xxhash64(*[_hash_input(df, c) for c in cols]))
    repeated = (hashed.groupBy("__h").count().filter(F.col("count") > 1).select("__h")
                .checkpoint(eager=True))
    if not is_small(repeated, DUP_HASHES_MAX_ROWS):
        return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()
    rep = F.broadcast(repeated)
    unique = hashed.join(rep, "__h", "left_anti")
    candidates = hashed.join(rep, "__h", "left_semi").dropDuplicates(cols + ["__h"])
    return unique.unionByName(candidates).drop("__h")


def _hash_input(df: DataFrame, c: str) -> Column:
    """Hash input normalised like the dedup's own equality: -0.0 equals 0.0."""
    from pyspark.sql.types import DoubleType, FloatType

    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return col + F.lit(0.0).cast(df.schema[c].dataType)
    return col


def _has_nested_float(df: DataFrame, cols: Sequence[str]) -> bool:
    from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StructType

    def nested(t, top):
        if isinstance(t, (DoubleType, FloatType)):
            return not top
        if isinstance(t, ArrayType):
            return nested(t.elementType, False)
        if isinstance(t, MapType):
            return nested(t.keyType, False) or nested(t.valueType, False)
        if isinstance(t, StructType):
            return any(nested(f.dataType, False) for f in t.fields)
        return False

    return any(nested(df.schema[c].dataType, True) for c in cols)


def fill_text(df: DataFrame, value: str, subset: Sequence[str]) -> DataFrame:
    """Null strings in ``subset`` -> ``value`` (F4); other types untouched."""
    return df.na.fill(value, subset=list(subset))


def fill_number(df: DataFrame, value: float | int, subset: Sequence[str]) -> DataFrame:
    """Null numbers in ``subset`` -> ``value`` (F5); string columns untouched."""
    return df.na.fill(value, subset=list(subset))


def drop_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``subset`` (F6), or in any column."""
    if subset:
        return df.na.drop(how="any", subset=list(subset))
    return df.na.drop(how="any")


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose string column is null or empty (decision D3)."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def epoch_ms_to_date(col: str | Column) -> Column:
    """Epoch milliseconds -> date in the session time zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c).cast("date")


def text_to_date(col: str | Column, fmt: str = "yyyy-MM-dd", prefix: int = 10) -> Column:
    """Leading ``prefix`` characters parsed as a date; bad text -> null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(F.substring(c, 1, prefix), fmt)


def to_int_rating(col: str | Column) -> Column:
    """Numeric rating -> int, truncating toward zero."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("int")


def dedup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of every repeated column name.

    Columns are renamed by position first, so a name that occurs twice can be
    addressed; then the first occurrence of each name is selected.
    """
    names = df.columns
    tmp = [f"__c{i}" for i in range(len(names))]
    renamed = df.toDF(*tmp)
    first: dict[str, int] = {}
    for i, n in enumerate(names):
        first.setdefault(n, i)
    return renamed.select([F.col(tmp[i]).alias(n) for n, i in first.items()])
