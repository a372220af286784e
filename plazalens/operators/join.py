"""Join helpers: semi-join filters and size-checked broadcasts.

A side is broadcast only when its size is proven: either it is bounded by
construction (a fixed dimension, one row per request) or a cheap count of at
most ``max_rows + 1`` rows shows it is small. Beyond the bound the plain join
is used, and AQE chooses broadcast or sort-merge from runtime sizes and
splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 1_000_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint on ``df`` only behind a size check."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str],
                     broadcast_keys: bool | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (J2): a left semi join.

    Only the key columns of ``keys`` are read, and a key repeated in ``keys``
    never multiplies rows of ``df`` (D10). ``broadcast_keys=None`` leaves the
    strategy to AQE (runtime size); ``True`` forces a checked broadcast.
    """
    cols = [on] if isinstance(on, str) else list(on)
    k = keys.select(*cols)
    if broadcast_keys:
        k = maybe_broadcast(k)
    return df.join(k, cols, "left_semi")


def anti_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys``."""
    cols = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*cols), cols, "left_anti")

