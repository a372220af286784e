"""Nested attribute flattening.

The reference expands the struct into a second frame, joins it back by a
generated row id and hopes both plans keep the same order (D6). Here the
list of true flags is a row expression over the struct: no join, no
shuffle, deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def struct_fields(df: DataFrame, col: str) -> list[str]:
    """Field names of a struct column, in struct order (from the schema)."""
    dt = df.schema[col].dataType
    if not isinstance(dt, StructType):
        raise TypeError(f"{col} is not a struct column")
    return dt.fieldNames()


def expand_struct(df: DataFrame, col: str) -> DataFrame:
    """One column per struct field (P5): ``select(col.*)``."""
    return df.select(f"{col}.*")


def true_flags(df: DataFrame, col: str, true_text: str = "True") -> list[Column]:
    """For each field, ``field = 'True'`` as a boolean column named like it."""
    return [(F.col(f"{col}.`{f}`") == F.lit(true_text)).alias(f) for f in struct_fields(df, col)]


def true_flag_names(df: DataFrame, col: str, sep: str = ", ", true_text: str = "True") -> Column:
    """Names of the fields equal to 'True', joined by ``sep``.

    ``concat_ws`` skips the nulls from unmatched ``when``: no true field (or a
    null struct) gives ``''``.
    """
    return F.concat_ws(
        sep,
        *[F.when(F.col(f"{col}.`{f}`") == F.lit(true_text), F.lit(f)) for f in struct_fields(df, col)],
    )


def attributes_list(df: DataFrame, col: str = "attributes", default: str | None = "Unknown",
                    strict_parity: bool = False) -> DataFrame:
    """Replace a struct of 'True'/'False' texts by the list of true names.

    ``strict_parity=True`` keeps ``''`` for no true field, as the reference
    ends up doing (its later null fill cannot fire, D5); otherwise ``''``
    becomes ``default``.
    """
    names = true_flag_names(df, col)
    if not strict_parity and default is not None:
        names = F.coalesce(F.nullif(names, F.lit("")), F.lit(default))
    return df.withColumn(col, names)
