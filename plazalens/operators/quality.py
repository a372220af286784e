"""Table checks: null counts, profiles, contracts, key uniqueness.

Each check is one aggregation over the table (one scan), returned as a
small DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lit(s: str) -> str:
    """A SQL string literal for a column or type name."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, one bigint column per input column: its number of nulls (A1)."""
    cols = list(cols or df.columns)
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for each named DataFrame (A2, A3), in one plan."""
    parts = [df.select(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"))
             for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_count(df: DataFrame, cols: str | Sequence[str], approx: bool = False,
                   alias: str = "distinct_keys") -> DataFrame:
    """Exact (or approximate) number of distinct keys (A4)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if approx:
        key = F.struct(*cols) if len(cols) > 1 else F.col(cols[0])
        return df.select(F.approx_count_distinct(key).alias(alias))
    return df.select(F.count_distinct(*[F.col(c) for c in cols]).alias(alias))


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, non-null and null counts.

    One wide aggregation, then ``stack`` turns it into one row per column.
    """
    cols = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"__nn{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    args = ", ".join(
        f"{i}, {_lit(c)}, {_lit(types[c])}, __nn{i}" for i, c in enumerate(cols)
    )
    long = wide.selectExpr(
        "__rows", f"stack({len(cols)}, {args}) AS (ordinal, column_name, data_type, non_null)"
    )
    return long.select(
        F.col("ordinal").cast("int").alias("ordinal"), "column_name", "data_type",
        F.col("__rows").alias("rows"), "non_null",
        (F.col("__rows") - F.col("non_null")).alias("nulls"),
    )


def contract_violations(df: DataFrame, contract: Sequence[tuple]) -> DataFrame:
    """Rows (column_name, check, violations) for a warehouse contract.

    ``contract`` items are (column, type, not_null, max_length). Checked in
    one aggregation: nulls in NOT NULL columns, strings longer than their cap
    (in characters), and - from the schema alone - a missing column or a
    type that differs (violations = -1 for those schema findings).
    """
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, checks = [], []
    schema_rows = []
    for i, (col, typ, not_null, max_len) in enumerate(contract):
        if col not in present:
            schema_rows.append((col, "missing", -1))
            continue
        if present[col] != typ:
            schema_rows.append((col, f"type {present[col]} <> {typ}", -1))
        if not_null:
            aggs.append(F.count_if(F.col(f"`{col}`").isNull()).alias(f"__n{i}"))
            checks.append((col, "not_null", f"__n{i}"))
        if max_len is not None and present[col] == "string":
            aggs.append(F.count_if(F.char_length(F.col(f"`{col}`")) > max_len).alias(f"__l{i}"))
            checks.append((col, f"max_length {max_len}", f"__l{i}"))
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("__rows")]
    wide = df.agg(*aggs)
    n = len(checks) + len(schema_rows)
    if n == 0:
        return wide.selectExpr("CAST(NULL AS STRING) AS column_name", "CAST(NULL AS STRING) AS check",
                               "CAST(0 AS BIGINT) AS violations").limit(0)
    stack_args = [f"{_lit(c)}, {_lit(k)}, {ref}" for c, k, ref in checks]
    stack_args += [f"{_lit(c)}, {_lit(k)}, CAST({v} AS BIGINT)" for c, k, v in schema_rows]
    return wide.selectExpr(f"stack({n}, {', '.join(stack_args)}) AS (column_name, check, violations)")


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count.

    A partial count per key runs before the shuffle, so a hot key costs one
    row per partition, not one per occurrence.
    """
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
              .filter(F.col("occurrences") > 1))
