"""Table profiles kept per unit beside a layer and merged on demand.

``run_profile`` profiles the units that changed since its last run and takes
out those that went; other units are not read. A unit's profile is one row per
column: rows, non-null rows and a HyperLogLog sketch of the values.
``layer_profile`` adds the units' profiles up: counts are exact, distinct
counts are within the sketch's error, as if one sketch had seen every unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.plans.versioned import VersionedRun, run_versioned_stage
from plazalens.sources.io import read_layer

LG_K = 12  # 4,096 registers: at most 4 KB a column and unit
#: relative standard error of a distinct count (1.04 / sqrt(registers))
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)

_UNIT = "source_file"


def _value_hash(name: str, dtype: str) -> Column:
    """64 bits of a value, null for a null; -0.0 is 0.0. A map has no hash of its own: its sorted entries have."""
    c = F.col(f"`{name}`")
    if dtype.startswith("map<"):
        c = F.sort_array(F.map_entries(c))
    elif "map<" in dtype:
        c = F.to_json(c)
    return F.when(F.col(f"`{name}`").isNotNull(), F.xxhash64(c))


def unit_profiles(df: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(column_name, ordinal, data_type, rows, non_null, sketch, source_file): a row per column and unit of ``df``.

    One partial aggregate per unit: a hot unit sends one row per partition.
    """
    fields = [(n, t) for n, t in df.dtypes if n != _UNIT]
    if not fields:
        raise ValueError("no column to profile")
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, (n, t) in enumerate(fields):
        aggs.append(F.count(F.col(f"`{n}`")).alias(f"__n{i}"))
        aggs.append(F.hll_sketch_agg(_value_hash(n, t), F.lit(lg_k)).alias(f"__s{i}"))
    wide = df.groupBy(_UNIT).agg(*aggs)
    columns = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("ordinal"), F.lit(t).alias("data_type"),
                                 F.col("__rows").alias("rows"), F.col(f"__n{i}").alias("non_null"),
                                 F.col(f"__s{i}").alias("sketch")) for i, (n, t) in enumerate(fields)])
    return wide.select(F.explode(columns).alias("c"), _UNIT).select("c.*", _UNIT)


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type, rows, non_null, nulls, distinct_values) over all units of ``profiles``.

    A unit made before a column was added counts as nulls of that column, as
    it reads back. ``distinct_values`` is an estimate (:data:`DISTINCT_ERROR`).
    """
    rows = profiles.groupBy(_UNIT).agg(F.max("rows").alias("rows")).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    merged = profiles.groupBy("column_name").agg(
        F.max("ordinal").alias("ordinal"), F.max("data_type").alias("data_type"),
        F.sum("non_null").alias("non_null"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
    return merged.join(F.broadcast(rows)).select(  # one row
        "ordinal", "column_name", "data_type", "rows", "non_null", (F.col("rows") - F.col("non_null")).alias("nulls"),
        "distinct_values")


def run_profile(spark: SparkSession, source_dataset: str, lake: str, platform: str,
                source: tuple[str, str]) -> VersionedRun:
    """Brings the profiles of a versioned layer (``source`` is (layer, entity)) up to its units."""
    layer, entity = source
    return run_versioned_stage(spark, source_dataset, f"{source_dataset}:profile:{layer}", lake, platform, source,
                               ("profile", f"{entity}_{layer}"), unit_profiles, rebalance=False)


def layer_profile(spark: SparkSession, lake: str, platform: str, source: tuple[str, str],
                  unit: str | None = None) -> DataFrame:
    """The profile of a layer, or of one unit, from its units' profiles; the layer itself is not read."""
    return merge_profiles(read_layer(spark, lake, "profile", platform, f"{source[1]}_{source[0]}", unit))
