"""Incremental layer runs: each input unit processed once.

A run lists the units below the raw root, removes those in the ledger, reads
all new units in one multi-path scan (the unit of each row comes from the
file metadata), writes bronze and silver partitioned by unit and only then
records the units in the ledger. Later stages (gold, sentiment) take the
units that an earlier one recorded and they did not. Writes overwrite the unit
partitions they contain (dynamic overwrite), so a run that died after a write
is simply repeated: nothing is duplicated and nothing fails on existing output
(D14). Every layer is written with its declared schema and read back under
it, which also cuts the lineage at the layer boundary.

Records that do not fit the raw schema stay in bronze with their text in
``_corrupt_record``; the run counts them and writes them to the layer
``rejects``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plazalens.sources.io import (
    CORRUPT,
    declare_layer,
    layer_path,
    list_units,
    read_declared,
    split_rejects,
    write_parquet_counted,
)
from plazalens.sources.ledger import append_ledger, new_units, read_ledger

Reader = Callable[[SparkSession, list, str], DataFrame]
Transform = Callable[[DataFrame], DataFrame]


class IncrementalRun(NamedTuple):
    """Units processed by one run and the rows written, counted while writing."""

    units: list[str]
    bronze_rows: int = 0
    silver_rows: int = 0
    rejected_rows: int = 0


def of_units(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of the named units: a filter on the partition column, so other units are not read.

    No join: one by unit would leave each unit's rows in one task, and the
    steps after it (dedup, profile) would take that partitioning over.
    """
    return df.filter(F.col("source_file").isin(list(names)))


def write_layer(df: DataFrame, lake_root: str, layer: str, platform: str, entity: str, rebalance: bool) -> int:
    """Writes the units in ``df``; returns the rows written.

    ``rebalance`` redistributes by unit before the write: after a dedup
    shuffle every partition holds rows of every unit and would write a small
    file into each unit's folder; AQE then writes files of the advisory size
    and splits a hot unit over several tasks.
    """
    path = layer_path(lake_root, layer, platform, entity)
    out = df.hint("rebalance", "source_file") if rebalance else df
    rows = write_parquet_counted(out, path, mode="overwrite", partition_by=["source_file"],
                                 name=f"{platform}-{entity}-{layer}")
    declare_layer(df.sparkSession, path, df.schema)  # after the data: no reader meets a column that is not there
    return rows


def run_incremental(spark: SparkSession, dataset: str, raw_root: str, lake_root: str,
                    platform: str, entity: str, reader: Reader, transform: Transform,
                    ledger_path: str | None = None, rebalance: bool = True) -> IncrementalRun:
    """Process the new units of one dataset; return what was processed.

    ``reader(spark, paths, unit_root)`` must return the raw rows with a
    ``source_file`` column; ``transform`` maps bronze to silver.
    """
    ledger_path = ledger_path or f"{lake_root.rstrip('/')}/_ledger"
    listed = list_units(spark, raw_root)
    fresh = new_units(listed, read_ledger(spark, ledger_path, dataset))
    # Unit names only (one per input file or folder): the list of paths the
    # reader needs, bounded by the number of inputs, never by their rows.
    names = sorted(r.file_name for r in fresh.collect())
    if not names:
        return IncrementalRun([])
    raw = reader(spark, [f"{raw_root.rstrip('/')}/{n}" for n in names], raw_root)
    corrupt, seen = CORRUPT in raw.columns, Observation()
    if corrupt:
        raw = raw.observe(seen, F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"))
    n_bronze = write_layer(raw, lake_root, "bronze", platform, entity, rebalance=False)
    units = spark.createDataFrame([(n,) for n in names], "file_name string")
    bronze = of_units(read_declared(spark, layer_path(lake_root, "bronze", platform, entity)), names)
    good, bad = split_rejects(bronze)
    n_bad = 0
    if corrupt and seen.get["bad"]:
        n_bad = write_layer(bad, lake_root, "rejects", platform, entity, rebalance)
    elif corrupt:  # nothing to scan bronze for
        declare_layer(spark, layer_path(lake_root, "rejects", platform, entity), bad.schema)
    n_silver = write_layer(transform(good), lake_root, "silver", platform, entity, rebalance)
    append_ledger(spark, ledger_path, dataset, units)
    return IncrementalRun(names, n_bronze, n_silver, n_bad)


def run_stage(spark: SparkSession, source_dataset: str, dataset: str, lake_root: str, platform: str,
              source: tuple[str, str], target: tuple[str, str], transform: Transform,
              ledger_path: str | None = None, rebalance: bool = True) -> IncrementalRun:
    """Process the units that ``source_dataset`` recorded and ``dataset`` did not yet.

    ``source`` and ``target`` are (layer, entity); ``transform`` keeps the
    ``source_file`` column. The rows written are reported as ``silver_rows``
    whatever the target layer.
    """
    ledger_path = ledger_path or f"{lake_root.rstrip('/')}/_ledger"
    fresh = new_units(read_ledger(spark, ledger_path, source_dataset), read_ledger(spark, ledger_path, dataset))
    names = sorted(r.file_name for r in fresh.collect())  # unit names only
    if not names:
        return IncrementalRun([])
    units = spark.createDataFrame([(n,) for n in names], "file_name string")
    rows = of_units(read_declared(spark, layer_path(lake_root, source[0], platform, source[1])), names)
    n = write_layer(transform(rows), lake_root, target[0], platform, target[1], rebalance)
    append_ledger(spark, ledger_path, dataset, units)
    return IncrementalRun(names, silver_rows=n)
