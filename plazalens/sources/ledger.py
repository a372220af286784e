"""Ledger of processed input units.

One ledger for every dataset, keyed by (dataset, file_name) (D7). It is an
append-only Parquet table; a missing ledger reads as an empty typed table
(D15), so a first run needs no set-up step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.operators.join import anti_keys
from plazalens.schemas import LEDGER
from plazalens.sources.io import path_exists


def read_ledger(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """The ledger, or an empty typed table when it does not exist yet."""
    df = spark.read.schema(LEDGER).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], LEDGER)
    if dataset is not None:
        df = df.filter(F.col("dataset") == dataset)
    return df


def new_units(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed units not yet in the ledger (S12, J4, U2): a left anti join."""
    return anti_keys(listed.select("file_name").distinct(), ledger, "file_name")


def append_ledger(spark: SparkSession, path: str, dataset: str, names: Sequence[str] | DataFrame) -> None:
    """Record processed units (S13). Typed, so an empty batch is fine."""
    if isinstance(names, DataFrame):
        df = names.select(F.lit(dataset).alias("dataset"), F.col("file_name"))
    else:
        df = spark.createDataFrame([(dataset, n) for n in names], LEDGER)
    df.write.mode("append").parquet(path)
