"""Layer runs that follow their input: grown, changed and withdrawn units, late keys, global dedup.

A state table beside the layers holds, for each dataset and unit, the version
that was made and the version that it was made from. A raw unit's version
comes from its files (path, length, modification time), a later stage's from
the stage before. A run compares the two: units that are new or differ are
made again, units that are gone are taken out, and the others are not read.

* **Late and withdrawn keys.** A stage that keeps the rows whose key is known
  (gold: reviews of known places) also keeps, per unit, the distinct keys of
  all its rows. The key set of each run is stored; keys that came or went since
  the last one name the units that must be made again, through that index.
* **Global dedup.** An index of 128-bit row hashes per unit says which unit
  keeps a row. A run meets the index, never the rows of other units. When a
  unit that kept rows changes or goes, the units that hold copies are made
  again too.

The state is written last: a run that died is repeated from the same state,
and its writes replace the same partitions. A unit that is made again is
absent from a layer between the removal of its old rows and its new ones.
Two writes of one length within one tick of the store's clock look the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.plans.incremental import Reader, Transform, of_units, write_layer
from plazalens.sources.io import (
    layer_path,
    list_files,
    path_exists,
    read_declared,
    remove_path,
    remove_units,
    split_rejects,
    unit_of,
)

STATE = "dataset string, file_name string, version string, made_from string, run long"


class VersionedRun(NamedTuple):
    """Units made (again) and taken out by one run, and the rows that it wrote to its target layer."""

    made: list[str]
    withdrawn: list[str]
    rows: int = 0
    rejected_rows: int = 0


def unit_versions(spark: SparkSession, root: str) -> DataFrame:
    """(file_name, version) of the units below ``root``, from the files' paths, lengths and modification times."""
    files = list_files(spark, root).withColumn("file_name", unit_of(F.col("path"), root))
    return files.groupBy("file_name").agg(F.concat_ws(
        ":", F.count("*"), F.sum("length"), F.hex(F.bit_xor(F.xxhash64("path", "length", "modificationTime")))).alias("version"))


def read_state(spark: SparkSession, lake: str, dataset: str) -> DataFrame:
    """(file_name, version, made_from) of the dataset's live units."""
    path = _state_path(lake)
    rows = spark.read.schema(STATE).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], STATE)
    last = rows.filter(F.col("dataset") == dataset).groupBy("file_name").agg(
        F.max_by(F.struct("version", "made_from"), "run").alias("s"))
    return last.select("file_name", "s.*").filter(F.col("version").isNotNull())


def _state_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/_units"


def _next_run(spark: SparkSession, lake: str) -> int:
    path = _state_path(lake)
    if not path_exists(spark, path):
        return 1
    return (spark.read.schema(STATE).parquet(path).agg(F.max("run")).first()[0] or 0) + 1


def _record(spark: SparkSession, lake: str, dataset: str, run: int, source: DataFrame, made: list[str],
            withdrawn: list[str], extra: Sequence[tuple[str, str]] = ()) -> None:
    """Appends the run's units; ``source`` has (file_name, version) of what they were made from."""
    names = spark.createDataFrame([(n,) for n in made], "file_name string")
    rows = names.join(source.select("file_name", F.col("version").alias("made_from")), "file_name", "left").select(
        F.lit(dataset).alias("dataset"), "file_name", F.lit(str(run)).alias("version"), "made_from", F.lit(run).cast("long").alias("run"))
    gone = spark.createDataFrame([(dataset, n, None, None, run) for n in withdrawn]
                                 + [(d, "keys", v, v, run) for d, v in extra], STATE)
    rows.unionByName(gone).coalesce(1).write.mode("append").parquet(_state_path(lake))


def _changes(now: DataFrame, before: DataFrame) -> tuple[list[str], list[str], set[str]]:
    """Names of the units to make and to take out, and of those known before; unit names only, never rows."""
    both = now.join(before.select("file_name", F.col("made_from").alias("old")), "file_name", "full").filter(
        ~F.col("version").eqNullSafe(F.col("old"))).select(
        "file_name", F.col("version").isNull().alias("gone"), F.col("old").isNotNull().alias("known")).collect()
    return (sorted(r.file_name for r in both if not r.gone), sorted(r.file_name for r in both if r.gone),
            {r.file_name for r in both if r.known})


def row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """128 bits of a row; a null differs from any value, and -0.0 from 0.0 does not."""
    cols = [F.col(f"`{c}`") + F.lit(0.0).cast(t) if t in ("double", "float") else F.col(f"`{c}`")
            for c, t in df.select(*[f"`{c}`" for c in columns]).dtypes]
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(F.lit(k), nulls, *cols).alias(f"h{k}") for k in (1, 2)]


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    return read_declared(spark, path) if path_exists(spark, f"{path}/_schema") else None


def _copies_of(index: DataFrame | None, names: list[str]) -> list[str]:
    """Other units that hold copies of rows that the named units keep."""
    if index is None or not names:
        return []
    mine = F.col("source_file").isin(names)  # partition column: a filter on folders
    kept = index.filter(mine & F.col("kept")).select("h1", "h2")
    return sorted(r.source_file for r in index.filter(~mine & ~F.col("kept")).join(kept, ["h1", "h2"], "left_semi")
                  .select("source_file").distinct().collect())


def run_versioned(spark: SparkSession, dataset: str, raw_root: str, lake: str, platform: str, entity: str,
                  reader: Reader, transform: Transform, dedup_columns: Sequence[str] | None = None,
                  rebalance: bool = True) -> VersionedRun:
    """Brings bronze and silver of ``entity`` up to the raw units as they are now.

    With ``dedup_columns`` a row whose values in them occur in several units
    stays in one of them only, whenever they came.
    """
    now = unit_versions(spark, raw_root)
    made, withdrawn, known = _changes(now, read_state(spark, lake, dataset))
    if not made and not withdrawn:
        return VersionedRun([], [])
    run = _next_run(spark, lake)
    path = {x: layer_path(lake, x, platform, entity) for x in ("bronze", "silver", "rejects", "row_index")}
    again: list[str] = []
    if dedup_columns:
        again = _copies_of(_index(spark, path["row_index"]), sorted(known))
        again = [n for n in again if n not in made and n not in withdrawn]
    old = sorted(known | set(again))
    for layer in path:
        remove_units(spark, path[layer], [n for n in old if layer != "bronze" or n in known])
    rows = bad_rows = 0
    todo = sorted({*made, *again})
    if made:
        raw = reader(spark, [f"{raw_root.rstrip('/')}/{n}" for n in made], raw_root)
        write_layer(raw, lake, "bronze", platform, entity, rebalance=False)
    if todo:
        good, bad = split_rejects(of_units(read_declared(spark, path["bronze"]), todo))
        bad_rows = write_layer(bad, lake, "rejects", platform, entity, rebalance)
        if dedup_columns:
            good = _keep_first_copies(spark, good, dedup_columns, todo, lake, platform, entity)
        rows = write_layer(transform(good), lake, "silver", platform, entity, rebalance)
    _record(spark, lake, dataset, run, now, todo, withdrawn)
    return VersionedRun(todo, withdrawn, rows, bad_rows)


def _keep_first_copies(spark: SparkSession, good: DataFrame, columns: Sequence[str], todo: list[str], lake: str,
                       platform: str, entity: str) -> DataFrame:
    """Rows that no other unit keeps, each in the first of the units at hand; their hashes go to the index."""
    path = layer_path(lake, "row_index", platform, entity)
    hashed = good.select("*", *row_hashes(good, columns))
    held = hashed.select("h1", "h2", "source_file").distinct()
    first = held.groupBy("h1", "h2").agg(F.min("source_file").alias("first"))
    index = _index(spark, path)
    if index is not None:
        elsewhere = index.filter(~F.col("source_file").isin(todo) & F.col("kept")).select("h1", "h2")
        first = first.join(elsewhere, ["h1", "h2"], "left_anti")
    marked = held.join(first, ["h1", "h2"], "left").select(
        "h1", "h2", F.coalesce(F.col("first") == F.col("source_file"), F.lit(False)).alias("kept"), "source_file")
    write_layer(marked, lake, "row_index", platform, entity, True)
    kept = of_units(read_declared(spark, path), todo).filter("kept").select("h1", "h2", "source_file")
    return hashed.join(kept, ["h1", "h2", "source_file"], "left_semi").select(good.columns)


def run_versioned_stage(spark: SparkSession, source_dataset: str, dataset: str, lake: str, platform: str,
                        source: tuple[str, str], target: tuple[str, str], transform: Callable[[DataFrame], DataFrame],
                        keys: DataFrame | None = None, on: str | None = None, rebalance: bool = True) -> VersionedRun:
    """Brings a later layer up to the layer before it, and to the ``keys`` that decide which of its rows stay.

    ``transform`` maps the rows of the units at hand (with ``source_file``);
    where it keeps only rows whose ``on`` is in ``keys``, both are given here,
    so that keys that came or went since the last run reach their old units.
    """
    now = read_state(spark, lake, source_dataset).select("file_name", "version")
    made, withdrawn, known = _changes(now, read_state(spark, lake, dataset))
    links = layer_path(lake, "key_index", platform, target[1])
    key_sets = f"{lake.rstrip('/')}/_keys/{dataset.replace(':', '_')}"
    run, extra, late, last = _next_run(spark, lake), [], [], None
    if keys is not None:
        fresh = f"{key_sets}/run={run}"
        keys.select(on).filter(F.col(on).isNotNull()).distinct().write.mode("overwrite").parquet(fresh)
        new, last = spark.read.parquet(fresh), read_state(spark, lake, f"{dataset}:keys").first()
        if last is not None:
            old = spark.read.schema(new.schema).parquet(f"{key_sets}/run={last.version}")
            moved = new.join(old, on, "left_anti").unionByName(old.join(new, on, "left_anti"))
            held = _index(spark, links)
            if held is not None:
                late = [r.source_file for r in held.join(moved, on, "left_semi").select("source_file").distinct().collect()]
        extra = [(f"{dataset}:keys", str(run))]
    todo = sorted({*made, *(n for n in late if n not in withdrawn)})
    rows = 0
    if todo or withdrawn:
        old_units = sorted(known | set(late))
        remove_units(spark, layer_path(lake, target[0], platform, target[1]), old_units)
        remove_units(spark, links, sorted(known))
    if todo:
        at_hand = of_units(read_declared(spark, layer_path(lake, source[0], platform, source[1])), todo)
        rows = write_layer(transform(at_hand), lake, target[0], platform, target[1], rebalance)
        if keys is not None:
            write_layer(at_hand.select(on, "source_file").distinct(), lake, "key_index", platform, target[1], rebalance)
    if todo or withdrawn or extra:
        _record(spark, lake, dataset, run, now, todo, withdrawn, extra)
        if last is not None:
            remove_path(spark, f"{key_sets}/run={last.version}")
    return VersionedRun(todo, withdrawn, rows)
