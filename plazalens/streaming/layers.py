"""Bronze and silver layers kept by a stream.

Each micro-batch is one unit of the layers, named after the stream and the
batch number, and is written like any other unit: bronze first, then silver
and rejects from the written bronze, then the ledger. A batch that died
anywhere in between is run again by Spark under the same number and replaces
its own partitions, so it leaves no second copy; the ledger names it once.
Later stages (``run_stage``) take the batches from the ledger.

Copies of rows in other batches are dropped by streaming state: a 128-bit hash
per row, kept for ``dedup_window`` after the row came. The clock is that of
arrival (the batch's own time, which a repeated batch keeps), so no row is
dropped for being late.

What a run holds on disk beside the layers and the state is bounded by a batch,
not by the input: batches with state have a size, a batch's shuffle files go as soon as
bronze (or silver) is written, and the state keeps two versions. The state lies
in RocksDB, so its memory is bounded too; a checkpoint begun with another store
keeps that one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plazalens.plans.incremental import of_units
from plazalens.plans.versioned import row_hashes
from plazalens.sources.io import (
    CORRUPT,
    declare_layer,
    layer_path,
    path_exists,
    read_declared,
    split_rejects,
    write_parquet,
)
from plazalens.sources.ledger import append_ledger, new_units, read_ledger

#: bytes of input files in a batch with state, where the caller says nothing
BATCH_BYTES = 1 << 30

#: settings of the stream's own session, where the caller's has none
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",  # a count that costs a look-up a row
    # versions of the state that are kept: a batch run again needs the last one
    "spark.sql.streaming.minBatchesToRetain": "2",
    # shuffle files of a written layer go with its job
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def _stream_conf(spark: SparkSession) -> Iterator[None]:
    """:data:`STREAM_CONF` while a stream starts: it takes a copy of the session's settings, the session gets its own back."""
    unset = [k for k in STREAM_CONF if spark.conf.get(k, None) is None]
    for k in unset:
        spark.conf.set(k, STREAM_CONF[k])
    try:
        yield
    finally:
        for k in unset:
            spark.conf.unset(k)


def _drop_shuffles(batch: DataFrame) -> None:
    """Removes the shuffle files of a batch that is written: Spark keeps a stream's until the driver collects its garbage."""
    cleaner = batch.sparkSession.sparkContext._jsc.sc().cleaner()
    rdds, seen = [batch._jdf.queryExecution().toRdd()], set()
    while rdds:
        rdd = rdds.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        deps = rdd.dependencies()
        for d in (deps.apply(i) for i in range(deps.size())):
            if d.getClass().getSimpleName() == "ShuffleDependency" and cleaner.isDefined():
                cleaner.get().doCleanupShuffle(d.shuffleId(), True)
            rdds.append(d.rdd())


def _put(df: DataFrame, path: str) -> None:
    write_parquet(df, path, mode="overwrite", partition_by=["source_file"])
    declare_layer(df.sparkSession, path, df.schema)


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint: another checkpoint never writes this one's units."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stream_layers(spark: SparkSession, dataset: str, source_dir: str, schema: StructType, lake: str, platform: str,
                  entity: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame],
                  dedup_columns: Sequence[str] | None = None, dedup_window: str = "7 days",
                  max_files_per_trigger: int | None = None, ledger_path: str | None = None,
                  max_bytes_per_trigger: int | None = None) -> None:
    """Takes every JSON file below ``source_dir`` not seen yet into bronze and silver, in batches, and stops.

    ``transform`` maps a batch of bronze to silver and keeps ``source_file``.
    With ``dedup_columns`` a row whose values in them came before, in this or
    another batch within ``dedup_window``, stays out. Records that do not fit
    ``schema`` pass the state by (which reads the batch's files once more), so
    none is dropped as a copy; they stay in bronze with their text and go to
    the layer ``rejects``. A source without files writes nothing.

    A batch takes so many files, or files of so many bytes in all as they lie
    there (compressed or not), one at least. Where neither is given, a run with
    ``dedup_columns`` takes ``BATCH_BYTES``, as the state knows the copies in
    other batches, and a run without them is one batch.
    """
    ledger_path = ledger_path or f"{lake.rstrip('/')}/_ledger"
    path = {x: layer_path(lake, x, platform, entity) for x in ("bronze", "silver", "rejects")}
    reader = spark.readStream.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())])).option(
        "columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger or dedup_columns:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger or BATCH_BYTES))
    stream = reader.json(source_dir)
    if dedup_columns:
        good, bad = stream.filter(F.col(CORRUPT).isNull()), stream.filter(F.col(CORRUPT).isNotNull())
        marked = good.select("*", F.current_timestamp().alias("_came"), *row_hashes(good, dedup_columns))
        kept = marked.withWatermark("_came", dedup_window).dropDuplicatesWithinWatermark(["h1", "h2"])
        stream = kept.select(stream.columns).unionByName(bad)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        unit = f"{_stream_name(session, checkpoint)}-{number:012d}"
        _put(batch.withColumn("source_file", F.lit(unit)), path["bronze"])
        _drop_shuffles(batch)
        if not path_exists(session, f"{path['bronze']}/source_file={unit}"):  # a batch without rows
            return
        units = session.createDataFrame([(unit,)], "file_name string")
        good, bad = split_rejects(of_units(read_declared(session, path["bronze"]), [unit]))
        _put(bad, path["rejects"])
        _put(transform(good), path["silver"])
        fresh = new_units(units, read_ledger(session, ledger_path, dataset))
        if not fresh.isEmpty():
            append_ledger(session, ledger_path, dataset, fresh)

    with _stream_conf(spark):
        query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
    query.awaitTermination()
