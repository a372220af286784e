"""Readers, writers and layer paths.

Layer tables live at ``{root}/{layer}/{platform}/{entity}``, one Parquet
dataset per entity and layer, partitioned by the input unit
(``source_file``) so a rerun of one unit overwrites only that unit
(dynamic partition overwrite).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from plazalens.schemas import CONTRACTS, LOAD_ORDINALS, STATE_DIM, US_STATES

LAYERS = ("bronze", "silver", "gold", "rejects", "row_index", "key_index", "profile")


def layer_path(root: str, layer: str, platform: str, entity: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{platform}/{entity}"


#: column of the raw text of a record that does not fit the schema
CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
              columns: Sequence[str] | None = None, with_source: bool = False,
              unit_root: str | None = None, with_rejects: bool = False) -> DataFrame:
    """JSON lines with a declared schema, pruned to ``columns``.

    A broken line or a value of the wrong type fails the read, or, with
    ``with_rejects``, keeps its text in the column ``_corrupt_record`` (null
    for good records): see :func:`split_rejects` and ``run_incremental``.

    ``with_source`` adds ``source_file``: the input unit, i.e. the first path
    segment below ``unit_root`` (a file, or a folder of files), taken from
    the file metadata column.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("recursiveFileLookup", "true")
    if not with_rejects:
        return _finish(reader.schema(schema).option("mode", "FAILFAST").json(paths), columns, with_source, unit_root)
    df = reader.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())])).option(
        "columnNameOfCorruptRecord", CORRUPT).json(paths)
    return _finish(df, [*(columns or schema.fieldNames()), CORRUPT], with_source, unit_root)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, rejected rows as unit and text) of a written frame."""
    if CORRUPT not in df.columns:
        return df, df.limit(0).select(*[c for c in ("source_file",) if c in df.columns],
                                      F.lit(None).cast("string").alias(CORRUPT))
    unit = [c for c in ("source_file",) if c in df.columns]
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull()).select(*unit, CORRUPT)


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None,
                 columns: Sequence[str] | None = None, with_source: bool = False,
                 unit_root: str | None = None) -> DataFrame:
    """Parquet, optionally with a declared schema and a glob."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*paths)
    return _finish(df, columns, with_source, unit_root)


def unit_of(path_col, unit_root: str | None):
    """First path segment below ``unit_root`` of a file path column.

    File paths come back as URIs (``file:/...``, ``s3a://bucket/...``) with
    special characters percent-encoded; they are decoded first (a literal
    ``+`` is kept), so the unit name is the real folder or file name and
    ``root/unit`` is a readable path.
    """
    def decode(c):
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    if unit_root is None:
        return decode(F.substring_index(path_col, "/", -1))
    root = unit_root.rstrip("/")
    root = root[len("file:"):] if root.startswith("file:") else root
    # Fast path, plain string operations on every row: find "root/" in the
    # URI (wherever the scheme puts it) and take the next path segment;
    # only that short segment is decoded. A root that the URI spells
    # differently (it has characters the URI encodes) takes the regex path.
    needle = root + "/"
    pos = F.locate(needle, path_col)
    rest = path_col.substr(pos + F.lit(len(needle)), F.lit(1 << 20))
    fast = decode(F.substring_index(rest, "/", 1))
    slow = F.regexp_extract(decode(path_col), _re_escape(root) + r"/([^/]+)", 1)
    return F.when(pos > 0, fast).otherwise(slow)


def _re_escape(s: str) -> str:
    return "".join("\\" + c if c in "\\.^$|?*+()[]{}" else c for c in s)


def _finish(df: DataFrame, columns, with_source: bool, unit_root: str | None) -> DataFrame:
    cols = [F.col(c) for c in (columns or df.columns)]
    if with_source:
        cols.append(unit_of(F.col("_metadata.file_path"), unit_root).alias("source_file"))
    return df.select(*cols)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] | None = None, compression: str = "snappy") -> None:
    """Parquet sink (S7). Default mode fails if the target exists, as the
    reference's default save does; ``mode="overwrite"`` with ``partition_by``
    replaces only the partitions present in ``df`` (dynamic overwrite)."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if mode == "overwrite":
            # per-write option: only the partitions present in df are replaced
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_parquet_counted(df: DataFrame, path: str, mode: str = "errorifexists",
                          partition_by: Sequence[str] | None = None, name: str = "written") -> int:
    """Write like :func:`write_parquet` and return the number of rows written.

    The count is an ``observe()`` metric collected while the write runs, so
    the output is not read a second time just to count it (A2).
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, mode=mode,
                  partition_by=partition_by)
    return int(obs.get["rows"])


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    This cuts the lineage at a layer boundary in the shared scratch or lake
    folder, so a lost executor recomputes from the table, not from the raw
    input.
    """
    write_parquet(df, path, mode="overwrite" if partition_by else "errorifexists",
                  partition_by=partition_by)
    return df.sparkSession.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _declared(spark: SparkSession, path: str) -> tuple[int, StructType | None]:
    """(number, schema) of the layer's last schema."""
    if not path_exists(spark, f"{path}/_schema"):
        return 0, None
    rows = spark.read.option("recursiveFileLookup", "true").text(f"{path}/_schema").collect()  # one row a schema change
    number, schema = max((json.loads(r.value) for r in rows), key=lambda x: x[0])
    return number, StructType.fromJson(schema)


def _grown(last: DataType, new: DataType, name: str) -> DataType:
    """``last`` with the struct fields that only ``new`` has, at any depth; another type is refused."""
    if isinstance(last, StructType) and isinstance(new, StructType):
        old = set(last.fieldNames())
        fields = [StructField(f.name, _grown(f.dataType, new[f.name].dataType, f"{name}.{f.name}") if f.name in new.fieldNames()
                              else f.dataType) for f in last.fields]
        return StructType(fields + [f for f in new.fields if f.name not in old])
    if isinstance(last, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(_grown(last.elementType, new.elementType, f"{name}[]"))
    if last != new:
        raise ValueError(f"{name} is {last.simpleString()}, not {new.simpleString()}")
    return last


def _nullable(t: DataType) -> DataType:
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_nullable(t.elementType))
    if isinstance(t, MapType):
        return MapType(_nullable(t.keyType), _nullable(t.valueType))
    return t


def declare_layer(spark: SparkSession, path: str, schema: StructType) -> None:
    """Stores a layer table's schema beside its data (in a folder that Parquet readers skip).

    A schema is never replaced: one with columns, or fields of a struct at any
    depth, that the last one lacks is added under the next number, with those
    of both, so units written before and after read back whole (P5, P6). An
    unchanged schema is not written. A type that changed otherwise is refused.
    """
    number, last = _declared(spark, path)
    schema = _nullable(schema)
    if last is not None:
        last = _nullable(last)
        grown = _grown(last, schema, path)
        if grown == last:
            return
        unit = [f for f in grown.fields if f.name == "source_file"]
        schema = StructType([f for f in grown.fields if f.name != "source_file"] + unit)
    spark.createDataFrame([(json.dumps([number + 1, json.loads(schema.json())]),)], "value string").coalesce(1).write.text(
        f"{path}/_schema/{number + 1}")


def read_declared(spark: SparkSession, path: str) -> DataFrame:
    """A layer table under its declared schema: unit names stay text, and a table without rows is empty."""
    _, schema = _declared(spark, path)
    if schema is None:
        raise ValueError(f"{path} is no layer")
    return spark.read.schema(schema).parquet(path)


def remove_units(spark: SparkSession, path: str, units: Sequence[str]) -> None:
    """Takes the units' partitions out of a layer; unknown ones are passed over."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for unit in units:
        remove_path(spark, f"{path}/source_file={escape(unit)}")


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_layer(spark: SparkSession, root: str, layer: str, platform: str, entity: str,
               unit: str | None = None) -> DataFrame:
    """Read a layer back, whole or one input unit."""
    df = read_declared(spark, layer_path(root, layer, platform, entity))
    if unit is not None and "source_file" in df.columns:
        df = df.filter(F.col("source_file") == unit)
    return df


def select_by_ordinal(df: DataFrame, table: str, ordinals: Sequence[tuple[str, int]] | None = None,
                      cast: bool = True) -> DataFrame:
    """Warehouse bulk load mapping (S15, P10): target column <- source column
    at a 1-based ordinal, cast to the contract type; columns not listed are
    not loaded (as ``text`` is not, D22). ``sources.load.load_table`` checks
    and writes it."""
    ordinals = ordinals or LOAD_ORDINALS[table]
    types = {c: t for c, t, _, _ in CONTRACTS[table]}
    src = df.columns
    out = []
    for target, pos in ordinals:
        if not 1 <= pos <= len(src):
            raise ValueError(f"ordinal {pos} out of range for {len(src)} columns")
        source = F.col(f"`{src[pos - 1]}`")
        out.append((source.cast(types[target]) if cast else source).alias(target))
    return df.select(*out)


def state_dimension(spark: SparkSession) -> DataFrame:
    """The 50-row state table with its identity key 1..50."""
    rows = [(i, code, name) for i, (name, code) in enumerate(US_STATES, start=1)]
    return spark.createDataFrame(rows, STATE_DIM)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every non-empty file below ``root`` (path, size, modification time), content not read.

    A root that does not exist yet lists as empty (a first run before any
    input arrived).
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(root).select("path", "length", "modificationTime"))


def list_units(spark: SparkSession, root: str) -> DataFrame:
    """Input units below ``root``: the first path segment of each file."""
    return list_files(spark, root).select(unit_of(F.col("path"), root).alias("file_name")).distinct()
