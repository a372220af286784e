"""Strict table loads: all rows of a source fit the contract, or nothing is loaded."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plazalens.operators.quality import pk_duplicates
from plazalens.schemas import CONTRACTS, PRIMARY_KEYS
from plazalens.sources.io import read_parquet, select_by_ordinal, write_parquet


class LoadError(ValueError):
    """A load that found rows outside the table's contract."""


def _file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def load_table(df: DataFrame, table: str, path: str, ordinals: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """Loads ``df`` into ``path`` as ``table`` and returns the loaded table.

    Columns are taken by ordinal and cast to the contract's types; a value
    that does not cast is a violation, like a null in a NOT NULL column or a
    text over its length. One pass writes the rows to a staging folder beside
    ``path`` and counts the violations as it goes; only a clean load is
    renamed to ``path`` (which must not exist yet). A failed one raises
    :class:`LoadError`, and nothing of it is seen. On a store that copies
    instead of renaming, use :func:`append_table`, which renames nothing.
    """
    spark = df.sparkSession
    target, files = _file_system(spark, path)
    if files.exists(target):
        raise LoadError(f"{path} exists")
    staging = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex[:12]}"
    schema = _write_checked(df, table, staging, ordinals)
    if not files.rename(_file_system(spark, staging)[0], target):
        raise LoadError(f"{staging} could not be renamed to {path}")
    return read_parquet(spark, path, schema=schema)


def _write_checked(df: DataFrame, table: str, staging: str, ordinals: Sequence[tuple[str, int]] | None) -> StructType:
    """Writes the rows to ``staging`` in contract types; a violation removes them and raises."""
    spark = df.sparkSession
    chosen = select_by_ordinal(df, table, ordinals, cast=False)
    checks, values = {}, []
    for column, kind, not_null, longest in CONTRACTS[table]:
        if column not in chosen.columns:
            continue
        raw = F.col(f"`{column}`")
        value = raw.try_cast(kind)
        values.append(value.alias(column))
        checks[f"{column} does not cast to {kind}"] = raw.isNotNull() & value.isNull()
        if not_null:
            checks[f"{column} is null"] = raw.isNull()
        if longest is not None:
            checks[f"{column} is longer than {longest}"] = F.char_length(value) > longest
    names = list(checks)
    seen = Observation()
    counted = chosen.observe(seen, *[F.count_if(checks[n]).alias(f"c{i}") for i, n in enumerate(names)])
    rows = counted.select(*values).select(chosen.columns)
    write_parquet(rows, staging)
    wrong = {n: seen.get[f"c{i}"] for i, n in enumerate(names) if seen.get[f"c{i}"]}
    if wrong:
        _drop(spark, staging)
        raise LoadError(f"{table}: " + "; ".join(f"{n}: {k} rows" for n, k in wrong.items()))
    return rows.schema


def _drop(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.delete(at, True)


def _published(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """(number, loads) of the last pointer file of a table."""
    at, files = _file_system(spark, f"{path}/_published")
    if not files.exists(at):
        return 0, []
    number = max((int(f.getPath().getName()) for f in files.listStatus(at) if f.getPath().getName().isdigit()), default=0)
    if not number:
        return 0, []
    return number, json.loads(spark.read.text(f"{path}/_published/{number}", wholetext=True).first()[0])


def _publish(spark: SparkSession, path: str, number: int, loads: list[str]) -> None:
    """Writes pointer file ``number``, which no other load may have written."""
    at, files = _file_system(spark, f"{path}/_published/{number}")
    try:
        out = files.create(at, False)
    except Py4JJavaError as e:
        raise LoadError(f"{path}: another load was published at the same time") from e
    out.write(bytearray(json.dumps(loads).encode()))
    out.close()


def append_table(df: DataFrame, table: str, path: str, ordinals: Sequence[tuple[str, int]] | None = None,
                 keys: Sequence[str] | None = None) -> DataFrame:
    """Appends ``df`` to the table at ``path`` as one load, all rows or none, and returns the whole table.

    A load is a folder that no reader knows until a pointer file names it; the
    pointer is one small file, created once, so nothing is renamed or copied
    and a reader sees all of a load or nothing. Rows are checked against the
    contract as in :func:`load_table`. The primary key is checked too: a key
    that comes twice in the load, or that an earlier load holds, refuses the
    load. The keys of each load are kept beside it, so earlier rows are not
    read. A refused load leaves nothing behind; a load that died before its
    pointer was written is never seen, and may simply be repeated.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    keys = list(keys or PRIMARY_KEYS[table])
    number, loads = _published(spark, path)
    name = f"load-{uuid.uuid4().hex[:12]}"
    try:
        schema = _write_checked(df, table, f"{path}/{name}/rows", ordinals)
        rows = spark.read.schema(schema).parquet(f"{path}/{name}/rows")
        write_parquet(rows.select(keys), f"{path}/{name}/keys")
        new = spark.read.schema(rows.select(keys).schema).parquet(f"{path}/{name}/keys")
        wrong = {"comes twice": pk_duplicates(new, keys).count()}
        if loads:
            old = spark.read.schema(new.schema).parquet(*[f"{path}/{x}/keys" for x in loads])
            wrong["is loaded already"] = new.join(old, keys, "left_semi").count()
        if any(wrong.values()):
            raise LoadError(f"{table}: " + "; ".join(f"key {', '.join(keys)} {why}: {n}" for why, n in wrong.items() if n))
        _publish(spark, path, number + 1, [*loads, name])
    except Exception:
        _drop(spark, f"{path}/{name}")
        raise
    return read_table(spark, path, table)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All published loads of an appended table."""
    path = path.rstrip("/")
    _, loads = _published(spark, path)
    if not loads:
        raise LoadError(f"{path} holds no load of {table}")
    return spark.read.parquet(*[f"{path}/{x}/rows" for x in loads])


def drop_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Removes the folders of loads that died before they were published; run it while no load is under way."""
    path = path.rstrip("/")
    _, loads = _published(spark, path)
    at, files = _file_system(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    dead = sorted(n for n in names if n.startswith("load-") and n not in loads)
    for n in dead:
        _drop(spark, f"{path}/{n}")
    return dead
