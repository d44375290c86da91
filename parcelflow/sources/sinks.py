"""Sinks: CSV export, (partitioned) table writes, batch retention, JDBC refresh.

All writes are distributed (one file per task) unless ``single_file=True`` is asked for, which
is only meant for small reports.  Partitioned writes use dynamic partition overwrite, so a
re-run of a batch replaces exactly the partitions it produces and nothing else; re-running a
failed job is therefore idempotent.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import stringify_all
from . import versions
from .readers import CSV_OPTIONS


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_text: str | None = None,
              single_file: bool = False, header: bool = True) -> None:
    """Text export; timestamps as ``yyyy-MM-dd HH:mm:ss``; NULL as ``null_text`` (or the CSV
    NULL marker ``\\N`` when None, so a round trip gives NULL back)."""
    out = stringify_all(df, null_text)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode(mode).option("header", str(header).lower()).option("quote", CSV_OPTIONS["quote"])
     .option("nullValue", CSV_OPTIONS["nullValue"]).csv(path))


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _by_name(df: DataFrame, target: str) -> DataFrame:
    """``df`` in the column order of the catalog table ``target`` (``insertInto`` goes by position);
    an error if a column is missing on either side."""
    wanted = df.sparkSession.table(target).columns
    if set(wanted) != set(df.columns):
        raise ValueError(f"columns {sorted(set(wanted) ^ set(df.columns))} are not on both sides of {target}")
    return df.select(*wanted)


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "orc",
                num_files: int | None = None) -> None:
    """Write a table to a path (``/…``, ``s3a://…``) or a catalog name; ``mode`` overwrite/append.

    A path is (re)loaded aside and switched to when the load is whole (``sources.versions``), so that
    neither readers nor a failed job ever see a missing table; ``readers.read_table`` reads it.  Rows
    are appended to what the last load wrote.  An existing catalog table is written with
    ``insertInto`` so its definition is kept."""
    spark = df.sparkSession
    out = df if num_files is None else df.repartition(num_files)
    if is_path(target):
        done = versions.loads(spark, target)
        if mode == "overwrite" or not done:
            versions.reload(out, target, fmt)
        else:
            out.write.mode(mode).format(fmt).save(f"{target}/{versions.VERSION}={done[-1]}")
    elif spark.catalog.tableExists(target):
        _by_name(out, target).write.insertInto(target, overwrite=(mode == "overwrite"))
    else:
        out.write.mode(mode).format(fmt).saveAsTable(target)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, fmt: str = "parquet") -> None:
    """A catalog table bucketed and sorted by ``key``, one file per bucket: joins and groupings on the key
    between tables of the same bucket count read it without a shuffle.  Each load defines the table anew.
    A key that a third of all rows share is one bucket; leave tables with such keys unbucketed."""
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format(fmt)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def drop_table(spark: SparkSession, table: str, allowed_prefix: str) -> bool:
    """DROP TABLE IF EXISTS, only inside the allowed namespace (guards against dropping foreign
    tables by a typo).  Returns whether the statement was issued."""
    if not table or not table.lower().startswith(allowed_prefix.lower()):
        return False
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return True


def write_partitioned(df: DataFrame, target: str, partitions: dict, overwrite: bool = True, fmt: str = "parquet",
                      stringify: bool = False, num_files: int | None = None) -> None:
    """Partitioned write; ``partitions`` maps partition column -> source column (the value is
    copied, the source column stays as data), e.g. ``{"batch_no": "refresh_time"}``.
    ``overwrite=True`` replaces only the partitions present in ``df`` (dynamic overwrite)."""
    out = df.withColumns({p: F.col(src).cast("string") for p, src in partitions.items()})
    if stringify:
        out = stringify_all(out)
    if num_files is not None:
        out = out.repartition(num_files, *[F.col(p) for p in partitions])
    spark = out.sparkSession
    if is_path(target):
        (out.write.mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partitions).format(fmt).save(target))
    elif spark.catalog.tableExists(target):
        key = "spark.sql.sources.partitionOverwriteMode"
        previous = spark.conf.get(key, None)
        spark.conf.set(key, "dynamic")          # insertInto has no per-write option; restore after
        try:
            _by_name(out, target).write.insertInto(target, overwrite=overwrite)
        finally:
            if previous is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, previous)
    else:
        out.write.mode("append").partitionBy(*partitions).format(fmt).saveAsTable(target)


def partitions(spark: SparkSession, target: str, partition_col: str) -> list[tuple[str, Callable[[], object]]]:
    """(value, function that drops it) of every partition of a path or catalog table."""
    if not is_path(target):
        specs = [r[0] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]
        values = [dict(x.split("=", 1) for x in spec.split("/")).get(partition_col) for spec in specs]
        return [(unquote(v), partial(spark.sql, f"ALTER TABLE {target} DROP IF EXISTS PARTITION "
                                                f"({partition_col}='{unquote(v)}')")) for v in values if v is not None]
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    folders = [st.getPath() for st in fs.listStatus(root) if st.isDirectory()]
    return [(unquote(p.getName().removeprefix(f"{partition_col}=")), partial(fs.delete, p, True))
            for p in folders if p.getName().startswith(f"{partition_col}=")]


def expire_batches(spark: SparkSession, target: str, before: str, partition_col: str = "batch_no") -> list[str]:
    """Drop every batch partition whose value sorts before ``before``; returns the values
    dropped.  Catalog tables: ``ALTER TABLE … DROP PARTITION`` per value; path tables: the
    partition folders are removed through the Hadoop file system (metadata operations only;
    folder names are unescaped, so values with ``:`` or blanks match)."""
    expired = []
    for value, drop in sorted(partitions(spark, target, partition_col), key=lambda x: x[0]):
        if value < before:
            drop()
            expired.append(value)
    return expired


def drop_batch(spark: SparkSession, target: str, value: str, partition_col: str = "batch_no") -> bool:
    """Drop one batch (a re-run with an empty result replaces its rows by none)."""
    found = [drop for v, drop in partitions(spark, target, partition_col) if v == value]
    for drop in found:
        drop()
    return bool(found)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               truncate: bool = True, stringify: bool = False, null_text: str | None = None) -> None:
    """JDBC sink.  ``mode="overwrite"`` with ``truncate=True`` empties the existing table and
    keeps its DDL (full refresh); ``mode="append"`` inserts.  Executors write in parallel, one
    connection per partition."""
    out = stringify_all(df, null_text) if stringify else df
    w = out.write.mode(mode)
    if mode == "overwrite" and truncate:
        w = w.option("truncate", "true")
    w.jdbc(url, table, properties=properties or {})
