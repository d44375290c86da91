"""Path tables whose loads are seen whole or not at all.

A load writes a folder of its own and then a marker; readers go by the markers:

    <table>/version=<n>/[bucket=<b>/]part-…    rows that load n wrote
    <table>/_loads/<n>                          load n is whole: its schema, format and bucket count

Until the marker is there readers see the table as it was, whether the load is running, failed or
was killed; what such a load left is removed by the next one.  A reload replaces all rows.
An upsert keeps the table in buckets of its key: a load reads and writes only the buckets that hold new
keys, and each bucket's rows are those of the newest load that wrote it.

Rows that a load replaces stay for one load more, for readers that have already begun.  One load at
a time writes a table.  The driver handles one folder name per bucket and load, no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import dedup

VERSION, BUCKET, LOADS = "version", "bucket", "_loads"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def loads(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the whole loads, in order; none where there is no such table."""
    return sorted(int(n) for n in _names(spark, f"{table}/{LOADS}") if n.isdigit())


def _about(spark: SparkSession, table: str, load: int) -> dict:
    fs, path = _fs(spark, f"{table}/{LOADS}/{load}")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, table: str, load: int, about: dict) -> None:
    """Writes the marker aside and renames it, so that a marker is never seen half written."""
    fs, aside = _fs(spark, f"{table}/{LOADS}/.{load}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(about).encode()))
    out.close()
    if not fs.rename(aside, _fs(spark, f"{table}/{LOADS}/{load}")[1]):
        raise OSError(f"load {load} of {table} could not be marked")


def _folders(spark: SparkSession, table: str, buckets: int | None) -> list[tuple[int, int | None, str]]:
    """(load, bucket, folder) of everything that is there, whole loads or not."""
    fs, pattern = _fs(spark, f"{table}/{VERSION}=*" + (f"/{BUCKET}=*" if buckets else ""))
    out = []
    for status in fs.globStatus(pattern) or []:
        path = status.getPath()
        parts = dict(p.split("=", 1) for p in path.toString().split("/")[-2:] if "=" in p)
        out.append((int(parts[VERSION]), int(parts[BUCKET]) if buckets else None, path.toString()))
    return out


def _newest(folders: list, done: list[int]) -> dict:
    """Bucket -> (load, folder) that holds its rows."""
    newest: dict = {}
    for load, bucket, folder in folders:
        if load in set(done) and load >= newest.get(bucket, (-1,))[0]:
            newest[bucket] = (load, folder)
    return newest


def is_versioned(spark: SparkSession, table: str) -> bool:
    return bool(loads(spark, table))


def _read(spark: SparkSession, about: dict, folders: list[str]) -> DataFrame:
    schema = StructType.fromJson(about["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(about["format"]).load(folders)


def read(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the newest whole load of every bucket."""
    done = loads(spark, table)
    if not done:
        raise ValueError(f"{table} has no whole load")
    about = _about(spark, table, done[-1])
    newest = _newest(_folders(spark, table, about["buckets"]), done)
    return _read(spark, about, [folder for _, folder in newest.values()])


def _begin(spark: SparkSession, table: str, done: list[int]) -> int:
    """The next load's number; what loads that never became whole have left goes."""
    for name in _names(spark, table):
        if name.startswith(f"{VERSION}=") and int(name.split("=")[1]) not in done:
            fs, path = _fs(spark, f"{table}/{name}")
            fs.delete(path, True)
    return (done[-1] if done else 0) + 1


def _drop_replaced(spark: SparkSession, table: str, buckets: int | None, done: list[int]) -> None:
    """Drops what loads before the last one had already replaced."""
    if not done:
        return
    folders = _folders(spark, table, buckets)
    before = _newest(folders, done)
    for load, bucket, folder in folders:
        if load in done and load < before[bucket][0]:
            fs, path = _fs(spark, folder)
            fs.delete(path, True)


def _about_of(df: DataFrame, fmt: str, buckets: int | None) -> dict:
    return {"schema": json.loads(df.schema.json()), "format": fmt, "buckets": buckets}


def reload(df: DataFrame, table: str, fmt: str = "parquet") -> int:
    """Replaces all rows of the table; returns the load's number.  ``df`` may read the table itself."""
    spark = df.sparkSession
    done = loads(spark, table)
    load = _begin(spark, table, done)
    df.write.mode("overwrite").format(fmt).save(f"{table}/{VERSION}={load}")
    _commit(spark, table, load, _about_of(df, fmt, None))
    _drop_replaced(spark, table, None, done)
    return load


def upsert(new: DataFrame, table: str, keys, order_by, tie_breakers="all", buckets: int = 64,
           fmt: str = "parquet") -> int | None:
    """Brings new records into the table, latest version per key; returns the load's number, None when
    there is nothing new.

    The table keeps the bucket count of its first load.  One shuffle brings the new records' keys
    down to one row each, one deals these and the touched buckets' rows by bucket.
    """
    spark = new.sparkSession
    done = loads(spark, table)
    about = _about(spark, table, done[-1]) if done else _about_of(new, fmt, buckets)
    if about["buckets"] is None:
        raise ValueError(f"{table} was not made by upserts")
    buckets, fmt, schema = about["buckets"], about["format"], StructType.fromJson(about["schema"])
    if set(schema.names) != set(new.columns):
        raise ValueError(f"columns {sorted(set(schema.names) ^ set(new.columns))} are not on both sides of {table}")
    new = new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    keys = [keys] if isinstance(keys, str) else list(keys)

    def with_bucket(df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    latest = with_bucket(dedup.latest_per_key(new, keys, order_by, tie_breakers))
    touched = {r[0] for r in with_bucket(new.select(*keys)).select(BUCKET).distinct().collect()}  # ``buckets`` at most
    if not touched:
        return None
    load = _begin(spark, table, done)
    newest = _newest(_folders(spark, table, buckets), done)
    rows, old = latest, [folder for bucket, (_, folder) in newest.items() if bucket in touched]
    if old:
        rows = rows.unionByName(with_bucket(_read(spark, about, old)))
    # Dealt by bucket once; the window below needs no shuffle of its own, and each bucket is one file.
    rows = rows.repartition(len(touched), BUCKET)
    rows = dedup.top1_per_key(rows, [BUCKET, *keys], dedup.latest_order(new, keys, order_by, tie_breakers))
    rows.write.mode("overwrite").format(fmt).partitionBy(BUCKET).save(f"{table}/{VERSION}={load}")
    _commit(spark, table, load, about)
    _drop_replaced(spark, table, buckets, done)
    return load
