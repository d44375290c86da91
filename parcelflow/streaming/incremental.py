"""Incremental cleaning on Structured Streaming.

The clean job runs hourly over newly landed records.  As a stream: a file source picks up new
files, each micro-batch is reduced to its latest version per key and written as one partition
``batch_id=<epoch>`` of a change table with dynamic partition overwrite — a retried epoch
replaces its own partition, so the sink is idempotent.  The cleaned table is the change table
reduced once more to the latest version per key (``cleaned``), which is exactly the batch
result over all records seen so far.  ``fold`` folds the changes into a table of one row per key, so
that later reads do not go through the whole history.

``trigger(availableNow=True)`` processes everything available and stops, which is how an
hourly scheduler drives it; the checkpoint folder must live on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import dedup
from ..sources.sinks import partitions

BATCH_COL = "batch_id"
VERSION_COL = "version"


def start_incremental_clean(spark: SparkSession, source_dir: str, schema: StructType, keys, order_by,
                            changes_path: str, checkpoint_path: str, tie_breakers="all",
                            file_glob: str | None = None, available_now: bool = True,
                            max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream (returns the running query; call ``awaitTermination()`` to block)."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    source = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        latest = dedup.latest_per_key(batch, keys, order_by, tie_breakers)
        (latest.withColumn(BATCH_COL, F.lit(int(epoch_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(changes_path))

    writer = source.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _state(spark: SparkSession, changes_path: str, table_path: str | None) -> tuple[DataFrame | None, int]:
    """(rows, last epoch in them): the newest folded version of the table, None and -1 without one."""
    versions = sorted(int(v) for v, _ in partitions(spark, table_path, VERSION_COL)) if table_path else []
    if not versions:
        return None, -1
    return spark.read.parquet(f"{table_path}/{VERSION_COL}={versions[-1]}"), versions[-1]


def cleaned(spark: SparkSession, changes_path: str, keys, order_by, tie_breakers="all",
            table_path: str | None = None) -> DataFrame:
    """Latest version per key: the folded table at ``table_path`` (if any) and the epochs after it."""
    rows, last = _state(spark, changes_path, table_path)
    epochs = [int(v) for v, _ in partitions(spark, changes_path, BATCH_COL) if int(v) > last]
    if epochs or rows is None:
        changes = spark.read.parquet(changes_path).filter(F.col(BATCH_COL) > F.lit(last)).drop(BATCH_COL)
        rows = changes if rows is None else rows.unionByName(changes)
    return dedup.latest_per_key(rows, keys, order_by, tie_breakers)


def fold(spark: SparkSession, changes_path: str, table_path: str, keys, order_by, tie_breakers="all") -> int:
    """Fold all epochs into a new version of the table and drop what it replaces; returns the last
    epoch folded.

    The new version is a folder of its own, written whole before the old version and the folded
    epochs go, so a run that fails in between is repeated without loss.  Run it after each
    ``availableNow`` run: reads then cost the table, not the history.
    """
    last = max((int(v) for v, _ in partitions(spark, changes_path, BATCH_COL)), default=-1)
    _, had = _state(spark, changes_path, table_path)
    if last > had:
        table = cleaned(spark, changes_path, keys, order_by, tie_breakers, table_path)
        table.write.mode("overwrite").parquet(f"{table_path}/{VERSION_COL}={last}")
    for value, drop in partitions(spark, table_path, VERSION_COL):
        if int(value) < max(last, had):
            drop()
    for value, drop in partitions(spark, changes_path, BATCH_COL):
        if int(value) <= max(last, had):
            drop()
    return max(last, had)
