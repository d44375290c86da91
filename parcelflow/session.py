"""Session helpers for tests, benchmarks and local runs.

Library code never creates a session; it takes the caller's.  ``local_session`` is what the
tests and ``bench.py`` use.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session;
only a local session without that setting gets a scratch folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every parcelflow job expects (AQE for runtime broadcast / skew / coalescing,
# UTC so that day boundaries of the timetable are stable).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Post-shuffle work here is CPU-heavy per row (sort-based top-1, timetable lambdas) while the
    # shuffled bytes are small; the default 1 MB floor lets AQE fold such stages into one task.
    # Large shuffles on a cluster are far above this floor, so it only matters for small ones.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "parcelflow",
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting a local session gets a scratch folder of its own; on a cluster it is an
    error, since a machine-local folder is not visible to the other machines.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="parcelflow-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


#: Setting with which an execution deletes its shuffle files when it ends; else they lie on the executors'
#: disks until the driver's JVM happens to collect the plan.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders that each ``discarding`` around the current call is to delete, outermost first.
_DISCARDED: ContextVar[tuple[list[str], ...]] = ContextVar("discarded", default=())


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back: computed once, and a
    lost executor re-reads the files.  The folder is deleted by ``discard``, at the end of the innermost
    ``discarding`` (with ``keep``, of the one around that), or when the application ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}/{tag}"
    folder = path.rsplit("/", 1)[0]
    delete_at_exit(spark, folder)
    around = _DISCARDED.get()[:-1] if keep else _DISCARDED.get()
    if around:
        around[-1].append(folder)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = folder
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a frame that ``written`` returned and that no later action reads; other
    frames are left alone."""
    if folder := df.__dict__.get("written_to"):
        _delete(df.sparkSession, folder)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Deletes, when left, what ``written`` wrote inside without ``keep``.  Frames that read those tables
    must have been computed by then."""
    folders: list[str] = []
    token = _DISCARDED.set((*_DISCARDED.get(), folders))
    try:
        yield
    finally:
        _DISCARDED.reset(token)
        for folder in folders:
            _delete(spark, folder)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Has the folder deleted when the application ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run sized from the input volume.

    * scans: ``maxPartitionBytes`` = ``target_partition_bytes`` (e.g. 100 TB -> ~400k scan tasks of
      256 MB, a few waves on 1000 executors);
    * shuffles: AQE starts from enough partitions that the largest exchange (the cleaning of the
      biggest feed, roughly the input size) is cut into ``target_partition_bytes`` pieces, never
      fewer than 2 per core, and coalesces small exchanges at runtime;
    * skew: partitions 5x the median and above ``2 * target`` are split by AQE;
    * broadcast: only relations Spark measures below 64 MB (static estimate or runtime size).
    """
    initial = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        # two joins in a row on one key: split a skewed one even if the next then shuffles again
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
