"""Helpers shared by the training-data operators: tables, staged intermediates, texts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of ``sf_dir``, read by Spark only (any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, the empty string for null."""
    return F.coalesce(F.col(col), F.lit(""))


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once below the cluster's shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads the files.  The folder is deleted when the Spark
    application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}/{tag}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path).getParent()
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: str, tag: str, partitions: int | None = None) -> DataFrame:
    """``df``, staged in the given order, with ``place``, its rows' numbers from 0.

    Rows are range-partitioned, sorted and numbered in their tasks; what comes before a task is a
    running sum over one row per task.
    """
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    # The identifier counts the rows of a partition from the partition's number shifted by 33 bits.
    rows = staged(dealt.sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()), tag)
    part = F.shiftright("_row", 33)
    counts = rows.groupBy(part.alias("_of")).agg(F.count("*").alias("_n"))
    before = staged(counts.select("_of", (F.sum("_n").over(Window.orderBy("_of")) - F.col("_n")).alias("_before")), f"{tag}_parts")
    return (rows.join(before, part == F.col("_of"))
            .withColumn("place", F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_row", "_of", "_before"))
