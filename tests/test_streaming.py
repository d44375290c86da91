"""Incremental clean over two micro-batches equals the batch clean over all records."""

from pyspark.sql import functions as F

from parcelflow.operators import dedup
from parcelflow.streaming import cleaned, fold, start_incremental_clean


def test_two_epochs_equal_batch(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = str(tmp_path / "src")
    ev.filter(F.col("ts") < "2024-01-15").coalesce(1).write.parquet(src + "/a")
    ev.filter(F.col("ts") >= "2024-01-15").coalesce(1).write.parquet(src + "/b")
    files = spark.read.parquet(src + "/a").inputFiles() + spark.read.parquet(src + "/b").inputFiles()
    land = str(tmp_path / "land")
    import os
    import shutil
    os.makedirs(land)
    for i, f in enumerate(files):
        shutil.copy(f.replace("file://", ""), f"{land}/part-{i}.parquet")
    q = start_incremental_clean(spark, land, ev.schema, ["user_id", "event_type"], ["ts"],
                                str(tmp_path / "changes"), str(tmp_path / "ckpt"), tie_breakers=["event_id"],
                                max_files_per_trigger=1)
    q.awaitTermination()
    got = cleaned(spark, str(tmp_path / "changes"), ["user_id", "event_type"], ["ts"], ["event_id"])
    want = dedup.latest_per_key(ev, ["user_id", "event_type"], ["ts"], ["event_id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(str(tmp_path / "changes")).select("batch_id").distinct().count() == 2

    table, keys = str(tmp_path / "table"), (["user_id", "event_type"], ["ts"], ["event_id"])
    assert fold(spark, str(tmp_path / "changes"), table, *keys) == 1
    assert fold(spark, str(tmp_path / "changes"), table, *keys) == 1  # nothing new
    late = ev.limit(1).withColumn("ts", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    late.withColumn("batch_id", F.lit(2)).write.partitionBy("batch_id").mode("append").parquet(str(tmp_path / "changes"))
    got = cleaned(spark, str(tmp_path / "changes"), *keys, table_path=table)
    want = dedup.latest_per_key(ev.unionByName(late), *keys)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert fold(spark, str(tmp_path / "changes"), table, *keys) == 2
    assert sorted(map(tuple, spark.read.parquet(table).drop("version").collect())) == sorted(map(tuple, want.collect()))
