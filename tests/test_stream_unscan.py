"""The continuous report over replayed files equals the batch job once the watermark has passed."""

from collections import Counter

from pyspark.sql import functions as F

from parcelflow.plans import registry as R
from parcelflow.plans import unscan
from parcelflow.plans.orgs import org_dim
from parcelflow.sources import derived
from parcelflow.streaming import start_unscanned

SF = "/root/testdata/sf0.001"
COLUMNS = [c for c in unscan.OUTPUT if c != "refresh_time"]


def late(df, time):
    """A record of the far future, which moves the watermark past all others."""
    return df.limit(1).withColumn(time, F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")).withColumn("waybill_number", F.lit("LATE"))


def test_replayed_files_give_the_batch_report(spark, tmp_path):
    t = R.cleaned_logistics(spark, SF)
    static = {}
    for name in ("volume_box", "volume_path", "volume_basic"):
        t[name].write.parquet(str(tmp_path / name))
        static[name] = spark.read.parquet(str(tmp_path / name))
    unload = t["volume_unload_detail"].filter("inflow_time IS NOT NULL")
    scans = derived.logistics_tables(spark, SF)["volume_scan"]
    streams = {}
    for name, df, time in (("unload", unload, "inflow_time"), ("scan", scans, "create_time")):
        folder = str(tmp_path / name)
        for part in (df.filter(F.xxhash64("waybill_number") % 2 == 0), df.filter(F.xxhash64("waybill_number") % 2 != 0), late(df, time)):
            part.coalesce(1).write.mode("append").parquet(folder)
        streams[name] = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(folder)
    orgs = org_dim(static["volume_basic"])
    q = start_unscanned(streams["unload"], streams["scan"], static["volume_box"], orgs, static["volume_path"],
                        str(tmp_path / "out"), str(tmp_path / "ckpt"), within="40000 days", delay="40000 days")
    q.awaitTermination()
    early = spark.read.schema(spark.createDataFrame([], "waybill_number string").schema).parquet(str(tmp_path / "out")).count()
    assert early == 0  # every record still within the delay
    q = start_unscanned(streams["unload"], streams["scan"], static["volume_box"], orgs, static["volume_path"],
                        str(tmp_path / "out2"), str(tmp_path / "ckpt2"), within="3000 days", delay="5000 days")
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out2")).filter("waybill_number <> 'LATE'").select(*COLUMNS)
    want = unscan.run({**t, "volume_unload_detail": unload, "volume_scan": scans, "volume_basic": static["volume_basic"]},
                      R.REFRESH_TIME).select(*COLUMNS)
    got, want = Counter(map(tuple, got.collect())), Counter(map(tuple, want.collect()))
    assert len(want) > 100 and got == want
