"""What the jobs leave on the disk while and after they run."""

import os
import time

import pytest
from pyspark.sql import functions as F

from parcelflow import session
from parcelflow.operators import route
from parcelflow.plans import forecast
from parcelflow.plans import registry as R

SF = "/root/testdata/sf0.001"


def _written(spark) -> set[str]:
    """Tables that lie below the checkpoint folder: <folder>/<tag>."""
    base = session.checkpoint_dir(spark).removeprefix("file:")
    return {f"{f}/{tag}" for f in os.listdir(base) if f.startswith("written-") for tag in os.listdir(f"{base}/{f}")}


def _tags(paths) -> list[str]:
    return sorted(p.rsplit("/", 1)[1] for p in paths if not p.endswith(".crc"))


def _shuffles(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (p.rsplit("/", 1)[1] for p in files.mkString("\n").split("\n") if p) if n.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = _shuffles(spark), spark.conf.get(session.FREE_SHUFFLES, None)
    sums = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    out = session.written(sums.join(sums.withColumnRenamed("s", "t"), "k"), "sums")
    until = time.time() + 10
    while (left := _shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(session.FREE_SHUFFLES, None) == setting
    assert out.count() == sums.count() == 7


def test_discarding_keeps_what_is_asked_for(spark):
    before, one = _written(spark), spark.range(3)
    with session.discarding(spark):
        with session.discarding(spark):
            session.written(one, "inner")
            kept = session.written(one, "kept", keep=True)
        assert _tags(_written(spark) - before) == ["kept"]
        assert kept.count() == 3
        last = session.written(one, "last", keep=True)
    assert _tags(_written(spark) - before) == ["last"]
    session.discard(one)
    session.discard(last)
    assert _written(spark) == before


def test_discarding_clears_up_after_an_error(spark):
    before = _written(spark)
    with pytest.raises(ZeroDivisionError), session.discarding(spark):
        session.written(spark.range(3), "lost")
        raise ZeroDivisionError
    assert _written(spark) == before


def test_forecast_job_leaves_only_its_batches(spark):
    before = _written(spark)
    out = R.QUERIES["job_forecast"](spark, SF)
    assert _written(spark) == before
    assert {r.batch_no for r in out.select("batch_no").distinct().collect()} == {R.FORECAST_END}


def test_forecast_writes_step_by_step_and_discards(spark, monkeypatch):
    """Each written step finds the disk without the steps that nobody reads any more."""
    before, found = _written(spark), {}

    def spy(df, tag, keep=False):
        found[tag] = _tags(_written(spark) - before)
        return session.written(df, tag, keep)

    monkeypatch.setattr(forecast, "written", spy)
    t = R.cleaned_logistics(spark, SF)
    out = forecast.run(t, R.FORECAST_END)
    always = ["line_info", "orgs", "volume_waybill"]
    assert found["items"] == sorted([*always, "trips"])
    assert found["opened"] == sorted([*always, "items"])
    assert found["loads"] == sorted([*always, "opened"])
    assert found["stock"] == sorted([*always, "loads"])
    assert found["status"] == sorted([*always, "loads", "stock"])
    assert _tags(_written(spark) - before) == ["departures", "line_info", "orgs", "status", "walk"]
    plain = forecast.run(t, R.FORECAST_END, materialize=False)
    assert out.count() > 0 and out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_the_job_reads_the_stored_columns_only(spark):
    """The steps on the stored tables give what they give on the whole cleaned tables."""
    t = R.cleaned_logistics(spark, SF)
    with session.discarding(spark):
        held = forecast.stored(t)
        for stage in ("unsigned", "stock", "loads"):
            a, b = (forecast.stages(x, R.FORECAST_END)[stage] for x in (held, t))
            assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_long_walk_holds_one_state(spark):
    """Routes of more legs than one plan takes: the written state replaces the one before."""
    stops = [f"N{i:02d}" for i in range(route.LEGS_AT_ONCE * 2 + 3)]
    way = spark.createDataFrame([("W1", stops, "2001-01-01 08:00:00")], "wb string, remaining array<string>, t string")
    way = way.withColumn("t", F.col("t").cast("timestamp_ntz"))
    lines = spark.createDataFrame([(a, b, "09:00:00", 32400, 60, 0) for a, b in zip(stops, stops[1:])],
                                  "leave_department_code string, arrive_department_code string, leave_time string, "
                                  "leave_secs int, run_minutes long, unload_time long")
    before = _written(spark)
    legs = route.schedule_walk(way, route.L.timetable(lines), "wb", "remaining", "t")
    assert _tags(_written(spark) - before) == ["departures", "walk"]
    assert [r.leg_idx for r in legs.orderBy("leg_idx").collect()] == list(range(len(stops) - 1))
