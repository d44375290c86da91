"""Path tables: reloads seen whole or not at all, upserts that leave other buckets alone."""

import pytest
from pyspark.sql import functions as F

from parcelflow.plans import clean, jobs
from parcelflow.sources import readers, sinks, versions


def rows(df):
    return sorted(map(tuple, df.collect()))


def fails(df):
    """The frame with a row that fails when it is computed, after others have been written."""
    return df.withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("midway"))).otherwise(F.col("v")))


def files(spark, path):
    return {f.split("?")[0] for f in spark.read.option("recursiveFileLookup", "true").parquet(path).inputFiles()}


def test_reload_that_fails_midway_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(10).select("id", F.lit("old").alias("v"))
    sinks.write_table(old, path, fmt="parquet")
    held = readers.read_table(spark, path, "parquet")
    with pytest.raises(Exception, match="midway"):
        sinks.write_table(fails(spark.range(100).repartition(4).select("id", F.lit("new").alias("v"))), path, fmt="parquet")
    assert rows(readers.read_table(spark, path, "parquet")) == rows(old) == rows(held)
    new = held.withColumn("v", F.lit("new"))  # reads the table that it replaces
    sinks.write_table(new, path, fmt="parquet")
    assert rows(readers.read_table(spark, path, "parquet")) == [(i, "new") for i in range(10)]
    assert versions.loads(spark, path) == [1, 2] and rows(held) == rows(old)  # a reader that began before goes on
    sinks.write_table(old.limit(0), path, fmt="parquet")
    assert readers.read_table(spark, path, "parquet").count() == 0
    sinks.write_table(old, path, mode="append", fmt="parquet")
    assert rows(readers.read_table(spark, path, "parquet")) == rows(old)


def table_of(spark, path):
    return {r.id: r.v for r in versions.read(spark, path).collect()}


def test_upsert_rewrites_the_touched_buckets_alone(spark, tmp_path):
    path, key = str(tmp_path / "base"), (["id"], ["at"], "all")
    first = spark.range(200).selectExpr("id", "1L AS at", "'a' AS v")
    assert versions.upsert(first, path, *key, buckets=16) == 1
    before = {f: f for f in files(spark, path)}
    new = spark.createDataFrame([(7, 2, "b"), (7, 3, "c"), (8, 0, "late"), (900, 1, "n")], "id long, at long, v string")
    touched = {r[0] for r in new.select(F.pmod(F.xxhash64("id"), F.lit(16))).distinct().collect()}
    assert versions.upsert(new, path, *key, buckets=99) == 2  # the table keeps its own count
    got = table_of(spark, path)
    assert len(got) == 201 and (got[7], got[8], got[900], got[9]) == ("c", "a", "n", "a")
    live = versions._newest(versions._folders(spark, path, 16), [1, 2])
    assert {b for b, (load, _) in live.items() if load == 2} == touched
    assert all(f in before for f in files(spark, path) if "version=1" in f)  # nothing of load 1 was written again
    assert versions.upsert(new.limit(0), path, *key) is None and versions.loads(spark, path) == [1, 2]
    third = spark.createDataFrame([(7, 9, "d")], "id long, at long, v string")
    assert versions.upsert(third, path, *key) == 3
    assert table_of(spark, path)[7] == "d" and versions.read(spark, path).count() == 201


def test_failed_upsert_is_not_seen_and_repeated(spark, tmp_path):
    path, key = str(tmp_path / "base"), (["id"], ["at"], ["v"])
    versions.upsert(spark.range(50).selectExpr("id", "1L AS at", "'a' AS v"), path, *key, buckets=4)
    new = spark.range(40, 120).selectExpr("id", "2L AS at", "'b' AS v")
    with pytest.raises(Exception, match="midway"):
        versions.upsert(fails(new), path, *key)
    # A load that was killed before its marker leaves a folder that nobody reads.
    new.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/version=2", mode="overwrite")
    assert set(table_of(spark, path).values()) == {"a"}
    assert versions.upsert(new, path, *key) == 2
    got = table_of(spark, path)
    assert len(got) == 120 and sum(v == "b" for v in got.values()) == 80


def test_upsert_of_unequal_columns_is_an_error(spark, tmp_path):
    path = str(tmp_path / "base")
    versions.upsert(spark.range(5).selectExpr("id", "1L AS at"), path, ["id"], ["at"], buckets=2)
    with pytest.raises(ValueError):
        versions.upsert(spark.range(5).selectExpr("id", "1L AS at", "2 AS more"), path, ["id"], ["at"])
    sinks.write_table(spark.range(3), str(tmp_path / "plain"), fmt="parquet")
    with pytest.raises(ValueError):
        versions.upsert(spark.range(3), str(tmp_path / "plain"), ["id"], ["id"])
    with pytest.raises(ValueError):
        versions.read(spark, str(tmp_path / "none"))


def _sign(spark, rows_):
    spec = clean.CLEAN_SPECS["volume_sign"]
    df = spark.createDataFrame(rows_, "id string, create_time string, inflow_time string, waybill_number string")
    return df.select(*[F.col(c) if c in df.columns else F.lit("\\N").alias(c) for c in spec.columns])


def test_upsert_job_from_raw_text(spark, tmp_path):
    path = str(tmp_path / "sign")
    first = [(str(i), "2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00.000Z", "x") for i in range(20)]
    jobs.run_upsert({"volume_sign": _sign(spark, first)}, {"volume_sign": path}, buckets=4)
    new = [("3", "2024-01-01T00:00:00.000Z", "2024-01-02T00:00:00.000Z", "y"), ("4", "null", "NULL", "never")]
    out = jobs.run_upsert({"volume_sign": _sign(spark, new)}, {"volume_sign": path})["volume_sign"]
    got = {r.id: r.waybill_number for r in out.collect()}
    assert len(got) == 20 and got["3"] == "y" and got["4"] == "x"


def test_clean_job_counts_rejects_and_returns_what_it_wrote(spark, tmp_path):
    raw = {n: _sign(spark, []) for n in clean.BATCHES[1]}
    rows_ = [("1", "2024-01-05T00:00:00.000Z", "soon", "a"), ("2", "NULL", "null", "b"),
             ("3", "2024-13-05T00:00:00.000Z", "2024-01-05T00:00:00.000Z", "c"), ("3", "x", "y", "d")]
    raw["volume_sign"] = _sign(spark, rows_)
    for n in clean.BATCHES[1]:
        if n != "volume_sign":
            raw[n] = spark.createDataFrame([], ", ".join(f"{c} string" for c in clean.CLEAN_SPECS[n].columns))
    run = jobs.run_clean(raw, 1, "2024-01-06 00:00:00", {"volume_sign": str(tmp_path / "sign")}, days=None, fmt="parquet")
    assert run.rejects == {"volume_sign": {"sign_time": 0, "create_time": 2, "inflow_time": 2}}
    assert list(run.tables) == ["volume_sign"] and run.tables["volume_sign"].count() == 3
    expected = clean.time_rejects(raw["volume_sign"], clean.CLEAN_SPECS["volume_sign"]).first().asDict()
    assert {f"{c}_rejects": n for c, n in run.rejects["volume_sign"].items()} == expected
