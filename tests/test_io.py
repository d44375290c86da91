"""Sources and sinks on local paths."""

import datetime as dt

import pytest

from parcelflow import schemas
from parcelflow.sources import readers, sinks


def test_table_round_trip_orc(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    p = str(tmp_path / "t_orc")
    sinks.write_table(df, p, fmt="orc", num_files=1)
    back = readers.read_table(spark, p, "orc")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    sinks.write_table(df, p, mode="append", fmt="orc")
    assert readers.read_table(spark, p, "orc").count() == 4


def test_single_file_csv_with_null_text_and_dir_reader(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5), None)], "id int, ts timestamp_ntz, v string")
    base = tmp_path / "out"
    sinks.write_csv(df, str(base / "x_clean.csv"), null_text="null", single_file=True)
    sinks.write_csv(df, str(base / "y.csv"))
    parts = [p for p in (base / "x_clean.csv").iterdir() if p.name.endswith(".csv")]
    assert len(parts) == 1
    assert parts[0].read_text().splitlines()[1] == "1,2024-01-02 03:04:05,null"
    tables = readers.read_dir(spark, str(base), "csv")
    assert sorted(tables) == ["x_clean", "y"]
    assert tables["y"].collect()[0]["v"] is None        # \N marker reads back as NULL


def test_drop_guard(spark):
    assert sinks.drop_table(spark, "other.t", allowed_prefix="ops") is False
    assert sinks.drop_table(spark, "ops_t_does_not_exist", allowed_prefix="ops") is True


def test_partitioned_overwrite_only_touches_own_batches(spark, tmp_path):
    p = str(tmp_path / "batches")
    a = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, refresh_time string")
    sinks.write_partitioned(a, p, {"batch_no": "refresh_time"})
    b = spark.createDataFrame([(3, "2024-01-02")], "id int, refresh_time string")
    sinks.write_partitioned(b, p, {"batch_no": "refresh_time"})
    got = sorted((r.id, r.batch_no) for r in spark.read.parquet(p).selectExpr("id", "cast(batch_no as string) batch_no").collect())
    assert got == [(1, "2024-01-01"), (3, "2024-01-02")]
    assert sinks.expire_batches(spark, p, "2024-01-02") == ["2024-01-01"]
    assert [r.id for r in spark.read.parquet(p).collect()] == [3]


def test_conform_contract(spark):
    df = spark.createDataFrame([("W1", "D1", None, "PC", "A1", "r", "t", "extra")],
                               "waybill_number string, now_department_code string, create_time string, "
                               "device_type string, assignment_number string, waybill_route_codes string, "
                               "refresh_time string, x string")
    out = schemas.conform(df, schemas.UNLOAD_UNSCAN)
    assert out.columns == [f.name for f in schemas.UNLOAD_UNSCAN.fields]
    with pytest.raises(ValueError):
        schemas.conform(df.drop("device_type"), schemas.UNLOAD_UNSCAN)


def test_cluster_conf_sizes_partitions_from_input():
    from parcelflow.session import cluster_conf
    big = cluster_conf(100 << 40, total_cores=8000)                 # 100 TB on 1000 x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.enabled"] == "true"
    small = cluster_conf(1 << 30, total_cores=64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128       # at least 2 per core
