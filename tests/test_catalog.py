"""Sinks against catalog tables (session catalog, scratch warehouse)."""

from parcelflow.sources import readers, sinks


def test_catalog_table_first_load_reload_and_drop(spark):
    spark.sql("DROP TABLE IF EXISTS ops_clean_t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sinks.write_table(df, "ops_clean_t", fmt="orc")                     # first load: create as select
    assert readers.read_table(spark, "ops_clean_t").count() == 2
    sinks.write_table(df.limit(1), "ops_clean_t", mode="overwrite")      # reload keeps the definition
    assert readers.read_table(spark, "ops_clean_t").count() == 1
    assert sinks.drop_table(spark, "other_t", allowed_prefix="ops") is False
    assert sinks.drop_table(spark, "ops_clean_t", allowed_prefix="ops") is True
    assert not spark.catalog.tableExists("ops_clean_t")


def test_catalog_partitions_overwrite_and_expire(spark):
    spark.sql("DROP TABLE IF EXISTS ops_forecast_t")
    a = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, refresh_time string")
    sinks.write_partitioned(a, "ops_forecast_t", {"batch_no": "refresh_time"})          # creates the table
    b = spark.createDataFrame([(3, "2024-01-02")], "id int, refresh_time string")
    sinks.write_partitioned(b, "ops_forecast_t", {"batch_no": "refresh_time"})          # replaces one batch
    rows = sorted((r.id, r.batch_no) for r in spark.table("ops_forecast_t").collect())
    assert rows == [(1, "2024-01-01"), (3, "2024-01-02")]
    assert sinks.expire_batches(spark, "ops_forecast_t", "2024-01-02") == ["2024-01-01"]
    assert [r.id for r in spark.table("ops_forecast_t").collect()] == [3]
    spark.sql("DROP TABLE ops_forecast_t")
