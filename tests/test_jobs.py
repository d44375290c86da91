"""The jobs end to end on the derived logistics feeds, written to path targets."""

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import dedup
from parcelflow.plans import clean, jobs
from parcelflow.plans import registry as R
from parcelflow.sources import derived, readers

SF = "/root/testdata/sf0.001"


def test_clean_forecast_warning_unscan_to_paths(spark, tmp_path):
    raw = derived.logistics_tables(spark, SF)
    targets = {t: str(tmp_path / f"{t}_clean") for t in clean.BATCHES[2]}
    cleaned = jobs.run_clean(raw, 2, R.REFRESH_TIME, targets, days=None, fmt="parquet").tables
    assert readers.read_table(spark, targets["volume_unload_detail"], "parquet").count() \
        == cleaned["volume_unload_detail"].count() > 0

    t = R.cleaned_logistics(spark, SF)
    fc_path = str(tmp_path / "forecast")
    first = jobs.run_forecast(t, "2001-09-01 13:45:00", fc_path, keep_days=5, line_target=str(tmp_path / "line_info"))
    assert readers.read_table(spark, str(tmp_path / "line_info"), "parquet").columns == [f.name for f in jobs.schemas.LINE_INFO.fields]
    jobs.run_forecast(t, "2001-09-03 13:45:00", fc_path, keep_days=5)
    jobs.run_forecast(t, "2001-09-09 13:45:00", fc_path, keep_days=5)    # expires the 09-01 and 09-03 batches
    batches = sorted(r[0] for r in spark.read.parquet(fc_path).select(F.col("batch_no").cast("string"))
                     .distinct().collect())
    assert batches == ["2001-09-09 13:45:00"]
    assert first.columns == [f.name for f in jobs.schemas.FORECAST.fields]

    w = jobs.run_load_warning(t, "2001-09-01 00:00:00", str(tmp_path / "warning"))
    assert readers.read_table(spark, str(tmp_path / "warning"), "parquet").count() == w.count()
    u = jobs.run_unload_unscan(t, "2001-09-01 00:00:00", str(tmp_path / "unscan"))
    assert readers.read_table(spark, str(tmp_path / "unscan"), "parquet").count() == u.count()


def _feed(spark, rows):
    """A sign feed: (id, create_time, inflow_time, waybill_number); the other fields are NULL spellings."""
    spec = clean.CLEAN_SPECS["volume_sign"]
    df = spark.createDataFrame(rows, "id string, create_time string, inflow_time string, waybill_number string")
    return df.select(*[F.col(c) if c in df.columns else F.lit("\\N").alias(c) for c in spec.columns]), spec


def test_raw_iso_versions_keep_the_latest(spark):
    raw, spec = _feed(spark, [
        ("1", "2019-12-12T10:00:00.000Z", "2019-12-12T10:00:00.000Z", "zzz"),
        ("1", "2019-12-12T10:00:00.000Z", "2019-12-13T10:00:00.000Z", "new"),
        ("1", "NULL", "null", "zzzz"), ("2", "nonsense", " ", "kept")])
    out = {r.id: r for r in clean.clean_table(raw, spec, None, days=None).collect()}
    assert out["1"].waybill_number == "new" and str(out["1"].inflow_time) == "2019-12-13 10:00:00"
    assert out["2"].create_time is None and out["2"].is_active is None
    rejects = clean.time_rejects(raw, spec).first()
    assert (rejects.create_time_rejects, rejects.inflow_time_rejects) == (1, 0)


def test_upsert_table_with_and_without_new_rows(spark):
    old, spec = _feed(spark, [("1", "2024-01-01 00:00:00", "2024-01-01 00:00:00", "x"),
                              ("1", "2024-01-01 00:00:00", "2023-01-01 00:00:00", "older")])
    history = dedup.standardize_timestamps(old, spec.ts_cols)
    empty, _ = _feed(spark, [])
    assert [r.waybill_number for r in clean.upsert_table(history, empty, spec).collect()] == ["x"]
    new, _ = _feed(spark, [("1", "2024-01-02T00:00:00.000Z", "2024-01-02T00:00:00.000Z", "y")])
    assert [r.waybill_number for r in clean.upsert_table(history, new, spec).collect()] == ["y"]


def test_missing_fields_and_tables_are_errors(spark):
    raw, spec = _feed(spark, [("1", "2024-01-01 00:00:00", "2024-01-01 00:00:00", "x")])
    for lacking in ("sign_time", "is_active"):
        with pytest.raises(ValueError):
            clean.clean_table(raw.drop(lacking), spec, "2024-01-05 00:00:00", days=None)
    with pytest.raises(Exception):
        clean.clean_table(raw.drop("create_time"), spec, "2024-01-05 00:00:00", days=7)
    with pytest.raises(ValueError):
        clean.run_batch({"volume_box": raw}, 1, None, days=None)


def test_empty_rerun_replaces_the_batch(spark, tmp_path):
    from parcelflow.sources import sinks
    target = str(tmp_path / "batches")
    df = spark.createDataFrame([(1, "b1"), (2, "b2")], "v int, day string")
    sinks.write_partitioned(df, target, {"batch_no": "day"})
    assert sinks.drop_batch(spark, target, "b1") and not sinks.drop_batch(spark, target, "b9")
    assert [r.v for r in spark.read.parquet(target).collect()] == [2]


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    from parcelflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802 - Spark's name
            return None

    class Session:
        sparkContext = Context()  # noqa: N815 - Spark's name

        class conf:  # noqa: N801 - Spark's name
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_forecast_query_cleans_once(spark, monkeypatch):
    seen = {}
    run = R.jobs.run_forecast

    def spy(t, *args, **options):
        seen.update(t)
        return run(t, *args, **options)

    monkeypatch.setattr(R.jobs, "run_forecast", spy)
    assert R.QUERIES["job_forecast"](spark, SF).count() > 0
    for name in clean.CLEAN_SPECS:
        if name != "volume_unload_detail":
            assert all("/written-" in f for f in seen[name].inputFiles())
