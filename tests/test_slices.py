"""Time slices of raw texts, and the ISO short cut of the parser."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import timefmt
from parcelflow.operators import dedup
from parcelflow.plans import clean
from tests.test_plans import _plan

END = "2024-01-10 10:00:00"
TEXTS = ["2024-01-03T05:00:00.000Z", "2024-01-03T10:00:00.000Z", "2024-01-03T09:59:59.999Z", "2024-01-10T05:00:00.000Z",
         "2024-01-10T10:00:00.000Z", "2024-01-10 09:59:59", "2024-01-11T00:00:00.000Z", "NULL", "null", "", " ", "\\N", None,
         "2024-13-45T00:00:00.000Z", "2024-01-0xT00:00:00.000Z", "2024/01/05 10:00:00", "20240105", "2024-1-5 10:00:00", "soon"]


def kept(spark, **options):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    return {r.t for r in dedup.time_slice(df, "t", END, 7, **options).collect()}


def test_text_slices_compare_times(spark):
    inside = {"2024-01-03T10:00:00.000Z", "2024-01-10T05:00:00.000Z", "2024-01-10 09:59:59"}
    late = {"2024-01-10T10:00:00.000Z", "2024-01-11T00:00:00.000Z"}
    assert kept(spark, upper=True) == inside
    assert kept(spark) == inside | late
    other = {"2024/01/05 10:00:00", "20240105", "2024-1-5 10:00:00"}
    assert kept(spark, upper=True, layout=None) == inside | other
    assert kept(spark, upper=True, layout="slash") == {"2024/01/05 10:00:00"}
    assert kept(spark, layout="key") == {"20240105"}


def test_slice_rejects_say_why(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert tuple(dedup.slice_rejects(df, "t").first()) == (6, 3, 3)
    assert tuple(dedup.slice_rejects(df, "t", None).first()) == (6, 3, 0)


@pytest.mark.parametrize("kind,want", [("date", ["2024-01-04", "2024-01-10"]),
                                       ("timestamp_ntz", ["2024-01-03 10:00:00", "2024-01-10 09:00:00"])])
def test_slices_of_other_types(spark, kind, want):
    texts = ["2024-01-03", "2024-01-04", "2024-01-10", "2024-01-11"] if kind == "date" else [
        "2024-01-03 09:00:00", "2024-01-03 10:00:00", "2024-01-10 09:00:00", "2024-01-10 10:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind).alias("t"))
    assert [str(r.t) for r in dedup.time_slice(df, "t", dt.datetime.fromisoformat(END), 7, upper=True).collect()] == want


def test_day_bounds_reach_the_scan(spark, tmp_path):
    spec = clean.CLEAN_SPECS["volume_sign"]
    raw = spark.createDataFrame([tuple("2024-01-05T00:00:00.000Z" for _ in spec.columns)],
                                ", ".join(f"{c} string" for c in spec.columns))
    raw.write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(spark, clean.clean_table(spark.read.parquet(str(tmp_path / "raw")), spec, END, upper=True))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(create_time,2024-01-03)" in plan and "LessThan(create_time,2024-01-11)" in plan


def test_iso_short_cut_equals_the_layouts(spark):
    texts = [t for t in TEXTS if t] + [
        "2019-12-12T10:00:00.000Z", "2019-12-12T10:00:00.00aZ", "+019-12-12T10:00:00.000Z", "2019-02-30T10:00:00.000Z",
        "2019-12-12T24:00:00.000Z", "2019-12-12T1:000:00.000Z", "2019-12-12T10:00:60.000Z", "2019-12-12 10:00:00.000Z",
        "2019-12-12T10:00:00.123456Z", "2019-12-12T10:00:00+08:00", " 2019-12-12T10:00:00.000Z", "0001-01-01T00:00:00.000Z",
        "2019-12-12T-1:00:00.000Z", "2019-12-12T10:00:00.-12Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", timefmt.iso_to_ts("t").alias("quick"), timefmt.iso_to_ts(F.col("t")).alias("plain")).collect()
    assert [(r.t, r.quick) for r in both] == [(r.t, r.plain) for r in both]
    assert sum(r.quick is not None for r in both) >= 12


def test_undated_rows_are_in_every_slice_of_stock(spark):
    undated = {"NULL", "null", "", " ", "\\N", None, "2024-13-45T00:00:00.000Z", "2024-01-0xT00:00:00.000Z", "soon"}
    inside = {"2024-01-03T10:00:00.000Z", "2024-01-10T05:00:00.000Z", "2024-01-10 09:59:59", "2024/01/05 10:00:00", "20240105",
              "2024-1-5 10:00:00"}
    late = {"2024-01-10T10:00:00.000Z", "2024-01-11T00:00:00.000Z"}
    assert kept(spark, upper=True, undated=True) == inside | undated
    assert kept(spark, undated=True) == inside | late | undated
    spec = clean.CLEAN_SPECS["volume_stock"]
    texts = {"1": "2024-01-05T00:00:00.000Z", "2": "null", "3": "2001-13-45T00:00:00.000Z", "4": "2023-01-05T00:00:00.000Z"}
    raw = spark.createDataFrame([(i, t) for i, t in texts.items()], "id string, create_time string")
    raw = raw.select(*[F.col(c) if c in raw.columns else F.lit("x").alias(c) for c in spec.columns])
    assert {r.id for r in clean.clean_table(raw, spec, END).collect()} == {"1", "2", "3"}


def test_time_columns_leave_row_loops_that_the_jvm_compiles(spark, capsys):
    for spec in clean.CLEAN_SPECS.values():
        raw = spark.range(1).select(*[F.concat(F.col("id").cast("string"), F.lit(c)).alias(c) for c in spec.columns])
        clean._standard(raw, spec).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000
