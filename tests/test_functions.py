"""Column functions and table helpers not covered by the registered queries."""

import datetime as dt

from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.functions import timefmt
from parcelflow.operators import dedup
from parcelflow.operators import lines as L
from parcelflow.sources import readers

T = dt.datetime


def test_rejects_and_time_keys(spark):
    raw = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-13-01",), ("junk",), (None,)], "create_time string")
    assert raw.transform(lambda d: dedup.timestamp_rejects(d, ["create_time"])).collect()[0][0] == 2
    clean = dedup.standardize_timestamps(raw, ["create_time"])
    keys = dedup.derive_time_keys(clean, "create_time", ["DATEASKEY", "HOURSASKEY"]).collect()[0]
    assert (keys.create_time_dateaskey, keys.create_time_hoursaskey) == ("20240102", "2024010203")


def test_strict5_compact_time_and_patterns(spark):
    df = spark.createDataFrame([("2024-01-0203:04:05",), ("2024/01/02 03:04",), ("20240102",)], "s string")
    strict = [r[0] for r in df.select(timefmt.parse_ts_strict5("s")).collect()]
    assert strict == [T(2024, 1, 2, 3, 4, 5), None, T(2024, 1, 2)]       # slash layout is not among the five
    assert df.select(timefmt.format_text("s", "TIME")).first()[0] == "2024-01-0203:04:05"  # compact layout kept
    ts = spark.createDataFrame([(T(2024, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    assert ts.select(timefmt.format_pattern("t", "yyyy/MM"), timefmt.format_pattern("t", "")).first() == ("2024/01", None)
    assert ts.select(timefmt.format_ts("t", "NO_SUCH_NAME")).first()[0] is None


def test_register_views_for_sql_users(spark):
    readers.register_views({"pf_view_t": spark.createDataFrame([(1,), (2,)], "x int")})
    assert spark.sql("SELECT sum(x) FROM pf_view_t").first()[0] == 3


def test_line_info_contract(spark):
    lines = spark.createDataFrame([("A", "B", "8:00", 60, 1, "trunk")],
                                  "leave_department_code string, arrive_department_code string, leave_time string, "
                                  "run_minutes long, unload_time long, type string")
    merged = L.merge_lines(lines, lines.limit(0), lines.limit(0).drop("type"))
    info = schemas.conform(L.splice(merged), schemas.LINE_INFO)
    assert info.collect() == [("A", "B", "08:00:00", 60, 1)]
    assert [f.name for f in info.schema.fields] == [f.name for f in schemas.LINE_INFO.fields]


def test_iso_text_and_bounded_slice(spark):
    df = spark.createDataFrame([("2019-12-12T10:00:00.000Z", T(2024, 1, 1)), ("2019-12-12 10:00:01", T(2024, 1, 9)),
                                (None, T(2024, 1, 10))], "s string, create_time timestamp_ntz")
    assert [r[0] for r in df.select(timefmt.iso_to_ts("s")).collect()] == [T(2019, 12, 12, 10), T(2019, 12, 12, 10, 0, 1),
                                                                          None]
    sliced = dedup.time_slice(df, "create_time", "2024-01-10 00:00:00", days=7, upper=True)
    assert [r.create_time for r in sliced.collect()] == [T(2024, 1, 9)]


def test_shift_by_text_amounts(spark):
    df = spark.createDataFrame([(T(2024, 1, 1), "1.5"), (T(2024, 1, 1), "x"), (T(2024, 1, 1), None)],
                               "ts timestamp_ntz, h string")
    out = [r.plus for r in dedup.shift_times(df, {"plus": ("ts", "h", "hours")}).collect()]
    assert out == [T(2024, 1, 1, 1, 30), T(2024, 1, 1), T(2024, 1, 1)]
