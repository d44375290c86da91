"""Hand-written domain fixtures: edge rows per operator (bag vs loose item, ties, NULLs,
route positions, roll-over, missing lines, statuses)."""

import datetime as dt

from pyspark.sql import functions as F

from parcelflow.functions import nulls, timefmt
from parcelflow.operators import dedup, joins
from parcelflow.operators import lines as L
from parcelflow.operators import route as R
from parcelflow.plans import forecast, warning

T = dt.datetime


def rows(df, *cols):
    src = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in src.collect()), key=repr)


# ------------------------------------------------------------------ latest / earliest per key

def test_latest_per_key_versions_ties_and_nulls(spark):
    df = spark.createDataFrame([
        ("a", T(2024, 1, 1), "v1"), ("a", T(2024, 1, 2), "v2"),          # two versions
        ("b", T(2024, 1, 1), "x"), ("b", T(2024, 1, 1), "y"),            # tie on the order column
        ("c", None, "n1"), ("c", T(2023, 1, 1), "n2"),                   # NULL order value
        ("d", T(2024, 5, 5), "only"),                                    # single row
    ], "id string, inflow_time timestamp_ntz, v string")
    out = dedup.latest_per_key(df, ["id"], ["inflow_time"])
    assert rows(out, "id", "v") == [("a", "v2"), ("b", "y"), ("c", "n2"), ("d", "only")]
    early = dedup.earliest_per_key(df, ["id"], ["inflow_time"])
    assert rows(early, "id", "v") == [("a", "v1"), ("b", "x"), ("c", "n2"), ("d", "only")]
    # idempotent
    assert rows(dedup.latest_per_key(out, ["id"], ["inflow_time"])) == rows(out)


def test_time_slice_pushes_filter(spark, tmp_path):
    df = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 1, 9))], "id int, create_time timestamp_ntz")
    p = str(tmp_path / "t")
    df.write.parquet(p)
    sliced = dedup.time_slice(spark.read.parquet(p), "create_time", "2024-01-10 00:00:00", days=7)
    assert rows(sliced, "id") == [(2,)]
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(create_time), GreaterThanOrEqual(create_time" in plan


def test_upsert_base(spark):
    hist = spark.createDataFrame([("1", T(2024, 1, 1), 1.0), ("2", T(2024, 1, 1), 2.0)],
                                 "id string, inflow_time timestamp_ntz, v double")
    new = spark.createDataFrame([("2", T(2024, 1, 3), 20.0), ("3", T(2024, 1, 3), 3.0)],
                                "id string, inflow_time timestamp_ntz, v double")
    out = dedup.upsert_base(hist, new, ["id"], ["inflow_time"])
    assert rows(out, "id", "v") == [("1", 1.0), ("2", 20.0), ("3", 3.0)]


# ------------------------------------------------------------------ container unpacking, anti/semi joins

def test_unpack_containers_cases(spark):
    items = spark.createDataFrame([("W1", "D1"), ("B1", "D1"), ("B2", "D2"), ("B3", "D3")], "item string, dept string")
    boxes = spark.createDataFrame([
        ("B1", "W10", "1"), ("B1", "W11", "1"), ("B1", "W12", "1"),    # container with 3 waybills
        ("B2", "W20", "0"),                                          # invalid binding
    ], "task_number string, waybill_number string, valid_status string")
    out = joins.unpack_containers(items, "item", boxes, box_filter=F.col("valid_status") == "1")
    assert rows(out, "item", "dept") == [("B2", "D2"), ("B3", "D3"), ("W1", "D1"), ("W10", "D1"),
                                         ("W11", "D1"), ("W12", "D1")]
    gated = joins.unpack_containers(items, "item", boxes, box_filter=F.col("valid_status") == "1",
                                    only_if=F.col("dept") != "D1")
    assert ("B1", "D1") in rows(gated, "item", "dept")


def test_without_within_partition_the_left_side(spark):
    left = spark.createDataFrame([("W1", "D1"), ("W1", "D2"), ("W2", "D1"), (None, "D1")], "w string, d string")
    right = spark.createDataFrame([("W1", "D1"), ("W1", "D1"), ("W2", "D9")], "w string, d string")
    a = joins.without(left, right, ["w", "d"])
    s = joins.within(left, right, ["w", "d"])
    assert rows(s) == [("W1", "D1")]                       # duplicates on the right never multiply
    assert rows(a) == sorted([("W1", "D2"), ("W2", "D1"), (None, "D1")], key=repr)   # NULL key never matches
    assert a.count() + s.count() == left.count()           # anti + semi = left


# ------------------------------------------------------------------ timestamps and sentinels

def test_parse_layouts_and_impossible_dates(spark):
    vals = [("2019-12-12 10:00:01.5", T(2019, 12, 12, 10, 0, 1)), ("2019-12-1210:00:01", T(2019, 12, 12, 10, 0, 1)),
            ("2019/12/12 10:00", T(2019, 12, 12, 10, 0)), ("20191212", T(2019, 12, 12)), ("201912", T(2019, 12, 1)),
            ("9:05", T(1970, 1, 1, 9, 5)), ("2020-13-05", None), ("NULL", None), ("", None)]
    df = spark.createDataFrame([(v,) for v, _ in vals], "s string")
    got = [r[0] for r in df.select(timefmt.parse_ts("s")).collect()]
    assert got == [e for _, e in vals]


def test_sentinels(spark):
    df = spark.createDataFrame([("a",), ("NULL",), ("null",), ("",), (" ",), ("\\N",), (None,)], "s string")
    assert rows(nulls.drop_sentinel_rows(df, ["s"])) == [("a",)]


# ------------------------------------------------------------------ route and timetable

def _tt(spark, lines):
    df = spark.createDataFrame(lines, "leave_department_code string, arrive_department_code string, leave_time string, "
                                      "run_minutes long, unload_time long")
    norm = L.merge_lines(df.withColumn("type", F.lit("trunk")), df.limit(0).withColumn("type", F.lit("x")),
                         df.limit(0))
    return L.timetable(norm)


def test_remaining_route_positions(spark):
    df = spark.createDataFrame([
        ("A:1-B:2-C:3", "A"), ("A:1-B:2-C:3", "B"), ("A:1-B:2-C:3", "C"), ("A:1-B:2-C:3", "Z"),
        ("A:1-B:2-A:3-C:4", "A"),                      # repeated department: last occurrence counts
    ], "route string, cur string")
    out = [r[0] for r in R.with_remaining(df, "route", "cur").select("remaining").collect()]
    assert out == [["A", "B", "C"], ["B", "C"], None, None, ["A", "C"]]


def test_next_departure_exact_later_and_rollover(spark):
    tt = _tt(spark, [("A", "B", "08:00:00", 60, 1), ("A", "B", "9:30", 30, 0)])
    w = spark.createDataFrame([
        (1, T(2024, 1, 31, 8, 0)),      # exactly at a departure
        (2, T(2024, 1, 31, 8, 1)),      # later the same day
        (3, T(2024, 1, 31, 22, 0)),     # after the last: first departure next day (month end)
        (4, None),
    ], "k int, ready timestamp_ntz").withColumn("s", F.lit("A")).withColumn("d", F.lit("B"))
    out = {r.k: (r.start_time, r.end_time, r.next_ready)
           for r in L.next_departure(w, tt, "s", "d", "ready").collect()}
    assert out[1] == (T(2024, 1, 31, 8), T(2024, 1, 31, 9), T(2024, 1, 31, 10))
    assert out[2] == (T(2024, 1, 31, 9, 30), T(2024, 1, 31, 10), T(2024, 1, 31, 10))
    assert out[3] == (T(2024, 2, 1, 8), T(2024, 2, 1, 9), T(2024, 2, 1, 10))
    assert out[4] == (None, None, None)


def test_nearest_departure_ties_and_missing(spark):
    tt = _tt(spark, [("A", "B", "08:00", 60, 1), ("A", "B", "10:00", 90, 2)])
    w = spark.createDataFrame([(1, T(2024, 1, 1, 9, 0), "A", "B"), (2, T(2024, 1, 1, 9, 50), "A", "B"),
                               (3, T(2024, 1, 1, 9, 0), "A", "C")], "k int, dep timestamp_ntz, s string, d string")
    out = {r.k: (r.run_minutes, r.line_leave_time) for r in L.nearest_departure(w, tt, "s", "d", "dep").collect()}
    assert out[1] == (60, "08:00:00")       # equal distance: earlier departure wins
    assert out[2] == (90, "10:00:00")
    assert out[3] == (None, None)           # no line for the pair


def test_schedule_walk_full_stop_and_numbering(spark):
    tt = _tt(spark, [("A", "B", "08:00", 60, 1), ("B", "C", "12:00", 120, 0), ("C", "D", "06:00", 30, 0)])
    w = spark.createDataFrame([
        ("w1", "A:x-B:y-C:z-D:q", "A", "stock", None, T(2024, 1, 1, 7)),          # 3 full legs, roll-over on leg 3
        ("w2", "A:x-B:y-E:z-C:q", "A", "stock", None, T(2024, 1, 1, 7)),          # line missing at leg 2
        ("w3", "P:x-A:y-B:z", "A", "load_noarrive", "P", T(2024, 1, 1, 7)),       # in transit: numbering from 2
        ("w4", "A:x-B:y", "A", "stock", None, None),                              # NULL ready time
    ], "k string, route string, cur string, status string, leave string, ready timestamp_ntz")
    w = R.with_remaining(w, "route", "cur")
    out = R.schedule_walk(w, tt, "k", "remaining", "ready", "status", "leave").collect()
    by = {}
    for r in out:
        by.setdefault(r.k, []).append(r)
    w1 = sorted(by["w1"], key=lambda r: r.leg_idx)
    assert [(r.src, r.dst, r.start_time, r.end_time) for r in w1] == [
        ("A", "B", T(2024, 1, 1, 8), T(2024, 1, 1, 9)),
        ("B", "C", T(2024, 1, 1, 12), T(2024, 1, 1, 14)),
        ("C", "D", T(2024, 1, 2, 6), T(2024, 1, 2, 6, 30)),
    ]
    assert [r.path_no for r in w1] == [1, 2, 3] and [r.pre_org for r in w1] == [None, "A", "B"]
    # contiguous legs with non-decreasing times
    for a, b in zip(w1, w1[1:]):
        assert a.dst == b.src and a.end_time <= b.start_time
    assert [(r.src, r.dst) for r in by["w2"]] == [("A", "B")]
    assert [(r.path_no, r.pre_org) for r in by["w3"]] == [(2, "P")]
    assert "w4" not in by


def test_schedule_walk_of_long_routes_and_idle_waybills(spark):
    """More legs than one plan walks, departures within one hour, and waybills that end on the way."""
    stops = [f"S{i}" for i in range(22)]
    tt = _tt(spark, [(a, b, f"{h:02d}:{m:02d}", 10, 0) for a, b in zip(stops, stops[1:]) if a != "S15"
                     for h in range(24) for m in (5, 20, 50)])
    rows = [(f"w{i}", stops[i % 20:], T(2024, 2, 28, 23, (7 * i) % 60)) for i in range(60)] + [
        ("one", ["S1"], T(2024, 1, 1)), ("none", None, T(2024, 1, 1)), ("gap", ["S1", None, "S2"], T(2024, 1, 1))]
    w = spark.createDataFrame(rows, "k string, remaining array<string>, ready timestamp_ntz")
    got = {}
    for r in R.schedule_walk(w, tt, "k", "remaining", "ready").collect():
        got.setdefault(r.k, []).append((r.leg_idx, r.src, r.dst, r.start_time, r.end_time))
    want = {}
    for k, remaining, t in rows[:60]:
        for i, (a, b) in enumerate(zip(remaining, remaining[1:])):
            if a == "S15":
                break
            start = t.replace(second=0)
            while start < t or start.minute not in (5, 20, 50):
                start += dt.timedelta(minutes=1)
            t = start + dt.timedelta(minutes=10)
            want.setdefault(k, []).append((i, a, b, start, t))
    assert {k: sorted(v) for k, v in got.items()} == want and max(map(len, want.values())) == 15


def test_a_bag_scanned_often_is_opened_once(spark):
    """1,000 scans of one bag of 1,000 pieces: 1,000 rows come out of the join with its contents."""
    from parcelflow.operators import joins
    from parcelflow.plans import forecast
    n = 1000
    one = "2024-01-01 00:00:00"
    ids = spark.range(n)
    t = {
        "volume_load": spark.sql(f"SELECT 'A' AS assignment_number, 'D1' AS leave_department_code, 'D2' AS arrive_department_code, "
                                 f"TIMESTAMP_NTZ '{one}' AS end_time, '1' AS is_active"),
        "volume_load_detail": ids.selectExpr("'A' AS assignment_number", "'BAG' AS waybill_number", "'1' AS is_active",
                                             f"timestampadd(MINUTE, id, TIMESTAMP_NTZ '{one}') AS create_time"),
        "volume_traffic": spark.sql("SELECT 'A' AS assignment_number, 'T' AS transport_task_id, 'Y' AS is_active"),
        "volume_traffic_detail": spark.sql(
            f"SELECT 'T' AS transport_task_id, 'C' AS car_number, TIMESTAMP_NTZ '{one}' AS actual_leave_department_time, "
            "cast(NULL AS timestamp_ntz) AS actual_arrive_department_time, cast(NULL AS timestamp_ntz) AS plan_arrive_department_time, "
            "'NORMAL' AS transport_task_status, 'Y' AS is_active"),
        "volume_box": ids.selectExpr("'BAG' AS task_number", "concat('W', id) AS waybill_number", "'1' AS valid_status",
                                     "cast(id AS double) AS waybill_weight", "1.0D AS waybill_volume"),
        "volume_waybill": ids.selectExpr("cast(id AS string) AS id", f"TIMESTAMP_NTZ '{one}' AS inflow_time",
                                         "concat('W', id) AS waybill_number", "'Y' AS is_active", "9.0D AS goods_weight",
                                         "9.0D AS goods_volume"),
    }
    seen = []
    unpack = joins.unpack_containers

    def counting(*args, **kwargs):
        out = unpack(*args, **kwargs)
        seen.append(out.count())
        return out

    joins.unpack_containers = counting
    try:
        out = forecast.load_events(t).collect()
    finally:
        joins.unpack_containers = unpack
    assert seen == [n] and len(out) == n
    last = T(2024, 1, 1) + dt.timedelta(minutes=n - 1)
    assert all(r.create_time == last and r.goods_weight == float(r.waybill_number[1:]) for r in out)


def test_splice_partner_lines(spark):
    lines = spark.createDataFrame([
        ("X", "H", "06:00", 60, 1, "trunk"), ("H", "Y", "09:00", 30, 2, "partner"), ("Y", "Z", "11:00", 45, 0, "car"),
    ], "leave_department_code string, arrive_department_code string, leave_time string, run_minutes long, "
       "unload_time long, type string")
    merged = L.merge_lines(lines.filter("type = 'trunk'"), lines.filter("type = 'car'"),
                           lines.filter("type = 'partner'").drop("type"))
    got = rows(L.splice(merged), "leave_department_code", "arrive_department_code", "leave_time", "run_minutes",
               "unload_time")
    assert ("X", "Y", "06:00:00", 90, 3) in got        # prepended
    assert ("H", "Z", "09:00:00", 75, 2) in got        # appended
    assert len(got) == 5


# ------------------------------------------------------------------ statuses and places

def test_status_resolver_cases(spark):
    end = "2024-01-10 12:00:00"
    wb = spark.createDataFrame([("id-" + w, w, T(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, "D0", "P0", "P0", "N", "PK")
                                for w in ["s", "nd", "na_late", "na_early", "ar_late", "ar_early", "stock_only"]],
                               "waybill_id string, waybill_number string, bill_time timestamp_ntz, goods_weight double, "
                               "goods_volume double, bill_weight double, bill_volume double, bill_qty double, "
                               "billing_department_code string, bill_prov_code string, pickup_prov_code string, "
                               "next_day_arrive string, customer_pickup_department_code string")
    stk = spark.createDataFrame([("s", "DS", T(2024, 1, 9)), ("stock_only", "DS", T(2024, 1, 9))],
                                "waybill_number string, receive_org_code string, in_stock_time timestamp_ntz")
    hb_rows = [
        ("s", None, None, None, T(2024, 1, 8), None),
        ("nd", None, None, None, T(2024, 1, 9), None),
        ("na_late", T(2024, 1, 9), None, T(2024, 1, 11), T(2024, 1, 9), 2),
        ("na_early", T(2024, 1, 9), None, T(2024, 1, 9, 20), T(2024, 1, 9), 2),
        ("ar_late", T(2024, 1, 9), T(2024, 1, 10, 11), None, T(2024, 1, 9), 3),
        ("ar_early", T(2024, 1, 9), T(2024, 1, 9, 1), None, T(2024, 1, 9), 3),
    ]
    hb = spark.createDataFrame([(w, "C", 1.0, 1.0, "DL", "DA", d, a, p, c, 0, u)
                                for (w, d, a, p, c, u) in hb_rows],
                               "waybill_number string, car_number string, goods_weight double, goods_volume double, "
                               "leave_department_code string, arrive_department_code string, depart_time timestamp_ntz, "
                               "arrive_time timestamp_ntz, plan_arrive_time timestamp_ntz, create_time timestamp_ntz, "
                               "run_minutes long, unload_time long")
    st = {r.waybill_number: (r.waybill_status, r.bill_time, r.current_org)
          for r in forecast.status(wb, stk, hb, end).collect()}
    E = T(2024, 1, 10, 12)
    assert st["s"] == ("stock", E, "DS")
    assert st["nd"] == ("load_nodepart", E, "DL")
    assert st["na_late"] == ("load_noarrive", T(2024, 1, 11, 2), "DA")
    assert st["na_early"] == ("load_noarrive", T(2024, 1, 10, 14), "DA")
    assert st["ar_late"] == ("load_arriveed", T(2024, 1, 10, 14), "DA")
    assert st["ar_early"] == ("load_arriveed", E, "DA")
    assert st["stock_only"] == (None, None, None)                        # observed default: dropped later
    st2 = {r.waybill_number: r.waybill_status for r in forecast.status(wb, stk, hb, end, "stock").collect()}
    assert st2["stock_only"] == "stock"


def test_expected_place(spark):
    df = spark.createDataFrame([(T(2024, 1, 1), T(2024, 1, 1)), (None, T(2024, 1, 1)), (None, None)],
                               "sort_time timestamp_ntz, tray_time timestamp_ntz")
    got = [r[0] for r in df.select(warning.expected_place("sort_time", "tray_time")).collect()]
    assert got == [warning.PLACE_READY_TO_LOAD, warning.PLACE_READY_TO_SORT, warning.PLACE_ON_PLATFORM]


def test_line_type_labels(spark):
    df = spark.createDataFrame([("Y", "Y"), ("Y", "N"), ("N", None)], "a string, b string")
    got = [r[0] for r in df.select(forecast.line_type(F.col("a"), F.col("b"))).collect()]
    assert got == [forecast.LINE_TRUNK, forecast.LINE_BRANCH, forecast.LINE_BRANCH]
