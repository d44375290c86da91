"""Departure lookups in a timetable with thousands of departures a day, against brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from parcelflow.operators import lines as L

DAY = dt.datetime(2024, 3, 30)


def test_many_departures(spark):
    rnd = random.Random(4)
    secs = sorted(rnd.sample(range(86_400), 5_000))
    rows = [("A", "B", f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", 30 + i % 7, i % 3, "trunk") for i, s in enumerate(secs)]
    trunk = spark.createDataFrame(rows, "leave_department_code string, arrive_department_code string, leave_time string, "
                                        "run_minutes long, unload_time long, type string")
    none = trunk.limit(0)
    tt = L.timetable(L.merge_lines(trunk, none, none.drop("type")))
    moments = [0, 86_399, 3_600, 7_199, secs[0], secs[-1], secs[2_500]] + [rnd.randrange(86_400) for _ in range(300)]
    asked = spark.createDataFrame([(i, DAY + dt.timedelta(seconds=s)) for i, s in enumerate(moments)], "n long, t timestamp_ntz") \
        .withColumns({"src": F.lit("A"), "dst": F.lit("B")})
    following = {r.n: r.start_time for r in L.next_departure(asked, tt, "src", "dst", "t").collect()}
    nearest = {r.n: r.line_leave_time for r in L.nearest_departure(asked, tt, "src", "dst", "t").collect()}
    for i, s in enumerate(moments):
        later = [x for x in secs if x >= s]
        want = DAY + (dt.timedelta(seconds=later[0]) if later else dt.timedelta(days=1, seconds=secs[0]))
        assert following[i] == want
        x = min(secs, key=lambda c: (abs(c - s), c))
        assert nearest[i] == f"{x // 3600:02d}:{x // 60 % 60:02d}:{x % 60:02d}"
