"""Property checks on generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parcelflow.operators import dedup, joins

KEYS = st.sampled_from(["a", "b", "c", None])
TIMES = st.one_of(st.none(), st.integers(0, 5).map(lambda h: dt.datetime(2024, 1, 1, h)))
ROWS = st.lists(st.tuples(KEYS, TIMES, st.integers(0, 3)), min_size=0, max_size=25)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "k string, t timestamp_ntz, v int"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(ROWS)
def test_latest_is_idempotent_and_unique(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    once = dedup.latest_per_key(df, ["k"], ["t"])
    assert _rows(dedup.latest_per_key(once, ["k"], ["t"])) == _rows(once)
    keys = [r[0] for r in once.collect()]
    assert len(keys) == len(set(keys)) == len({r[0] for r in rows})


@SETTINGS
@given(ROWS, ROWS)
def test_anti_plus_semi_is_left(spark, left, right):
    a = spark.createDataFrame(left, SCHEMA)
    b = spark.createDataFrame(right, SCHEMA)
    anti, semi = joins.without(a, b, ["k", "v"]), joins.within(a, b, ["k", "v"])
    assert sorted(_rows(anti) + _rows(semi), key=repr) == _rows(a)
    present = {(r[0], r[2]) for r in right if r[0] is not None}
    assert all((r[0], r[2]) in present for r in semi.collect())


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["I1", "I2", "B1", "B2"]), st.integers(0, 3)), max_size=12),
       st.lists(st.tuples(st.sampled_from(["B1", "B2", "B3"]), st.sampled_from(["W1", "W2", "W3"])), max_size=8))
def test_unpack_equals_left_join_coalesce(spark, items, boxes):
    it = spark.createDataFrame(items, "item string, n int")
    bx = spark.createDataFrame(boxes, "task_number string, waybill_number string")
    got = joins.unpack_containers(it, "item", bx)
    contents = {}
    for c, w in boxes:
        contents.setdefault(c, []).append(w)
    want = [(w, n) for i, n in items for w in (contents.get(i) or [i])]
    assert _rows(got) == sorted(want, key=repr)
