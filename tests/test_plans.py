"""Plan-shape checks for the properties the design relies on at scale."""

from pyspark.sql import functions as F

from parcelflow.plans import registry as R

SF = "/root/testdata/sf0.001"


def _plan(spark, df):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # static plan: stable to inspect
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_top1_limits_before_the_shuffle(spark):
    p = _plan(spark, R.QUERIES["clean_latest_ties"](spark, SF))
    lines = p.splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line for line in lines[ex + 1:]), "no partial limit below the exchange"
    assert any("WindowGroupLimit" in line for line in lines[:ex]), "no final limit above the exchange"


def test_anti_and_semi_joins_are_planned_as_such(spark):
    assert "LeftAnti" in _plan(spark, R.QUERIES["without_two_keys"](spark, SF))
    assert "LeftSemi" in _plan(spark, R.QUERIES["within_two_keys"](spark, SF))


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(spark, R.QUERIES["without_two_keys"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p


def test_no_python_in_the_jobs(spark):
    for name in ["pipeline_unscan", "pipeline_warning", "schedule_walk", "nearest_departure"]:
        p = _plan(spark, R.QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_the_walk_meets_hours_not_timetables(spark):
    """Above the joins with the waybills no column holds a day's departures."""
    from parcelflow.operators import lines as L
    hours = L.departures_by_hour(L.timetable(R.merged_lines(spark, SF)))
    assert "tt" not in hours.columns and "hours" not in hours.columns
    p = _plan(spark, R.QUERIES["schedule_walk"](spark, SF))
    assert "tt#" not in p and "collect_list" not in p and "ArrowEvalPython" not in p
    assert p.count("__pf_l_deps") and "Exchange hashpartitioning(o_orderkey" not in p


def test_bucketed_cleaned_tables_join_without_a_shuffle(spark):
    from parcelflow.operators import dedup, joins
    from parcelflow.plans import clean, jobs
    from parcelflow.sources import derived
    raw = derived.logistics_tables(spark, SF)
    names = {n: f"parcelflow_bucketed_{n}" for n, spec in clean.CLEAN_SPECS.items() if spec.bucket_key}
    for n in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for batch in clean.BATCHES:
            run = jobs.run_clean(raw, batch, R.REFRESH_TIME, {n: t for n, t in names.items() if n in clean.BATCHES[batch]},
                                 days=None, fmt="parquet", buckets=8)
            assert all(df.count() > 0 for df in run.tables.values())
        t = {n: spark.table(name) for n, name in names.items()}
        open_ = joins.without(t["volume_waybill"].filter("is_active = 'Y'"), t["volume_sign"], ["waybill_number"])
        stock = dedup.latest_per_key(t["volume_stock"], ["waybill_number"], ["create_time"], [])
        both = open_.join(stock.select(F.col("waybill_number").alias("s")), F.col("waybill_number") == F.col("s"), "left")
        path = t["volume_path"].select(F.col("waybill_number").alias("p"), "waybill_route_codes")
        out = both.join(path, F.col("waybill_number") == F.col("p"))
        assert "Exchange" not in _plan(spark, out)
        assert out.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")
