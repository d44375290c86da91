"""Registered queries: one per operator of the inventory, each over the whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame built from the parquet tables
in ``sf_dir`` (or from data Spark derives from them).  The twin DuckDB SQL of each key lives in
``plans.oracle``; output column names are identical on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import nulls, timefmt
from ..operators import dedup, joins
from ..operators import lines as lines_ops
from ..operators import route as route_ops
from .. import schemas
from ..session import checkpoint_dir, delete_at_exit, discarding, written
from ..sources import derived, readers, sinks
from ..streaming import incremental
from . import clean as clean_job
from . import forecast as forecast_job
from . import jobs
from . import unscan as unscan_job
from . import warning as warning_job

QUERIES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return derived.table(spark, sf_dir, name)




# ---------------------------------------------------------------- record versions

@register("clean_latest")
def q_clean_latest(spark, d):
    ev = table(spark, d, "events")
    return dedup.latest_per_key(ev, ["user_id", "event_type"], ["ts"], ["event_id"])


@register("clean_latest_ties")
def q_clean_latest_ties(spark, d):
    li = table(spark, d, "lineitem")
    return dedup.latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], "all")


@register("clean_earliest")
def q_clean_earliest(spark, d):
    ev = table(spark, d, "events")
    return dedup.earliest_per_key(ev, ["user_id", "event_type"], ["ts"], ["event_id"])


@register("clean_time_slice")
def q_clean_time_slice(spark, d):
    ev = dedup.time_slice(table(spark, d, "events"), "ts", dt.datetime(2024, 1, 31), days=7)
    return dedup.latest_per_key(ev, ["user_id", "event_type"], ["ts"], ["event_id"])


@register("upsert_base")
def q_upsert_base(spark, d):
    ev = table(spark, d, "events")
    history = ev.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")) \
        .withColumn("inflow_time", F.col("ts"))
    # re-delivered records: later inflow, corrected value
    new = ev.filter(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")) \
        .withColumn("inflow_time", timefmt.add_days("ts", 30)) \
        .withColumn("value", F.col("value") + F.lit(1.0))
    return dedup.upsert_base(history, new, ["event_id"], ["inflow_time"], [])


# ---------------------------------------------------------------- sentinels and time functions

@register("sentinel_filter")
def q_sentinel_filter(spark, d):
    ev = table(spark, d, "events")
    k = F.col("event_id") % 7
    spelled = (F.when(k == 0, F.lit("NULL")).when(k == 1, F.lit("")).when(k == 2, F.lit(" "))
               .when(k == 3, F.lit("null")).when(k == 4, F.lit("\\N")).otherwise(F.col("props")))
    etype = F.when(F.col("event_id") % 5 == 0, F.lit("NULL")).otherwise(F.col("event_type"))
    raw = ev.select("event_id", "user_id", spelled.alias("props"), etype.alias("event_type"))
    kept = nulls.drop_sentinel_rows(raw, ["props"])
    return nulls.normalize_nulls(kept, ["event_type"])


# text layouts used to print event timestamps before parsing them back, by event_id % 11
PRINT_LAYOUTS = ["yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-ddHH:mm:ss", "yyyy-M-d H:mm", "yyyy/MM/dd HH:mm:ss",
                 "yyyy/MM/dd HH:mm", "yyyy-MM-dd", "yyyyMMddHHmmss", "yyyyMMdd", "yyyyMM", "HH:mm:ss.SSS", "H:mm"]


@register("standardize_ts")
def q_standardize_ts(spark, d):
    ev = table(spark, d, "events")
    k = (F.col("event_id") % 11).cast("int")
    text = None
    for i, pat in enumerate(PRINT_LAYOUTS):
        v = F.date_format("ts", pat)
        text = F.when(k == i, v) if text is None else text.when(k == i, v)
    # every 13th value is an impossible calendar date and must come back as NULL
    bad = F.concat(F.date_format("ts", "yyyy"), F.lit("-13-"), F.date_format("ts", "dd"))
    text = F.when(F.col("event_id") % 13 == 0, bad).otherwise(text)
    raw = ev.select("event_id", k.alias("layout_no"), text.alias("ts_text"))
    return dedup.standardize_timestamps(raw.withColumn("parsed", F.col("ts_text")), ["parsed"]) \
        .select("event_id", "layout_no", "parsed")


def fmt_alias(name: str) -> str:
    return "fmt_" + "".join(ch if ch.isalnum() else "_" for ch in name.lower())


@register("format_ts")
def q_format_ts(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", *[timefmt.format_ts("ts", n).alias(fmt_alias(n)) for n in timefmt.FORMATS])


def _texts(spark, d) -> DataFrame:
    """Event times printed in one of the layouts, ISO, or as something that is no time."""
    ev = table(spark, d, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    full = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    odd = [iso, F.concat(full, F.lit("123456789012")), F.concat(F.lit("x"), full), F.lit(" "), full]
    k = (F.col("event_id") % (len(PRINT_LAYOUTS) + len(odd))).cast("int")
    text = None
    for i, v in enumerate([*(F.date_format("ts", pat) for pat in PRINT_LAYOUTS), *odd]):
        text = F.when(k == i, v) if text is None else text.when(k == i, v)
    return ev.select("event_id", k.alias("kind"), text.alias("text"))


@register("parse_five_layouts")
def q_parse_five_layouts(spark, d):
    return _texts(spark, d).select("event_id", "kind", timefmt.parse_ts_strict5("text").alias("parsed"))


@register("iso_to_ts")
def q_iso_to_ts(spark, d):
    return _texts(spark, d).select("event_id", "kind", timefmt.iso_to_ts("text").alias("parsed"),
                                   timefmt.parse_ts("text").alias("without_iso"))


@register("format_text")
def q_format_text(spark, d):
    return _texts(spark, d).select("event_id", timefmt.format_text("text", "TIME").alias("as_time"),
                                   timefmt.format_text("text", "DATEASKEY").alias("as_key"),
                                   timefmt.format_pattern(timefmt.parse_ts("text"), "dd.MM.yyyy HH").alias("as_pattern"),
                                   timefmt.format_pattern(timefmt.parse_ts("text"), None).alias("no_pattern"))


@register("minutes_between")
def q_minutes_between(spark, d):
    ev = table(spark, d, "events")
    origin = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return ev.select("event_id", timefmt.minutes_between("ts", origin).alias("minutes"),
                     timefmt.millis_between("ts", origin).alias("millis"))


@register("add_time")
def q_add_time(spark, d):
    ev = table(spark, d, "events").withColumn("frac_days", F.col("value") / F.lit(10.0)) \
        .withColumn("mins", (F.col("event_id") % 100).cast("int")) \
        .withColumn("secs", (F.col("event_id") % 1000).cast("int")) \
        .withColumn("whole_days", (F.col("event_id") % 40).cast("int"))
    out = dedup.shift_times(ev, {
        "plus_frac_days": ("ts", "frac_days", "days"),
        "plus_days": ("ts", "whole_days", "days"),
        "plus_frac_hours": ("ts", "value", "hours"),
        "plus_minutes": ("ts", "mins", "minutes"),
        "plus_seconds": ("ts", "secs", "seconds"),
    })
    return out.select("event_id", "plus_frac_days", "plus_days", "plus_frac_hours", "plus_minutes", "plus_seconds")


# ---------------------------------------------------------------- joins

def _boxes(spark, d) -> DataFrame:
    """Order lines as container contents: container = order key, content = line id."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("task_number"),
                     (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("waybill_number"),
                     F.col("l_quantity"), F.col("l_returnflag"))


@register("unpack_containers")
def q_unpack_containers(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return joins.unpack_containers(orders, "o_orderkey", _boxes(spark, d), out_col="item",
                                   box_filter=F.col("l_returnflag") == "N", carry=["l_quantity"]) \
        .select("o_orderkey", "o_custkey", "item", "l_quantity")


@register("unpack_only_if")
def q_unpack_only_if(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return joins.unpack_containers(orders, "o_orderkey", _boxes(spark, d), out_col="item",
                                   box_filter=F.col("l_returnflag") == "N",
                                   only_if=F.col("o_orderstatus") == "O") \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "item")


@register("without_one_key")
def q_without_one_key(spark, d):
    return joins.without(table(spark, d, "orders"), table(spark, d, "lineitem"), ["o_orderkey"], ["l_orderkey"])


def _event_days(spark, d, etype):
    ev = table(spark, d, "events").filter(F.col("event_type") == etype)
    return ev.select("event_id", "user_id", F.to_date("ts").alias("day"))


@register("without_two_keys")
def q_without_two_keys(spark, d):
    return joins.without(_event_days(spark, d, "view"), _event_days(spark, d, "click"), ["user_id", "day"])


@register("within_two_keys")
def q_within_two_keys(spark, d):
    return joins.within(_event_days(spark, d, "view"), _event_days(spark, d, "click"), ["user_id", "day"])


def nation_orgs(spark, d) -> DataFrame:
    """Nations as departments: code, province (= region) and a center flag (region 0 and 1)."""
    n = table(spark, d, "nation")
    return n.select(F.col("n_nationkey").alias("code"), F.col("n_regionkey").alias("prov_code"),
                    F.when(F.col("n_regionkey") <= 1, F.lit("Y")).otherwise(F.lit("N")).alias("center"))


@register("restrict_to_centers")
def q_restrict_to_centers(spark, d):
    return joins.restrict_to_centers(table(spark, d, "supplier"), "s_nationkey", nation_orgs(spark, d))


@register("keep_in_any")
def q_keep_in_any(spark, d):
    o = table(spark, d, "orders")
    return joins.keep_in_any(table(spark, d, "customer"),
                             [(o.filter(F.col("o_orderstatus") == "O"), "o_custkey"),
                              (o.filter(F.col("o_orderstatus") == "P"), "o_custkey")], ["c_custkey"])


# ---------------------------------------------------------------- lines and timetable


def merged_lines(spark, d) -> DataFrame:
    return lines_ops.merge_lines(*derived.supplier_lines(spark, d))


@register("merge_lines")
def q_merge_lines(spark, d):
    return merged_lines(spark, d)


@register("splice_lines")
def q_splice_lines(spark, d):
    return lines_ops.splice(merged_lines(spark, d))


@register("timetable")
def q_timetable(spark, d):
    tt = lines_ops.timetable(merged_lines(spark, d))
    rendered = F.array_join(F.transform("tt", lambda x: F.format_string(
        "%s/%d/%d", lines_ops.secs_to_text(x["secs"]), x["run"], x["unload"])), ",")
    return tt.select(lines_ops.SRC, lines_ops.DST, F.size("tt").alias("departures"), rendered.alias("schedule"))


@register("nearest_departure")
def q_nearest_departure(spark, d):
    w = derived.order_routes(spark, d).select(
        "o_orderkey", "t0", derived.dept_code("c_nationkey").alias("src"),
        derived.dept_code((F.col("c_nationkey") + 1) % derived.N_NATIONS).alias("dst"))
    tt = lines_ops.timetable(merged_lines(spark, d))
    return lines_ops.nearest_departure(w, tt, "src", "dst", "t0") \
        .select("o_orderkey", "t0", "src", "dst", "line_leave_time", "run_minutes", "unload_time")


@register("next_departure")
def q_next_departure(spark, d):
    w = derived.order_routes(spark, d).select(
        "o_orderkey", "t0", derived.dept_code("c_nationkey").alias("src"),
        derived.dept_code((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 3) % derived.N_NATIONS).alias("dst"))
    tt = lines_ops.timetable(merged_lines(spark, d))
    return lines_ops.next_departure(w, tt, "src", "dst", "t0") \
        .select("o_orderkey", "t0", "src", "dst", "start_time", "end_time", "next_ready")


# ---------------------------------------------------------------- routes

def route_legs(spark, d) -> DataFrame:
    w = derived.order_routes(spark, d)
    w = route_ops.with_remaining(w, "route", "current")
    return route_ops.legs(w, "o_orderkey", "remaining", "status", "leave_org", carry=["t0"])


@register("route_remaining")
def q_route_remaining(spark, d):
    return route_legs(spark, d).select("o_orderkey", "leg_idx", "src", "dst", "path_no", "pre_org")


@register("schedule_walk")
def q_schedule_walk(spark, d):
    tt = lines_ops.timetable(merged_lines(spark, d))
    w = route_ops.with_remaining(derived.order_routes(spark, d), "route", "current")
    return route_ops.schedule_walk(w, tt, "o_orderkey", "remaining", "t0", "status", "leave_org")


# ---------------------------------------------------------------- end-to-end jobs


REFRESH_TIME = "2001-09-01 00:00:00"


def cleaned_logistics(spark, d) -> dict:
    """Derived raw feeds -> cleaned tables (whole history: no time slice, the derived feeds span
    years while the slice is a 7-day production window; ``clean_time_slice`` covers S4)."""
    return clean_job.clean_all(derived.logistics_tables(spark, d), REFRESH_TIME, days=None)


SLICE_DAYS = 1000


def _register_clean(name: str) -> None:
    @register(f"clean_{name}")
    def q(spark, d):
        """One cleaned table from its raw text feed, with the production time slice."""
        raw = derived.logistics_tables(spark, d)[name]
        return clean_job.clean_table(raw, clean_job.CLEAN_SPECS[name], dt.datetime.fromisoformat(REFRESH_TIME), SLICE_DAYS)


for _name in clean_job.CLEAN_SPECS:
    _register_clean(_name)


@register("clean_slice_inside_day")
def q_clean_slice_inside_day(spark, d):
    """A slice of raw ISO texts that begins and ends inside a day, with an upper bound."""
    raw = derived.logistics_tables(spark, d)["volume_unload_detail"]
    return clean_job.clean_table(raw, clean_job.CLEAN_SPECS["volume_unload_detail"], "1996-03-16 03:00:00", 280, upper=True)


@register("slice_rejects")
def q_slice_rejects(spark, d):
    """What no slice of the feed can keep, by reason."""
    return dedup.slice_rejects(derived.logistics_tables(spark, d)["volume_unload_detail"], "create_time")


@register("time_rejects")
def q_time_rejects(spark, d):
    raw = derived.logistics_tables(spark, d)["volume_unload_detail"]
    return clean_job.time_rejects(raw, clean_job.CLEAN_SPECS["volume_unload_detail"])


@register("pipeline_clean")
def q_pipeline_clean(spark, d):
    """Both batches, all ten tables: one row per cleaned record."""
    cleaned = cleaned_logistics(spark, d)
    parts = [cleaned[n].select(F.lit(n).alias("table_name"), F.col(spec.keys[0]).alias("record_id"),
                               "create_time", "inflow_time") for n, spec in clean_job.CLEAN_SPECS.items()]
    return reduce(DataFrame.unionByName, parts)


@register("pipeline_unscan")
def q_pipeline_unscan(spark, d):
    return unscan_job.run(cleaned_logistics(spark, d), REFRESH_TIME)


@register("pipeline_warning")
def q_pipeline_warning(spark, d):
    return warning_job.run(cleaned_logistics(spark, d), REFRESH_TIME)


@register("expected_place")
def q_expected_place(spark, d):
    ev = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    base = ev.select("user_id", "day").distinct()
    tray = dedup.latest_per_key(ev.filter(F.col("event_type") == "view").select("user_id", "day", "ts"),
                                ["user_id", "day"], ["ts"], []).withColumnRenamed("ts", "tray_time")
    sort = dedup.earliest_per_key(ev.filter(F.col("event_type") == "click").select("user_id", "day", "ts"),
                                  ["user_id", "day"], ["ts"], []).withColumnRenamed("ts", "sort_time")
    out = base.join(tray, ["user_id", "day"], "left").join(sort, ["user_id", "day"], "left")
    return out.withColumn("expect_place", warning_job.expected_place("sort_time", "tray_time"))


# ---------------------------------------------------------------- forecast job (E2) and its stages


FORECAST_END = "2001-09-01 13:45:00"


def forecast_stages(spark, d) -> dict:
    return forecast_job.stages(cleaned_logistics(spark, d), FORECAST_END)


@register("forecast_unsigned")
def q_forecast_unsigned(spark, d):
    return forecast_stages(spark, d)["unsigned"]


@register("forecast_stock")
def q_forecast_stock(spark, d):
    return forecast_stages(spark, d)["stock"]


@register("load_chain")
def q_load_chain(spark, d):
    return forecast_stages(spark, d)["loads"]


@register("forecast_nearest")
def q_forecast_nearest(spark, d):
    return forecast_stages(spark, d)["nearest"]


@register("waybill_status")
def q_waybill_status(spark, d):
    st = forecast_stages(spark, d)["status"]
    return st.select("waybill_number", "old_bill_time", "bill_time", "waybill_status", "current_org",
                     "next_day_arrive")


@register("forecast_in_transit")
def q_forecast_in_transit(spark, d):
    s = forecast_stages(spark, d)
    return forecast_job.in_transit(s["status"], s["orgs"], FORECAST_END, FORECAST_END)


@register("pipeline_forecast")
def q_pipeline_forecast(spark, d):
    return forecast_job.run(cleaned_logistics(spark, d), FORECAST_END)


@register("line_info")
def q_line_info(spark, d):
    """The forecast's line table as its sink writes it, read back."""
    path = scratch(spark, "line_info")
    info = forecast_job.line_info_out(forecast_job.line_info(derived.logistics_tables(spark, d)))
    sinks.write_table(schemas.conform(info, schemas.LINE_INFO), path, mode="overwrite", fmt="parquet")
    return readers.read_table(spark, path, "parquet")


# ---------------------------------------------------------------- sources and sinks


def scratch(spark, tag: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder (never machine-local on a
    cluster; tests get a scratch folder only when no checkpoint dir is configured), deleted when
    the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/parcelflow-io/{tag}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path


def taken(spark, name: str) -> DataFrame:
    """The rows of a managed table, copied to the checkpoint folder; the table is dropped."""
    rows = written(readers.read_table(spark, name), "taken")
    sinks.drop_table(spark, name, "parcelflow_")
    return rows


@register("csv_round_trip")
def q_csv_round_trip(spark, d):
    cust = table(spark, d, "customer")
    base = scratch(spark, "csv")
    sinks.write_csv(cust, f"{base}/customer.csv")
    tables = readers.read_dir(spark, base, "csv", schemas={"customer": cust.schema})
    return tables["customer"]


def _fresh_table(tag: str) -> str:
    return f"parcelflow_{tag}_{uuid.uuid4().hex}"


@register("first_load")
def q_first_load(spark, d):
    """A managed table is made by its first load and read by name."""
    name = _fresh_table("first")
    sinks.write_table(table(spark, d, "customer"), name, fmt="parquet")
    return taken(spark, name)


@register("table_reload")
def q_table_reload(spark, d):
    """A later load replaces the rows and keeps the definition, whatever the frame's column order."""
    cust = table(spark, d, "customer")
    name = _fresh_table("reload")
    sinks.write_table(cust, name, fmt="parquet")
    again = cust.withColumn("c_acctbal", F.col("c_acctbal") + 1.0)
    sinks.write_table(again.select(*reversed(again.columns)), name, fmt="parquet")
    return taken(spark, name)


@register("path_reload")
def q_path_reload(spark, d):
    """A path table is reloaded from its own rows and switched to when the load is whole."""
    path = scratch(spark, "reload")
    sinks.write_table(table(spark, d, "customer"), path, fmt="parquet")
    rows = readers.read_table(spark, path, "parquet")
    sinks.write_table(rows.withColumn("c_acctbal", F.col("c_acctbal") + 1.0), path, fmt="parquet")
    return readers.read_table(spark, path, "parquet")


@register("string_table")
def q_string_table(spark, d):
    """A partitioned table of texts, loaded in two batches into one partition column, by name."""
    ev = _events_by_day(spark, d)
    name = _fresh_table("text")
    sinks.write_partitioned(ev.filter(F.col("event_id") % 2 == 0), name, {"batch_no": "day"}, stringify=True)
    sinks.write_partitioned(ev.filter(F.col("event_id") % 2 == 1), name, {"batch_no": "day"}, overwrite=False, stringify=True)
    return taken(spark, name)


@register("catalog_retention")
def q_catalog_retention(spark, d):
    """Batches of a catalog table that are older than the cutoff go; the later ones stay as they are."""
    name = _fresh_table("batches")
    sinks.write_partitioned(_events_by_day(spark, d), name, {"batch_no": "day"})
    sinks.expire_batches(spark, name, "2024-01-10")
    return taken(spark, name)


@register("append_to_batch")
def q_append_to_batch(spark, d):
    """Rows appended to batches that are there already, without replacing them."""
    ev = _events_by_day(spark, d)
    path = scratch(spark, "append")
    sinks.write_partitioned(ev, path, {"batch_no": "day"})
    again = ev.filter(F.col("day") == "2024-01-15").withColumn("event_id", -F.col("event_id"))
    sinks.write_partitioned(again, path, {"batch_no": "day"}, overwrite=False)
    return _read_batches(spark, path, ev)


@register("guarded_drop")
def q_guarded_drop(spark, d):
    """Drops stay inside the allowed prefix: the orders table survives, the customer table goes."""
    kept, gone = _fresh_table("keep"), _fresh_table("drop")
    sinks.write_table(table(spark, d, "orders"), kept, fmt="parquet")
    sinks.write_table(table(spark, d, "customer"), gone, fmt="parquet")
    refused = sinks.drop_table(spark, kept, "other_")
    dropped = sinks.drop_table(spark, gone, "parcelflow_")
    return taken(spark, kept).agg(F.count("*").alias("kept_rows")).select(
        "kept_rows", F.lit(refused).alias("foreign_dropped"),
        F.lit(dropped and not spark.catalog.tableExists(gone)).alias("own_dropped"))


def _sign_upsert(spark, d, new_rows: bool) -> DataFrame:
    raw = derived.logistics_tables(spark, d)["volume_sign"]
    spec = clean_job.CLEAN_SPECS["volume_sign"]
    history = clean_job.clean_table(raw, spec, None, days=None)
    new = raw.filter(F.col("id").cast("long") % 2 == 0) if new_rows else raw.filter(F.lit(False))
    new = new.withColumn("operation_department_code", F.lit("N01")) \
        .withColumn("inflow_time", F.lit("2030-01-01T00:00:00.000Z"))
    return clean_job.upsert_table(history, new, spec)


@register("upsert_table")
def q_upsert_table(spark, d):
    return _sign_upsert(spark, d, True)


@register("upsert_table_idle")
def q_upsert_table_idle(spark, d):
    return _sign_upsert(spark, d, False)


@register("upsert_job")
def q_upsert_job(spark, d):
    """A base table of signatures: a first load, corrected records of every second signature, and an
    empty slice, read back."""
    raw = derived.logistics_tables(spark, d)["volume_sign"]
    path = scratch(spark, "upsert")
    jobs.run_upsert({"volume_sign": raw}, {"volume_sign": path}, buckets=8)
    new = raw.filter(F.col("id").cast("long") % 2 == 0).withColumn("operation_department_code", F.lit("N01")) \
        .withColumn("inflow_time", F.lit("2030-01-01T00:00:00.000Z"))
    jobs.run_upsert({"volume_sign": new}, {"volume_sign": path})
    return jobs.run_upsert({"volume_sign": raw.filter(F.lit(False))}, {"volume_sign": path})["volume_sign"]


@register("job_clean_rejects")
def q_job_clean_rejects(spark, d):
    """The rejects that the clean job counted while it wrote its second batch."""
    raw = derived.logistics_tables(spark, d)
    base = scratch(spark, "clean")
    run = jobs.run_clean(raw, 2, REFRESH_TIME, {n: f"{base}/{n}" for n in clean_job.BATCHES[2]}, days=None, fmt="parquet")
    rows = [(n, c, k, run.tables[n].count()) for n, by_column in run.rejects.items() for c, k in by_column.items() if k]
    return spark.createDataFrame(rows, "table_name string, column_name string, rejects long, cleaned_rows long")


@register("job_clean_bucketed")
def q_job_clean_bucketed(spark, d):
    """Cleaned waybills and signatures in buckets of the waybill number: waybills nobody signed for."""
    raw, names = derived.logistics_tables(spark, d), {}
    for batch, n in ((2, "volume_waybill"), (1, "volume_sign")):
        names[n] = _fresh_table(n)
        jobs.run_clean(raw, batch, REFRESH_TIME, {n: names[n]}, days=None, fmt="parquet", buckets=8)
    open_ = written(joins.without(spark.table(names["volume_waybill"]), spark.table(names["volume_sign"]), ["waybill_number"])
                    .select("id", "waybill_number", "bill_time", "goods_qty"), "open")
    for n in names.values():
        sinks.drop_table(spark, n, "parcelflow_")
    return open_


@register("job_forecast")
def q_job_forecast(spark, d):
    """The forecast job with its sinks: an older batch and this one, of which retention leaves this one."""
    path = scratch(spark, "forecast")
    with discarding(spark):
        # Two batches in several jobs each read the cleaned tables: cleaned once.
        t = forecast_job.stored(cleaned_logistics(spark, d))
        with discarding(spark):
            stages = forecast_job.stages(t, "2001-08-01 00:00:00", materialize=True)
            old = schemas.conform(forecast_job.result(t, stages, "2001-08-01 00:00:00").limit(9), schemas.FORECAST)
            sinks.write_partitioned(old, path, {"batch_no": "refresh_time"})
        jobs.run_forecast(t, FORECAST_END, path, keep_days=5)
    return _read_batches(spark, path, spark.createDataFrame([], schemas.FORECAST))


@register("job_warning")
def q_job_warning(spark, d):
    path = scratch(spark, "warning")
    jobs.run_load_warning(cleaned_logistics(spark, d), REFRESH_TIME, path)
    return readers.read_table(spark, path, "parquet")


@register("job_unscan")
def q_job_unscan(spark, d):
    path = scratch(spark, "unscan")
    jobs.run_unload_unscan(cleaned_logistics(spark, d), REFRESH_TIME, path)
    return readers.read_table(spark, path, "parquet")


def _events_by_day(spark, d):
    ev = table(spark, d, "events")
    return ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


def _read_batches(spark, path, like):
    schema = StructType(list(like.schema.fields) + [StructField("batch_no", StringType(), True)])
    return spark.read.schema(schema).parquet(path)


@register("partition_overwrite")
def q_partition_overwrite(spark, d):
    ev = _events_by_day(spark, d)
    path = scratch(spark, "batches")
    sinks.write_partitioned(ev, path, {"batch_no": "day"}, overwrite=True)
    fix = ev.filter(F.col("day") == "2024-01-15").withColumn("value", F.col("value") + 1)
    sinks.write_partitioned(fix, path, {"batch_no": "day"}, overwrite=True)  # replaces that day only
    return _read_batches(spark, path, ev)


@register("expire_batches")
def q_expire_batches(spark, d):
    ev = _events_by_day(spark, d)
    path = scratch(spark, "retention")
    sinks.write_partitioned(ev, path, {"batch_no": "day"}, overwrite=True)
    sinks.expire_batches(spark, path, "2024-01-10")
    return _read_batches(spark, path, ev)


# ---------------------------------------------------------------- incremental clean on Structured Streaming


@register("stream_clean_latest")
def q_stream_clean_latest(spark, d):
    """The events feed streamed file by file through the incremental clean; the cleaned table
    must equal the batch result (same oracle as ``clean_latest``)."""
    schema = table(spark, d, "events").schema
    base = scratch(spark, "stream")
    q = incremental.start_incremental_clean(spark, d, schema, ["user_id", "event_type"], ["ts"],
                                            f"{base}/changes", f"{base}/_checkpoint", tie_breakers=["event_id"],
                                            file_glob="events.parquet")
    q.awaitTermination()
    incremental.fold(spark, f"{base}/changes", f"{base}/table", ["user_id", "event_type"], ["ts"], ["event_id"])
    return spark.read.parquet(f"{base}/table").drop(incremental.VERSION_COL)


# ---------------------------------------------------------------- role-playing org joins and province pairs

def _nation_org_dim(spark, d):
    n = table(spark, d, "nation")
    return n.select(F.col("n_nationkey").alias("code"),
                    F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("prov_code"),
                    F.when(F.col("n_regionkey") <= 1, F.lit("Y")).otherwise(F.lit("N")).alias("center"))


@register("org_roles")
def q_org_roles(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = (li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(o, F.col("l_orderkey") == o["o_orderkey"])
         .join(c, F.col("o_custkey") == c["c_custkey"]))
    j = joins.with_org(j, {"s_nationkey": "o1", "c_nationkey": "o2"}, _nation_org_dim(spark, d), fields=["center"])
    return j.select("l_orderkey", "l_linenumber", "o1_center", "o2_center",
                    forecast_job.line_type(F.col("o1_center"), F.col("o2_center")).alias("line_type"))


@register("next_day_flag")
def q_next_day_flag(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).withColumn("pickup_nation", (F.col("o_orderkey") % 25).cast("int"))
    j = joins.with_org(j, {"c_nationkey": "bill", "pickup_nation": "pickup"}, _nation_org_dim(spark, d),
                       fields=["prov_code"])
    same_day = derived.logistics_tables(spark, d)["volume_same_day"]
    out = forecast_job.next_day_flag(j, same_day, "bill_prov_code", "pickup_prov_code")
    return out.select("o_orderkey", "bill_prov_code", "pickup_prov_code", "next_day_arrive")
