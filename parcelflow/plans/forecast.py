"""Forecast job (E2): remaining legs and times of every unsigned waybill.

Steps (each a function returning a DataFrame, composed in ``run``):

  orgs        latest active org per code                                   (W2)
  line_info   merge trunk/branch/partner lines, splice partner lines       (U1 A1 J8 U2 A2)
  unsigned    active waybills ▷ signatures, org roles, next-day flag       (J4 J12 J13)
  stock       latest WAYBILL stock record per waybill                      (W3)
  loads       load ⋈ traffic ⋈ traffic detail ⋈ (detail ⟕ bags), latest per
              waybill, ⋈ waybill                                           (J1 J6 W4)
  nearest     the line departure nearest the actual departure              (J9)
  status      status, ready time and current department per waybill        (P10 P11 P12 P14)
  in_transit  goods on the road: the running leg                           (R6)
  walked      remaining route walked through the timetable                 (R1-R5, R7)
  result      in_transit ∪ walked, one batch                               (U4)

No step collects to the driver; the timetable stays a DataFrame (``array<struct>`` per pair)
joined to the legs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timefmt
from ..operators import dedup, joins
from ..session import discard, discarding, written
from ..operators import lines as L
from ..operators import route as R
from .orgs import org_dim

# --- fixed values -------------------------------------------------------------------------
LINE_TRUNK = "干线"    # both ends are centers
LINE_BRANCH = "支线"   # otherwise
STATUS_STOCK = "stock"
STATUS_NODEPART = "load_nodepart"
STATUS_NOARRIVE = "load_noarrive"
STATUS_ARRIVED = "load_arriveed"
WAY = "way"
OTHER = "other"
# Columns of the batch result, in order.
OUTPUT = ["waybill_number", "old_bill_time", "car_number", "bill_time", "goods_weight", "goods_volume", "goods_qty",
          "bill_weight", "bill_volume", "bill_qty", "leave_department_code", "arrive_department_code",
          "customer_pickup_department_code", "start_time", "end_time", "line_type", "waybill_type",
          "waybill_status", "next_day_arrive", "pre_org_code", "path_no", "depart_org_transfer",
          "arrive_org_transfer", "refresh_time", "create_time"]

# Cleaned tables that the job reads and the columns it reads of them (None: all, they break ties).  Those whose
# cleaning shuffles most come first (see ``stored``).
READS = {
    "volume_stock": None,
    "volume_load_detail": "waybill_number assignment_number create_time is_active",
    "volume_waybill": "id waybill_number goods_qty goods_volume goods_weight billing_department_code "
                      "receive_department_code customer_pickup_department_code bill_time is_active inflow_time",
    "volume_path": "id waybill_number waybill_route_codes",
    "volume_box": "waybill_number task_number waybill_weight waybill_volume valid_status",
    "volume_traffic_detail": "transport_task_id car_number transport_task_status actual_leave_department_time "
                             "plan_arrive_department_time actual_arrive_department_time is_active",
    "volume_load": "assignment_number leave_department_code arrive_department_code end_time is_active",
    "volume_traffic": "assignment_number transport_task_id is_active",
    "volume_sign": "waybill_number",
}
CLEANED = sorted(READS)
# ------------------------------------------------------------------------------------------
# What a load event says, in the order that breaks ties.
EVENT = ["car_number", "leave_department_code", "arrive_department_code", "depart_time", "arrive_time",
         "plan_arrive_time"]


def _ts(value) -> Column:
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(value)).cast("timestamp_ntz")


def line_type(center_a: Column, center_b: Column) -> Column:
    """Trunk when both ends are centers, else branch (one labelling for both outputs, Q8)."""
    both = F.coalesce((center_a == F.lit("Y")) & (center_b == F.lit("Y")), F.lit(False))
    return F.when(both, F.lit(LINE_TRUNK)).otherwise(F.lit(LINE_BRANCH))


def line_info(t: dict) -> DataFrame:
    merged = L.merge_lines(t["volume_line"], t["volume_branch_line"], t["volume_partner_line"])
    return L.splice(merged)


def next_day_flag(df: DataFrame, same_day: DataFrame, leave_prov: str, arrive_prov: str) -> DataFrame:
    """``next_day_arrive`` = 'Y' when the province pair is marked equal, else 'N' (pairs are
    reduced to one row first, so a repeated pair never multiplies rows)."""
    pairs = (same_day.groupBy(F.col("leave_province_code").alias("__pf_lp"),
                              F.col("arrive_province_code").alias("__pf_ap"))
             .agg(F.max(F.when(F.col("equal_province") == F.lit("Y"), F.lit(1)).otherwise(F.lit(0))).alias("__pf_eq")))
    j = df.join(pairs, (df[leave_prov] == pairs["__pf_lp"]) & (df[arrive_prov] == pairs["__pf_ap"]), "left")
    return j.withColumn("next_day_arrive", F.when(F.col("__pf_eq") == 1, F.lit("Y")).otherwise(F.lit("N"))) \
        .drop("__pf_lp", "__pf_ap", "__pf_eq")


def unsigned(t: dict, orgs: DataFrame) -> DataFrame:
    wb = t["volume_waybill"].filter(F.col("is_active") == F.lit("Y"))
    wb = joins.without(wb, t["volume_sign"], ["waybill_number"])
    wb = joins.with_org(wb, {"billing_department_code": "bill", "customer_pickup_department_code": "pickup"},
                        orgs, fields=["prov_code"])
    wb = next_day_flag(wb, t["volume_same_day"], "bill_prov_code", "pickup_prov_code")
    zero = F.lit(0.0)
    return wb.select(
        F.col("id").alias("waybill_id"), "waybill_number", "bill_time",
        F.coalesce("goods_weight", zero).alias("goods_weight"), F.coalesce("goods_volume", zero).alias("goods_volume"),
        F.coalesce("goods_weight", zero).alias("bill_weight"), F.coalesce("goods_volume", zero).alias("bill_volume"),
        F.coalesce("goods_qty", zero).alias("bill_qty"), "receive_department_code", "billing_department_code",
        "bill_prov_code", "pickup_prov_code", "next_day_arrive", "customer_pickup_department_code")


def latest_stock(t: dict) -> DataFrame:
    st = t["volume_stock"].filter(F.col("waybill_type") == F.lit("WAYBILL"))
    st = dedup.latest_per_key(st, ["waybill_number"], ["create_time"], "all")
    return st.select("waybill_number", F.col("department_code").alias("receive_org_code"),
                     F.col("stock_time").alias("in_stock_time"))


def load_events(t: dict, materialize: bool = False) -> DataFrame:
    """Latest load event per waybill with its transport times (bags unpacked), one row per waybill.

    The latest event is found in two steps.  What was scanned, a waybill or a bag, is reduced to its
    latest event first: all contents of a bag share its events, and what a binding adds (its weights)
    does not depend on the event, so the order of a waybill's events through one bag is the
    order of the bag's.  Then each bag is opened once, and the latest event per waybill is
    taken over the bags that held it and its own scans.  A bag scanned a thousand times
    with a thousand pieces gives a thousand rows.  Weights come from the bag binding, else from
    the waybill's latest active record.  With ``materialize`` the trips, the items' latest
    events and these with the bags opened are written, so that the disk holds the shuffles of one step at a time."""
    load = t["volume_load"].filter(F.col("is_active") == F.lit("1")) \
        .select("assignment_number", "leave_department_code", "arrive_department_code", "end_time")
    detail = t["volume_load_detail"].filter(F.col("is_active") == F.lit("1")) \
        .select(F.col("assignment_number").alias("__pf_an"), "waybill_number", F.col("create_time").alias("ld_create"))
    traffic = t["volume_traffic"].filter(F.col("is_active") == F.lit("Y")) \
        .select(F.col("assignment_number").alias("__pf_an2"), "transport_task_id")
    tdet = t["volume_traffic_detail"].filter((F.col("transport_task_status") != F.lit("CANCLE"))
                                             & (F.col("is_active") == F.lit("Y"))) \
        .select(F.col("transport_task_id").alias("__pf_tt"), "car_number",
                F.col("actual_leave_department_time").alias("depart_time"),
                F.col("actual_arrive_department_time").alias("arrive_time"),
                F.col("plan_arrive_department_time").alias("plan_arrive_time"))
    trips = (load.join(traffic, load["assignment_number"] == traffic["__pf_an2"], "inner")
             .join(tdet, F.col("transport_task_id") == tdet["__pf_tt"], "inner")
             .select("assignment_number", "end_time", *EVENT))
    trips = _materialize(trips, materialize, "trips")
    events = trips.join(detail, F.col("assignment_number") == detail["__pf_an"], "inner").select(
        "waybill_number", F.coalesce("ld_create", "end_time").alias("create_time"), *EVENT)
    by_item = _materialize(dedup.latest_per_key(events, ["waybill_number"], ["create_time"], EVENT), materialize, "items")
    discard(trips)
    opened = joins.unpack_containers(by_item, "waybill_number", t["volume_box"],
                                     box_filter=F.col("valid_status") == F.lit("1"),
                                     carry=["waybill_weight", "waybill_volume"])
    opened = _materialize(opened, materialize, "opened")
    discard(by_item)
    latest = dedup.latest_per_key(opened, ["waybill_number"], ["create_time"],
                                  [EVENT[0], "waybill_weight", "waybill_volume", *EVENT[1:]])
    wb = dedup.latest_per_key(
        t["volume_waybill"].filter(F.col("is_active") == F.lit("Y"))
        .select("id", "inflow_time", F.col("waybill_number").alias("__pf_wb"), F.col("goods_weight").alias("__pf_gw"),
                F.col("goods_volume").alias("__pf_gv")), ["__pf_wb"], ["inflow_time", "id"], [])
    j = latest.join(wb, latest["waybill_number"] == wb["__pf_wb"], "inner")
    return j.select("waybill_number", "car_number",
                    F.coalesce("waybill_weight", "__pf_gw", F.lit(0.0)).alias("goods_weight"),
                    F.coalesce("waybill_volume", "__pf_gv", F.lit(0.0)).alias("goods_volume"),
                    "leave_department_code", "arrive_department_code", "depart_time", "arrive_time",
                    "plan_arrive_time", "create_time")


def with_line_times(loads: DataFrame, info: DataFrame) -> DataFrame:
    """run / unload of the line departure nearest each load's actual departure."""
    tt = L.timetable(info)
    return L.nearest_departure(loads, tt, "leave_department_code", "arrive_department_code", "depart_time") \
        .drop("line_leave_time")


def status(wb: DataFrame, stk: DataFrame, hb: DataFrame, end_time, stock_only: str = "drop") -> DataFrame:
    """Status, ready time (``bill_time``) and current department per unsigned waybill that is in
    stock or on a load.  ``stock_only="stock"`` treats waybills without any load as in stock
    (the observed default drops them, Q7)."""
    end = _ts(end_time)
    s = stk.select(F.col("waybill_number").alias("__pf_s_wb"), F.col("receive_org_code").alias("stk_org"),
                   "in_stock_time")
    h = hb.select(F.col("waybill_number").alias("__pf_h_wb"), *[F.col(c).alias(f"hb_{c}") for c in hb.columns
                                                               if c != "waybill_number"])
    j = (wb.join(s, wb["waybill_number"] == s["__pf_s_wb"], "left")
         .join(h, F.col("waybill_number") == h["__pf_h_wb"], "left")
         .filter(F.col("__pf_s_wb").isNotNull() | F.col("__pf_h_wb").isNotNull()))
    hb_time = F.coalesce("hb_arrive_time", "hb_depart_time", "hb_create_time")
    has_hb = F.col("__pf_h_wb").isNotNull()
    in_stock = F.coalesce(F.col("in_stock_time") > hb_time, F.lit(False))
    if stock_only == "stock":
        in_stock = in_stock | (~has_hb & F.col("in_stock_time").isNotNull())
    dep, arr = F.col("hb_depart_time"), F.col("hb_arrive_time")
    st = (F.when(in_stock, F.lit(STATUS_STOCK))
          .when(has_hb & dep.isNull() & arr.isNull(), F.lit(STATUS_NODEPART))
          .when(has_hb & dep.isNotNull() & arr.isNull(), F.lit(STATUS_NOARRIVE))
          .when(has_hb & arr.isNotNull(), F.lit(STATUS_ARRIVED)))
    unload_min = F.coalesce(F.col("hb_unload_time"), F.lit(0)) * 60
    ready = (F.when(st == STATUS_STOCK, end)
             .when(st == STATUS_NODEPART, end)
             .when(st == STATUS_NOARRIVE, timefmt.add_minutes(F.greatest(F.col("hb_plan_arrive_time"), end), unload_min))
             .when(st == STATUS_ARRIVED, F.greatest(timefmt.add_minutes(arr, unload_min), end)))
    leave, arrive = F.col("hb_leave_department_code"), F.col("hb_arrive_department_code")
    # current department; goods on the road count for the arrival department
    current = (F.when(st == STATUS_STOCK, F.col("stk_org"))
               .when(st == STATUS_NODEPART, F.when(arrive.isNotNull(), leave))
               .when(st == STATUS_NOARRIVE, F.when(leave.isNotNull(), arrive))
               .when(st == STATUS_ARRIVED, arrive))
    return j.select(
        "waybill_id", "waybill_number", F.col("bill_time").alias("old_bill_time"), ready.alias("bill_time"),
        "goods_weight", "goods_volume", F.lit(1.0).alias("goods_qty"), "bill_weight", "bill_volume", "bill_qty",
        current.alias("current_org"), "billing_department_code", "bill_prov_code", "pickup_prov_code",
        "next_day_arrive", "customer_pickup_department_code", "in_stock_time", st.alias("waybill_status"),
        F.col("hb_depart_time").alias("depart_time"), F.col("hb_arrive_time").alias("arrive_time"),
        F.col("hb_car_number").alias("car_number"), leave.alias("leave_department_code"),
        arrive.alias("arrive_department_code"), F.col("hb_goods_weight").alias("hb_weight"),
        F.col("hb_goods_volume").alias("hb_volume"), F.col("hb_plan_arrive_time").alias("plan_arrive_time"))


def in_transit(st: DataFrame, orgs: DataFrame, refresh_time: str, create_time) -> DataFrame:
    """Goods on the road (departed, not arrived, plan known, arriving at a center): the running leg."""
    on_road = st.filter((F.col("waybill_status") == F.lit(STATUS_NOARRIVE))
                        & F.col("leave_department_code").isNotNull() & F.col("arrive_department_code").isNotNull()
                        & F.col("plan_arrive_time").isNotNull())
    j = joins.with_org(on_road, {"leave_department_code": "o1", "arrive_department_code": "o2"}, orgs,
                       fields=["center"])
    j = j.filter(F.col("o2_center") == F.lit("Y"))
    return j.select(
        "waybill_number", "old_bill_time", "car_number", F.col("depart_time").alias("bill_time"),
        F.col("hb_weight").alias("goods_weight"), F.col("hb_volume").alias("goods_volume"),
        F.lit(1.0).alias("goods_qty"), "bill_weight", "bill_volume", "bill_qty",
        "leave_department_code", "arrive_department_code", "customer_pickup_department_code",
        F.lit(None).cast("timestamp_ntz").alias("start_time"), F.col("plan_arrive_time").alias("end_time"),
        line_type(F.col("o1_center"), F.col("o2_center")).alias("line_type"),
        F.lit(WAY).alias("waybill_type"), F.lit(WAY).alias("waybill_status"), "next_day_arrive",
        F.col("leave_department_code").alias("pre_org_code"), F.lit(1).alias("path_no"),
        F.col("o1_center").alias("depart_org_transfer"), F.col("o2_center").alias("arrive_org_transfer"),
        F.lit(refresh_time).alias("refresh_time"), _ts(create_time).alias("create_time"))


def walked(st: DataFrame, path: DataFrame, info: DataFrame, orgs: DataFrame, refresh_time: str,
           create_time) -> DataFrame:
    """Remaining route of every located waybill walked through the timetable; legs touching a
    center are kept."""
    p = path.select(F.col("id").alias("path_id"), F.col("waybill_number").alias("__pf_p_wb"), "waybill_route_codes")
    located = st.filter(F.col("current_org").isNotNull() & F.col("bill_time").isNotNull())
    j = located.join(p, located["waybill_number"] == p["__pf_p_wb"], "inner").drop("__pf_p_wb")
    j = R.with_remaining(j, "waybill_route_codes", "current_org")
    # One walk per waybill record and path record; the waybill's attributes ride along.
    key = ["waybill_number", "waybill_id", "path_id"]
    carried = ["bill_time", "old_bill_time", "car_number", "goods_weight", "goods_volume",
               "goods_qty", "bill_weight", "bill_volume", "bill_qty", "waybill_status", "next_day_arrive",
               "customer_pickup_department_code"]
    legs = R.schedule_walk(j, L.timetable(info), key, "remaining", "bill_time", "waybill_status",
                           "leave_department_code", carry=carried)
    legs = joins.with_org(legs, {"src": "o1", "dst": "o2"}, orgs, fields=["center"])
    legs = legs.filter((F.col("o1_center") == F.lit("Y")) | (F.col("o2_center") == F.lit("Y")))
    return legs.select(
        "waybill_number", "old_bill_time", "car_number", "bill_time", "goods_weight", "goods_volume", "goods_qty",
        "bill_weight", "bill_volume", "bill_qty", F.col("src").alias("leave_department_code"),
        F.col("dst").alias("arrive_department_code"), "customer_pickup_department_code", "start_time", "end_time",
        line_type(F.col("o1_center"), F.col("o2_center")).alias("line_type"),
        F.col("waybill_status").alias("waybill_type"), F.lit(OTHER).alias("waybill_status"), "next_day_arrive",
        F.col("pre_org").alias("pre_org_code"), "path_no", F.col("o1_center").alias("depart_org_transfer"),
        F.col("o2_center").alias("arrive_org_transfer"), F.lit(refresh_time).alias("refresh_time"),
        _ts(create_time).alias("create_time"))


def _materialize(df: DataFrame, enabled: bool, tag: str) -> DataFrame:
    """A relation that several later steps read, written once to the shared checkpoint folder."""
    return written(df, tag) if enabled else df


def stored(t: dict, names=tuple(READS)) -> dict:
    """``t`` with the named cleaned tables written, as far as the job reads them (``READS``).  One is written
    after the other: the shuffle files of a cleaning are gone before the next begins."""
    return t | {n: written(t[n] if READS[n] is None else t[n].select(*READS[n].split()), n) for n in names}


def stages(t: dict, end_time: str, stock_only: str = "drop", materialize: bool = False) -> dict[str, DataFrame]:
    """All intermediate relations of the job (lazily planned unless ``materialize``, which
    checkpoints the relations that later steps share: org master, line info and status; the status is then
    computed step by step, each of which leaves only its result on the disk)."""
    orgs = _materialize(org_dim(t["volume_basic"]), materialize, "orgs")
    info = _materialize(line_info(t), materialize, "line_info")
    wb = unsigned(t, orgs)
    stk = latest_stock(t)
    loads = load_events(t)
    hb = with_line_times(loads, info)
    if materialize:
        spark = orgs.sparkSession
        with discarding(spark):
            with discarding(spark):
                held = written(load_events(t, materialize=True), "loads", keep=True)
            st = written(status(wb, written(stk, "stock"), with_line_times(held, info), end_time, stock_only),
                         "status", keep=True)
    else:
        st = status(wb, stk, hb, end_time, stock_only)
    return {"orgs": orgs, "line_info": info, "unsigned": wb, "stock": stk, "loads": loads, "nearest": hb,
            "status": st}


def line_info_out(info: DataFrame) -> DataFrame:
    """The spliced lines as the ``line_info`` table shows them."""
    return info.select(L.SRC, L.DST, L.LT, "run_minutes", "unload_time")


def result(t: dict, s: dict, end_time: str, create_time=None) -> DataFrame:
    """In-transit legs ∪ walked legs (columns ``OUTPUT``) from the stages."""
    create_time = create_time or end_time
    way = in_transit(s["status"], s["orgs"], end_time, create_time)
    other = walked(s["status"], t["volume_path"], s["line_info"], s["orgs"], end_time, create_time)
    return way.select(*OUTPUT).unionByName(other.select(*OUTPUT))


def run(t: dict, end_time: str, create_time=None, stock_only: str = "drop", materialize: bool = True) -> DataFrame:
    """The batch result.  With ``materialize`` the tables may be planned cleanings: each is computed in the step
    that reads it, the waybills, which two steps read, once."""
    if not materialize:
        return result(t, stages(t, end_time, stock_only), end_time, create_time)
    t = stored(t, ["volume_waybill"])
    s = stages(t, end_time, stock_only, materialize=True)
    discard(t["volume_waybill"])
    return result(t, s, end_time, create_time)
