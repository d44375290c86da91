"""Load-warning job (E3): goods unloaded at a center, still in stock there, neither loaded
again at that center nor signed for — with where they probably are now.

Plan (each step a DataFrame operator):
  unload  = unload scans at centers, latest per (item, dept), unpacked, latest per (waybill, dept)
  load    = load scans at centers, distinct, unpacked (only non-PC active scans)
  tray    = pallet bindings, as unload
  sort    = sorter scans, as unload but earliest
  valid   = unload  ▷ load (2 keys)  ▷ sign (1 key)  ⋉ stock (2 keys)
  result  = valid ⟕ tray ⟕ sort  + expected place
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from ..session import written
from .orgs import org_dim

# --- fixed values -------------------------------------------------------------------------
PLACE_READY_TO_LOAD = "可装车"   # sorted: can be loaded
PLACE_READY_TO_SORT = "可分拣"   # on a pallet, not sorted yet
PLACE_ON_PLATFORM = "在站台"     # neither: still on the unloading platform
# ------------------------------------------------------------------------------------------

OUTPUT = ["waybill_no", "unload_org_code", "unload_time", "tray_time", "sort_org_code", "sort_time",
          "expect_place", "refresh_time"]


def expected_place(sort_time, tray_time) -> Column:
    s = F.col(sort_time) if isinstance(sort_time, str) else sort_time
    t = F.col(tray_time) if isinstance(tray_time, str) else tray_time
    return (F.when(s.isNotNull(), F.lit(PLACE_READY_TO_LOAD))
            .when(t.isNotNull(), F.lit(PLACE_READY_TO_SORT))
            .otherwise(F.lit(PLACE_ON_PLATFORM)))


def _at_centers(scans: DataFrame, orgs: DataFrame, boxes: DataFrame, time: Callable | None,
                only_if: Column | None = None) -> DataFrame:
    """(waybill_no, org, t) of scans (item, org, t) at centers: bags unpacked, one row per waybill
    and department with the extreme ``time`` (``F.max`` or ``F.min``; no time when None).

    Scans of the same item are reduced before unpacking, so a bag that is scanned often meets
    its contents once per department."""
    at = joins.restrict_to_centers(scans, "org", orgs)
    extreme = [] if time is None else [time("t").alias("t")]
    flag = [] if only_if is None else [F.coalesce(only_if, F.lit(False)).alias("opens")]
    once = at.select(*at.columns, *flag).groupBy("item", "org", *(["opens"] if flag else []))
    once = once.agg(*extreme) if extreme else once.agg(F.count("*").alias("n")).drop("n")
    bags = joins.unpack_containers(once, "item", boxes, out_col="waybill_no",
                                   only_if=F.col("opens") if flag else None)
    if time is None:
        return bags.select("waybill_no", "org")
    return bags.groupBy("waybill_no", "org").agg(time("t").alias("t"))


def run(t: dict, refresh_time: str, materialize: bool = True) -> DataFrame:
    """``t``: cleaned unload/load detail, box, sign, stock and raw basic, pallet, scan tables.
    ``materialize`` writes the org master and the valid bag bindings, which all four
    unpacking steps share, once to the checkpoint folder."""
    orgs = org_dim(t["volume_basic"])
    box = t["volume_box"].filter(F.col("valid_status") == F.lit("1")).select("task_number", "waybill_number")
    if materialize:
        orgs, box = written(orgs, "orgs"), written(box, "box")

    def scans(name: str, org: str, time: str = "create_time", *more: str) -> DataFrame:
        return t[name].select(F.col("waybill_number").alias("item"), F.col(org).alias("org"), F.col(time).alias("t"), *more)

    unload = _at_centers(scans("volume_unload_detail", "now_department_code"), orgs, box, F.max) \
        .select("waybill_no", F.col("org").alias("unload_org_code"), F.col("t").alias("unload_time"))
    load = _at_centers(scans("volume_load_detail", "leave_department_code", "create_time", "device_type", "is_active"),
                       orgs, box, None,
                       only_if=(F.col("device_type") != F.lit("PC")) & (F.col("is_active") == F.lit("1"))) \
        .withColumnRenamed("org", "load_org_code")
    tray = _at_centers(scans("volume_pallet_detail", "org_code"), orgs, box, F.max) \
        .select("waybill_no", F.col("org").alias("tray_org_code"), F.col("t").alias("tray_time"))
    sort = _at_centers(scans("volume_scan", "operation_org_code"), orgs, box, F.min) \
        .select("waybill_no", F.col("org").alias("sort_org_code"), F.col("t").alias("sort_time"))

    valid = joins.without(unload, load, ["waybill_no", "unload_org_code"], ["waybill_no", "load_org_code"])
    valid = joins.without(valid, t["volume_sign"], ["waybill_no"], ["waybill_number"])
    valid = joins.within(valid, t["volume_stock"], ["waybill_no", "unload_org_code"],
                         ["waybill_number", "department_code"])

    tray = tray.withColumnRenamed("waybill_no", "__pf_t_wb")
    sort = sort.withColumnRenamed("waybill_no", "__pf_s_wb")
    out = (valid
           .join(tray, (valid["waybill_no"] == tray["__pf_t_wb"]) & (valid["unload_org_code"] == tray["tray_org_code"]),
                 "left")
           .join(sort, (F.col("waybill_no") == sort["__pf_s_wb"]) & (F.col("unload_org_code") == sort["sort_org_code"]),
                 "left"))
    return (out.withColumn("expect_place", expected_place("sort_time", "tray_time"))
            .withColumn("refresh_time", F.lit(refresh_time)).select(*OUTPUT))
