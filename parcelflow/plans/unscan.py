"""Unloaded-not-scanned job (E4): goods unloaded at a center that were never scanned on that
center's sorter, with their planned route.

Plan: unload scans -> unpack bags (valid bindings) -> keep center departments (semi join) ->
drop (waybill, department) pairs present in sorter scans (anti join on two keys, distinct key
set first) -> attach the route (left join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from .orgs import org_dim

OUTPUT = ["now_department_code", "waybill_number", "create_time", "device_type", "assignment_number",
          "waybill_route_codes", "refresh_time"]


def run(t: dict, refresh_time: str, time_col: str = "inflow_time") -> DataFrame:
    """``t``: cleaned ``volume_unload_detail``, ``volume_box``, ``volume_path`` and raw
    ``volume_basic``, ``volume_scan``.  ``time_col`` picks the unload time column (Q12)."""
    orgs = org_dim(t["volume_basic"])
    unload = t["volume_unload_detail"].select(
        "waybill_number", "now_department_code", F.col(time_col).alias("create_time"), "device_type",
        "assignment_number")
    unload = joins.restrict_to_centers(unload, "now_department_code", orgs)
    unpacked = joins.unpack_containers(unload, "waybill_number", t["volume_box"],
                                       box_filter=F.col("valid_status") == F.lit("1"))
    not_scanned = joins.without(unpacked, t["volume_scan"], ["waybill_number", "now_department_code"],
                                ["waybill_number", "operation_org_code"])
    path = t["volume_path"].select(F.col("waybill_number").alias("__pf_wb"), "waybill_route_codes")
    out = not_scanned.join(path, not_scanned["waybill_number"] == path["__pf_wb"], "left").drop("__pf_wb")
    return out.withColumn("refresh_time", F.lit(refresh_time)).select(*OUTPUT)
