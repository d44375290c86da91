"""Unloaded-not-scanned goods as a continuous report.

The batch job (``plans.unscan``) lists, per run, goods unloaded at a center that its sorter never
scanned.  As a stream the same goods are reported once, as soon as no scan can come any more: unload
scans and sorter scans are two streams, joined on (waybill, department) and on a time window around the
unloading, and an unload scan whose window has passed the watermark without a match is a row of the report.

State holds the scans of two windows and the allowed delay, whatever has gone through the stream.  Bags, the org
master and routes are static sides, read anew by each micro-batch.  The file sink writes every row
once, also after a restart from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import joins
from ..plans.unscan import OUTPUT


def unscanned(unload: DataFrame, scans: DataFrame, boxes: DataFrame, orgs: DataFrame, path: DataFrame,
              within: str = "1 day", delay: str = "1 hour", time_col: str = "inflow_time") -> DataFrame:
    """The report's rows (``plans.unscan.OUTPUT`` without the refresh time).

    ``unload`` and ``scans`` are streaming, the rest static; ``orgs`` is the org master of
    ``plans.orgs.org_dim``.  ``within``: how long before or after the unloading a scan counts; ``delay``: how
    late a record may come.  Records without a time are never reported.
    """
    arrived = unload.select("waybill_number", "now_department_code", F.col(time_col).alias("create_time"),
                            "device_type", "assignment_number")
    # Watermarks need a zoned time; the zone-less one is what the report shows.
    arrived = arrived.withColumn("__pf_e", F.col("create_time").cast("timestamp")).withWatermark("__pf_e", delay)
    arrived = joins.restrict_to_centers(arrived, "now_department_code", orgs)
    arrived = joins.unpack_containers(arrived, "waybill_number", boxes, box_filter=F.col("valid_status") == F.lit("1"))
    seen = scans.select(F.col("waybill_number").alias("__pf_w"), F.col("operation_org_code").alias("__pf_o"),
                        F.col("create_time").cast("timestamp").alias("__pf_t")).withWatermark("__pf_t", delay)
    met = arrived.join(seen, F.expr(
        f"waybill_number = __pf_w AND now_department_code = __pf_o AND __pf_t >= __pf_e - INTERVAL {within} "
        f"AND __pf_t <= __pf_e + INTERVAL {within}"), "left_outer")
    missed = met.filter(F.col("__pf_w").isNull()).drop("__pf_w", "__pf_o", "__pf_t", "__pf_e")
    routes = path.select(F.col("waybill_number").alias("__pf_p"), "waybill_route_codes")
    out = missed.join(routes, F.col("waybill_number") == F.col("__pf_p"), "left")
    return out.select(*[c for c in OUTPUT if c != "refresh_time"])


def start_unscanned(unload: DataFrame, scans: DataFrame, boxes: DataFrame, orgs: DataFrame, path: DataFrame, target: str,
                    checkpoint_path: str, available_now: bool = True, **options) -> StreamingQuery:
    """Start the report into the parquet folder ``target`` (returns the running query)."""
    rows = unscanned(unload, scans, boxes, orgs, path, **options)
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target)
