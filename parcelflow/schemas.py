"""Output contracts of the jobs (column name and type), and a helper to conform a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

S, D, T = StringType(), DoubleType(), TimestampNTZType()


def _st(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


LINE_INFO = _st(("leave_department_code", S), ("arrive_department_code", S), ("leave_time", S),
                ("run_minutes", LongType()), ("unload_time", LongType()))

FORECAST = _st(("waybill_number", S), ("old_bill_time", T), ("car_number", S), ("bill_time", T),
               ("goods_weight", D), ("goods_volume", D), ("goods_qty", D), ("bill_weight", D), ("bill_volume", D),
               ("bill_qty", D), ("leave_department_code", S), ("arrive_department_code", S),
               ("customer_pickup_department_code", S), ("start_time", T), ("end_time", T), ("line_type", S),
               ("waybill_type", S), ("waybill_status", S), ("next_day_arrive", S), ("pre_org_code", S),
               ("path_no", IntegerType()), ("depart_org_transfer", S), ("arrive_org_transfer", S),
               ("refresh_time", S), ("create_time", T))

LOAD_WARNING = _st(("waybill_no", S), ("unload_org_code", S), ("unload_time", T), ("tray_time", T),
                   ("sort_org_code", S), ("sort_time", T), ("expect_place", S), ("refresh_time", S))

UNLOAD_UNSCAN = _st(("now_department_code", S), ("waybill_number", S), ("create_time", T), ("device_type", S),
                    ("assignment_number", S), ("waybill_route_codes", S), ("refresh_time", S))


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Select the contract's columns in order, cast to its types; fail on a missing column."""
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for contract: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])
