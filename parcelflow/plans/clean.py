"""Clean job (E1): raw operational feeds -> latest version per primary key.

Per table: source-side time slice on ``create_time`` (a pushed-down scan filter), timestamp
standardisation of the time columns, then ``latest_per_key`` (one shuffle on the key).  Tables
of a batch are independent Spark jobs; the caller decides where each result goes (path or
catalog table, via ``sources.sinks``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import nulls
from ..operators import dedup
from ..sources import versions


@dataclass(frozen=True)
class CleanSpec:
    columns: tuple                    # output projection; a raw feed without one of them is an error
    ts_cols: tuple                    # columns brought to timestamps
    keys: tuple = ("id",)
    order_by: tuple = ("inflow_time",)
    bucket_key: str | None = None     # key that the jobs join the cleaned table by
    slice_col: str = "create_time"
    slice_layout: str | None = "iso"  # how the texts of ``slice_col`` start (``dedup.DAY_LAYOUTS``)
    undated: bool = False             # records without a time in ``slice_col`` are in every slice
    tie_breakers: object = "all"


def _spec(columns: str, ts_cols: str, keys: tuple = ("id",), bucket_key: str | None = None,
          undated: bool = False) -> CleanSpec:
    return CleanSpec(tuple(columns.split()), tuple(ts_cols.split()), keys, bucket_key=bucket_key, undated=undated)


# --- fixed values -------------------------------------------------------------------------
# Field list, time columns and dedup key per cleaned table (all ordered by inflow_time, latest
# first) and the two batches.
CLEAN_SPECS = {
    "volume_box": _spec(
        "id waybill_number task_number leave_department_code waybill_type waybill_weight waybill_volume create_time "
        "alter_time handle_time valid_status inflow_time",
        "create_time handle_time inflow_time"),
    "volume_load": _spec(
        "id assignment_number car_number status leave_department_code arrive_department_code begin_time end_time "
        "leave_department_time arrive_department_time immediately transport_type create_time is_active device_type "
        "inflow_time",
        "begin_time end_time leave_department_time arrive_department_time create_time inflow_time"),
    "volume_load_detail": _spec(
        "id waybill_number assignment_number shipment_type leave_department_code arrive_department_code create_time "
        "device_type is_active operate_department_code inflow_time",
        "create_time inflow_time"),
    "volume_path": _spec(
        "id waybill_number leave_department_code arrive_department_code waybill_route_codes create_time inflow_time",
        "create_time inflow_time", bucket_key="waybill_number"),
    "volume_sign": _spec(
        "id waybill_number operation_department_code sign_time create_time is_active inflow_time",
        "sign_time create_time inflow_time", bucket_key="waybill_number"),
    "volume_stock": _spec(
        "id waybill_number department_code final_station stock_time create_time waybill_type waybill_weight "
        "waybill_volume next_department_code inflow_time",
        "stock_time create_time inflow_time", bucket_key="waybill_number", undated=True),
    "volume_traffic": _spec(
        "id assignment_number transport_task_id create_time is_active inflow_time",
        "create_time inflow_time"),
    "volume_traffic_detail": _spec(
        "transport_task_id car_number leave_department_code arrival_status arrive_department_code "
        "transport_task_status plan_leave_department_time actual_leave_department_time plan_arrive_department_time "
        "actual_arrive_department_time create_time is_active inflow_time",
        "plan_leave_department_time actual_leave_department_time plan_arrive_department_time "
        "actual_arrive_department_time create_time inflow_time",
        keys=("transport_task_id",)),
    "volume_unload_detail": _spec(
        "id waybill_number assignment_number pre_bill_number shipment_type create_time scan_status device_type "
        "is_active now_department_code inflow_time",
        "create_time inflow_time"),
    "volume_waybill": _spec(
        "id waybill_number goods_qty goods_volume goods_weight billing_department_code receive_department_code "
        "customer_pickup_department_code bill_time waybill_is_active create_time is_active inflow_time",
        "bill_time create_time inflow_time", bucket_key="waybill_number"),
}
BATCHES = {
    1: ["volume_box", "volume_load", "volume_load_detail", "volume_path", "volume_sign"],
    2: ["volume_stock", "volume_traffic", "volume_traffic_detail", "volume_unload_detail", "volume_waybill"],
}
DEFAULT_WINDOW_DAYS = 7
# ------------------------------------------------------------------------------------------


def rejects_of(spec: CleanSpec) -> list:
    """Aggregates over a frame with ``__pf_raw_<time column>`` beside the parsed columns: values that are
    present but no time."""
    return [F.count_if(F.col(f"__pf_raw_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in spec.ts_cols]


def _standard(raw: DataFrame, spec: CleanSpec, observation: Observation | None = None) -> DataFrame:
    """The configured fields with real NULLs and timestamps; a missing field is an error.  An
    ``observation`` counts the rejects while the rows pass."""
    missing = [c for c in spec.columns if c not in raw.columns]
    if missing:
        raise ValueError(f"the feed lacks configured columns {missing}")
    plain = nulls.normalize_nulls(raw.select(*spec.columns))
    if observation is None:
        return dedup.standardize_timestamps(plain, spec.ts_cols)
    both = dedup.standardize_timestamps(
        plain.select("*", *[F.col(c).alias(f"__pf_raw_{c}") for c in spec.ts_cols]), spec.ts_cols)
    return both.observe(observation, *rejects_of(spec)).select(*spec.columns)


def clean_table(raw: DataFrame, spec: CleanSpec, end, days: float | None = DEFAULT_WINDOW_DAYS,
                upper: bool = False, observation: Observation | None = None) -> DataFrame:
    """Slice (``slice_col >= end - days``, and ``< end`` when ``upper``; no slice when ``days`` is None),
    read NULL spellings and time texts, keep the latest version per key.  ``observation`` receives the
    rejects per time column among the rows of the slice when the result is computed."""
    df = raw if days is None else dedup.time_slice(raw, spec.slice_col, end, days, upper, spec.slice_layout, spec.undated)
    return dedup.latest_per_key(_standard(df, spec, observation), list(spec.keys), list(spec.order_by), spec.tie_breakers)


def time_rejects(raw: DataFrame, spec: CleanSpec) -> DataFrame:
    """One row: per time column, how many values are present but no time (they become NULL)."""
    return dedup.timestamp_rejects(nulls.normalize_nulls(raw.select(*spec.columns)), spec.ts_cols)


def run_batch(raw_tables: dict, batch: int, end, days: float | None = DEFAULT_WINDOW_DAYS,
              specs: dict | None = None, observations: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """Clean every table of a batch (an error if one is missing); returns lazily planned frames."""
    specs = specs or CLEAN_SPECS
    missing = [t for t in BATCHES[batch] if t not in raw_tables]
    if missing:
        raise ValueError(f"batch {batch} lacks the tables {missing}")
    if isinstance(end, str):
        end = dt.datetime.fromisoformat(end)
    seen = observations or {}
    return {t: clean_table(raw_tables[t], specs[t], end, days, observation=seen.get(t)) for t in BATCHES[batch]}


def clean_all(raw_tables: dict, end, days: float | None = DEFAULT_WINDOW_DAYS) -> dict[str, DataFrame]:
    """Both batches; dimension tables (not in ``CLEAN_SPECS``) pass through unchanged."""
    out = dict(raw_tables)
    for b in BATCHES:
        out.update(run_batch(raw_tables, b, end, days))
    return out


def upsert_job(new_raw: DataFrame, spec: CleanSpec, target: str, buckets: int = 64) -> int | None:
    """Base-table refresh that ends in the table: cleans the new records and brings them into the path
    table ``target`` (``sources.versions``), of which only the buckets that hold new keys are read and
    written.  Returns the load's number, None for an empty slice."""
    return versions.upsert(_standard(new_raw, spec), target, list(spec.keys), list(spec.order_by),
                           spec.tie_breakers, buckets)


def upsert_table(history: DataFrame, new_raw: DataFrame, spec: CleanSpec) -> DataFrame:
    """Base-table refresh: history ∪ new records, re-deduplicated.  An empty slice (a one-row
    ``isEmpty`` probe of the raw feed) leaves its cleaning out of the plan; the history is brought to one version per key
    either way."""
    keys, order = list(spec.keys), list(spec.order_by)
    if new_raw.isEmpty():
        return dedup.latest_per_key(history, keys, order, spec.tie_breakers)
    return dedup.upsert_base(history, _standard(new_raw, spec), keys, order, spec.tie_breakers)
