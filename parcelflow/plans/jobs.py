"""The four jobs end to end: inputs -> result -> sinks (the user-level entry points E1-E4).

Inputs are a dict of DataFrames (from ``sources.readers.read_dir`` / ``read_table`` or any other
reader); targets are paths or catalog table names.  Every write is a single distributed write
of the result; re-running a batch replaces exactly that batch.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation

from .. import schemas
from ..session import discarding, written
from ..sources import readers, sinks
from . import clean, forecast, unscan, warning


@dataclass
class CleanRun:
    """What a clean run wrote, read back, and the rejects it met: per table and time column the values
    that are present but no time.  Spark counts them while the rows pass; rows that are computed again
    after a lost executor may be counted again."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    rejects: dict[str, dict[str, int]] = field(default_factory=dict)


def run_clean(raw: dict, batch: int, end, targets: dict, days: float | None = clean.DEFAULT_WINDOW_DAYS,
              fmt: str = "orc", num_files: int | None = None, buckets: int | None = None) -> CleanRun:
    """Clean every table of ``batch`` that has a target and overwrite the target (first load creates
    it, later loads overwrite it in place and keep a catalog definition).

    With ``buckets``, catalog targets of tables with a join key (``CleanSpec.bucket_key``) are bucketed
    by it, so that the other jobs join them without a shuffle."""
    observations = {t: Observation() for t in clean.BATCHES[batch] if t in targets}
    run = CleanRun()
    for name, df in clean.run_batch(raw, batch, end, days, observations=observations).items():
        if name not in targets:
            continue
        target, key = targets[name], clean.CLEAN_SPECS[name].bucket_key
        if buckets and key and not sinks.is_path(target):
            sinks.write_bucketed(df, target, key, buckets, fmt)
        else:
            sinks.write_table(df, target, mode="overwrite", fmt=fmt, num_files=num_files)
        run.tables[name] = readers.read_table(df.sparkSession, target, fmt if sinks.is_path(target) else None)
        run.rejects[name] = dict(observations[name].get)
    return run


def run_upsert(raw: dict, targets: dict, buckets: int = 64) -> dict[str, DataFrame]:
    """Bring new records into base tables at paths (see ``clean.upsert_job``); returns the tables."""
    out = {}
    for name, target in targets.items():
        clean.upsert_job(raw[name], clean.CLEAN_SPECS[name], target, buckets)
        out[name] = readers.read_table(raw[name].sparkSession, target, "parquet")
    return out


def _stamp(end_time) -> str:
    return end_time.strftime("%Y-%m-%d %H:%M:%S") if isinstance(end_time, dt.datetime) else str(end_time)


def run_forecast(cleaned: dict, end_time, target: str, keep_days: int | None = 5, jdbc: dict | None = None,
                 create_time=None, line_target: str | None = None) -> DataFrame:
    """Forecast the batch ``end_time``, write it as partition ``batch_no=<end_time>`` (only that
    partition is replaced; an empty result leaves no rows of it), write the spliced lines to
    ``line_target``, optionally append the batch to a JDBC table, then drop batches older than
    ``keep_days``.  The result is computed once and read back for every sink; what the batch wrote on the way
    is discarded."""
    end = _stamp(end_time)
    spark = cleaned["volume_waybill"].sparkSession
    with discarding(spark):
        stages = forecast.stages(cleaned, end, materialize=True)
        if line_target:
            sinks.write_table(schemas.conform(forecast.line_info_out(stages["line_info"]), schemas.LINE_INFO),
                              line_target, mode="overwrite", fmt="parquet")
        result = written(schemas.conform(forecast.result(cleaned, stages, end, create_time), schemas.FORECAST),
                         "forecast", keep=True)
    if result.isEmpty():
        sinks.drop_batch(spark, target, end)
    else:
        sinks.write_partitioned(result, target, {"batch_no": "refresh_time"}, overwrite=True)
    if jdbc:
        sinks.write_jdbc(result, jdbc["url"], jdbc["table"], mode="append", properties=jdbc.get("properties"))
    if keep_days is not None:
        cutoff = dt.datetime.fromisoformat(end) - dt.timedelta(days=keep_days)
        sinks.expire_batches(spark, target, _stamp(cutoff))
    return result


def _report(result: DataFrame, contract, target: str, jdbc: dict | None) -> DataFrame:
    out = written(schemas.conform(result, contract), "report")
    sinks.write_table(out, target, mode="overwrite", fmt="parquet")
    if jdbc:
        sinks.write_jdbc(out, jdbc["url"], jdbc["table"], mode="overwrite", truncate=True,
                         properties=jdbc.get("properties"))
    return out


def run_load_warning(cleaned: dict, end_time, target: str, jdbc: dict | None = None) -> DataFrame:
    """Goods unloaded but not loaded; the report is replaced each run (decision Q14), and a
    JDBC copy is refreshed by truncate + insert when ``jdbc`` is given."""
    return _report(warning.run(cleaned, _stamp(end_time)), schemas.LOAD_WARNING, target, jdbc)


def run_unload_unscan(cleaned: dict, end_time, target: str, jdbc: dict | None = None,
                      time_col: str = "inflow_time") -> DataFrame:
    """Goods unloaded but never scanned on the sorter; replaced each run."""
    return _report(unscan.run(cleaned, _stamp(end_time), time_col), schemas.UNLOAD_UNSCAN, target, jdbc)
