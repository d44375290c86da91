"""Organisation master: one active record per department code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedup


def org_dim(basic: DataFrame) -> DataFrame:
    """Latest active record per code: (code, prov_code, center).  Used by every job, so a
    repeated code in the master never multiplies rows (decision Q11)."""
    active = basic.filter(F.col("is_active") == F.lit("Y"))
    latest = dedup.latest_per_key(active, ["code"], ["create_time"], "all")
    return latest.select("code", "prov_code", "center")
