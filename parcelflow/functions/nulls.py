"""NULL spellings and text rendering as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------
# Text spellings that mean "no value" in the operational feeds (compared after trimming,
# so a single blank and the empty string are both covered).
NULL_SPELLINGS = ["", "NULL", "null", "\\N"]
# ------------------------------------------------------------------------------------------


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_sentinel(c) -> Column:
    """TRUE when the value is NULL or one of the ``NULL_SPELLINGS`` (after trim)."""
    c = _as_col(c)
    return c.isNull() | F.trim(c.cast("string")).isin(*NULL_SPELLINGS)


def null_if_sentinel(c) -> Column:
    """The value, or a real NULL when it is spelled as one of ``NULL_SPELLINGS``."""
    c = _as_col(c)
    return F.when(~is_sentinel(c), c)


def normalize_nulls(df: DataFrame, cols=None) -> DataFrame:
    """Turn sentinel spellings into real NULLs in the given (default: all string) columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    cols = set(cols)
    spelled = ", ".join(f"r'{x}'" for x in NULL_SPELLINGS)
    return df.selectExpr(*[f"CASE WHEN trim(cast(`{c}` AS string)) NOT IN ({spelled}) THEN `{c}` END AS `{c}`"
                           if c in cols else f"`{c}`" for c in df.columns])


def drop_sentinel_rows(df: DataFrame, cols) -> DataFrame:
    """Keep rows whose every listed column holds a real value (not NULL, not a sentinel)."""
    cond = None
    for c in cols:
        ok = ~is_sentinel(c)
        cond = ok if cond is None else (cond & ok)
    return df.filter(cond)


def stringify(c, null_text: str | None = None) -> Column:
    """Render any column as text; timestamps as ``yyyy-MM-dd HH:mm:ss``; NULL -> ``null_text``."""
    c = _as_col(c)
    text = c.cast("string")
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def stringify_all(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Every column as text in one projection (for text sinks with all-string contracts)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f.name)
        if t.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(stringify(c, null_text).alias(f.name))
    return df.select(*out)
