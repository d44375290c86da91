"""Record-version operators: latest / earliest record per key, time slices, upserts and
timestamp standardisation of whole tables.

Top-1 per key is a ``row_number`` window filtered to 1.  Catalyst rewrites that shape into a
partial ``WindowGroupLimit`` *before* the shuffle and a final one after it, so each map task
forwards at most one row per key: a key that holds a third of the table still sends only one
row per map task to its reducer.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nulls, timefmt


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return list(cols)


def _sort(cols, descending: bool) -> list[Column]:
    out = []
    for c in _names(cols):
        if isinstance(c, Column):
            out.append(c)  # caller supplied an explicit sort expression
        elif descending:
            out.append(F.col(c).desc_nulls_last())
        else:
            out.append(F.col(c).asc_nulls_last())
    return out


def top1_per_key(df: DataFrame, keys, sort_exprs: list[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``sort_exprs`` (a total order makes it deterministic)."""
    rn = "__pf_rn"
    w = Window.partitionBy(*_names(keys)).orderBy(*sort_exprs)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def _tie_breakers(df: DataFrame, keys, order_by, tie_breakers) -> list:
    if tie_breakers != "all":
        return _names(tie_breakers)
    used = {c for c in _names(keys) + _names(order_by) if isinstance(c, str)}
    # all remaining columns of orderable types, so equal-order duplicates resolve the same way
    # on every run; fully identical rows are interchangeable anyway.
    return [f.name for f in df.schema.fields
            if f.name not in used and not f.dataType.simpleString().startswith(("map", "array", "struct"))]


def latest_order(df: DataFrame, keys, order_by, tie_breakers="all") -> list[Column]:
    """The order that puts a key's latest version first (see ``latest_per_key``)."""
    return _sort(order_by, True) + _sort(_tie_breakers(df, keys, order_by, tie_breakers), True)


def latest_per_key(df: DataFrame, keys, order_by, tie_breakers="all") -> DataFrame:
    """Latest version per key: ``order_by`` descending (NULLS LAST), then ``tie_breakers``
    descending.  ``tie_breakers="all"`` uses every other column."""
    return top1_per_key(df, keys, latest_order(df, keys, order_by, tie_breakers))


def earliest_per_key(df: DataFrame, keys, order_by, tie_breakers="all") -> DataFrame:
    """Earliest version per key: ``order_by`` ascending with NULLS LAST (a record without a
    time is never the earliest), then ``tie_breakers`` ascending."""
    ties = _tie_breakers(df, keys, order_by, tie_breakers)
    return top1_per_key(df, keys, _sort(order_by, False) + _sort(ties, False))


#: Layouts that a text column's times start with: day-level bounds in them reach the scan.
DAY_LAYOUTS = {"iso": "%Y-%m-%d", "slash": "%Y/%m/%d", "key": "%Y%m%d"}
_DAY_SHAPES = {"iso": "0000-00-00", "slash": "0000/00/00", "key": "00000000"}


def _moment(value) -> _dt.datetime:
    return _dt.datetime.fromisoformat(value) if isinstance(value, str) else value


def _in_layout(col: str, layout: str) -> Column:
    shape = _DAY_SHAPES[layout]
    return F.translate(F.substring(col, 1, len(shape)), "123456789", "0" * 9) == F.lit(shape)


def time_slice(df: DataFrame, col: str, end, days: int | float = 7, upper: bool = False,
               layout: str | None = "iso", undated: bool = False) -> DataFrame:
    """Rows with ``end - days <= col`` (and ``col < end`` when ``upper``), as times whatever the type.

    Text columns are sliced in two stages.  Bounds at day level, in the layout that the column's texts
    start with (``DAY_LAYOUTS``), are plain text comparisons and reach the parquet/ORC scan; what
    they let through is parsed and compared exactly.  Null spellings, texts that are no time
    and texts of another layout are out; ``slice_rejects`` counts them.  ``layout=None`` takes texts of
    every known layout and pushes nothing.  Other types compare with literals, which reach the
    scan as they are.

    ``undated`` keeps the rows without a time (NULL, NULL spellings, texts that are no time) in every
    slice.  Texts are then all parsed, in whatever layout, since none can be told off by its beginning.
    """
    end = _moment(end)
    start = end - _dt.timedelta(days=days)
    dtype = dict(df.dtypes)[col]

    def bound(t: _dt.datetime, as_type: str = "timestamp_ntz") -> Column:
        return F.lit(t.isoformat(sep=" ")).cast(as_type)

    def next_day(t: _dt.datetime) -> _dt.datetime:
        """The first midnight that is not before ``t``."""
        day = t.replace(hour=0, minute=0, second=0, microsecond=0)
        return day if day == t else day + _dt.timedelta(days=1)

    def inside(at: Column, low: Column, high: Column) -> Column:
        return (at >= low) & (at < high) if upper else at >= low

    if dtype == "string":
        if undated:
            layout = None
        if layout is not None:
            day = DAY_LAYOUTS[layout]
            df = df.filter(F.col(col) >= F.lit(start.strftime(day)))
            if upper:
                df = df.filter(F.col(col) < F.lit(next_day(end).strftime(day)))
            df = df.filter(_in_layout(col, layout))
        at, low, high = timefmt.iso_to_ts(col), bound(start), bound(end)
        if upper:  # the parser appears once: its long expression would be evaluated for each bound
            span = (end - start) // _dt.timedelta(microseconds=1)
            kept = F.floor(F.timestamp_diff("MICROSECOND", low, at) / F.lit(span)) == 0
        else:
            kept = inside(at, low, high)
    elif dtype == "date":
        kept = inside(F.col(col), bound(next_day(start), "date"), bound(next_day(end), "date"))
    else:
        kind = "timestamp" if dtype == "timestamp" else "timestamp_ntz"
        kept = inside(F.col(col), bound(start, kind), bound(end, kind))
    return df.filter(F.coalesce(kept, F.lit(True)) if undated else kept)


def slice_rejects(df: DataFrame, col: str, layout: str | None = "iso") -> DataFrame:
    """One row on a text column: ``missing`` (NULL or a NULL spelling), ``no_time``, and ``other_layout``
    (a time in another layout), none of which a slice ever keeps."""
    missing = nulls.null_if_sentinel(col).isNull()
    at = timefmt.iso_to_ts(col)
    other = F.lit(False) if layout is None else ~_in_layout(col, layout)
    return df.agg(F.count_if(missing).alias("missing"), F.count_if(~missing & at.isNull()).alias("no_time"),
                  F.count_if(~missing & at.isNotNull() & other).alias("other_layout"))


def upsert_base(history: DataFrame, new: DataFrame, keys, order_by, tie_breakers="all") -> DataFrame:
    """History plus new rows, re-deduplicated to the latest version per key."""
    both = history.unionByName(new, allowMissingColumns=True)
    return latest_per_key(both, keys, order_by, tie_breakers)


def standardize_timestamps(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Bring the listed columns to TIMESTAMP_NTZ whatever their text layout."""
    types = dict(df.dtypes)
    cols = set(cols)
    return df.select(*[timefmt.to_ts(c, types[c]).alias(c) if c in cols else F.col(c) for c in df.columns])


def timestamp_rejects(raw: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One-row count per column of values that are present but do not parse (distributed agg)."""
    types = dict(raw.dtypes)
    aggs = []
    for c in cols:
        parsed = timefmt.to_ts(c, types[c])
        aggs.append(F.count_if(F.col(c).isNotNull() & parsed.isNull()).alias(f"{c}_rejects"))
    return raw.agg(*aggs)


def derive_time_keys(df: DataFrame, ts_col: str, names: Iterable[str]) -> DataFrame:
    """Add ``<ts_col>_<name>`` text keys (e.g. DATEASKEY, HOURSASKEY) for partitioning/reporting."""
    return df.withColumns({f"{ts_col}_{n.lower()}": timefmt.format_ts(ts_col, n) for n in names})


def shift_times(df: DataFrame, spec: dict) -> DataFrame:
    """``{out: (ts_col, amount, unit)}`` with unit in days|hours|minutes|seconds; a fractional
    amount for days/hours is applied as whole minutes (truncated)."""
    fns = {"days": timefmt.add_days, "hours": timefmt.add_hours}
    new = {}
    for out, (ts_col, amount, unit) in spec.items():
        amt = F.col(amount) if isinstance(amount, str) else amount
        if unit in fns:
            if isinstance(amount, str):
                t = dict(df.dtypes)[amount]
                is_frac = t in ("double", "float", "string") or t.startswith("decimal")   # text: read as a number
            else:
                is_frac = isinstance(amount, float)
            new[out] = fns[unit](ts_col, amt, fractional=is_frac)
        elif unit == "minutes":
            new[out] = timefmt.add_minutes(ts_col, amt)
        elif unit == "seconds":
            new[out] = timefmt.add_seconds(ts_col, amt)
        else:
            raise ValueError(f"unknown unit {unit!r}")
    return df.withColumns(new)
