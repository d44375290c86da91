"""Line timetable operators.

A *line* is a scheduled departure ``(leave_department_code, arrive_department_code, leave_time)``
with a run time in minutes and an unload time in hours.  ``leave_time`` is a time-of-day text;
it is normalised to seconds after midnight (``leave_secs``) and re-rendered as ``HH:mm:ss`` so
that ``8:30`` and ``08:30:00`` are the same departure and times order numerically (Q18).

The per-pair timetable is an ``array<struct>`` column (one row per department pair, bounded
by the departures of that pair in a day).  Nearest and next departure look it up with array
functions: no fan-out of rows, no window, no Python.  The schedule walk, which looks up once per
leg, joins ``departures_by_hour`` instead, so that no row carries a day's departures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nulls, timefmt

SRC, DST, LT = "leave_department_code", "arrive_department_code", "leave_time"

# --- fixed values -------------------------------------------------------------------------
PARTNER_TYPE = "partner"       # type forced on partner lines
EXCLUDED_BRANCH_TYPE = "airplane"  # branch lines of this type are not part of the network
# ------------------------------------------------------------------------------------------


def secs_to_text(secs: Column) -> Column:
    """Seconds after midnight -> ``HH:mm:ss`` (pure arithmetic, independent of time zones)."""
    return F.when(secs.isNotNull(), F.format_string(
        "%02d:%02d:%02d", (secs / 3600).cast("int"), ((secs / 60) % 60).cast("int"), (secs % 60).cast("int")))


def _normalize_leave_time(df: DataFrame) -> DataFrame:
    secs = timefmt.time_of_day_seconds(LT)
    return (nulls.drop_sentinel_rows(df, [LT])
            .withColumn("leave_secs", secs)
            .filter(F.col("leave_secs").isNotNull())
            .withColumn(LT, secs_to_text(F.col("leave_secs"))))


def merge_lines(trunk: DataFrame, branch: DataFrame, partner: DataFrame) -> DataFrame:
    """Union of trunk, branch (without ``airplane``) and partner lines (type ``partner``), one
    row per (leave, arrive, leave time): max run minutes and unload hours (NULL as 0), max type.
    Rows whose leave time is missing / a NULL spelling / not a time of day are dropped."""
    cols = [SRC, DST, LT, "run_minutes", "unload_time"]
    t = trunk.select(*cols, F.col("type").cast("string").alias("type"))
    b = branch.filter(F.col("type") != F.lit(EXCLUDED_BRANCH_TYPE)).select(*cols, F.col("type").cast("string"))
    p = partner.select(*cols, F.lit(PARTNER_TYPE).alias("type"))
    allv = _normalize_leave_time(t.unionByName(b).unionByName(p))
    return (allv.groupBy(SRC, DST, "leave_secs")
            .agg(F.first(LT).alias(LT),
                 F.max(F.coalesce(F.col("run_minutes").cast("long"), F.lit(0))).alias("run_minutes"),
                 F.max(F.coalesce(F.col("unload_time").cast("long"), F.lit(0))).alias("unload_time"),
                 F.max("type").alias("type"))
            .select(SRC, DST, LT, "leave_secs", "run_minutes", "unload_time", "type"))


def splice(lines: DataFrame) -> DataFrame:
    """Extend partner lines through the lines they connect to, then keep one row per
    (leave, arrive, leave time) with the max run and unload.

    * prepend: a line ``d`` arriving where a partner line ``a`` leaves gives
      ``(d.leave, a.arrive, d.leave_time, a.run + d.run, a.unload + d.unload)``;
    * append: a line ``d`` leaving where a partner line ``a`` arrives gives
      ``(a.leave, d.arrive, a.leave_time, a.run + d.run, a.unload + d.unload)``;
    * plus every original line.

    Only maxima survive, so the side whose leave time is not kept reduces exactly to its max run
    / unload per department pair (for a fixed connecting department the max of a sum over a
    product of rows is the sum of the maxima).  Both kinds then come out of one join: every line
    ``x`` meets the per-pair maxima of the pairs leaving ``x.arrive``; the row is a prepend
    candidate when that pair has a partner line and an append candidate when ``x`` itself is a
    partner line, and both have the key ``(x.leave, pair.arrive, x.leave_time)``.  One join, one
    aggregation of the lines, no fan-out beyond the pairs leaving each hub.
    """
    base = lines.select(SRC, DST, LT, "leave_secs", "run_minutes", "unload_time", "type")
    is_partner = F.col("type") == F.lit(PARTNER_TYPE)
    pair_max = (base.groupBy(F.col(SRC).alias("__pf_p_src"), F.col(DST).alias("__pf_p_dst"))
                .agg(F.max("run_minutes").alias("__pf_all_run"), F.max("unload_time").alias("__pf_all_unload"),
                     F.max(F.when(is_partner, F.col("run_minutes"))).alias("__pf_partner_run"),
                     F.max(F.when(is_partner, F.col("unload_time"))).alias("__pf_partner_unload")))
    x = base.withColumn("__pf_x_partner", is_partner)
    j = x.join(pair_max, x[DST] == pair_max["__pf_p_src"], "inner")
    as_prepend = F.col("__pf_partner_run").isNotNull()
    as_append = F.col("__pf_x_partner")
    run = F.greatest(F.when(as_prepend, F.col("run_minutes") + F.col("__pf_partner_run")),
                     F.when(as_append, F.col("run_minutes") + F.col("__pf_all_run")))
    unload = F.greatest(F.when(as_prepend, F.col("unload_time") + F.col("__pf_partner_unload")),
                        F.when(as_append, F.col("unload_time") + F.col("__pf_all_unload")))
    spliced = (j.filter(as_prepend | as_append)
               .select(F.col(SRC), F.col("__pf_p_dst").alias(DST), LT, "leave_secs",
                       run.alias("run_minutes"), unload.alias("unload_time")))
    original = base.select(SRC, DST, LT, "leave_secs", "run_minutes", "unload_time")
    return (original.unionByName(spliced)
            .groupBy(SRC, DST, "leave_secs")
            .agg(F.first(LT).alias(LT), F.max("run_minutes").alias("run_minutes"),
                 F.max("unload_time").alias("unload_time"))
            .select(SRC, DST, LT, "leave_secs", "run_minutes", "unload_time"))


def timetable(lines: DataFrame) -> DataFrame:
    """One row per department pair: ``tt`` = departures sorted by leave time, one entry per leave
    second (the one with the smallest run, then unload — the only one any lookup can pick).

    The array is bounded by construction: at most 86,400 entries (one per second of the day),
    however large the network grows.  ``hours[h]`` counts the departures before hour ``h``, so
    that a lookup only reads the departures of one hour."""
    per_second = (lines.groupBy(SRC, DST, F.col("leave_secs").alias("secs"))
                  .agg(F.min(F.struct(F.col("run_minutes").alias("run"), F.col("unload_time").alias("unload")))
                       .alias("best")))
    entry = F.struct(F.col("secs"), F.col("best.run").alias("run"), F.col("best.unload").alias("unload"))
    pairs = per_second.groupBy(SRC, DST).agg(F.sort_array(F.collect_list(entry)).alias("tt"))
    return pairs.withColumn("hours", F.transform(F.sequence(F.lit(0), F.lit(24)), lambda h: F.size(
        F.filter("tt", lambda x: x["secs"] < h * 3600))))


def _first_at_or_after(tt: Column, hours: Column, x: Column) -> Column:
    """1-based index into ``tt`` of the first departure whose second of day is >= ``x``
    (``size + 1`` when there is none): the departures before ``x``'s hour, plus the first position
    of ``x`` in the sorted concatenation of that hour's leave seconds and ``x``."""
    hour = F.least(F.floor(x / F.lit(3600)), F.lit(24)).cast("int")
    before = F.get(hours, hour)
    within = F.slice(tt, before + 1, F.coalesce(F.get(hours, hour + 1), before) - before)["secs"].cast("array<bigint>")
    x = x.cast("bigint")
    return before + F.array_position(F.sort_array(F.concat(within, F.array(x))), x)


def _micros_of_day(ts: Column, day0: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", day0, ts)


def _ceil_secs(us: Column) -> Column:
    return F.ceil(us.cast("double") / F.lit(1_000_000.0)).cast("bigint")


def departures_by_hour(tt: DataFrame) -> DataFrame:
    """The timetable as rows to join by (pair, hour of the ready time), hours 0 to 24 of every pair:
    ``secs`` and ``deps``, the departures inside the hour (3,600 at most), ``later``, the first one
    after it on the same day, and ``first``, the pair's first one of a day (hour 24 is the end of a day,
    after which only that is left)."""
    hour = F.col("hour")
    rows = tt.select(SRC, DST, "tt", "hours", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("hour"))
    before = F.get("hours", hour)
    upto = F.coalesce(F.get("hours", hour + 1), before)
    rows = rows.withColumn("deps", F.slice("tt", before + 1, upto - before)) \
        .withColumn("later", F.get("tt", upto)).withColumn("first", F.get("tt", 0))
    return rows.select(SRC, DST, "hour", F.col("deps.secs").cast("array<bigint>").alias("secs"), "deps", "later", "first")


def _nearest_cols(tt: Column, ts: Column, t_us: Column, k: Column) -> Column:
    pred, succ = F.get(tt, k - 2), F.get(tt, k - 1)     # last < ceil(t), first >= ceil(t)
    d_pred = t_us - pred["secs"].cast("bigint") * 1_000_000
    d_succ = succ["secs"].cast("bigint") * 1_000_000 - t_us
    return (F.when(ts.isNull(), F.get(tt, 0)).when(pred.isNull(), succ).when(succ.isNull(), pred)
            .when(d_succ < d_pred, succ).otherwise(pred))


def nearest_departure(df: DataFrame, tt: DataFrame, src_col: str, dst_col: str, depart_col: str) -> DataFrame:
    """Add ``run_minutes``, ``unload_time`` and ``line_leave_time`` of the departure of the pair
    (``src_col`` -> ``dst_col``) closest to ``depart_col`` on the same day (NULL when the pair
    has no line).  One left join with the per-pair timetable; the lookup is an insertion-point
    search with array functions in materialised columns, so it stays in whole-stage codegen."""
    t = tt.select(F.col(SRC).alias("__pf_s"), F.col(DST).alias("__pf_d"), F.col("tt").alias("__pf_tt"),
                  F.col("hours").alias("__pf_hours"))
    j = df.join(t, (df[src_col] == t["__pf_s"]) & (df[dst_col] == t["__pf_d"]), "left")
    tt_c, ts = F.col("__pf_tt"), F.col(depart_col)
    j = (j.withColumn("__pf_us", _micros_of_day(ts, F.date_trunc("DAY", ts).cast("timestamp_ntz")))
         .withColumn("__pf_k", _first_at_or_after(tt_c, F.col("__pf_hours"), _ceil_secs(F.col("__pf_us"))))
         .withColumn("__pf_best", _nearest_cols(tt_c, ts, F.col("__pf_us"), F.col("__pf_k"))))
    return (j.withColumn("run_minutes", F.col("__pf_best.run"))
            .withColumn("unload_time", F.col("__pf_best.unload"))
            .withColumn("line_leave_time", secs_to_text(F.col("__pf_best.secs")))
            .drop("__pf_s", "__pf_d", "__pf_tt", "__pf_hours", "__pf_us", "__pf_k", "__pf_best"))


def next_departure(df: DataFrame, tt: DataFrame, src_col: str, dst_col: str, ready_col: str) -> DataFrame:
    """Add ``start_time`` (next departure at/after ``ready_col``, rolling to the next day),
    ``end_time`` = start + run minutes, and ``next_ready`` = end + unload hours (codegen'd
    insertion-point lookup, as in ``nearest_departure``)."""
    t = tt.select(F.col(SRC).alias("__pf_s"), F.col(DST).alias("__pf_d"), F.col("tt").alias("__pf_tt"),
                  F.col("hours").alias("__pf_hours"))
    j = df.join(t, (df[src_col] == t["__pf_s"]) & (df[dst_col] == t["__pf_d"]), "left")
    tt_c, ready = F.col("__pf_tt"), F.col(ready_col)
    j = (j.withColumn("__pf_day0", F.date_trunc("DAY", ready).cast("timestamp_ntz"))
         .withColumn("__pf_k", _first_at_or_after(tt_c, F.col("__pf_hours"), _ceil_secs(_micros_of_day(ready, F.col("__pf_day0"))))))
    today, first_any = F.get(tt_c, F.col("__pf_k") - 1), F.get(tt_c, 0)
    start = F.when(today.isNotNull(), F.timestamp_add("SECOND", today["secs"].cast("long"), F.col("__pf_day0"))) \
        .otherwise(F.timestamp_add("SECOND", first_any["secs"].cast("long"),
                                   F.timestamp_add("DAY", F.lit(1), F.col("__pf_day0"))))
    run = F.when(today.isNotNull(), today["run"]).otherwise(first_any["run"])
    unload = F.when(today.isNotNull(), today["unload"]).otherwise(first_any["unload"])
    j = j.withColumn("start_time", start).withColumn("__pf_run", run).withColumn("__pf_unload", unload)
    end = F.timestamp_add("MINUTE", F.col("__pf_run").cast("long"), F.col("start_time"))
    return (j.withColumn("end_time", end)
            .withColumn("next_ready", timefmt.add_hours(F.col("end_time"), F.col("__pf_unload").cast("double"),
                                                        fractional=True))
            .drop("__pf_s", "__pf_d", "__pf_tt", "__pf_hours", "__pf_day0", "__pf_k", "__pf_run", "__pf_unload"))
